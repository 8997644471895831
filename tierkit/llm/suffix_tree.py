"""Language-model scores from a probabilistic suffix tree over bytes.

A text is its words, A-Z lower-cased, with one space between them and an end symbol; as words
hold no space, the probability of this byte sequence is the probability of the words. The tree
holds contexts of up to ``DEPTH`` bytes. A context is a candidate when it makes up at least
``CONTEXT_SHARE`` of all training positions, so there are at most ``DEPTH / CONTEXT_SHARE``
candidates for any corpus, with at most 257 bytes each; it is retained when its next-byte distribution diverges from that
of its suffix by ``DIVERGENCE`` bits or more. Each distribution is smoothed towards that of the
suffix, with ``PRIOR`` for each byte that follows it, and the root towards all bytes. With the prefixes of retained contexts the tree is an
automaton: every byte moves to the longest suffix state, and its probability there is summed.

The counts come from all training texts: byte runs, folded in the tasks and summed in Spark,
and, for the unigram base, the exact count of every word. Frequent words, at most
``1 / HEAD_SHARE``, are looked up in the tasks; the others are joined to their counts.

Words are told apart by 64-bit hashes.

Defined results: a null or empty text is one end symbol; texts are scored whole, whatever
their length; a null ``doc_id`` hashes like the empty string and so is a training row; rows
that repeat are trained on and scored one by one; without training texts every byte has the
probability 1 / 257 and every word count is 0; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.shared import held_out, stored
from tierkit.llm.words import Counter64, Lookup, Words, column, map_slices, mix, slices

DEPTH = 6
CONTEXT_SHARE = 5e-6
DIVERGENCE = 0.05
PRIOR = 6.0
HEAD_SHARE = 1e-5
END, START, BITS = 256, 257, 9
END_TOKEN = int(mix(np.full(1, 0xE0D, np.uint64)).view(np.int64)[0])
LANE = 2048
#: Rows of a block while the tree is built, in the driver
ROWS = 1024


def symbols(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one sequence, each after ``DEPTH`` start symbols; and where each begins."""
    size = w.end - w.start
    inside = ~w.space
    length = np.bincount(w.doc, size + 1, len(w.n)).astype(np.int64)
    length[w.n == 0] = 1
    first = np.concatenate(([0], np.cumsum(length + DEPTH)))
    out = np.full(first[-1], START, np.int64)
    # the bytes of a word keep their order; a separator follows each word
    within = np.cumsum(size + 1) - (size + 1)
    at = first[w.doc] + DEPTH + within - within[np.minimum(w.first[w.doc], max(len(within) - 1, 0))] if len(size) else within
    spread = np.repeat(at - (np.cumsum(size) - size), size)
    out[spread + np.arange(len(spread))] = w.data[inside]
    out[at + size] = 32
    out[first[1:] - 1] = END
    return out, first


def byte_runs(docs: DataFrame) -> DataFrame:
    """``code, n``: counts of every run of ``DEPTH + 1`` symbols, nine bits each, last one lowest."""

    def count(batches):
        counter = Counter64()
        for part in slices(batches):
            out, _ = symbols(Words(part.column("text"), lower=True))
            codes = np.zeros(len(out) - DEPTH, np.int64)
            for j in range(DEPTH + 1):
                codes = (codes << BITS) | out[j : j + len(codes)]
            codes = codes[out[DEPTH:] != START]
            full = counter.add(codes.view(np.uint64))
            if full:
                yield _pairs("code", *full)
        yield _pairs("code", *counter.fold())

    return docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: counts of every word, and of the end, by hash."""

    def count(batches):
        counter = Counter64()
        for part in slices(batches):
            w = Words(part.column("text"), lower=True)
            ends = np.full(len(w.n), END_TOKEN, np.int64).view(np.uint64)
            full = counter.add(np.concatenate((w.hash, ends)))
            if full:
                yield _pairs("word", *full)
        yield _pairs("word", *counter.fold())

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _pairs(name: str, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: column(keys), "n": column(counts.astype(np.int64))})


class Tree:
    """Automaton of the retained contexts: next state and log10 probability by symbol."""

    def __init__(self, depth: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray):
        self.used = np.unique(np.concatenate((symbol, context[depth == 1], [END, START])))
        width = len(self.used) + 1  # the last column stands for each byte never seen
        place = np.searchsorted(self.used, symbol)
        levels, retained = [], []
        for d in range(DEPTH + 1):
            own = depth == d
            codes, which = np.unique(context[own], return_inverse=True)
            if d == 0:
                codes, which = np.zeros(1, np.int64), np.zeros(own.sum(), np.int64)
            # a block of rows at a time: only the distributions themselves are held whole
            p, keep = np.empty((len(codes), width)), np.ones(len(codes), bool)
            rows = np.argsort(which, kind="stable")
            which, seat, times = which[rows], place[own][rows], n[own][rows]
            for at in range(0, len(codes), ROWS):
                to = min(at + ROWS, len(codes))
                mine = slice(*np.searchsorted(which, [at, to]))
                counts = np.zeros((to - at, width), np.float32)
                counts[which[mine] - at, seat[mine]] = times[mine]
                total = counts.sum(axis=1, keepdims=True)
                if d == 0:
                    prior = np.full((1, width), 1.0 / 257, np.float32)
                    prior[0, np.searchsorted(self.used, START)] = 0
                    p[at:to] = (counts + 257 * prior) / (total + 257)
                    continue
                above = levels[-1]
                parent = np.searchsorted(above[0], codes[at:to] & ((1 << BITS * (d - 1)) - 1))
                base = above[1][np.minimum(parent, len(above[0]) - 1)]
                kinds = np.float32(PRIOR) * (counts > 0).sum(axis=1, keepdims=True)
                some = p[at:to] = (counts + kinds * base) / (total + kinds)
                with np.errstate(divide="ignore", invalid="ignore"):
                    bits = np.where(some > 0, some * np.log2(some / base), 0)
                keep[at:to] = bits[:, :-1].sum(axis=1) >= DIVERGENCE
            levels.append((codes, p))
            retained.append(keep)
        # every state needs its suffix and its prefix
        for d in range(DEPTH, 1, -1):
            codes, above = levels[d][0][retained[d]], levels[d - 1][0]
            for wanted in (codes & ((1 << BITS * (d - 1)) - 1), codes >> BITS):
                at = np.minimum(np.searchsorted(above, wanted), len(above) - 1)
                retained[d - 1][at[above[at] == wanted]] = True
        states = [codes[keep] for (codes, _), keep in zip(levels, retained)]
        first = np.concatenate(([0], np.cumsum([len(s) for s in states])))
        self.score = np.empty((first[-1], width))
        for d, keep in enumerate(retained):
            self.score[first[d] : first[d + 1]] = levels[d][1][keep]
            levels[d] = None  # else all distributions are held beside the scores
        np.log10(np.maximum(self.score, 1e-30, out=self.score), out=self.score)
        self.next = np.zeros(self.score.shape, np.int32)
        for d in range(DEPTH + 1):
            for at in range(0, len(states[d]), ROWS):
                moved = (states[d][at : at + ROWS, None] << BITS) | np.append(self.used, 511)
                out = self.next[first[d] + at : first[d] + at + len(moved)]
                for e in range(1, min(d + 1, DEPTH) + 1):
                    wanted = moved & ((1 << BITS * e) - 1)
                    if len(states[e]):
                        to = np.minimum(np.searchsorted(states[e], wanted), len(states[e]) - 1)
                        hit = states[e][to] == wanted
                        out[hit] = (first[e] + to)[hit]
        self.column = np.full(512, width - 1, np.int32)
        self.column[self.used] = np.arange(width - 1)
        self.width = width

    def scores(self, w: Words) -> np.ndarray:
        """Log10 probability of every text."""
        out, first = symbols(w)
        seen = self.column[out]
        lanes = -(-len(seen) // LANE)
        padded = np.zeros(lanes * LANE + DEPTH, np.int32)
        padded[:DEPTH] = self.column[START]
        padded[DEPTH : DEPTH + len(seen)] = seen
        # lanes advance together; each reads the symbols before its own first to find its state
        window = np.lib.stride_tricks.as_strided(
            padded, (LANE + DEPTH, lanes), (padded.strides[0], LANE * padded.strides[0])
        )
        state = np.zeros(lanes, np.int32)
        logs = np.zeros((LANE, lanes), np.float32)
        following, score = self.next.reshape(-1), self.score.reshape(-1)
        for step in range(LANE + DEPTH):
            at = state * np.int32(self.width) + window[step]
            if step >= DEPTH:
                np.take(score, at, out=logs[step - DEPTH], mode="clip")
            state = following[at]
        flat = logs.T.reshape(-1)[: len(out)].astype(np.float64)
        flat[out == START] = 0
        sums = np.concatenate(([0.0], np.cumsum(flat)))
        return sums[first[1:]] - sums[first[:-1]]


def fit(training: DataFrame) -> Tree:
    """The tree of all training texts."""
    counted = stored(byte_runs(training), "runs")
    total = counted.agg(F.sum("n")).first()[0] or 0
    mask = F.element_at(F.lit([(1 << BITS * d) - 1 for d in range(DEPTH + 1)]), F.col("depth") + 1)
    entries = (
        counted.select(F.explode(F.lit(list(range(DEPTH + 1)))).alias("depth"), "code", "n")
        .select(
            "depth",
            F.shiftright("code", BITS).bitwiseAND(mask).alias("context"),
            F.col("code").bitwiseAND((1 << BITS) - 1).alias("symbol"),
            "n",
        )
        .groupBy("depth", "context", "symbol")
        .agg(F.sum("n").alias("n"))
    )
    frequent = (
        entries.groupBy("depth", "context").agg(F.sum("n").alias("all")).filter(F.col("all") >= CONTEXT_SHARE * total)
    )
    found = entries.join(frequent, ["depth", "context"], "left_semi").toArrow()
    depth, context, symbol, n = (found.column(c).to_numpy().astype(np.int64) for c in ("depth", "context", "symbol", "n"))
    del found
    order = np.lexsort((symbol, context, depth))
    depth, context, symbol, n = (x[order] for x in (depth, context, symbol, n))
    return Tree(depth, context, symbol, n)


def score(docs: DataFrame, parts: int = 7) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    training = docs.filter(~held_out(parts))
    tree = spark.sparkContext.broadcast(fit(training))
    counts = stored(word_counts(training), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    most = counts.filter(F.col("n") >= max(HEAD_SHARE * total, 1)).toArrow()
    words, n = most.column("word").to_numpy().view(np.uint64), most.column("n").to_numpy()
    head = spark.sparkContext.broadcast((Lookup(words), n[np.argsort(words)]) if total else None)
    scale = float(np.log10(total + distinct + 1))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(part.column("text"), lower=True)
        model = tree.value.scores(w)
        hashes, rows = w.hash, part.num_rows
        keys = np.concatenate((hashes, np.full(rows, END_TOKEN, np.int64).view(np.uint64)))
        doc = np.concatenate((w.doc, np.arange(rows)))
        sums, known = -scale * (w.n + 1.0), np.zeros(rows, np.int64)
        rest = np.ones(len(keys), bool)
        if head.value is not None:
            lookup, n = head.value
            at, place = lookup.find(keys)
            rest[at] = False
            sums += np.bincount(doc[at], np.log10(n[place] + 1.0), rows)
            known += np.bincount(doc[at], minlength=rows)
        order = np.lexsort((keys[rest], doc[rest]))
        doc, keys = doc[rest][order], keys[rest][order]
        texts = w.spans(w.bounds[:-1], w.bounds[1:])
        # before the words a mark of the text, a word that hardly any text has
        size = np.bincount(doc, minlength=rows) + 1
        offsets = np.concatenate(([0], np.cumsum(size)))
        listed = np.empty(offsets[-1], np.uint64)
        listed[offsets[:-1]] = mix(texts)
        listed[np.arange(len(keys)) + doc + 1] = keys
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "copy": column(texts),
                "n_tokens": column(w.n.astype(np.int64) + 1),
                "known": column(known),
                "base": column(sums),
                "score": column(model),
                "words": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), column(listed)),
            }
        )

    schema = "doc_id long, copy long, n_tokens long, known long, base double, score double, words array<long>"
    scored = map_slices(docs, work, schema)
    totals = ("n_tokens", "known", "base", "score")
    listed = scored.select("doc_id", "copy", F.struct(*totals).alias("text"), F.posexplode("words").alias("at", "word"))
    # the text's own figures travel once, with its mark, so one pass over the texts gives both
    listed = listed.select("doc_id", "copy", "word", F.when(F.col("at") == 0, F.col("text")).alias("text"))
    found = listed.join(counts, "word", "left").filter("text IS NOT NULL OR n IS NOT NULL")
    rare = F.when(F.col("text").isNull(), F.log10(F.col("n") + 1))
    both = found.groupBy("doc_id", "copy").agg(
        F.count("text").alias("rows"),
        *(F.min(f"text.{c}").alias(c) for c in totals),
        F.count(rare).alias("rare_known"),
        F.sum(rare).alias("rare_base"),
    )
    one = lambda c, kind: (F.coalesce(F.col(c), F.lit(0)) / F.col("rows")).cast(kind)
    return both.select(
        "doc_id",
        held_out(parts).alias("held_out"),
        "n_tokens",
        (F.col("known") + one("rare_known", "long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + one("rare_base", "double")).alias("base_score"),
        "score",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("_row"),
    ).drop("_row")
