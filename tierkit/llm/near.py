"""Near duplicates by a chosen-path set similarity join.

A document is the set of its word shingles. ``TOKENS`` minwise tokens stand for the set. A
tree branches every document by those tokens that a hash of the path so far selects, about
``1 / similarity`` of them a level, so two similar documents keep meeting in the same node
with a known chance; independent trees bring the chance of missing a link below
``1 - recall``. Nodes with one member end. At the depths in ``STARS`` members are compared with
their node's leader, which is linear, and nodes that are one component by then end, too: a
dense group of copies, which no branching would ever part, so costs as much as it has
members. Of the rest, large nodes branch ``LEVELS`` times in all, and the number of trees is
sized for that depth, so the chance to miss a link does not depend on the size of a node. Then
every node is compared exhaustively, but for pairs that can't be links: those of one
component, and those that their tokens or shingles rule out. ``PROBE`` of its tokens tell first
whether half of a document is found in other components at all; a link at the threshold passes
that but for ``PROBE_DEVIATIONS`` standard deviations, and only the shingles of what is
left are shuffled. A shingle that only one component of
all open nodes has is shared by no such pair, so a document of ``n`` shingles with ``own`` such
ones shares ``n - own`` at most, and has no link beyond a size that follows from it. Among the
documents that this leaves, pairs that meet in a rare shingle (at most ``RARE`` of them have it)
are made from those shingles; for all other pairs the rare ones count as ``own``, too. In a group
of edited copies of one text that bound is the similarity itself: those nearer than the
threshold are one component by the stars, and the others leave the node. A large node is dealt
out as the members of its most frequent component against the rest, in blocks. No pair is
compared twice. Candidates whose tokens agree too rarely are dropped at ``DEVIATIONS`` standard
deviations; every other candidate is confirmed on the full sets.

Documents with equal sets are one class from the start, so a group of exact copies is one
row in everything above, whatever its size. The roots branch by whole tokens; below them, and
for the estimate, one byte of each token is enough, which keeps the shuffles small.

Defined results: A-Z count as a-z; a text with fewer words than a shingle has its whole word
sequence as its only shingle; a null text, or one without words, has an empty set and is
linked with nothing; a null ``doc_id`` takes no part (``component_id`` null, kept); rows that
repeat a ``doc_id`` fall into one component with it if their texts are similar, and
``filter_documents`` keeps one of the equal ones. An empty table gives no rows. Other columns
are not looked at and are handed through.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.shared import few_files, stars, stored, temporary
from tierkit.llm.words import Words, column, map_slices, mix, packed, runs, unpacked, unpacked_slices

TOKENS = 128
SMALL_NODE = 48
BLOCK = 256
RARE = 24
LEVELS = 3
STARS = (0, 0, 1)
DEVIATIONS = 3.5
PROBE = 32
PROBE_DEVIATIONS = 4.5
FEW_TEXTS = 200_000
_ODD = (mix(np.arange(1, TOKENS + 1, dtype=np.uint64)) | np.uint64(1))[:, None]
_SEAT = mix(np.arange(1001, 1001 + TOKENS, dtype=np.uint64))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Text index and hash of the distinct shingles of each text, and the number of texts."""
    w = Words(texts, lower=True)
    hashes = w.hash
    at, keys = w.windows(hashes, size)
    doc = w.doc[at]
    short = np.flatnonzero((w.n > 0) & (w.n < size))
    for n in np.unique(w.n[short]):
        some = short[w.n[short] == n]
        total = np.full(len(some), n, np.uint64)
        for j in range(n):
            total = mix(total + hashes[w.first[some] + j])
        doc, keys = np.concatenate((doc, some)), np.concatenate((keys, total))
    order = np.lexsort((keys, doc))
    doc, keys = doc[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], keys[new], len(w.n)


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, 128 bits that name the set, its minwise tokens, and their sketch of
    one byte a token."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        doc, keys, rows = shingle_sets(part.column("text"), shingle)
        start, length = runs(doc)
        n, a, b = np.zeros(rows, np.int64), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
        tokens = np.zeros((rows, TOKENS), np.uint32)
        if len(doc):
            own = doc[start]
            n[own] = length
            a[own] = np.add.reduceat(mix(keys ^ _SEAT[0]), start)
            b[own] = np.bitwise_xor.reduceat(mix(keys ^ _SEAT[1]), start)
            for j in range(TOKENS):
                tokens[own, j] = np.minimum.reduceat(keys * _ODD[j], start) >> np.uint64(32)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "n_shingles": column(n),
                "set_a": column(a),
                "set_b": column(b),
                "tokens": pa.array([t.tobytes() for t in tokens], pa.binary()),
                "sketch": pa.array([t.tobytes() for t in tokens.astype(np.uint8)], pa.binary()),
            }
        )

    return map_slices(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        work,
        "doc_id long, n_shingles long, set_a long, set_b long, tokens binary, sketch binary",
    )


def _tokens(values: pa.Array) -> np.ndarray:
    """Tokens, or their sketches, as rows of a matrix."""
    values = values.cast(pa.large_binary())
    bounds = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    if bounds[0] == bounds[-1]:
        return np.zeros((len(values), TOKENS), np.uint8)
    data = np.frombuffer(values.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return data.view(np.uint8 if bounds[1] - bounds[0] == TOKENS else np.uint32).reshape(-1, TOKENS)


def _branch(members: DataFrame, similarity: float) -> DataFrame:
    """Children ``node, rep, tokens``: the tokens that the path's hash selects, for each member."""
    limit = np.uint64(min(int(2**64 / (similarity * TOKENS)), 2**64 - 1))

    def work(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                part = whole.slice(at, 4096)
                path = np.array(part.column("node"), np.int64).view(np.uint64)
                keys = mix(path[:, None] ^ _SEAT) ^ _tokens(part.column("tokens")).astype(np.uint64)
                row, seat = np.nonzero(mix(keys) < limit)
                taken = part.take(pa.array(row))
                node = column(mix(keys[row, seat] + np.uint64(0x51ED)))
                yield pa.RecordBatch.from_arrays([node, *taken.columns[1:]], schema=taken.schema)

    return members.mapInArrow(work, members.schema)


def _least(similarity: float) -> float:
    """Share of equal sketch bytes that a similar pair misses only at ``DEVIATIONS`` standard deviations."""
    equal = similarity + (1 - similarity) / 256
    return equal - DEVIATIONS * math.sqrt(equal * (1 - equal) / TOKENS)


def _candidates(pairs: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose tokens don't speak against it."""
    least = _least(similarity)
    side = lambda k: reps.select(F.col("rep").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"t_{k}"))

    def work(batches):
        for part in batches:
            same = _tokens(part.column("t_a")) == _tokens(part.column("t_b")) if part.num_rows else np.zeros((0, 1))
            yield part.select(["a", "b"]).filter(pa.array(same.mean(axis=1) >= least))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * int(round(similarity * 100)))
    return both.select("a", "b", "t_a", "t_b").mapInArrow(work, "a long, b long")


def _step(df: DataFrame, name: str) -> DataFrame:
    """``stored`` for what comes from a shuffle; a task for each split of the input stays with ``stored``."""
    return stored(few_files(df), name)


def _texts_of(members: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``members(rep, ...)``, one a ``rep``, with their ``text``, the least of those with that
    ``rep``; only texts of members move between tasks, unless there are too many to send their ids."""
    wanted = members.select("rep")
    if wanted.count() <= FEW_TEXTS:
        wanted = F.broadcast(wanted)
    texts = texts.join(wanted, "rep", "left_semi").groupBy("rep").agg(F.min("text").alias("text"))
    return texts.join(members, "rep") if len(members.columns) > 1 else texts


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    percent = int(round(similarity * 100))

    def work(batches):
        for part, both in unpacked_slices(batches, "text_a", "text_b"):
            sides = [shingle_sets(texts, shingle) for texts in both]
            size_a, size_b = (np.bincount(doc, minlength=part.num_rows) for doc, _, _ in sides)
            doc, keys = (np.concatenate(x) for x in list(zip(*sides))[:2])
            order = np.lexsort((keys, doc))
            doc, keys = doc[order], keys[order]
            twice = (doc[1:] == doc[:-1]) & (keys[1:] == keys[:-1])
            shared = np.bincount(doc[1:][twice], minlength=part.num_rows)
            yield part.select(["a", "b"]).filter(pa.array(100 * shared >= percent * (size_a + size_b - shared)))

    texts = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), texts)
    side = lambda k: texts.select(F.col("rep").alias(k), F.col("text").alias(f"text_{k}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(work, "a long, b long")


def _labelled(members: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """Members of the nodes that are not yet one component, with their component, the node's size
    and its leader, another at each turn."""
    if labels is None:
        members = members.withColumn("label", F.col("rep"))
    else:
        members = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
            "label", F.coalesce("label", "rep")
        )
    open_nodes = (
        members.groupBy("node")
        .agg(
            F.count("*").alias("size"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.min(F.struct(F.xxhash64("rep", "node", F.lit(turn)), "rep", "label")).alias("leader"),
        )
        .filter("low <> high")
        .select("node", "size", F.col("leader.rep").alias("leader"), F.col("leader.label").alias("leader_label"))
    )
    return members.join(open_nodes, "node")


def _star(members: DataFrame) -> DataFrame:
    return members.filter("label <> leader_label").select(
        F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")
    )


def _postings(texts: DataFrame, shingle: int) -> DataFrame:
    """``rep, label, key`` of the distinct shingles of ``texts``."""

    def work(batches):
        for part, (own,) in unpacked_slices(batches, "text"):
            doc, keys, _ = shingle_sets(own, shingle)
            rep, label = (part.column(c).take(pa.array(doc)) for c in ("rep", "label"))
            yield pa.RecordBatch.from_pydict({"rep": rep, "label": label, "key": column(keys)})

    return texts.select("rep", "label", "text").mapInArrow(work, "rep long, label long, key long")


def _own(postings: DataFrame, totals: DataFrame) -> DataFrame:
    """``rep, own``: how many of the ``n`` keys of each of ``totals(rep, n)`` no other component has;
    those without one are left out."""
    shared = postings.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    # a component's key goes to all its members, so those are counted by what is left of them
    lost = postings.join(shared.select("key"), "key").groupBy("rep").agg(F.count("*").alias("met"))
    total = totals.select("rep", "n").join(lost, "rep", "left").fillna(0, ["met"])
    return total.select("rep", (F.col("n") - F.col("met")).alias("own")).filter("own > 0")


def _own_shingles(texts: DataFrame, shingle: int) -> DataFrame:
    """``rep, own``: the shingles of each of ``texts(rep, label, n, text)`` that no other component has."""
    return _own(_postings(texts, shingle), texts)


def _probed(members: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The members of ``node, rep, label`` whose first tokens are common enough in other components."""
    error = math.sqrt(similarity * (1 - similarity) / PROBE)
    spare = PROBE - math.ceil(PROBE * (similarity - PROBE_DEVIATIONS * error))
    seat = np.arange(PROBE, dtype=np.int64) << 32

    def work(batches):
        for part in batches:
            data = b"".join(part.column("tokens").to_pylist())
            tokens = (np.frombuffer(data, np.uint32) if data else np.zeros(0, np.uint32)).reshape(-1, PROBE)
            of = pa.array(np.repeat(np.arange(part.num_rows), PROBE))
            keys = pa.array((tokens.astype(np.int64) | seat).ravel())
            yield pa.RecordBatch.from_arrays([part.column("rep").take(of), part.column("label").take(of), keys], ["rep", "label", "key"])

    first = classes.select("rep", F.substring("tokens", 1, 4 * PROBE).alias("tokens"))
    wanted = members.select("rep", "label").distinct().join(first, "rep")
    postings = wanted.mapInArrow(work, "rep long, label long, key long")
    out = _own(postings, wanted.select("rep", F.lit(PROBE).alias("n"))).filter(F.col("own") > spare)
    return members.join(out.select("rep"), "rep", "left_anti").select("node", "rep", "label")


def _rare_shingles(texts: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of different components that meet in a shingle that at most ``RARE`` of
    ``texts`` have, and ``rep, own``: shingles of that kind, or of one component."""
    postings = _step(_postings(texts, shingle), "postings")
    kinds = postings.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    common = kinds.filter((F.col("low") != F.col("high")) & (F.col("n") > RARE)).select("key")
    met = postings.join(common, "key").groupBy("rep").agg(F.count("*").alias("met"))
    own = texts.select("rep", "n").join(met, "rep", "left").fillna(0, ["met"])
    rare = kinds.filter((F.col("low") != F.col("high")) & (F.col("n") <= RARE)).select("key")
    rare = postings.join(rare, "key")
    one, two = (rare.select("key", F.col("rep").alias(k), F.col("label").alias(f"of_{k}")) for k in "ab")
    pairs = one.join(two, "key").filter("a < b AND of_a <> of_b").select("a", "b")
    return pairs, own.select("rep", (F.col("n") - F.col("met")).alias("own"))


def _possible(members: DataFrame, similarity: float) -> DataFrame:
    """The members of ``node, rep, label, n, own`` that a link inside their node may still have, in
    nodes of several components.

    Of two linked members the smaller one reaches its own size at least (``home``), so a member
    that does not is kept only where a home is within its reach.
    """
    percent = int(round(similarity * 100))
    # shared * (100 + percent) >= percent * (n + other) has to hold for n - own shared ones
    members = members.withColumn("reach", F.floor((F.col("n") - F.col("own")) * (100 + percent) / percent) - F.col("n"))
    home = F.col("reach") >= F.col("n")
    homes = members.filter(home).groupBy("node").agg(F.min("n").alias("least"))
    return members.join(homes, "node").filter(home | (F.col("reach") >= F.col("least"))).drop("reach", "least")


def _sized(members: DataFrame) -> DataFrame:
    """The members with their node's ``size``, and how many are of its most frequent component, ``top``."""
    counts = members.groupBy("node", "label").agg(F.count("*").alias("same"))
    nodes = counts.groupBy("node").agg(F.sum("same").alias("size"), F.max(F.struct("same", "label")).alias("most"))
    nodes = nodes.filter(F.col("size") > F.col("most.same"))
    nodes = nodes.select("node", "size", F.col("most.same").alias("same"), F.col("most.label").alias("most"))
    return members.join(nodes, "node").withColumn("top", F.col("label") == F.col("most")).drop("most")


def _exhaustive(members: DataFrame, sketches: DataFrame, similarity: float, best: bool = False) -> DataFrame:
    """Candidate pairs of different components in each node, by its members' tokens; with ``best``
    only the likeliest of each member in each group, to join components before all are made.

    A small node is one group. A large one is dealt out in blocks: the members of the most
    frequent component against the others, and these among themselves, so no group has more
    than ``2 * BLOCK`` members by expectation, no task holds a node, and a node with few other
    members costs as much as it has members.
    """
    small = F.col("size") <= SMALL_NODE
    tops, others = F.ceil(F.col("same") / BLOCK), F.ceil((F.col("size") - F.col("same")) / BLOCK)
    block = F.pmod(F.xxhash64("rep"), F.when(small, 1).when(F.col("top"), tops).otherwise(others))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    group = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    sides = (
        F.when(small, F.array(group(0, block, block)))
        .when(F.col("top"), F.transform(upto(others), lambda k: group(1, block, k)))
        .otherwise(
            F.concat(
                F.transform(upto(tops), lambda k: group(1, k, block)),
                F.transform(upto(others), lambda k: group(2, F.least(block, k), F.greatest(block, k))),
            )
        )
    )
    dealt = members.select("node", "rep", "label", "n", "own", "top", block.alias("block"), F.explode(sides).alias("s"))
    full = dealt.select("node", "s.kind", "s.i", "s.j", "rep", "label", "n", "own", "top", "block").join(sketches, "rep")
    row = F.struct("rep", "label", "n", "own", "top", "block", "sketch")
    groups = full.groupBy("node", "kind", "i", "j").agg(F.collect_list(row).alias("m"))
    least, percent = _least(similarity), int(round(similarity * 100))

    def work(batches):
        for part in batches:
            m = part.column("m")
            bounds = m.offsets.to_numpy()
            flat = m.values
            rep, label, n, own, block = (flat.field(c).to_numpy() for c in ("rep", "label", "n", "own", "block"))
            top = flat.field("top").to_numpy(zero_copy_only=False)
            tokens = _tokens(flat.field("sketch"))
            kind, alone = np.array(part.column("kind")), np.array(part.column("i")) == np.array(part.column("j"))
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for g in range(part.num_rows):
                mine = np.arange(bounds[g], bounds[g + 1])
                if kind[g] == 1:
                    one, two = mine[top[mine]], mine[~top[mine]]
                    a, b = np.repeat(one, len(two)), np.tile(two, len(one))
                else:
                    a, b = (mine[x] for x in np.triu_indices(len(mine), 1))
                some = label[a] != label[b]
                if kind[g] == 2 and not alone[g]:
                    some &= block[a] != block[b]
                shared = np.minimum(n[a] - own[a], n[b] - own[b])
                some &= 100 * shared >= percent * (n[a] + n[b] - shared)
                some &= 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
                a, b = a[some], b[some]
                same = [
                    (tokens[a[at : at + (1 << 14)]] == tokens[b[at : at + (1 << 14)]]).mean(axis=1) for at in range(0, len(a), 1 << 14)
                ]
                same = np.concatenate([np.zeros(0), *same])
                a, b, same = a[same >= least], b[same >= least], same[same >= least]
                if best and len(a):
                    order = np.lexsort((-same, b))
                    a, b = a[order], b[order]
                    first = np.append(True, b[1:] != b[:-1])
                    a, b = a[first], b[first]
                left.append(rep[a])
                right.append(rep[b])
            a, b = np.concatenate(left), np.concatenate(right)
            yield pa.RecordBatch.from_pydict({"a": column(np.minimum(a, b)), "b": column(np.maximum(a, b))})

    return groups.select("kind", "i", "j", "m").mapInArrow(work, "a long, b long")


def _meet(depth: int) -> float:
    """Chance that a pair at exactly the similarity shares a node of ``depth`` in one tree."""
    meet = 1.0
    for _ in range(depth):
        meet = 1 - math.exp(-meet)
    return meet


def trees_for(recall: float, similarity: float, depth: int = LEVELS) -> int:
    """Trees so that a pair at exactly ``similarity`` shares a node of ``depth`` in one of them."""
    return math.ceil(math.log(1 - recall) / math.log(1 - _meet(depth)))


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document: its component under links
    of at least ``similarity``, named by the least ``doc_id``, which is the one kept."""
    with temporary(docs.sparkSession) as kept:
        return kept(few_files(_near_duplicates(docs, shingle, similarity, recall, kept)), "near")


def _near_duplicates(docs: DataFrame, shingle: int, similarity: float, recall: float, kept: Callable[..., DataFrame]) -> DataFrame:
    """``near_duplicates`` as a plan over tables that were stored for it; those that its exhaustive
    comparisons read are ``kept``, so these stay readable."""
    with temporary(docs.sparkSession) as handed:
        signed = stored(signatures(docs, shingle), "sets")
        classes = (
            signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
            .groupBy("set_a", "set_b")
            .agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), F.min("tokens").alias("tokens"), F.min("sketch").alias("sketch"))
        )
        classes = kept(few_files(classes), "classes")
        signed = handed(few_files(signed.select("doc_id", "n_shingles", "set_a", "set_b")), "names")  # tokens are the classes' now
    reps = classes.select("rep", "n", "sketch")

    roots = mix(np.arange(1, trees_for(recall, similarity) + 1, dtype=np.uint64)).view(np.int64).tolist()
    trees = classes.select(F.explode(F.lit(roots)).alias("node"), "rep", "tokens")
    level = _branch(trees, similarity).select("node", "rep")
    shared = level.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1").select("node")
    members = _step(level.join(shared, "node"), "members")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").filter("rep IS NOT NULL AND text IS NOT NULL")
    texts = stored(packed(texts), "texts")

    links, labels, seen = [], None, []

    def compare(pairs: DataFrame, estimate: bool = True) -> None:
        nonlocal labels
        pairs = pairs.distinct()
        if seen:
            pairs = pairs.join(reduce(DataFrame.union, seen), ["a", "b"], "left_anti")
        pairs = _step(_candidates(pairs, reps, similarity) if estimate else pairs, "pairs")
        seen.append(pairs)
        found = _step(_confirmed(pairs, texts, shingle, similarity), "found")
        if not found.isEmpty():
            links[:] = [stars(reduce(DataFrame.union, [found, *links]))]
            labels = links[0].select(F.col("a").alias("node"), F.col("b").alias("label"))

    left = []
    for depth in range(LEVELS):  # nodes of the first level are at depth 0
        for turn in range(STARS.count(depth)):
            compare(_star(_labelled(members, labels, turn)))
        still = _step(_labelled(members, labels, depth), "open").select("node", "rep", "size")
        large = still.filter(F.col("size") > SMALL_NODE)
        if depth + 1 == LEVELS or large.isEmpty():
            left.append(still)
            break
        left.append(still.filter(F.col("size") <= SMALL_NODE))
        known = reps.select("rep", F.col("sketch").alias("tokens"))
        deeper = _branch(large.select("node", "rep").join(known, "rep").select("node", "rep", "tokens"), similarity)
        members = _step(deeper.select("node", "rep"), "members")

    # links found at a depth end nodes of the depths before, too
    still = _step(_labelled(reduce(DataFrame.union, left).select("node", "rep"), labels, LEVELS).select("node", "rep", "label"), "left")
    still = _step(_probed(still, classes, similarity), "probed")

    def wanted(members: DataFrame) -> DataFrame:
        return _texts_of(members.select("rep", "label").distinct(), texts).join(reps.select("rep", "n"), "rep")

    def viable(members: DataFrame, numbers: DataFrame) -> DataFrame:
        open_ones = _labelled(members.select("node", "rep"), labels, LEVELS).select("node", "rep", "label")
        return _possible(open_ones.join(numbers, "rep"), similarity)

    def numbers(own: DataFrame) -> DataFrame:
        return _step(reps.select("rep", "n").join(own, "rep", "left").fillna(0, ["own"]), "own")

    possible = _step(viable(still, numbers(_own_shingles(wanted(still), shingle))), "possible")
    meeting, own = _rare_shingles(wanted(possible), shingle)
    compare(meeting)
    own = numbers(own)
    for best in (True, False):
        sized = kept(few_files(_sized(viable(possible, own))), "sized")
        compare(_exhaustive(sized, reps.select("rep", "sketch"), similarity, best), estimate=False)

    sets = classes.select("set_a", "set_b", "rep")
    if labels is not None:
        sets = sets.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    else:
        sets = sets.withColumn("label", F.col("rep"))
    sets = sets.select("set_a", "set_b", F.coalesce("label", "rep").alias("component_id"))
    known = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return (
        signed.join(sets, ["set_a", "set_b"], "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(known).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def filter_documents(docs: DataFrame, **options) -> DataFrame:
    """One document of each group, with all its columns; rows without ``doc_id`` stay."""
    kept = near_duplicates(docs, **options).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    known = packed(docs).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return unpacked(known).union(docs.filter("doc_id IS NULL")).select(*docs.columns)
