"""Near duplicates against all pairs."""

import random
import re

import pytest

from tierkit.llm import near


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def brute(rows, size):
    sets = [(i, shingles(t, size)) for i, t in rows]
    label = {i: i for i, _ in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                label[high] = low
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("size", [4, 5])
def test_components(docs, prose, size):
    rng = random.Random(5)
    rows = [None, "", " \n ", "One", "one", "two words", "Two  WORDS", "two words here now", "x " * 5000]
    for g in range(12):
        base = prose(g, 150)
        rows += [" ".join(edited(base, rng.choice([0, 1, 2, 3, 4, 6]), rng)) for _ in range(6)]
    dense = prose(77, 300)
    rows += [" ".join(edited(dense, rng.choice([1, 2, 3, 10]), rng)) for _ in range(70)]
    rows += [" ".join([*prose(500 + i, 30), *prose(1000, 20)]) for i in range(20)]  # a shared passage
    order = list(enumerate(rows))
    rng.shuffle(order)
    frame = docs(*order, extra=("rep", "node", "label"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near.near_duplicates(frame, size).collect()}
    assert got == brute(list(enumerate(rows)), size)


def test_chains_join_and_large_nodes_are_finished(docs, prose, monkeypatch):
    """A chain of drifting texts is one component, also when no node counts as small."""
    monkeypatch.setattr(near, "SMALL_NODE", 4)
    monkeypatch.setattr(near, "BLOCK", 3)
    rng, words, rows = random.Random(1), prose(3, 200), []
    for _ in range(25):
        words = edited(words, 2, rng)
        rows.append(" ".join(words))
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs(*rows), 4).collect()}
    assert got == {i: v[1] for i, v in brute(list(enumerate(rows)), 4).items()}


def test_pairs_inside_large_nodes_are_found(docs, monkeypatch):
    """Pairs at 0.8 in a family at 0.77, whose nodes stay large at every level."""
    monkeypatch.setattr(near, "SMALL_NODE", 4)
    monkeypatch.setattr(near, "BLOCK", 16)
    some = lambda stem, n: [f"{stem}x{j}" for j in range(n)]
    core, rows = some("core", 172), []
    for pair in range(80):
        own = some(f"own{pair}", 4)
        rows += [" ".join([*core, *own, *some(f"{side}{pair}", 22)]) for side in "ab"]
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs(*rows), 1, recall=0.95).collect()}
    lost = [i for i in range(0, 160, 2) if (got[i], got[i + 1]) != (i, i)]
    assert len(lost) <= 4  # 5 %


def test_a_family_below_the_similarity_costs_no_comparison(docs, monkeypatch):
    """150 texts at 0.79 of each other, two of them linked: the shingles of their own rule out the rest."""
    made, exhaustive = [], near._exhaustive
    monkeypatch.setattr(near, "SMALL_NODE", 8)
    monkeypatch.setattr(near, "_exhaustive", lambda *a: made.append(exhaustive(*a)) or made[-1])
    core = [f"core{j}" for j in range(154)]
    rows = [" ".join([*core, *(f"own{i}x{j}" for j in range(21))]) for i in range(150)]
    rows.append(rows[3].replace("own3x7", "other"))
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs(*rows), 1).collect()}
    assert got == {**{i: i for i in range(150)}, 150: 3}
    assert len(made) == 2 and all(m.distinct().count() <= 1 for m in made)


def test_members_that_shingles_rule_out_have_no_link(docs, prose, spark):
    rng = random.Random(8)
    base = prose(4, 120)
    rows = [" ".join(edited(base, rng.randrange(12), rng)[: rng.choice([95, 110, 120])]) for _ in range(60)]
    sets = [shingles(t, 3) for t in rows]
    texts = spark.createDataFrame([(i, i, len(sets[i]), t) for i, t in enumerate(rows)], "rep long, label long, n long, text string")
    own = {r["rep"]: r["own"] for r in near._own_shingles(near.packed(texts), 3).collect()}
    alone = [len([x for x in s if sum(x in t for t in sets) == 1]) for s in sets]
    assert own == {i: n for i, n in enumerate(alone) if n}
    members = spark.createDataFrame(
        [(node, i, i, len(sets[i]), alone[i]) for node, ids in enumerate([range(60), range(0, 60, 2), [7], [4, 5]]) for i in ids],
        "node long, rep long, label long, n long, own long",
    )
    kept = {(r["node"], r["rep"]) for r in near._possible(members, 0.8).collect()}
    near_ids = {(i, j) for i in range(60) for j in range(60) if i != j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert near_ids and {(0, i) for i, _ in near_ids} <= kept
    assert {(1, i) for i, j in near_ids if i % 2 == j % 2 == 0} <= kept
    assert len({i for node, i in kept if node == 0}) < 60


def test_rows_without_or_with_the_same_id(docs, prose):
    text = " ".join(prose(1, 60))
    frame = docs((None, text), (None, None), (3, text), (3, text), (7, text), (8, "other text of four words"))
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near.near_duplicates(frame).collect()), key=str)
    assert got == sorted([(None, None, True)] * 2 + [(3, 3, True)] * 2 + [(7, 3, False), (8, 8, True)], key=str)
    left = near.filter_documents(frame)
    assert left.columns == frame.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == [3, 8, None, None]


def test_empty_table(docs):
    assert near.near_duplicates(docs("x").filter("false")).count() == 0


def test_more_recall_takes_more_trees():
    assert near.trees_for(0.9, 0.8) < near.trees_for(0.999, 0.8)


def test_pairs_that_meet_in_rare_shingles(docs, spark, monkeypatch):
    """Rare shingles give their pairs; for all others they count as a document's own."""
    monkeypatch.setattr(near, "RARE", 2)
    rows = [(1, 1, "a b c d"), (2, 2, "a b c e"), (3, 3, "a b f e"), (4, 4, "a g"), (5, 4, "a g h")]
    texts = spark.createDataFrame([(r, label, len(t.split()), t) for r, label, t in rows], "rep long, label long, n long, text string")
    pairs, own = near._rare_shingles(near.packed(texts), 1)
    # a and b are in more than two texts; c, e in two of different components; g in two of one
    assert {tuple(r) for r in pairs.collect()} == {(1, 2), (2, 3)}
    assert {tuple(r) for r in own.collect()} == {(1, 2), (2, 2), (3, 2), (4, 1), (5, 2)}


def test_probe_keeps_members_of_links_and_drops_those_of_none(spark):
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = words(60)
    rows, linked = [], []
    for k in range(40):  # pairs at the threshold, and texts that only share a passage
        base = words(100)
        other = [w if i >= 11 else f"x{k}_{i}" for i, w in enumerate(base)]
        linked += [len(rows), len(rows) + 1]
        rows += [" ".join(base), " ".join(other), " ".join(passage + words(140))]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    classes = near.signatures(docs, 1).withColumnRenamed("doc_id", "rep")
    members = classes.selectExpr("1L AS node", "rep", "rep AS label")
    left = {r["rep"] for r in near._probed(members, classes, 0.8).collect()}
    assert left == set(linked)
    assert near._probed(members.limit(0), classes, 0.8).count() == 0
