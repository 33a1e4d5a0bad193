import random
from collections import defaultdict

import numpy as np
import pytest

from cargolens.llm import near_duplicates
from cargolens.llm.common import Scratch
from cargolens.llm.components import components
from cargolens.llm.near_duplicates import op7_minhash_dedup
from tests.llm.frames import clashing, corpus, documents, edges, folder, words


def shingles(text):
    found = (text or "").encode().lower().split()
    if len(found) < 5:
        return {b" ".join(found)} if found else set()
    return {b" ".join(found[i : i + 5]) for i in range(len(found) - 4)}


def _parents(pairs, nodes):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def brute(rows):
    """Rows (doc_id, set size, component, kept), with documents compared pair by pair."""
    sets = [shingles(t) for _, t, *_ in rows]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
        or rows[i][0] is not None and rows[i][0] == rows[j][0]
    ]
    top = _parents(pairs, range(len(rows)))
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[top[i]] = min(row[0], least.get(top[i], row[0]))
    out = []
    for i, row in enumerate(rows):
        own = least.get(top[i])
        out.append((row[0], len(sets[i]), own, own is None or row[0] == own))
    return sorted(out, key=str)


def edited(rng, text, n):
    found = text.split(" ")
    for k in rng.sample(range(len(found)), n):
        found[k] = f"edit{rng.randrange(10**6)}"
    return " ".join(found)


def family(seed=4, n=60):
    """A text and edited copies, each alike to the text and most not to each other, and
    copies of copies that only a chain of links reaches."""
    rng = random.Random(seed)
    base = " ".join(words(rng, "en", 200))
    rows = [(1000 + i, edited(rng, base, 5)) for i in range(n)] + [(2000, base)]
    for i in range(6):
        rows.append((3000 + i, edited(rng, rows[i][1], 5)))
    return [(*r, None, None, None) for r in rows]


def just_below(n=30, seed=9):
    """Copies of one text, each pair of them just below or just above the similarity."""
    rng = random.Random(seed)
    base = " ".join(words(rng, "fr", 220))
    return [(5000 + i, edited(rng, base, rng.choice([4, 5, 6])), None, None, None) for i in range(n)]


@pytest.mark.parametrize(
    "rows", [[], edges(), corpus(), family(), just_below(), just_below(12) + edges()],
    ids=["empty", "edges", "corpus", "family", "just_below", "just_below_and_edges"],
)
def test_same_as_all_pairs(spark, tmp_path, rows):
    found = op7_minhash_dedup(spark, folder(clashing(documents(spark, rows)), tmp_path / "in")).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_blocks_of_few_nodes_find_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 3)
    monkeypatch.setattr(near_duplicates, "SIDE", 3)
    rows = family(n=12) + just_below()
    found = op7_minhash_dedup(spark, folder(documents(spark, rows), tmp_path / "in")).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_pairs_outside_the_largest_component_are_compared():
    import pyarrow as pa

    own = [bytes([k]) * near_duplicates.HASHES for k in (1, 1, 1, 2)]
    # Nodes 5, 6 (largest component 5), 7 and 8 outside; 7 agrees with 5 and 6.
    rows = [(True, 7, own[2], 7, True), (True, 8, own[3], 8, True)] + [
        (False, n, c, k, o) for n, c, k, o in ((5, own[0], 5, False), (6, own[1], 5, False), (7, own[2], 7, True), (8, own[3], 8, True))
    ]
    left, node, checks, component, outside = zip(*rows)
    table = pa.table({"left": left, "right": [not x for x in left], "node": node, "checks": checks, "component": component,
                      "outside": outside, "size": [10] * len(rows)})
    found = near_duplicates._compared(table)
    assert sorted(zip(*(found[c].to_pylist() for c in "ab"))) == [(5, 7), (6, 7)]


def test_a_block_hands_on_a_forest():
    import pyarrow as pa

    n = 200
    table = pa.table({
        "left": [True] * n, "right": [True] * n, "node": range(n), "component": range(n), "outside": [True] * n,
        "size": [10] * n, "checks": [bytes([k % 2]) * near_duplicates.HASHES for k in range(n)],
    })
    found = near_duplicates._compared(table)
    top = _parents(zip(*(found[c].to_pylist() for c in "ab")), range(n))
    assert found.num_rows == n - 2 and set(top.values()) == {0, 1}


@pytest.mark.parametrize("split", [False, True])
def test_texts_of_a_cluster_are_compared_whole(split):
    import pyarrow as pa

    rows = just_below(40)
    sets = [shingles(t) for _, t, *_ in rows]
    component = [i - i % 2 for i in range(40)]  # what is known to be one already
    side = [i < 15 for i in range(40)] if split else [True] * 40
    other = [not x for x in side] if split else side
    table = pa.table({"node": range(40), "component": component, "text": [t for _, t, *_ in rows], "left": side, "right": other})
    found = near_duplicates._verified(table)
    pairs = list(zip(*(found[c].to_pylist() for c in "ab")))
    like = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    assert all(like(a, b) for a, b in pairs) and len(pairs) < 20
    known = list(enumerate(component))
    every = [(a, b) for a in range(40) for b in range(a) if like(a, b) and (not split or side[a] != side[b])]
    assert every and _parents(pairs + known, range(40)) == _parents(every + known, range(40))


def test_texts_without_words_of_linked_documents_link_nothing(spark, tmp_path):
    one, other = just_below(2)[0][1], " ".join(words(random.Random(3), "de", 200))
    rows = [(1, one), (1, " "), (2, one + " tail"), (3, other), (3, "\t"), (4, other + " tail"), (5, "\n"), (6, "")]
    rows = [(*r, None, None, None) for r in rows]
    found = op7_minhash_dedup(spark, folder(documents(spark, rows), tmp_path / "in")).collect()
    with_words = {r["doc_id"]: r["component_id"] for r in found if r["n_shingles"]}
    assert with_words == {1: 1, 2: 1, 3: 3, 4: 3}
    without = [r for r in found if not r["n_shingles"]]
    assert len(without) == 4 and all(r["kept"] and r["component_id"] == r["doc_id"] for r in without)


def test_estimate_of_the_signature():
    rng = random.Random(1)
    text = " ".join(words(rng, "de", 400))
    other = edited(rng, text, 20)
    a, b = (near_duplicates._hashed(near_duplicates.words_of(t)) for t in (text, other))
    real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    share = (near_duplicates._minima(a) == near_duplicates._minima(b)).mean()
    assert abs(real - share) < 0.15


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)]
    pairs += [(100 + i, 101 + i) for i in range(25)] + [(200, 200 + i) for i in range(1, 30)] + [(7, 7)]
    edges_ = spark.createDataFrame(pairs, "u long, v long")
    found = {r["u"]: r["v"] for r in components(edges_, Scratch(spark)).collect()}
    want = _parents(pairs, {x for p in pairs for x in p})
    assert found == {n: top for n, top in want.items() if n != top}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u long, v long"), Scratch(spark)).isEmpty()
