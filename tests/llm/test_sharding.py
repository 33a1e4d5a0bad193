import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cargolens.llm.sharding import Tree, assign, op10_sharding, shard_of
from tests.llm.frames import clashing, corpus, documents, edges, folder


@pytest.mark.parametrize("rows", [[], edges(), corpus()])
def test_law_sizes_and_slots(spark, tmp_path, rows):
    docs = clashing(documents(spark, rows))
    found = op10_sharding(spark, folder(docs, tmp_path / "in")).collect()
    assert len(found) == len(rows)
    text = lambda t: (t or "").encode()
    want = Counter((i, len(text(t)) + 1, zlib.crc32(text(t))) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    slots, shards = defaultdict(list), defaultdict(set)
    for r in found:
        assert r["law"] == "key" and 0 <= r["shard"] < 8
        assert r["grown_shard"] in (r["shard"], 8)
        slots[r["shard"]].append(r["slot"])
        shards[r["doc_id"]].add((r["shard"], r["grown_shard"]))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())


def _shards(spark, tree, n=20_000):
    rows = spark.range(n).select("id", shard_of(F.col("id"), tree).alias("s")).collect()
    return {r["id"]: r["s"] for r in rows}


def test_shares_follow_weights(spark):
    tree = Tree((((((0, 1.0), (1, 3.0)),), ((2, 4.0),)), (((3, 8.0),),)) if False else (
        (((0, 1.0), (1, 3.0)), ((2, 4.0),)), (((3, 8.0),),),
    ))
    counts = Counter(_shards(spark, tree).values())
    for shard, weight in ((0, 1), (1, 3), (2, 4), (3, 8)):
        assert abs(counts[shard] / 20_000 - weight / 16) < 0.015


def test_a_new_shard_takes_rows_only_into_itself(spark):
    tree = Tree.balanced(2, 2, 2)
    before, after = _shards(spark, tree), _shards(spark, tree.with_region())
    moved = [k for k in before if before[k] != after[k]]
    assert all(after[k] == 8 for k in moved)
    assert abs(len(moved) / 20_000 - 1 / 9) < 0.01


def test_movement_is_confined_to_the_subtree_that_grew(spark):
    tree = Tree.balanced(2, 2, 2)
    before, after = _shards(spark, tree), _shards(spark, tree.with_weight(1, 2.0))
    place = lambda s: (s // 4, s // 2)  # noqa: E731  region, rack
    for k in before:
        if before[k] != after[k]:
            # Only into the region whose weight grew; within it only into the rack that grew,
            # and within that only into the shard.
            assert place(after[k])[0] == 0
            if place(before[k])[0] == 0:
                assert place(after[k]) == (0, 0)
            if place(before[k]) == (0, 0):
                assert after[k] == 1
    emptied = _shards(spark, tree.with_weight(1, 0.0))
    assert 1 not in emptied.values()
    assert all(emptied[k] == before[k] for k in before if before[k] // 4 == 1)


def test_other_columns_and_keys(spark):
    docs = documents(spark, corpus()).withColumnRenamed("doc_id", "id")
    found = assign(docs, Tree.balanced(1, 1, 1), key="id").collect()
    assert {r["shard"] for r in found} == {0} and {r["grown_shard"] for r in found} == {None}
    assert [r["id"] for r in sorted(found, key=lambda r: r["slot"])] == sorted(r["id"] for r in found)
