import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cargolens.llm import suffixes
from cargolens.llm.suffixes import COVER, LENGTH, PERIOD, op2_suffix_dedup, remove_repeated, repeated, runs_of
from tests.llm.frames import clashing, corpus, documents, edges, folder, prose, words


def brute(rows):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    times = Counter(b[k : k + LENGTH] for _, b in data for k in range(len(b) - LENGTH + 1))
    out = Counter()
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - LENGTH + 1):
            if times[b[k : k + LENGTH]] > 1:
                gone[k : k + LENGTH] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()] += 1
    return out


def tricky():
    """Repeats inside one text, overlaps, periods, repeats of just 199, 200 and 201 bytes."""
    rng = random.Random(9)
    draw = lambda n: " ".join(words(rng, "en", n))
    a, b = draw(80), draw(80)
    texts = [
        a + b + a, "ab" * 400 + draw(20), "abc" * 90, draw(30) + "abc" * 90,
        draw(40) + b[:199] + draw(9), draw(40) + a[:200] + draw(9), draw(40) + a[5:206] + draw(9),
        b[100:] + a[:150], "ä" * 150 + draw(10), draw(3) + "ä" * 150, "x" * 200, "x" * 199, "y" * 201,
    ]
    return [(i, t, None, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("rows", [[], edges()[:12], tricky(), corpus()], ids=["empty", "edges", "tricky", "corpus"])
def test_same_as_all_windows(spark, tmp_path, rows):
    found = op2_suffix_dedup(spark, folder(clashing(documents(spark, rows)), tmp_path / "in")).collect()
    assert Counter(map(tuple, found)) == brute(rows)


def test_edge_rows_do_not_crash(spark):
    assert len(remove_repeated(documents(spark, edges())).collect()) == len(edges())


def test_kept_bytes(spark):
    rows = tricky()
    for r in remove_repeated(documents(spark, rows)).collect():
        data, at, left = rows[r["doc_id"]][1].encode(), 0, b""
        for span in r["spans"] or []:
            left += data[at : span["start"]]
            at = span["end"]
        assert bytes(r["kept"]) == left + data[at:]


def test_the_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


@pytest.mark.parametrize("seed", range(6))
def test_sorted_buckets_find_what_counting_finds(seed):
    rng = random.Random(seed)
    base = bytes(rng.choices(b"ab", k=900))
    contents, buckets = [], []
    for _ in range(12):
        at = rng.randrange(500)
        content = bytearray(base[at : at + rng.randint(LENGTH, 390)])
        if rng.random() < 0.6:
            content[rng.randrange(len(content))] = ord("c")
        contents.append(bytes(content))
        buckets.append(rng.randrange(2))
    contents.append(b"ab" * 300)
    buckets.append(0)
    windows = [len(c) - LENGTH + 1 for c in contents]
    offsets = [rng.randrange(40) for _ in contents]  # any layout gives the same answer
    times = Counter(
        (b, c[k : k + LENGTH]) for b, c, n in zip(buckets, contents, windows) for k in range(n)
    )
    want = [times[b, c[k : k + LENGTH]] > 1 for b, c, n in zip(buckets, contents, windows) for k in range(n)]
    assert repeated(contents, windows, offsets, buckets).tolist() == want


def test_runs_cover_all_windows_and_equal_windows_agree():
    data = (prose(random.Random(1), n=300) + "z" * 500 + prose(random.Random(1), n=300)).encode()
    prints, at = {}, 0
    for start, windows, value, digest, offset, anchors in runs_of(data):
        assert start == at and windows > 0 and anchors > 0
        at += windows
        for k in range(start, at):
            assert prints.setdefault(data[k : k + LENGTH], value) == value
    assert at == len(data) - LENGTH + 1
    assert runs_of(b"a" * 199) == []


def test_small_blocks_give_the_same(monkeypatch, spark):
    rows = corpus(seed=4, n=20)
    want = sorted((r["doc_id"], r["n_removed"]) for r in remove_repeated(documents(spark, rows)).collect())
    monkeypatch.setattr(suffixes, "BLOCK", 1)
    found = sorted((r["doc_id"], r["n_removed"]) for r in remove_repeated(documents(spark, rows)).collect())
    assert found == want


def test_a_large_bucket_is_dealt_into_pieces(monkeypatch, spark):
    rng = random.Random(3)
    passage = " ".join(words(rng, "en", 70))[:373]
    rows = [(i, f"{prose(rng, n=30)} {passage} {prose(rng, n=30)}", None, None, None) for i in range(300)]
    monkeypatch.setattr(suffixes, "BLOCK", 10_000)
    written, table = {}, suffixes.Scratch.table

    def spy(self, df, name):
        out = table(self, df, name)
        if name == "hot":
            written[name] = out.selectExpr("f", "piece", "length(bytes) AS size").toPandas()
        return out

    monkeypatch.setattr(suffixes.Scratch, "table", spy)
    found = remove_repeated(documents(spark, rows), digests=True)
    assert Counter(tuple(r) for r in found.drop("spans").collect()) == brute(rows)
    sizes = written["hot"].groupby(["f", "piece"])["size"].sum()
    assert len(sizes) > 3 and sizes.max() < 2 * suffixes.BLOCK
