import random
import subprocess
import sys
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest

from cargolens.llm.common import small_batches
from cargolens.llm.substrings import (
    LEAST, LEAST_RUN, MOST, _chunked, _without_spans, cuts, op9_substring_dedup, remove_repeats,
)
from tests.llm.frames import CLASHING, clashing, corpus, documents, edges, folder, prose, words


@pytest.mark.parametrize("text", ["", "a", "ab " * 3000, "x" * 5000, "文字列" * 900, prose(random.Random(2), n=900)])
def test_chunks_cover_the_text(text):
    data = text.encode()
    ends = cuts(data)
    assert (ends[-1] if ends else 0) == len(data)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert all(0 < size <= MOST for size in sizes)
    for a, b in zip([0, *ends], ends):
        data[a:b].decode()  # no character is cut
    if " " in text.strip():
        assert all(size >= LEAST for size in sizes[:-1])


def test_an_insertion_moves_few_cuts():
    text = prose(random.Random(8), n=2000)
    one = text.encode()
    at = len(one) // 2
    other = one[:at] + b" inserted words " + one[at:]
    pieces = lambda d: Counter(d[a:b] for a, b in zip([0, *cuts(d)], cuts(d)))
    assert sum((pieces(one) - pieces(other)).values()) <= 4


@pytest.mark.parametrize("rows", [[], edges(), corpus()], ids=["empty", "edges", "corpus"])
def test_first_occurrences_stay_and_later_ones_go(spark, tmp_path, rows):
    found = op9_substring_dedup(spark, folder(clashing(documents(spark, rows)), tmp_path / "in")).collect()
    assert len(found) == len(rows)
    texts = Counter((i, t) for i, t, *_ in rows)
    by_id = {}
    for i, t, *_ in rows:
        by_id.setdefault(i, []).append(t)
    # (doc_id, place) of the occurrences of every chunk; one for repeated rows.
    seen = {}
    for i, t in texts:
        data, at = (t or "").encode(), 0
        for end in cuts(data):
            seen.setdefault(data[at:end], set()).add((-1 if i is None else i, t, at))
            at = end
    for r in found:
        candidates = [t for t in by_id[r["doc_id"]] if len((t or "").encode()) == r["n_bytes"]]
        assert candidates
        data = (candidates[0] or "").encode()
        kept, at = [], 0
        for start, end in r["spans"]:
            assert end - start >= LEAST_RUN
            kept.append(data[at:start])
            at = end
            places = [0, *cuts(data)]
            for a, b in zip(places, places[1:]):
                if start <= a and b <= end:
                    assert len(seen[data[a:b]]) > 1
        kept.append(data[at:])
        if len(set(candidates)) == 1:
            assert (r["text"] is None) == (candidates[0] is None)
            assert (r["text"] or "").encode() == b"".join(kept)
        assert r["n_removed"] == r["n_bytes"] - sum(map(len, kept))


def test_shared_passages_stay_once_and_clean_texts_whole(spark):
    rng = random.Random(6)
    passage = " ".join(words(rng, "en", 55))
    rows = [(i, f"{prose(rng)} {passage} {prose(rng)}", None, None, None) for i in range(5)]
    rows += [(10 + i, prose(rng, "de", 90), None, None, None) for i in range(5)]
    found = {r["doc_id"]: r for r in remove_repeats(documents(spark, rows)).collect()}
    middle = passage[120:-120]
    assert [i for i in range(5) if middle in found[i]["cut"]["text"]] == [0]
    for i in range(10, 15):
        assert found[i]["cut"]["text"] == found[i]["text"] and found[i]["cut"]["n_removed"] == 0


def test_other_columns_pass_through(spark):
    docs = clashing(documents(spark, corpus(n=8)))
    out = remove_repeats(docs, "result")
    assert out.columns == [*docs.columns, "result"]
    assert {r["key"] for r in out.collect()} == {"key"} and set(CLASHING) <= set(out.columns)


def test_small_batches_hold_the_same_rows():
    batches = [pa.record_batch({"n": pa.array(range(a, b), pa.int64())}) for a, b in ((0, 7), (7, 7), (7, 10), (10, 11))]
    found = list(small_batches(iter(batches), rows=3))
    assert [b.num_rows for b in found] == [3, 3, 1, 3, 1]
    assert pa.Table.from_batches(found) == pa.Table.from_batches(batches).combine_chunks()


def test_a_batch_is_not_chunked_as_a_whole():
    rng = random.Random(12)
    some = [prose(rng, n=300) for _ in range(50)] + [None, ""]
    texts = [some[i % 52] for i in range(5200)]
    batch = pa.record_batch({
        "doc_id": pa.array(range(len(texts)), pa.int64()), "content": pa.array([0] * len(texts), pa.int64()),
        "text": pa.array(texts, pa.string()),
    })
    tracemalloc.start()
    sizes = []
    for part in _chunked(iter([batch])):
        sizes += [sum(x) for x in part["sizes"].to_pylist()]
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sizes == [len((t or "").encode()) for t in texts]
    # A chunk costs some hundred bytes as Python objects, of which a few hundred texts stand at a time.
    assert batch.nbytes > 8_000_000 and most < batch.nbytes // 4


def test_spans_are_cut_from_nulls_and_others():
    texts = pa.array([None, "", "é" * 60 + "tail", "whole"], pa.string())
    found = pa.array([None, None, [{"at": 0, "size": 60}, {"at": 60, "size": 60}], [{"at": 0, "size": 5}]])
    assert _without_spans(texts, found).to_pylist() == [
        {"text": None, "n_bytes": 0, "n_removed": 0, "spans": []},
        {"text": "", "n_bytes": 0, "n_removed": 0, "spans": []},
        {"text": "tail", "n_bytes": 124, "n_removed": 120, "spans": [[0, 120]]},
        {"text": "whole", "n_bytes": 5, "n_removed": 0, "spans": []},
    ]


@pytest.mark.parametrize("module", ["substrings", "near_duplicates", "packing"])
def test_workers_of_the_pipeline_need_no_pandas(module):
    code = f"import sys, cargolens.llm.{module}; print('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout == "False\n"
