import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cargolens.llm import byte_pairs
from cargolens.llm.byte_pairs import Splitter, decode, encode, op13_bpe
from tests.llm.frames import clashing, corpus, documents, edges, folder

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    (31, "a <|endoftext|> b\n<|endoftext|>\n\n c<|endoftext|><|endoftext|>", None, None, None),
    (32, " \n <|endoftext|>", None, None, None),
    (33, "it's don't, we'll 'street 'tis\r\n\r\n  x\x1cy \x1c z　　w \xa0 é", None, None, None),
    (34, "\n\n\n", None, None, None), (35, "   ", None, None, None), (36, "x" * 5000 + " " * 5000, None, None, None),
    (37, "<|endoftext|", None, None, None), (38, "<|endoftext|>", None, None, None),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def _want(library, rows):
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        yield i, ids, library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("rows", [[], edges(), corpus(), ODD], ids=["empty", "edges", "corpus", "odd"])
def test_same_as_the_library_on_whole_texts(spark, tmp_path, library, rows):
    found = op13_bpe(spark, folder(clashing(documents(spark, rows)), tmp_path / "in")).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter((i, len(x), sha(",".join(map(str, x))), sha(t)) for i, x, t in _want(library, rows))
    assert Counter(tuple(r) for r in found) == want


def test_ids_and_texts_whatever_the_blocks(spark, tmp_path, library, monkeypatch):
    rows = corpus() + ODD
    folder(documents(spark, rows).repartition(3), tmp_path / "in")
    docs = spark.read.parquet(f"{tmp_path}/in/documents.parquet")
    want = Counter((i, tuple(x), t) for i, x, t in _want(library, rows))
    for block in (1, 500, byte_pairs.BLOCK):
        found = encode(docs, FILE, block=block).collect()
        assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in found) == want


def test_words_are_cut_where_the_library_cuts(library):
    rng, own = random.Random(3), Splitter(FILE)
    letters = [*" \n\t\r  \x1c\x85\xa0  .,'!?;:abZéÀß5²٣×́文\U0001f600", "'s", "'t", "'ll", "<|endoftext|>", "<|"]
    for _ in range(20_000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 12)))
        ids = [i for w in own.words(text) for i in library.encode(w, add_special_tokens=False).ids]
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_a_word_is_encoded_once(library):
    calls = []

    class Recording:
        def encode_batch_fast(self, words, **settings):
            calls.extend(words)
            return library.encode_batch_fast(words, **settings)

    def batch(*words):
        n = len(words)
        columns = {"block": pa.array([7] * n, pa.int64()), "number": pa.array(range(n), pa.int32()), "word": words}
        return pa.record_batch(columns)

    sorted_words = [batch(" a", " a", " bc"), batch(), batch(" bc", " bc"), batch(" bc", "é")]
    rows = [r for b in byte_pairs._encoded(iter(sorted_words), Recording(), byte_pairs._spelling(FILE), 2) for r in b.to_pylist()]
    assert calls == [" a", " bc", "é"]
    words = [w for b in sorted_words for w in b["word"].to_pylist()]
    assert [list(np.frombuffer(r["ids"], "<u2")) for r in rows] == [library.encode(w).ids for w in words]
    assert all(r["surface"] is None for r in rows)


@pytest.mark.parametrize("size", [1, 3, 10**6])
def test_bundles_hold_every_word_once(monkeypatch, size):
    monkeypatch.setattr(byte_pairs, "BUNDLE", size)
    rng = random.Random(1)
    rows = [(rng.choice([-5, 0, 9]), k, rng.randbytes(2 * rng.randint(1, 4)), b"x" if k % 50 == 0 else None) for k in range(300)]
    rng.shuffle(rows)
    schema = pa.schema([("block", pa.int64()), ("number", pa.int32()), ("ids", pa.binary()), ("surface", pa.binary())])
    batches = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema).to_batches(40)
    found, odd = [], []
    for batch in byte_pairs._bundled(iter(batches)):
        for row in batch.to_pylist():
            numbers, lengths, ids = byte_pairs._unbundle(row["words"])
            ends = np.cumsum(lengths)
            found += [(row["block"], n, ids[e - k : e]) for n, k, e in zip(numbers, lengths, ends)]
            odd += [(row["block"], x["number"], x["spelling"]) for x in row["odd"]]
    assert sorted(found) == sorted((b, n, i) for b, n, i, _ in rows)
    assert sorted(odd) == sorted((b, n, s) for b, n, _, s in rows if s)


def test_words_that_are_spelled_otherwise(spark):
    """A spelling that is not the word itself is what the text decodes to."""
    texts = byte_pairs._Block()
    split = [["a", " b", " b"], ["é", "a"]]
    texts.add(pa.array([1, 2]), split, 9)
    name, words, numbers = texts.numbered((0, 0))
    assert words.to_pylist() == [" b", "a", "é"] or words.to_pylist() == ["a", " b", "é"]
    at = {w: k for k, w in enumerate(words.to_pylist())}
    ids = {"a": 7, " b": 8, "é": 9}
    data = np.array([ids[w] for w in words.to_pylist()], "<u2").tobytes()
    bundle = byte_pairs._bundle(np.arange(3), np.full(3, 2), data)
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).ravel()
    found = pa.table({"words": [bundle], "odd": [[{"number": at["é"], "spelling": b"\xc3"}]]})
    block = pa.table({
        "documents": [byte_pairs._packed(pa.table({"doc_id": [1, 2], "count": pa.array([3, 2], pa.int32())}))],
        "numbers": [byte_pairs._packed(pa.table({"n": planes}))],
        "words": [byte_pairs._packed(pa.table({"word": words}))],
    })
    (out,) = byte_pairs._put_together(block, found, 2, False)
    assert out["ids"].to_pylist() == [[7, 8, 8], [9, 7]] and out["decoded"].to_pylist() == ["a b b", "\ufffda"]


def test_shuffles_are_by_word_and_by_block_alone(spark, tmp_path):
    folder(documents(spark, corpus()), tmp_path / "in")
    plan = op13_bpe(spark, str(tmp_path / "in"))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange " in line]
    assert len(exchanges) == 3
    assert sum("hashpartitioning(word" in x for x in exchanges) == 1
    assert sum("hashpartitioning(block" in x for x in exchanges) == 2


def test_decoding_of_any_ids(spark, library):
    rng = random.Random(4)
    rows = [(k, [rng.randrange(50_257) for _ in range(rng.randint(0, 9))]) for k in range(200)]
    frame = spark.createDataFrame([*rows, (200, None), (0, [50256])], "doc_id long, ids array<int>")
    want = Counter((k, library.decode(ids or [], skip_special_tokens=False)) for k, ids in [*rows, (200, None), (0, [50256])])
    assert Counter(map(tuple, decode(frame, FILE).collect())) == want


def test_other_tokenizers_are_refused(tmp_path):
    settings = json.loads(open(FILE).read())
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(settings | change))
        with pytest.raises(ValueError):
            Splitter(str(path))
