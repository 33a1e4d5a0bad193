import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cargolens.llm import packing
from cargolens.llm.packing import op1_best_fit_packing, pack, plan
from tests.llm.frames import clashing, corpus, documents, edges, folder


def _check(patterns, counts, capacity):
    used = Counter()
    for pattern, times in patterns:
        assert times > 0 and sum(length * n for length, n in pattern) <= capacity
        for length, n in pattern:
            used[length] += n * times
    assert used == Counter({k: n for k, n in counts.items() if n})
    return sum(times for _, times in patterns)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plan_uses_every_piece_once(counts):
    sequences = _check(plan(counts, 40), counts, 40)
    total = sum(k * n for k, n in counts.items())
    assert sequences >= -(-total // 40)
    assert sequences <= 2 * max(1, -(-total // 40))


def test_exact_complements_come_first():
    # A single, a pair and a triple fill the gap exactly; best fit would need more.
    assert _check(plan({7: 1, 3: 1, 6: 1, 2: 2, 5: 1, 1: 1}, 10), {7: 1, 3: 1, 6: 1, 2: 2, 5: 1, 1: 1}, 10) == 3
    assert _check(plan({8: 5, 2: 5, 4: 6, 3: 12}, 10), {8: 5, 2: 5, 4: 6, 3: 12}, 10) == 11


def test_many_alike_are_one_step():
    patterns = plan({4096: 10**9, 3000: 10**9, 1096: 10**9, 1: 7}, 4096)
    assert len(patterns) <= 4 and _check(patterns, {4096: 10**9, 3000: 10**9, 1096: 10**9, 1: 7}, 4096) == 2 * 10**9 + 1


def test_few_sequences_on_mixed_lengths():
    rng = random.Random(3)
    counts = Counter(min(4096, int(rng.lognormvariate(6.5, 1.2)) + 1) for _ in range(20_000))
    sequences = _check(plan(counts), counts, 4096)
    bound = -(-sum(k * n for k, n in counts.items()) // 4096)
    assert sequences <= bound * 1.002 + 1


@pytest.mark.parametrize("rows", [[], edges(), corpus()])
def test_pieces_and_places(spark, tmp_path, rows):
    docs = clashing(documents(spark, rows))
    found = op1_best_fit_packing(spark, folder(docs, tmp_path / "in")).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            want[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[n] for n in names) for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096


def test_a_text_does_not_walk_the_table_of_words():
    class Older(dict):
        def __iter__(self):
            raise AssertionError("all words of the table were walked for some texts")

        keys = items = values = __iter__

    words = packing._Words(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["one two three", "two four", None, "one\nfive six", "x" * 100 + " one"]
    want = list(words.ids(texts))
    kept = Older(words)
    words.forget()
    words.older = kept
    assert list(words.ids(texts)) == want
    assert {"one", "two", "five"} <= set(words) and "x" * 100 not in words


def test_the_table_of_words_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(packing, "MOST_BYTES", 20_000)
    file = public_tokenizers.path("word_bpe_49k.json")
    words, tokenizer = packing._Words(file), Tokenizer.from_file(file)
    texts = [f"word{k} and word{k % 7} of some length {'y' * (k % 90)}" for k in range(600)]
    for text, ids in zip(texts, words.ids(texts)):
        assert list(np.frombuffer(ids, "<u4")) == tokenizer.encode(text, add_special_tokens=False).ids
    assert words.older and len(words) < 120 and len(words.older) < 120


def test_words_of_all_letters_as_the_library():
    file = public_tokenizers.path("word_bpe_49k.json")
    rng, words, tokenizer = random.Random(5), packing._Words(file), Tokenizer.from_file(file)
    letters = [*map(chr, range(0x20, 0x180)), *"abcdeABCDE.,;:!?'", "\n", "\t", chr(0x301), chr(0xFB01), chr(0x6587), "<|endoftext|>"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 9))) for _ in range(30_000)]
    texts += ["".join(rng.choices([chr(c) for c in range(0xAA, 0x100)], k=4)) for _ in range(5000)]
    for text, ids in zip(texts, words.ids(texts)):
        assert list(np.frombuffer(ids, "<u4")) == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_any_table_with_lengths_can_be_packed(spark):
    parts = spark.createDataFrame([(i, i % 5 + 1) for i in range(50)], "name long, length long")
    found = pack(parts, ["name"], 6).collect()
    assert Counter(r["name"] for r in found) == Counter(range(50))
    assert len({r["sequence_id"] for r in found}) == 25
