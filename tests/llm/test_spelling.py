import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cargolens.llm import spelling
from cargolens.llm.common import Scratch
from cargolens.llm.spelling import Shards, near_words, occurrences, op12_spelling_variants, variants
from tests.llm.frames import clashing, corpus, documents, edges, folder


def _words(rows):
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if i is not None:
                h = zlib.crc32(f"{i}:{run}".encode())
                if h % 199 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                yield run


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def _brute(counts):
    near = {a: [b for b in counts if _near(a, b)] for a in counts}
    form = {}
    for a in counts:
        best = min(near[a], key=lambda b: (-counts[b], b), default=None)
        if best is not None and counts[best] >= 5 * counts[a]:
            form[a] = best
    for a in counts:
        root = a
        while root in form:
            root = form[root]
        yield a, form.get(a), root, counts[a], len(near[a]), counts.get(form.get(a))


def _typos(rng, n=120):
    """Documents in which some words are frequent and others are slips of them, and of slips."""
    letters = "abcdeéÿ×"
    bases = ["".join(rng.choices(letters, k=rng.randint(6, 9))) for _ in range(12)]
    pool = {b: 400 for b in bases}
    for times in (60, 8, 6):
        for word in [*pool]:
            at = rng.randrange(len(word))
            slip = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:]])
            pool.setdefault(slip, times)
    words = [w for w, k in pool.items() for _ in range(k)]
    rng.shuffle(words)
    step = -(-len(words) // n)
    return [(k, " ".join(words[k * step : (k + 1) * step]), "en", None, None) for k in range(n)]


@pytest.mark.parametrize(
    "rows", [[], edges(), corpus(n=150), _typos(random.Random(2))], ids=["empty", "edges", "corpus", "typos"]
)
def test_same_as_brute_force(spark, tmp_path, rows):
    found = op12_spelling_variants(spark, folder(clashing(documents(spark, rows)), tmp_path / "in"))
    counts = {w: n for w, n in Counter(_words(rows)).items() if n >= 5}
    assert Counter(map(tuple, found.collect())) == Counter(_brute(counts))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_the_typos_have_forms_chains_and_ties(spark):
    counts = {w: n for w, n in Counter(_words(_typos(random.Random(2)))).items() if n >= 5}
    rows = list(_brute(counts))
    assert sum(f is not None for _, f, *_ in rows) > 10
    assert any(f is not None and f != r for _, f, r, *_ in rows)


def test_occurrences(spark):
    rows = [(k, f"Straße, STRASSE! ÀÉÎÕÜ×÷ abcdef{k}xyzuvw don't", None, None, None) for k in range(300)] + edges()
    found = Counter(r["word"] for r in occurrences(documents(spark, rows)).collect())
    assert found == Counter(_words(rows))


def test_parts_of_filters_give_the_same_pairs(spark, tmp_path):
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("abcd", k=rng.randint(6, 7))) for _ in range(900)})
    table = spark.createDataFrame([(w, 5 + k) for k, w in enumerate(words)], "word string, n long")
    want = sorted(tuple(sorted((a, b))) for k, a in enumerate(words) for b in words[:k] if _near(a, b))
    for part in (64, 640, spelling.PART):
        found = near_words(table, Scratch(spark), part).collect()
        assert sorted(tuple(sorted((r["word"], r["near"]))) for r in found) == want


def test_a_filter_knows_its_words_and_few_others():
    rng = np.random.default_rng(1)
    words = rng.integers(97, 123, (20_000, 8), dtype=np.uint8)
    shards = Shards.of({6: 10, 8: len(words)})
    h, part = spelling._hashes(words), np.zeros((8, shards.total), np.uint64)
    block = shards.place(h, 8)
    for k, bits in enumerate(spelling._bits(h)):
        np.bitwise_or.at(part[k], block, bits)
    assert len(spelling._known(h, 8, shards, part, 0)) == len(words)
    others = spelling._hashes(rng.integers(123, 150, (50_000, 8), dtype=np.uint8))
    assert len(spelling._known(others, 8, shards, part, 0)) < 50_000 * 0.005
    assert not len(spelling._known(others, 7, shards, part, 0))


def test_positives_alone_are_shuffled_to_the_vocabulary(spark):
    """The edits of a word are hundreds; what leaves the probing are its neighbours and few more."""
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abcdefghijklmnopqrst", k=8)) for _ in range(5000)})
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    counts = {8: len(words)}
    shards = Shards.of(counts)
    letters = spelling._alphabet(table)
    found = spelling._positives(table, letters, shards, 0, shards.total)
    assert found.count() < 0.5 * len(words)


def test_long_chains_are_followed_to_the_end(spark):
    rows = [("a" * (6 + k), 5 * 6**k) for k in range(9)]
    found = {r["word"]: r["root"] for r in variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert set(found.values()) == {"a" * 14}
