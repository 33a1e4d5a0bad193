import random
import subprocess
import sys
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cargolens.llm import language
from cargolens.llm.language import fit, op4_language_id, training_sample
from tests.llm.frames import clashing, corpus, documents, edges, folder, prose


def _labelled(n=120, seed=2):
    rng = random.Random(seed)
    langs = [rng.choice(["en", "de", "fr"]) for _ in range(n)]
    return [prose(rng, lang, rng.choice([15, 60])) for lang in langs], langs


def test_kernel_is_the_normalised_number_of_common_ngrams():
    texts, langs = _labelled(20)
    model = fit(texts, langs, landmarks=6, most_grams=10**6)

    def grams(text):
        low = "".join(c.lower() if c.isalpha() else " " for c in text)
        while "  " in low:
            low = low.replace("  ", " ")
        return {low[i : i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1)} - {" "}

    got = model.kernels(model.presence(texts))
    chosen = [next(i for i, t in enumerate(texts) if np.allclose(got[i, k], 1)) for k in range(6)]
    for i, text in enumerate(texts):
        for k, j in enumerate(chosen):
            a, b = grams(text), grams(texts[j])
            assert abs(got[i, k] - len(a & b) / np.sqrt(len(a) * len(b))) < 0.02


def test_held_out_accuracy():
    texts, langs = _labelled(150)
    model = fit(texts[:100], langs[:100])
    names, scores = model.predict(texts[100:])
    assert np.mean([a == b for a, b in zip(names, langs[100:])]) >= 0.95
    assert ((0 <= scores) & (scores <= 1)).all()


def test_long_texts_are_read_in_parts_with_one_result(monkeypatch):
    texts, langs = _labelled(40)
    model = fit(texts, langs)
    long = [" ".join(texts), texts[0], " ".join(texts[:20])]
    whole = model.presence(long)
    monkeypatch.setattr(language, "_PART", 50)
    assert (model.presence(long) == whole).all()


@pytest.mark.parametrize("rows", [[], edges(), corpus(), [(1, "Only one text.", "en", "s", 1)]])
def test_query(spark, tmp_path, rows):
    found = op4_language_id(spark, folder(clashing(documents(spark, rows)), tmp_path / "in")).collect()
    assert len(found) == len(rows)
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(t)
    for r in found:
        i = r["doc_id"]
        assert r["held_out"] == (zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if not any(t and any(map(str.isalpha, t)) for t in texts[i]):
            assert (r["lang_pred"], r["score"]) == ("und", 0)


def test_the_fold_and_the_label_teach_and_nothing_else_does(spark, tmp_path):
    rows = corpus(n=60)
    folders = []
    for k, change in enumerate([lambda r: r, lambda r: (*r[:2], "xx" if zlib.crc32(str(r[0]).encode()) % 4 == 2 else r[2], "other", 0)]):
        folders.append(folder(documents(spark, [change(r) for r in rows]), tmp_path / str(k)))
    one, other = (sorted(map(tuple, op4_language_id(spark, f).collect())) for f in folders)
    assert one == other and {r[2] for r in one} <= {"en", "de", "fr"}
    right = [r[2] == lang for r, (_, _, lang, *_) in zip(one, sorted(rows)) if r[1]]
    assert np.mean(right) >= 0.6  # copies in this corpus have labels of their own


def test_sample_is_bounded_and_counts_copies_once(spark):
    rows = [(i, f"Text number {i % 50} in words", "en" if i % 3 else "de", None, None) for i in range(600)]
    texts, langs = training_sample(documents(spark, rows), per_language=10)
    assert len(texts) == len(set(texts)) and langs.count("en") <= 10 and langs.count("de") <= 10


def test_copies_do_not_crowd_out_the_texts_of_a_label(spark):
    rows = [(i, "One and the same text, many times", "en", None, None) for i in range(20_000)]
    rows += [(30_000 + i, f"Different text {'abcdefghij'[i % 10]} {'klmnopqrst'[i // 10]}", "en", None, None) for i in range(20)]
    texts, langs = training_sample(documents(spark, rows), per_language=15)
    assert len(texts) == len(set(texts)) == langs.count("en") == 15
    texts, langs = training_sample(documents(spark, rows))
    assert len(texts) == len(set(texts)) == 21


def test_labels_with_long_texts_only_are_learnt(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, "en", 20), "en", None, None) for i in range(30)]
    rows += [(100 + i, prose(rng, "de", 60), "de", None, None) for i in range(4)]
    rows.append((200, prose(rng, "en", 60), "en", None, None))
    texts, langs = training_sample(documents(spark, rows), per_language=20, most_chars=200)
    assert langs.count("de") == 4 and langs.count("en") == 20
    assert {t for t, k in zip(texts, langs) if k == "de"} == {r[1] for r in rows if r[2] == "de"}
    assert rows[-1][1] not in texts


def test_a_batch_is_not_unpacked_as_a_whole(monkeypatch):
    monkeypatch.setattr(language, "_PART", 20_000)
    texts, langs = _labelled(40)
    model = fit(texts, langs)
    many = [None if i % 7 == 0 else texts[i % 40] * 80 for i in range(1000)]
    batch = pa.array(many)
    wanted = model.predict(many)
    tracemalloc.start()
    names, scores = model.predict(batch)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert (names, scores.tolist()) == (wanted[0], wanted[1].tolist())
    # Some blocks of texts, one presence matrix and the arrays of one part; not a copy of the batch.
    assert len(batch) > 7 * language._BLOCK and batch.nbytes > 15_000_000
    assert most < batch.nbytes // 3 + 2 * 4 * language._BLOCK * model.n_grams + 100 * 20_000 < batch.nbytes


def test_workers_need_no_pandas(spark):
    texts, langs = _labelled(40)
    found = language.language(spark, fit(texts, langs), F.col("text"))
    rows = spark.createDataFrame([(t,) for t in texts[:3]] + [(None,)], "text string").select(found.alias("f")).collect()
    assert [r["f"]["lang_pred"] for r in rows][3] == language.UNKNOWN
    code = "import sys, cargolens.llm.language; print('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout == "False\n"
