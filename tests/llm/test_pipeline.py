import random

import pytest

import corpus_pipeline as pipeline
from cargolens.llm import quality, substrings
from cargolens.llm.near_duplicates import near_duplicates
from tests.llm.frames import SCHEMA, clashing, corpus, documents, edges, folder, prose


def rows(seed=11):
    rng = random.Random(seed)
    clean = [(i, prose(rng, lang, 80), lang, "s", None) for i, lang in enumerate(["en", "de", "fr"] * 8)]
    junk = [
        (100, "1234 5678 !!! " * 20, "en", "s", None), (101, None, "en", "s", None), (102, "", None, None, None),
        (103, "Der Der Der " * 60, "de", "s", None), (104, "item | menu | shop | help | news " * 9, "en", "s", None),
    ]
    copies = [(200 + i, clean[i][1], "en", "s", None) for i in range(3)]
    near = [(300, clean[4][1] + " More.", "de", "s", None)]
    shared = [(400, clean[5][1].replace("\n", " ")[:0] + prose(rng, "fr", 40) + "\n" + clean[5][1], "fr", "s", None)]
    return clean + junk + copies + near + shared


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The result of every stage, each made from the one before as the checker does."""
    path = tmp_path_factory.mktemp("pipeline")
    docs = documents(spark, rows())
    found = [docs]
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, found[-1], str(path)).write.parquet(f"{path}/{k}")
        found.append(spark.read.parquet(f"{path}/{k}"))
    return found


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_and_their_order():
    assert [name for name, _ in pipeline.STAGES] == ["language", "quality", "near_duplicates", "substrings", "packing"]
    assert pipeline.ORACLE_SQL is None


def test_columns_of_documents_stay(steps):
    for step in steps[:-1]:
        assert step.schema.names == [c.split()[0] for c in SCHEMA.split(", ")]
        assert [f.dataType for f in step.schema] == [f.dataType for f in steps[0].schema]


def test_each_stage_decides_and_keeps_clean_documents(steps):
    start, language, good, single, cut, _ = steps
    assert set(ids(start)) - set(ids(language)) == {100, 101, 102}
    assert set(ids(language)) - set(ids(good)) == {103, 104}
    assert set(ids(good)) - set(ids(single)) == {200, 201, 202, 300}
    assert ids(cut) == ids(single)
    assert set(range(24)) <= set(ids(cut))


def test_same_as_each_operator_by_itself(spark, steps):
    _, language, good, single, cut, _ = steps
    from pyspark.sql import functions as F

    judged = language.select("doc_id", quality.judge(F.col("text")).alias("q")).where("q.kept")
    assert sorted((r["doc_id"], r["q"]["clean_text"]) for r in judged.collect()) == sorted(
        (r["doc_id"], r["text"]) for r in good.collect()
    )
    kept = {r["doc_id"] for r in near_duplicates(good).where("kept").collect()}
    assert kept == set(ids(single))
    texts = {r["doc_id"]: r["cut"]["text"] for r in substrings.remove_repeats(single).collect()}
    assert texts == {r["doc_id"]: r["text"] for r in cut.collect()}
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())
    assert texts[400] != {r["doc_id"]: r["text"] for r in single.collect()}[400]


def test_packing_holds_every_document(steps):
    packed = steps[-1].collect()
    assert sorted({r["doc_id"] for r in packed}) == ids(steps[-2])


def test_run(spark, tmp_path, steps):
    found = pipeline.run(spark, folder(documents(spark, rows()), tmp_path / "in"))
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, found.collect())) == sorted(map(key, steps[-1].collect()))


@pytest.mark.parametrize("given", [[], edges() + corpus(n=10)], ids=["empty", "edges"])
def test_empty_and_odd_tables(spark, tmp_path, given):
    docs = clashing(documents(spark, given))
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() >= 0
