from __future__ import annotations

import random
from contextlib import contextmanager

import pytest

from cargolens.schemas import BRONZE_COLUMNS
from cargolens.sources.csv_export import read_export, write_export
from cargolens.sources.layers import wide_rows
from tests.samples import raw, raw_frame


def write_file(path, header, rows, encoding="cp1252"):
    with open(path, "wb") as out:
        out.write((header + "\r\n").encode(encoding))
        for row in rows:
            out.write((row + "\r\n").encode(encoding))


def fields(**changes) -> str:
    """A CSV line of 53 fields, empty unless given."""
    return ",".join(changes.get(name, "") for name in BRONZE_COLUMNS)


def test_windows_text_nulls_and_positions(spark, tmp_path):
    path = str(tmp_path / "export.csv")
    header = ",".join(f"Column {i}" for i in range(len(BRONZE_COLUMNS)))
    write_file(path, header, [
        fields(order_item_id="1", order_city="Café €", customer_zipcode='""', product_name='"a, ""b"""'),
        fields(order_item_id="2", order_city="  padded ", shipping_mode="Same Day"),
    ])
    first, second = sorted(read_export(spark, path).collect(), key=lambda r: r["order_item_id"])
    assert first["order_city"] == "Café €"
    assert first["customer_zipcode"] == "" and first["order_zipcode"] is None
    assert first["product_name"] == 'a, "b"'
    assert second["order_city"] == "  padded " and second["shipping_mode"] == "Same Day"


def test_utf8_and_quoted_line_breaks(spark, tmp_path):
    path = str(tmp_path / "export.csv")
    write_file(path, fields(), [fields(order_item_id="1", customer_street='"line one\nline two"', order_city="Zürich")], "utf-8")
    rows = read_export(spark, path, encoding="utf-8", multiline=True).collect()
    assert [(r["customer_street"], r["order_city"]) for r in rows] == [("line one\nline two", "Zürich")]
    with pytest.raises(Exception):
        read_export(spark, path, encoding="utf-8").collect()


def test_wrong_field_count_fails(spark, tmp_path):
    path = str(tmp_path / "export.csv")
    write_file(path, fields(), ["only,three,fields"])
    with pytest.raises(Exception):
        read_export(spark, path).collect()


@pytest.mark.parametrize("given", [["1"] * 55, ["only", "three", "fields"]], ids=["long", "short"])
@pytest.mark.parametrize("use", [lambda d: d.count(), lambda d: d.select("sales", "market").collect()], ids=["count", "pruned"])
def test_wrong_field_count_fails_however_little_is_read(spark, tmp_path, given, use):
    path = str(tmp_path / "export.csv")
    write_file(path, fields(), [fields(order_item_id="1"), ",".join(given)])
    with pytest.raises(Exception):
        use(read_export(spark, path))


def test_all_windows_characters_without_a_session_setting(spark, tmp_path):
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    path = str(tmp_path / "export.csv")
    text = bytes(c for c in range(0x21, 0x100) if c not in b'",' and c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)).decode("cp1252")
    write_file(path, fields(), [fields(order_city=text)])
    rows = read_export(spark, path)
    assert [r["order_city"] for r in rows.collect()] == [text]
    write_export(rows, str(tmp_path / "again"))
    (part,) = (tmp_path / "again").glob("part-*.csv")
    assert text.encode("cp1252") in part.read_bytes()
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == before


def test_round_trip(spark, tmp_path):
    rows = raw_frame(
        spark, raw(order_city=" Café €", customer_zipcode="", product_name='say "hi", twice'), raw(order_item_id="2")
    )
    path = str(tmp_path / "export")
    write_export(rows, path)
    assert sorted(map(repr, read_export(spark, path).collect())) == sorted(map(repr, rows.collect()))


def test_ascii_text_is_exchanged_in_one_pass_without_a_search(spark):
    from cargolens.sources import csv_export

    rows = spark.createDataFrame([("plain",), ("\u20ac \x80 \xe9 \x81 ?",), (None,)], "a string")
    exchanged = csv_export._written_as_latin_1(rows)
    assert [r["a"] for r in exchanged.collect()] == ["plain", "\x80 ? \xe9 ? ?", None]
    plan = exchanged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 1 and "char_length" in plan


def test_an_export_is_written_as_wide_rows(spark, tmp_path, monkeypatch):
    from cargolens.sources import csv_export

    entered = []

    @contextmanager
    def seen(session):
        with wide_rows(session):
            entered.append(session.conf.get("spark.sql.codegen.hugeMethodLimit"))
            yield

    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    monkeypatch.setattr(csv_export, "wide_rows", seen)
    write_export(raw_frame(spark, raw()), str(tmp_path / "export"))
    assert entered == ["8000"] and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before


def _multiline_rows(rng, n):
    texts = ["plain", "", '""', '"a, b"', '"line\none"', '"three\n\nlines ""quoted""\n"', '"crlf\r\ninside"', "Café €", '"\n"', '" ,\n, "']
    return [fields(order_item_id=str(k), customer_street=rng.choice(texts), order_city=rng.choice(texts), market=rng.choice(texts)) for k in range(n)]


@pytest.fixture(params=[300, 10**9], ids=["small blocks", "one block"])
def blocks(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("encoding", ["cp1252", "utf-8"])
def test_multiline_files_are_cut_at_true_record_ends(spark, tmp_path, blocks, encoding):
    """Equal to a reader that takes each file in one task, however small the blocks are."""
    import csv
    import io

    rng, want = random.Random(6), []
    (tmp_path / "in").mkdir()
    for k, n in enumerate([40, 1, 0, 25]):
        write_file(tmp_path / "in" / f"{k}.csv", fields(customer_street='"two\nlines"'), rows := _multiline_rows(rng, n), encoding)
        for row in rows:
            (values,) = csv.reader(io.StringIO(row, newline=""))
            want.append((values[BRONZE_COLUMNS.index("order_item_id")], values[BRONZE_COLUMNS.index("customer_street")], values[BRONZE_COLUMNS.index("order_city")]))
    rows = read_export(spark, str(tmp_path / "in"), encoding="windows-1252" if encoding == "cp1252" else encoding, multiline=True)
    found = [(r["order_item_id"], r["customer_street"] or "", r["order_city"] or "") for r in rows.collect()]
    assert sorted(found) == sorted(want) and len(found) == 66
    assert rows.count() == 66
    if blocks == 300:
        assert rows.rdd.getNumPartitions() > 15
    if encoding == "utf-8":
        whole = (
            spark.read.schema(rows.schema).option("header", True).option("escape", '"').option("multiLine", True)
            .option("nullValue", "\u0001").option("emptyValue", "").csv(str(tmp_path / "in"))
        )
        # That reader leaves the carriage return of a line's end in the last field.
        theirs = [repr(r).replace("='\\r')", "=None)") for r in whole.collect()]
        assert sorted(map(repr, rows.collect())) == sorted(theirs)


def test_a_field_longer_than_a_block(spark, tmp_path, blocks):
    path, long = str(tmp_path / "export.csv"), "\n".join(f"line {k}" for k in range(400))
    write_file(path, fields(), [fields(order_item_id="1", market=f'"{long}"'), fields(order_item_id="2")], "utf-8")
    rows = read_export(spark, path, encoding="utf-8", multiline=True).collect()
    assert sorted((r["order_item_id"], r["market"]) for r in rows if r["market"]) == [("1", long)] and len(rows) == 2


@pytest.mark.parametrize("use", [lambda d: d.count(), lambda d: d.select("sales", "market").collect()], ids=["count", "pruned"])
def test_wrong_field_count_fails_in_multiline_files(spark, tmp_path, use):
    path = str(tmp_path / "export.csv")
    write_file(path, fields(), [fields(order_item_id="1"), '"only\nthree",fields,here'], "utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        use(read_export(spark, path, encoding="utf-8", multiline=True))


def test_encodings_of_wide_characters_are_not_cut(spark, tmp_path):
    with pytest.raises(ValueError):
        read_export(spark, str(tmp_path), encoding="utf-16", multiline=True)
