"""Raw order-item exports as CSV: positional, all text."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cargolens.schemas import BRONZE
from cargolens.sources.layers import wide_rows

# Unquoted empty fields are NULL, quoted empty fields are empty text.  A NULL
# marker that cannot occur keeps the reader from folding the two together.
_NO_SUCH_TEXT = "\u0001NULL"


# Spark reads and writes Windows code pages only under a session-wide legacy setting.
# Windows-1252 differs from ISO-8859-1 in the 32 codes from 0x80 alone, so those are
# exchanged and no setting is touched.  Codes without a character read as U+FFFD.
_CODES = bytes(range(0x80, 0xA0))
_AS_LATIN_1 = _CODES.decode("iso-8859-1")
_AS_WINDOWS = _CODES.decode("windows-1252", "replace")


def _native(encoding: str) -> tuple[str, bool]:
    """An encoding that Spark knows, and whether the 32 codes are to be exchanged."""
    windows = encoding.lower().replace("_", "-") in ("windows-1252", "cp1252")
    return ("iso-8859-1", True) if windows else (encoding, False)


def _exchanged(df: DataFrame, this: str, that: str) -> DataFrame:
    """Every column with the characters of ``this``, none of them ASCII, as those of ``that``."""
    affected = f"[{this}]"
    # Most text is ASCII, a byte to a character, and need not be searched.
    return df.select(
        *[
            F.when(
                (F.octet_length(c) > F.char_length(c)) & F.col(c).rlike(affected), F.translate(c, this, that)
            ).otherwise(F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def _options(multiline: bool) -> dict[str, object]:
    return {
        "escape": '"', "nullValue": _NO_SUCH_TEXT, "emptyValue": "", "multiLine": multiline,
        "mode": "FAILFAST", "columnPruning": False,
    }


def read_export(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "windows-1252",
    multiline: bool = False,
) -> DataFrame:
    """53 text columns by position; a record with another field count fails.

    It fails whatever columns are used and when rows are only counted, as every field is
    split off for every read.  Files are split across tasks, also those of exports with
    line breaks inside quotes, which need ``multiline=True`` (see ``records``).
    """
    encoding, exchange = _native(encoding)
    if multiline:
        text = records(spark, path, encoding)
        options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _options(True).items()}
        parsed = F.from_csv("record", BRONZE.simpleString(), options)
        # As a generator it is evaluated in full, however little of it is used.
        rows = text.select(F.explode(F.array(parsed)).alias("fields")).select("fields.*")
    else:
        reader = spark.read.schema(BRONZE).option("header", True).option("encoding", encoding)
        rows = reader.options(**_options(False)).csv(path)
    return _exchanged(rows, _AS_LATIN_1, _AS_WINDOWS) if exchange else rows


# What a run of lines is of a record: all of it, its end, its beginning, or a part between.
_WHOLE, _END, _BEGINNING, _MIDDLE = 0, 1, 2, 3


def _cut(
    batches: Iterator[pa.RecordBatch], opened: Mapping[str, set[int]]
) -> Iterator[pa.RecordBatch]:
    """Lines of blocks, in order, put together to records and to parts at a block's ends.

    A line break is inside quotes if the quotes before it are odd in number; ``opened`` names
    the blocks (by file and start) that begin so.  What spans batches is carried along.
    """
    at: tuple[str, int] | None = None
    inside = first = head = False
    carried: list[bytes] = []

    def ended() -> Iterator[pa.RecordBatch]:
        """What is still open when a block ends."""
        if carried:
            kind = _MIDDLE if head else _BEGINNING
            yield rows([kind], [b"\n".join(carried)], [first and not head])

    def rows(kinds, values, firsts) -> pa.RecordBatch:
        n = len(kinds)
        return pa.record_batch(
            {
                "file": pa.array([at[0]] * n, pa.string()),
                "block": pa.array([at[1]] * n, pa.int64()),
                "kind": pa.array(kinds, pa.int32()),
                "first": pa.array(firsts, pa.bool_()),
                "record": pa.array(values, pa.binary()),
            }
        )

    for batch in batches:
        files, blocks = batch["file"].to_pylist(), batch["block"].to_numpy()
        borders = [0, *(k for k in range(1, len(files)) if files[k] != files[k - 1] or blocks[k] != blocks[k - 1])]
        for start, end in zip(borders, [*borders[1:], len(files)]):
            if start == end:
                continue
            if (files[start], int(blocks[start])) != at:
                yield from ended()
                at, carried = (files[start], int(blocks[start])), []
                inside = head = at[1] in opened.get(at[0], ())
                first = at[1] == 0
            lines = batch["line"].slice(start, end - start)
            # Whether a line ends inside quotes; a record ends where one doesn't.
            quotes = np.cumsum(pc.count_substring(lines, '"').to_numpy()) + inside
            ends = np.flatnonzero(quotes % 2 == 0) + 1
            inside = bool(quotes[-1] % 2)
            if len(ends):
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), lines)
                values = pc.binary_join(lists, pa.scalar(b"\n"))
                kinds, firsts = np.zeros(len(ends), np.int32), np.zeros(len(ends), bool)
                kinds[0] = _END if head else _WHOLE
                firsts[0] = first and not head
                if carried:
                    joined = b"\n".join([*carried, values[0].as_py()])
                    values = pa.concat_arrays([pa.array([joined], pa.binary()), values.slice(1)])
                    carried = []
                yield rows(kinds, values, firsts)
                # A block that begins in a record has no record of the file's start.
                first = head = False
            carried += lines.slice(int(ends[-1]) if len(ends) else 0).to_pylist()
    if at:
        yield from ended()


def records(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """``record``: each record as text, but for the first one of each file, its header.

    Line breaks inside quotes are part of a record.  Blocks of a file are read by many
    tasks: a first pass counts the quotes of each block, whose parities, added up along
    the file, tell whether a block begins inside quotes.  So a second pass cuts each block
    at true ends of records; only the parts at the ends of blocks, at most two a block,
    are shuffled to be put together.  What is held at once is the list of blocks that
    begin inside quotes.  The encoding must keep ASCII characters as single bytes.
    """
    if not re.fullmatch(r"(?i)utf-?8|us-ascii|iso-8859-\d+", encoding):
        raise ValueError(f"records of {encoding} text are not cut")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
        "value",
    )
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = (
        lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
        .select("file", "block", (F.sum("odd").over(along) % 2).alias("inside"))
        .where("inside = 1")
    )
    opened: dict[str, set[int]] = {}
    for row in odd.toLocalIterator():
        opened.setdefault(row["file"], set()).add(row["block"])

    schema = "file string, block long, kind int, first boolean, record binary"
    cut = lines.select("file", "block", "line").mapInArrow(lambda batches: _cut(batches, opened), schema)
    whole = cut.where(F.col("kind") == _WHOLE).select("first", "record")
    # An end of a record comes before the beginning of another one in the same block.
    order = Window.partitionBy("file").orderBy("block", "kind")
    number = F.count_if(F.col("kind") == _BEGINNING).over(order)
    parts = cut.where(F.col("kind") != _WHOLE).withColumn("number", number)
    put_together = parts.groupBy("file", "number").agg(
        F.max("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("block", "kind", F.hex("record").alias("hex")))).alias("parts"),
    )
    joined = F.unhex(F.array_join(F.transform("parts", lambda p: p["hex"]), "0A"))
    found = whole.unionByName(put_together.select("first", joined.alias("record"))).where(~F.col("first"))
    text = F.col("record").cast("string") if "8859" not in encoding else F.decode("record", encoding)
    text = F.regexp_replace(F.make_valid_utf8(text), r"\r\z", "")
    return found.select(text.alias("record")).where(F.trim("record") != "")


def _written_as_latin_1(rows: DataFrame) -> DataFrame:
    """Every column so that its bytes in ISO-8859-1 are those of Windows-1252."""
    known = [(w, c) for w, c in zip(_AS_WINDOWS, _AS_LATIN_1) if w != "\ufffd"]
    # A character that only ISO-8859-1 has reads back as another one, so it is lost here.
    lost = "?" * len(_AS_LATIN_1)
    return _exchanged(rows, _AS_LATIN_1 + "".join(w for w, _ in known), lost + "".join(c for _, c in known))


def write_export(df: DataFrame, path: str, encoding: str = "windows-1252") -> None:
    """The same dialect, for handing raw rows on."""
    encoding, exchange = _native(encoding)
    rows = df.select(*BRONZE.names)
    if exchange:
        rows = _written_as_latin_1(rows)
    writer = (
        rows.write.option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    with wide_rows(df.sparkSession):
        writer.csv(path)
