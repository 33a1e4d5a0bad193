"""Looking up dimension rows for a very large table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cargolens.workspace import reads_a_table

# As many keys are looked for as there are shuffle partitions, as no more can hold more
# rows than a partition should; the sketch tracks ten times as many, up to what it can.
MOST_HOT = 100_000
_TRACKED_FOR_EACH = 10

# Hot keys are cut this much finer than partitions, as pieces meet by chance.
_PIECES_PER_PARTITION = 4


# Column metadata of written tables: rows of the table and mean bytes of a value in memory.
ROWS, WIDTH = "cargolens.rows", "cargolens.width"
_ROW_OVERHEAD = 32  # of a row in a hash table, beside its values


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (compressed file sizes for written tables)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def memory_bytes(df: DataFrame) -> int | None:
    """What the columns of a written table take in memory, if they say so.

    Layers count rows and add up lengths while they write a table, and the columns carry
    the result wherever they are selected.  A filtered table counts as a whole.
    """
    known = [field.metadata for field in df.schema.fields]
    if not known or any(ROWS not in x for x in known) or not reads_a_table(df):
        return None
    return max(x[ROWS] for x in known) * (_ROW_OVERHEAD + sum(8 + x[WIDTH] for x in known))


def broadcast_limit(df: DataFrame) -> int:
    state = df.sparkSession._jsparkSession.sessionState()
    return int(state.conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame, most_bytes: int = 0) -> bool:
    """By size in memory where it is known, else by the optimizer's estimate.

    ``most_bytes`` raises the limit for a known size, unless broadcasts are switched off.
    """
    size, limit = memory_bytes(df), broadcast_limit(df)
    if size is None:
        return plan_bytes(df) <= limit
    return size <= (max(limit, most_bytes) if limit > 0 else limit)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys_together(rows: DataFrame, key_hashes: Sequence[Column]) -> list[list[tuple[int, int]]]:
    """For each key, (hash, pieces) of values holding more rows than a shuffle partition should.

    One scan whatever the number of keys: every task fills a sketch of bounded size for
    each, and no key is shuffled.  The answer only steers how rows are spread, so an
    estimate is enough for exact results.  A value is cut in proportion to its share, so
    all pieces together are at most a few times the partitions plus the number of hot
    values.
    """
    partitions = shuffle_partitions(rows)
    most = max(1, min(partitions, MOST_HOT))
    names = [f"h{i}" for i in range(len(key_hashes))]
    row = (
        rows.select(*[key.alias(name) for key, name in zip(key_hashes, names)])
        .agg(
            F.count("*").alias("n"),
            *[F.expr(f"approx_top_k({h}, {most}, {most * _TRACKED_FOR_EACH})").alias(h) for h in names],
        )
        .first()
    )
    total = row["n"]
    least = total / most
    return [
        [
            (item["item"], math.ceil(item["count"] * partitions * _PIECES_PER_PARTITION / total))
            for item in row[name] or []
            if item["count"] > least
        ]
        for name in names
    ]


def hot_keys(rows: DataFrame, key_hash: Column) -> list[tuple[int, int]]:
    """``hot_keys_together`` for a single key."""
    return hot_keys_together(rows, [key_hash])[0]


class Lookup:
    """A table that is unique on its key, and the columns of the rows that refer to it.

    NULL keys match nothing.  Key columns that are named like a column of the rows appear
    once in the result.  ``most_bytes`` is as in ``fits_broadcast``.  ``sized_by`` is the table
    that tells the size, if ``dimension`` is that table with something joined to it.
    """

    def __init__(
        self,
        dimension: DataFrame,
        on: Sequence[tuple[str, str]] | Sequence[str],
        most_bytes: int = 0,
        sized_by: DataFrame | None = None,
    ):
        self.dimension = dimension
        self.is_broadcast = fits_broadcast(dimension if sized_by is None else sized_by, most_bytes)
        self.pairs = [(key, key) if isinstance(key, str) else key for key in on]

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """The table with key columns of names of their own, so that no name is ambiguous."""
        keys = [F.col(b).cast(rows.schema[a].dataType).alias(f"__{b}") for a, b in self.pairs]
        return self.dimension.select("*", *keys).drop(*[b for _, b in self.pairs if b in rows.columns])

    def _same_key(self) -> list[Column]:
        return [F.col(a) == F.col(f"__{b}") for a, b in self.pairs]

    @property
    def added_bytes(self) -> float:
        """Mean bytes that the table adds to a row, as far as known."""
        keys = {b for _, b in self.pairs}
        return sum(8 + f.metadata.get(WIDTH, 0) for f in self.dimension.schema.fields if f.name not in keys)

    @property
    def row_hash(self) -> Column:
        return F.xxhash64(*[F.col(a) for a, _ in self.pairs])

    def join(
        self,
        rows: DataFrame,
        hot: list[tuple[int, int]],
        spread_by: Sequence[str] | None = None,
        how: str = "inner",
    ) -> DataFrame:
        """Inner (or left) join; the rows of a hot key are cut into pieces when they are shuffled."""
        keyed = self._keyed(rows)
        wanted = [*rows.columns, *[name for name in keyed.columns if not name.startswith("__")]]
        if self.is_broadcast:
            return rows.join(F.broadcast(keyed), self._same_key(), how).select(*wanted)
        if memory_bytes(self.dimension) is not None:
            keyed = keyed.hint("merge")  # the planner would go by compressed file sizes
        if not hot:
            return rows.join(keyed, self._same_key(), how).select(*wanted)

        # At most MOST_HOT rows of two numbers.
        pieces = F.broadcast(rows.sparkSession.createDataFrame(hot, "__hash long, __pieces int"))
        piece = F.pmod(F.xxhash64(*(spread_by or rows.columns)), F.coalesce("__pieces", F.lit(1)))
        cut_rows = rows.withColumn("__hash", self.row_hash).join(pieces, "__hash", "left")
        cut_rows = cut_rows.select(*rows.columns, piece.alias("__piece"))
        last = F.coalesce("__pieces", F.lit(1)).cast("long") - 1
        every_piece = F.explode(F.sequence(F.lit(0).cast("long"), last))
        dimension_hash = F.xxhash64(*[F.col(f"__{b}") for _, b in self.pairs])
        copies = keyed.withColumn("__hash", dimension_hash).join(pieces, "__hash", "left")
        copies = copies.select(*keyed.columns, every_piece.alias("__copy"))
        same_piece = F.col("__piece") == F.col("__copy")
        return cut_rows.join(copies, [*self._same_key(), same_piece], how).select(*wanted)


def lookup_joins(
    rows: DataFrame,
    lookups: Sequence[Lookup],
    keys_from: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Inner equi-joins of ``rows`` with several lookup tables, one after the other.

    Tables that are broadcast come last, so what they add to the rows is never shuffled; of the
    others those that add least come first, as it is shuffled again for each one after them.
    A table below the broadcast limit (by its size in memory, see ``memory_bytes``) is
    broadcast.  For each other one both sides are shuffled once, with the rows of a hot
    key cut into pieces and its one row repeated per piece, so no task receives a whole
    hot key.  The hot keys of all of them are looked for in one scan of ``keys_from``, a
    table with the same key columns; without it ``rows`` should be a table itself.
    ``spread_by`` columns tell the rows of one key apart (by default all columns).
    """
    shuffled = sorted((x for x in lookups if not x.is_broadcast), key=lambda x: x.added_bytes)
    source = keys_from if keys_from is not None else rows
    found = hot_keys_together(source, [x.row_hash for x in shuffled]) if shuffled else []
    hot = {id(x): keys for x, keys in zip(shuffled, found)}
    for lookup in [*shuffled, *(x for x in lookups if x.is_broadcast)]:
        rows = lookup.join(rows, hot.get(id(lookup), []), spread_by)
    return rows


def lookup_join(
    rows: DataFrame,
    dimension: DataFrame,
    on: Sequence[tuple[str, str]] | Sequence[str],
    keys_from: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    rows_unique: bool = False,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """``lookup_joins`` with one table; ``sized_by`` as in ``Lookup``.

    ``rows_unique`` says that ``rows`` has one row per key (it was grouped by it), so no
    key can be hot and none is looked for.
    """
    lookup = Lookup(dimension, on, sized_by=sized_by)
    if rows_unique:
        return lookup.join(rows, [])
    return lookup_joins(rows, [lookup], keys_from, spread_by)


_BITS = 63  # ids of a word; the sign bit is left out
_WORD_BYTES = 64  # of a word, the number before it and its start, in a hash table


def _words(dimension: DataFrame, natural: str, key: str) -> DataFrame:
    """The ids of a table as words of 63 bits, with the key before the first id of each.

    ``is_numbered`` says whether the keys of a word follow its ids without a gap.
    """
    ids = dimension.select(F.col(natural).cast("long").alias("id"), F.col(key).cast("long").alias("key"))
    place = F.pmod("id", F.lit(_BITS).cast("long")).cast("int")
    ids = ids.where("id IS NOT NULL").select("id", "key", place.alias("place"), (F.col("id") - place).alias("__word"))
    within = Window.partitionBy("__word").orderBy("id")
    first = F.col("key") - F.row_number().over(within)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place"))
    return ids.withColumn("first", first).groupBy("__word").agg(
        F.bit_or(bit).alias("__bits"),
        F.min("first").alias("__before"),
        (
            F.equal_null(F.min("first"), F.max("first")) & (F.count("key") == F.bit_count(F.bit_or(bit)))
            & (F.count("key") == F.count("*"))
        ).alias("is_numbered"),
    )


def numbered_lookup(
    rows: DataFrame, dimension: DataFrame, natural: str, key: str, most_bytes: int
) -> DataFrame | None:
    """Inner join that adds the surrogate ``key`` of the whole-number id ``natural``, without a shuffle.

    Keys that number the ids in order need no table of their own: a bitmap of the ids, with the
    number of ids before each word, says them all.  It is broadcast, one row for up to 63 ids.
    None if the keys are not numbered so, if the bitmap takes more than ``most_bytes`` (ids far
    apart), or if broadcasts are switched off; the table must be joined then.
    """
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if not all(isinstance(df.schema[natural].dataType, whole) for df in (rows, dimension)):
        return None
    if broadcast_limit(dimension) <= 0:
        return None
    words = _words(dimension, natural, key)
    found = words.agg(F.count("*").alias("n"), F.bool_and("is_numbered").alias("numbered")).first()
    if not found["numbered"] or found["n"] * _WORD_BYTES > most_bytes:
        return None
    place = F.pmod(F.col(natural).cast("long"), F.lit(_BITS).cast("long")).cast("int")
    start = F.col(natural).cast("long") - place
    upto = F.call_function("shiftleft", F.col("__bits"), _BITS - place)  # the id's bit is the last one left
    joined = rows.join(F.broadcast(words.drop("is_numbered")), start == F.col("__word"))
    held = joined.where(F.call_function("shiftright", F.col("__bits"), place).bitwiseAND(F.lit(1)) == 1)
    number = (F.col("__before") + F.bit_count(upto)).cast(dimension.schema[key].dataType)
    return held.select(*rows.columns, number.alias(key))


def unmatched_keys(
    rows: DataFrame, dimension: DataFrame, on: Sequence[tuple[str, str]] | Sequence[str]
) -> DataFrame:
    """Key values of ``rows`` without a dimension row, with their row counts.

    Rows are counted per key before the anti join, so a hot key is one row.
    """
    pairs = [(key, key) if isinstance(key, str) else key for key in on]
    counted = rows.groupBy(*[left for left, _ in pairs]).agg(F.count("*").alias("row_count"))
    keys = dimension.select(*[F.col(right).alias(f"__{right}") for _, right in pairs])
    condition = [counted[left] == keys[f"__{right}"] for left, right in pairs]
    return counted.join(keys, condition, "left_anti")


def unmatched_count(rows: DataFrame, dimension: DataFrame, on, name: str) -> DataFrame:
    missing = unmatched_keys(rows, dimension, on)
    return missing.agg(F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias(name))
