"""Removal of every byte that a repeated 200-byte string covers, exactly.

A full suffix array of a corpus would be many times its size.  Only suffixes that can
have a partner are sorted, and bucket by bucket:

1. Every 200-byte window has a fingerprint, the smallest hash of its 24-byte strings;
   equal windows have equal fingerprints.  Consecutive windows with one fingerprint make
   a run (about 90 windows, so one row per 90 bytes).  Runs whose fingerprint occurs
   nowhere else cannot hold a repeated window and are done.
2. The others are grouped by fingerprint and content digest (128 bits together).  Where
   all runs of a fingerprint have one content, all their windows are repeated.  Counts
   are pre-aggregated: copies in any number are one row.
3. What is left are fingerprints with different contents.  Each is a suffix bucket; a
   task sorts the suffixes of a block of buckets at a time: by their first and last 32
   bytes, and where those tie by the ranks of a difference-cover sample of the block.
   Modulo 31 the six residues of the cover have every difference, so two tied suffixes
   both meet a sampled position at one distance below 31, and the 168-byte strings
   there, ranked once, decide what is left of the 200 bytes.

4. A bucket larger than a block is never sorted whole, whatever its size.  Its contents are
   dealt by their digest into pieces of about a block; a piece gives each different
   200-byte string once, as a 128-bit digest with the number of its windows, these are
   counted over all pieces, and a piece gets back those of its single strings that others hold.

Memory is bounded by a block (or one text, if that is longer), not by how long or how
frequent the repeats are.

Cases: null text is empty; texts below 200 bytes have no window and stay; matches never
cross documents; repeated rows are documents that repeat each other; a null doc_id is an
id like others; a document of one character over and over repeats itself; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cargolens.llm.common import Scratch, read

LENGTH = 200
ANCHOR = 24
_INSIDE = LENGTH - ANCHOR + 1  # anchors in a window
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)  # every difference modulo 31 occurs
_EDGE = 32  # bytes compared directly at either end; more than PERIOD
_SAMPLED = LENGTH - _EDGE
BLOCK = 1_000_000  # bytes whose suffixes are sorted together

_draws = np.random.RandomState(11)
_BYTE = _draws.randint(0, 2**63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)  # odd


def _anchor_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``ANCHOR`` bytes at every position."""
    eight = _BYTE[raw]
    with np.errstate(over="ignore"):
        factor = _FACTOR
        for step in (1, 2, 4):
            eight = eight[:-step] * factor + eight[step:]
            factor = factor * factor
        whole = (eight[:-16] * factor + eight[8:-8]) * factor + eight[16:]
        whole = (whole ^ (whole >> np.uint64(32))) * _FACTOR
    return whole ^ (whole >> np.uint64(29))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    more = width - size
    return np.minimum(values[:-more], values[more:]) if more else values


def runs_of(data: bytes) -> list[tuple[int, int, int, int, int, int]]:
    """(at, windows, fingerprint, digest, anchor's offset, anchors) of each run."""
    if len(data) < LENGTH:
        return []
    hashes = _anchor_hashes(np.frombuffer(data, np.uint8))
    low = _sliding_min(hashes, _INSIDE)
    starts = np.r_[0, np.flatnonzero(low[1:] != low[:-1]) + 1, len(low)].tolist()
    prints = low[starts[:-1]]
    out = []
    for at, end, value in zip(starts[:-1], starts[1:], prints):
        anchors = np.flatnonzero(hashes[at : end - 1 + _INSIDE] == value)
        digest = xxhash.xxh3_64_intdigest(data[at : end - 1 + LENGTH])
        out.append((at, end - at, int(value), digest, int(anchors[0]), len(anchors)))
    return out


def _runs(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, found = [], []
            for i, text in enumerate(batch["text"]):
                own = runs_of((text.as_py() or "").encode("utf-8", "surrogatepass"))
                index += [i] * len(own)
                found += own
            at, windows, prints, digests, offset, anchors = zip(*found) if found else [()] * 6
            index = pa.array(index, pa.int64())
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"].take(index),
                    "content": batch["content"].take(index),
                    "at": pa.array(at, pa.int32()),
                    "windows": pa.array(windows, pa.int32()),
                    "f": pa.array(np.array(prints, np.uint64).view(np.int64)),
                    "h": pa.array(np.array(digests, np.uint64).view(np.int64)),
                    "offset": pa.array(offset, pa.int32()),
                    "anchors": pa.array(anchors, pa.int32()),
                }
            )

    columns = "content long, at int, windows int, f long, h long, offset int, anchors int"
    return docs.mapInArrow(run, f"doc_id {kind.simpleString()}, {columns}")


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes at every position as one big-endian number."""
    wide = text.astype(np.uint64)
    out = wide[:-7] << np.uint64(56)
    for k in range(1, 8):
        out |= wide[k : len(wide) - 7 + k] << np.uint64(56 - 8 * k)
    return out


def _refine(order: np.ndarray, classes: np.ndarray, keys: np.ndarray):
    """Sort items by (class, key); the items that still have an equal, and new classes."""
    by = np.lexsort((keys, classes))
    order, classes, keys = order[by], classes[by], keys[by]
    first = np.ones(len(by), bool)
    first[1:] = (classes[1:] != classes[:-1]) | (keys[1:] != keys[:-1])
    new = np.cumsum(first) - 1
    tied = np.bincount(new)[new] > 1
    return order[tied], new[tied]


def repeated(contents: list[bytes], windows: list[int], offsets: list[int], buckets: list[int]) -> np.ndarray:
    """For the windows of all contents, one after the other: is it repeated in its bucket?

    One block of suffix buckets.  Contents are laid out with their anchors at one
    residue, which makes most ties meet at the cover's first residue.
    """
    parts, bases, size = [], [], 0
    for content, offset in zip(contents, offsets):
        gap = -(size + offset) % PERIOD
        bases.append(size + gap)
        parts += [bytes(gap), content]
        size += gap + len(content)
    joined = b"".join([*parts, bytes(PERIOD + LENGTH)])
    words = _words(np.frombuffer(joined, np.uint8))
    counts = np.array(windows)
    total = int(counts.sum())
    first = np.repeat(np.cumsum(counts) - counts, counts)
    place = np.repeat(np.array(bases), counts) + np.arange(total) - first
    classes = np.repeat(np.unique(np.array(buckets), return_inverse=True)[1], counts)

    items = np.arange(total)
    for edge in (*range(0, _EDGE, 8), *range(_SAMPLED, LENGTH, 8)):
        items, classes = _refine(items, classes, words[place[items] + edge])
    found = np.zeros(total, bool)
    if not len(items):
        return found

    # Ranks of the sampled positions that tied suffixes can meet.
    meets = np.stack([place[items] + (d - place[items]) % PERIOD for d in COVER])
    sample = np.unique(meets)
    strings = [joined[p : p + _SAMPLED] for p in sample.tolist()]
    rank_of = {string: rank for rank, string in enumerate(sorted(set(strings)))}
    ranks = np.fromiter((rank_of[string] for string in strings), np.int64, len(strings))

    def keys(d: int, of: np.ndarray) -> np.ndarray:
        distance = meets[d, of] - place[items[of]]
        rank = ranks[np.searchsorted(sample, meets[d, of])]
        return (classes[of] * PERIOD + distance) * len(rank_of) + rank

    everyone = np.arange(len(items))
    _, one, same, n = np.unique(
        keys(0, everyone), return_index=True, return_inverse=True, return_counts=True
    )
    tied = n[same] > 1
    # Equals with other residues meet elsewhere; one of each class stands for it.
    if len(np.unique(place[items] % PERIOD)) > 1:
        several = np.concatenate([keys(d, one) for d in range(len(COVER))])
        _, again, times = np.unique(several, return_inverse=True, return_counts=True)
        meets_other = (times[again] > 1).reshape(len(COVER), len(one)).any(0)
        tied |= meets_other[same]
    found[items[tied]] = True
    return found


def _ranges(flags: np.ndarray) -> list[int]:
    """[start, end, start, end, ...] of the runs of True."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edge.tolist()


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (f, h, windows, offset, several, bytes), sorted by f, to the repeated windows."""

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        f, h, windows, offsets, several, contents = zip(*rows)
        flags = repeated(list(contents), list(windows), list(offsets), list(f))
        ranges, at = [], 0
        for n, copies in zip(windows, several):
            ranges.append([0, n] if copies else _ranges(flags[at : at + n]))
            at += n
        return pa.record_batch(
            {"f": pa.array(f, pa.int64()), "h": pa.array(h, pa.int64()),
             "ranges": pa.array(ranges, pa.list_(pa.int32()))}
        )

    block: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch[name].to_pylist() for name in ("f", "h", "windows", "offset", "several", "bytes"))):
            # A block ends where a bucket ends.
            if size > BLOCK and row[0] != block[-1][0]:
                yield solved(block)
                block, size = [], 0
            block.append(row)
            size += len(row[-1])
    if block:
        yield solved(block)


def _digests(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit digests of all windows of a piece, as bytes: different ones, each window's, times."""
    found = bytearray()
    for content, windows in zip(rows["bytes"].to_pylist(), rows["windows"].to_pylist()):
        for at in range(windows):
            found += xxhash.xxh3_128_digest(content[at : at + LENGTH])
    # As void the zero bytes at the end count too.
    return np.unique(np.frombuffer(bytes(found), "V16"), return_inverse=True, return_counts=True)


def _piece_strings(rows: pa.Table) -> pa.Table:
    """(f, piece, g, times): the different strings of one piece of a bucket."""
    strings, _, times = _digests(rows)
    return pa.table(
        {"f": pa.array(np.repeat(rows["f"][0].as_py(), len(times)), pa.int64()),
         "piece": pa.array(np.repeat(rows["piece"][0].as_py(), len(times)), pa.int64()),
         "g": pa.array([g.tobytes() for g in strings], pa.binary()), "times": pa.array(times, pa.int64())}
    )


def _piece_ranges(rows: pa.Table, elsewhere: pa.Table) -> pa.Table:
    """(f, h, ranges) of one piece; ``elsewhere`` are its single strings that other pieces hold."""
    if not rows.num_rows:
        return pa.table({"f": pa.array([], pa.int64()), "h": pa.array([], pa.int64()),
                         "ranges": pa.array([], pa.list_(pa.int32()))})
    strings, each, times = _digests(rows)
    others = np.frombuffer(b"".join(elsewhere["g"].to_pylist()), "V16")
    flags = ((times > 1) | np.isin(strings, others))[each]
    ranges, at = [], 0
    for n, copies in zip(rows["windows"].to_pylist(), rows["several"].to_pylist()):
        ranges.append([0, n] if copies else _ranges(flags[at : at + n]))
        at += n
    return pa.table({"f": rows["f"], "h": rows["h"], "ranges": pa.array(ranges, pa.list_(pa.int32()))})


def _counted_buckets(hot: DataFrame, scratch: Scratch) -> DataFrame:
    """(f, h, ranges) of the buckets that are larger than a block, piece by piece."""
    hot = scratch.table(hot, "hot")
    strings = hot.groupBy("f", "piece").applyInArrow(
        _piece_strings, "f long, piece long, g binary, times long"
    )
    strings = scratch.table(strings, "strings")
    counts = strings.groupBy("f", "g").agg(F.count("*").alias("pieces")).where("pieces > 1")
    # What a piece holds twice by itself is repeated anyway.
    elsewhere = strings.where("times = 1").join(counts, ["f", "g"]).select("f", "piece", "g")
    out = hot.groupBy("f", "piece").cogroup(elsewhere.groupBy("f", "piece")).applyInArrow(
        _piece_ranges, "f long, h long, ranges array<int>"
    )
    out = scratch.table(out, "counted")
    scratch.drop(hot, strings)
    return out


def _contents(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of the runs listed for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, listed in zip(batch["text"], batch["listed"].to_pylist()):
                data = text.as_py().encode("utf-8", "surrogatepass")
                rows += [
                    (r["f"], r["h"], r["windows"], r["offset"], r["several"], r["pieces"],
                     data[r["at"] : r["at"] + r["windows"] - 1 + LENGTH])
                    for r in listed
                ]
            f, h, windows, offset, several, pieces, found = zip(*rows) if rows else [()] * 7
            yield pa.record_batch(
                {"f": pa.array(f, pa.int64()), "h": pa.array(h, pa.int64()),
                 "windows": pa.array(windows, pa.int32()), "offset": pa.array(offset, pa.int32()),
                 "several": pa.array(several, pa.bool_()), "pieces": pa.array(pieces, pa.int64()),
                 "bytes": pa.array(found, pa.binary())}
            )

    key = wanted.withColumnsRenamed({"doc_id": "id", "content": "text_hash"})
    same = docs["doc_id"].eqNullSafe(key["id"]) & (docs["content"] == key["text_hash"])
    # Copies of a row would give their contents again; one of them is enough.
    joined = docs.join(key, same).select("text", "listed")
    schema = "f long, h long, windows int, offset int, several boolean, pieces long, bytes binary"
    return joined.mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, content, spans: sorted, disjoint (start, end) byte ranges to remove."""
    runs = scratch.table(_runs(docs), "runs")
    shared = runs.groupBy("f").agg(F.sum("anchors").alias("n")).where("n > 1").select("f")
    shared = scratch.table(shared, "shared")
    flagged = scratch.table(runs.join(shared, "f"), "flagged")
    scratch.drop(runs, shared)

    one = F.struct("doc_id", "content", "at", "windows", "offset")
    contents = flagged.groupBy("f", "h").agg(
        (F.count("*") > 1).alias("several"), F.max("anchors").alias("anchors"), F.min(one).alias("one")
    )
    contents = scratch.table(contents, "contents")
    kinds = contents.groupBy("f").agg(
        F.count("*").alias("kinds"), F.max("anchors").alias("most"),
        F.ceil(F.sum(F.col("one.windows") + (LENGTH - 1)) / BLOCK).alias("pieces"),
    )
    open_ = scratch.table(kinds.where("kinds > 1 OR most > 1").select("f", "pieces"), "open")

    listed = contents.join(open_, "f").select("f", "h", "several", "pieces", "one.*")
    listed = listed.groupBy("doc_id", "content").agg(
        F.collect_list(F.struct("f", "h", "at", "windows", "offset", "several", "pieces")).alias("listed")
    )
    # Repeated rows give their contents once more, so equal ones are merged again.
    each = _contents(listed, docs)
    large = not open_.where("pieces > 1").isEmpty()
    if large:
        each = scratch.table(each, "each")
    small = each.where("pieces = 1").repartition("f").dropDuplicates(["f", "h"])
    sorted_ = small.sortWithinPartitions("f").mapInArrow(
        _sorted_buckets, "f long, h long, ranges array<int>"
    )
    solved = [scratch.table(sorted_, "sorted")]
    if large:
        hot = each.where("pieces > 1").dropDuplicates(["f", "h"])
        hot = hot.withColumn("piece", F.pmod(F.xxhash64("h"), "pieces"))
        solved.append(_counted_buckets(hot.drop("pieces", "offset"), scratch))
        scratch.drop(each)
    sorted_ = solved[0] if not large else solved[0].unionByName(solved[1])

    alone = contents.join(open_, "f", "left_anti").where("several").select(
        "f", "h", F.lit(None).cast("array<int>").alias("ranges")
    )
    covered = flagged.select("doc_id", "content", "at", "windows", "f", "h").join(
        sorted_.where(F.size("ranges") > 0).unionByName(alone), ["f", "h"]
    )
    ranges = F.coalesce("ranges", F.array(F.lit(0), F.col("windows")))
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(ranges) - 2, F.lit(2)),
        lambda i: F.struct(
            (F.col("at") + F.get(ranges, i)).alias("start"),
            (F.col("at") + F.get(ranges, i + 1) + (LENGTH - 1)).alias("end"),
        ),
    )
    grouped = covered.select("doc_id", "content", F.explode(pairs).alias("span")).groupBy(
        "doc_id", "content"
    ).agg(F.sort_array(F.collect_set("span")).alias("spans"))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    merged = F.aggregate(
        "spans", empty,
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= x["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(F.struct(
                    F.get(done, F.size(done) - 1)["start"].alias("start"),
                    F.greatest(F.get(done, F.size(done) - 1)["end"], x["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    spans = scratch.table(grouped.select("doc_id", "content", merged.alias("spans")), "spans")
    scratch.drop(flagged, contents, open_, *solved)
    return spans


def remove_repeated(docs: DataFrame, digests: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans and ``kept``: what is left, as bytes.

    With ``digests``, kept_sha256 in the place of ``kept``.
    """
    scratch = Scratch(docs.sparkSession)
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("content", F.xxhash64("text"))
    spans = repeated_spans(keyed, scratch)
    spans = spans.withColumnsRenamed({"doc_id": "id", "content": "text_hash"})

    @F.pandas_udf(T.BinaryType())
    def keep(texts: pd.Series, founds: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, founds):
            data, at, parts = text.encode("utf-8", "surrogatepass"), 0, []
            for span in found if found is not None else ():
                parts.append(data[at : span["start"]])
                at = span["end"]
            left = b"".join([*parts, data[at:]])
            out.append(hashlib.sha256(left).hexdigest().encode() if digests else left)
        return pd.Series(out)

    same = keyed["doc_id"].eqNullSafe(spans["id"]) & (keyed["content"] == spans["text_hash"])
    removed = F.aggregate(
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")), F.lit(0).cast("long"),
        lambda n, x: n + x["end"] - x["start"],
    )
    kept = keep("text", "spans")
    return keyed.join(spans, same, "left").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        "spans",
        kept.cast("string").alias("kept_sha256") if digests else kept.alias("kept"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that repeated 200-byte strings cover."""
    found = remove_repeated(read(spark, sf_dir, "documents"), digests=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
