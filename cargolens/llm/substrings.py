"""Removal of repeated passages by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of each text (16 bits, so a position depends on
the last 16 bytes only).  A chunk ends behind white space where the hash's top bits are
zero, so the same words are cut alike wherever they stand, and an insertion shifts
nothing behind the next cut.  Chunks are compared by 128-bit digest over all documents:
the first occurrence, by doc_id and place, stays.  In every document the later
occurrences that lie side by side make runs, and runs of ``LEAST_RUN`` bytes or more
are cut out.  Shorter runs are phrases that many texts share by their nature.

Counting is pre-aggregated per digest; texts go through one shuffle, to meet the few
spans to be cut.  A worker holds one Arrow batch and what it makes of a few hundred of its
texts, and gives free memory back when its task ends.

Cases: null text stays null and empty text empty; rows that agree in doc_id and text
are one document (both rows get one result, and are no repeat of each other); a null
doc_id comes before all others; text without white space is cut at hash positions of
any character, or after ``MOST`` bytes; equal texts with different ids are repeats, so
all but the first lose what chunks cover; an empty table gives no rows.  Other columns
pass through unchanged, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens.llm.common import Scratch, read, small_batches, unused

LEAST, MOST = 24, 128  # bytes of a chunk; the last one of a text may be shorter
LEAST_RUN = 100  # bytes
_CUT = "struct<text: string, n_bytes: long, n_removed: long, spans: array<array<int>>>"
_CUT_TYPES = {
    "text": pa.string(), "n_bytes": pa.int64(), "n_removed": pa.int64(),
    "spans": pa.list_(pa.list_(pa.int32())),
}
_GEAR = np.random.RandomState(7).randint(0, 1 << 16, 256).astype(np.uint16)
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text; the last is its length."""
    if len(data) <= LEAST:
        return [len(data)] if data else []
    raw = np.frombuffer(data, np.uint8)
    # Sum of the last 16 gear values, each shifted once per byte since: by doubling.
    rolled = _GEAR[raw]
    for step in (1, 2, 4, 8):
        older = rolled[:-step] << np.uint16(step)
        rolled[step:] += older
    at_space = np.flatnonzero(_SPACE[raw] & (rolled >> 14 == 0)) + 1
    starts = np.append((raw[1:] & 0xC0) != 0x80, True)  # a character ends here
    any_place: np.ndarray | None = None

    ends, last = [], 0
    for cut in [*at_space.tolist(), len(data)]:
        while cut - last > MOST:  # no cut at white space in reach
            if any_place is None:
                any_place = np.flatnonzero(starts & (rolled >> 12 == 0)) + 1
            k = int(np.searchsorted(any_place, last + LEAST))
            if k < len(any_place) and any_place[k] <= last + MOST:
                last = int(any_place[k])
            else:
                last += MOST
                while not starts[last - 1]:
                    last -= 1
            ends.append(last)
        if cut - last >= LEAST:
            ends.append(cut)
            last = cut
    if last < len(data):
        ends.append(len(data))
    return ends


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``chunks`` from rows (doc_id, content, text)."""
    for batch in small_batches(batches):
        offsets, starts, sizes, digests = [0], [], [], []
        for text in batch["text"]:
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            at = 0
            for end in cuts(data):
                starts.append(at)
                sizes.append(end - at)
                digests.append(hashlib.blake2b(data[at:end], digest_size=16).digest())
                at = end
            offsets.append(len(starts))
        offsets = pa.array(offsets, pa.int32())
        lists = {
            "starts": pa.array(starts, pa.int32()),
            "sizes": pa.array(sizes, pa.int32()),
            "digests": pa.array(digests, pa.binary()),
        }
        lists = {k: pa.ListArray.from_arrays(offsets, v) for k, v in lists.items()}
        yield pa.record_batch({"doc_id": batch["doc_id"], "content": batch["content"]} | lists)


def chunks(docs: DataFrame) -> DataFrame:
    """doc_id, content, and the starts, sizes and digests of each text's chunks."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = "starts array<int>, sizes array<int>, digests array<binary>"
    keyed = docs.select("doc_id", F.xxhash64("text").alias("content"), "text")
    return keyed.mapInArrow(_chunked, f"doc_id {kind}, content long, {lists}")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, content and ``found``: (at, size) of chunks that occur earlier elsewhere."""
    scratch = Scratch(docs.sparkSession)
    cut = scratch.table(chunks(docs), "chunks")
    each = cut.select(
        "doc_id", "content", F.explode(F.arrays_zip("starts", "sizes", "digests")).alias("c")
    ).select(
        "doc_id", "content", F.col("c.starts").alias("at"), F.col("c.sizes").alias("size"),
        F.col("c.digests").alias("digest"),
    )
    place = F.struct("doc_id", "content", "at")
    known = each.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("times"))
    # Written, so that the shuffles of the counts and of the join do not add up on the disks.
    known = scratch.table(known.where("times > 1").select("digest", "first"), "known")
    later = each.join(known, "digest").where(~place.eqNullSafe(F.col("first")))
    found = scratch.table(
        later.groupBy("doc_id", "content").agg(
            F.sort_array(F.collect_set(F.struct("at", "size"))).alias("found")
        ),
        "found",
    )
    scratch.drop(cut, known)
    return found


def _spans(found) -> list[tuple[int, int]]:
    """Runs of chunks side by side, of ``LEAST_RUN`` bytes or more."""
    spans: list[list[int]] = []
    for chunk in found if found is not None else ():
        at, size = chunk["at"], chunk["size"]
        if spans and spans[-1][1] == at:
            spans[-1][1] = at + size
        else:
            spans.append([at, at + size])
    return [(a, b) for a, b in spans if b - a >= LEAST_RUN]


def _without_spans(texts: pa.Array, founds: pa.Array) -> pa.Array:
    """Texts without the runs of the chunks found in them, as rows of ``_CUT``."""
    rows = []
    for text, found in zip(texts, founds):
        if (text := text.as_py()) is None:
            rows.append((None, 0, 0, []))
            continue
        data, kept, at = text.encode("utf-8", "surrogatepass"), [], 0
        spans = _spans(found.as_py())
        for start, end in spans:
            kept.append(data[at:start])
            at = end
        kept.append(data[at:])
        left = b"".join(kept)
        rows.append((
            left.decode("utf-8", "surrogatepass") if spans else text,
            len(data), len(data) - len(left), spans,
        ))
    columns = zip(zip(*rows), _CUT_TYPES.values())
    return pa.StructArray.from_arrays([pa.array(c, kind) for c, kind in columns], list(_CUT_TYPES))


def remove_repeats(docs: DataFrame, into: str = "cut") -> DataFrame:
    """``docs`` with a struct column: kept text, n_bytes, n_removed, spans (start, end)."""

    @F.arrow_udf(_CUT)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pairs = (pa.record_batch(list(pair), names=["text", "found"]) for pair in batches)
        for batch in small_batches(pairs):
            yield _without_spans(batch["text"], batch["found"])

    key, content, found = unused(docs, "key", "content", "found")
    spans = repeated_chunks(docs).toDF(key, content, found)
    same = docs["doc_id"].eqNullSafe(spans[key]) & (F.xxhash64(docs["text"]) == spans[content])
    return docs.join(spans, same, "left").select(
        *[docs[c] for c in docs.columns], cut(docs["text"], spans[found]).alias(into)
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one holds."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "cut.n_bytes", "cut.n_removed", F.size("cut.spans").cast("long").alias("n_spans"),
        "cut.spans", "cut.text",
    )
