"""Near-duplicate documents: MinHash bands, exact verification, components.

1. One pass over the texts gives each document its number of distinct five-word
   shingles, a digest of its word sequence, 32 band keys of four universal-hash minima
   each, and one byte of each of 256 minima.  At a similarity of 0.75 a pair
   shares no band with probability (1 - 0.75^4)^32, 5 in a million, and less above.
2. Documents with one word sequence are one class and go on as one node, their
   smallest doc_id, however many they are.
3. In each bucket of a band the nodes are compared with a centre, not with each other.
   The centre is the node that meets most others over all bands: of a text and its
   edited copies that is the text itself.  Pairs whose set sizes rule the similarity out
   go; the others are tested on the minima's bytes (160 of 256 must agree; a pair at 0.75
   fails that with a probability of one in a million) and then on the full shingle sets.
4. Links become components.  A bucket whose nodes are in one component is done: no
   link inside it can change anything.  In the others the nodes outside the largest
   component are compared with all of the bucket, byte rows against byte rows in
   blocks.  Of the pairs that pass, a block hands on a spanning forest only.
5. The components of these forests are clusters: each pair that passed lies in one of
   them.  The texts of a cluster meet in blocks, where all pairs of different components
   are compared by their full shingle sets, and again a spanning forest of the links comes
   out.  So no step emits more rows than it has nodes and blocks, however many pairs of
   a group lie just below the similarity, and no pair of one bucket and two components
   stays untested.

Cases: null and empty texts have no shingles and are linked with nothing; a text of
fewer than five words has its whole sequence as its only shingle; rows of one doc_id
are one document, linked by any of their texts; a row with a null doc_id takes the
component of documents with the same words, else its component is null, and it is
kept in the latter case; very long texts and copies in any number are handled as
others; an empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cargolens.llm.common import Scratch, give_back_memory, read, small_batches
from cargolens.llm.components import components

WORDS = 5
SIMILARITY = 75  # percent
BANDS, ROWS = 32, 4
HASHES = 256  # universal hashes; the first BANDS * ROWS make the bands, all are compared
LEAST_EQUAL = 160  # bytes of the minima that must agree before sets are compared
BLOCK = 2048  # nodes of a bucket that are compared with as many at a time
PER_PIECE = 256  # pairs that one copy of a centre's text serves
SIDE, SIDE_SHINGLES = 1024, 1 << 21  # texts, and their shingles, that meet as many of a cluster

_WORD = r"[^\x20\x09-\x0D]"  # what a text with a word has

_random = np.random.RandomState(20240229)


def _draw(n: int) -> np.ndarray:
    return _random.randint(0, 2**63, n, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


# Multiply-add hashing modulo 2^64: odd factors, any addends.
_FACTORS, _ADDENDS, _BY_WORD, _BY_ROW, _BY_BAND = map(_draw, (HASHES, HASHES, WORDS, ROWS, BANDS))


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread a sum's bits over the whole word (xor-shift and odd factors)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; both ASCII only, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _hashed(found: list[bytes]) -> np.ndarray:
    """Distinct shingles as 64-bit hashes."""
    if len(found) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found))], np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = len(own) - WORDS + 1
    return np.unique(_mix(sum(own[k : k + n] * _BY_WORD[k] for k in range(WORDS))))


def _minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 256):  # a block that fits a core's cache
        hashes = shingles[at : at + 256, None] * _FACTORS
        hashes += _ADDENDS
        np.minimum(low, hashes.min(0), out=low)
    return low


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, content (digest of the words), bands and bytes of the minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes, contents, bands, checks = [], [], [], []
            for text in batch["text"]:
                found = words_of(text.as_py())
                if not found:
                    sizes.append(0)
                    contents.append(None)
                    bands.append(None)
                    checks.append(None)
                    continue
                shingles = _hashed(found)
                low = _minima(shingles)
                mixed = _mix(low)
                keys = (mixed[: BANDS * ROWS].reshape(BANDS, ROWS) * _BY_ROW).sum(1) + _BY_BAND
                sizes.append(len(shingles))
                contents.append(hashlib.blake2b(b" ".join(found), digest_size=16).digest())
                bands.append(_mix(keys).view(np.int64))
                checks.append((mixed & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "content": pa.array(contents, pa.binary()),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                    "checks": pa.array(checks, pa.binary()),
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles long, content binary, bands array<long>, checks binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


@F.arrow_udf(T.BooleanType())
def _alike(left: pa.Array, right: pa.Array) -> pa.Array:
    a = np.frombuffer(b"".join(left.to_pylist()), np.uint8).reshape(-1, HASHES)
    b = np.frombuffer(b"".join(right.to_pylist()), np.uint8).reshape(-1, HASHES)
    return pa.array((a == b).sum(1) >= LEAST_EQUAL)


def _shingle_set(text: str) -> set[bytes]:
    found = words_of(text)
    if len(found) < WORDS:
        return {b" ".join(found)}
    return {b" ".join(found[i : i + WORDS]) for i in range(len(found) - WORDS + 1)}


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last_text, last_set = None, set()
    for batch in small_batches(batches):
        good = []
        for a, b in zip(batch["text_a"], batch["text_b"]):
            if (a := a.as_py()) != last_text:
                last_text, last_set = a, _shingle_set(a)
            own = _shingle_set(b.as_py())
            both = len(last_set & own)
            good.append(100 * both >= SIMILARITY * (len(last_set) + len(own) - both))
        yield pa.record_batch(
            {"u": batch["a"].filter(pa.array(good, pa.bool_())),
             "v": batch["b"].filter(pa.array(good, pa.bool_()))}
        )


def _sizes_allow(a: str, b: str):
    return F.expr(f"100 * least({a}, {b}) >= {SIMILARITY} * greatest({a}, {b})")


def _texts_of(nodes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Texts of some nodes.  These are written first, so that Spark sees whether they are
    few enough to go to the texts; else the texts are shuffled."""
    wanted = scratch.table(nodes.distinct(), "wanted")
    found = scratch.table(texts.join(wanted, "node", "left_semi"), "texts")
    scratch.drop(wanted)
    return found


def _links(likely: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) that are similar, as edges (u, v); a is the likelier hot side."""
    likely = scratch.table(likely, "likely")
    both = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node")))
    texts = _texts_of(both, texts, scratch)
    # A node in many pairs is copied, once for every PER_PIECE pairs, and its pairs are
    # dealt out among the copies.
    pieces = likely.groupBy("a").agg(F.ceil(F.count("*") / PER_PIECE).cast("int").alias("pieces"))
    dealt = likely.join(pieces, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("pieces")).cast("int").alias("piece")
    )
    centres = texts.toDF("a", "text_a").join(pieces, "a").select(
        "a", "text_a", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")
    )
    with_texts = dealt.join(texts.toDF("b", "text_b"), "b").join(centres, ["a", "piece"])
    kind = texts.schema["node"].dataType.simpleString()
    found = with_texts.select("a", "b", "text_a", "text_b").mapInArrow(
        _confirmed, f"u {kind}, v {kind}"
    )
    found = scratch.table(found, "links")
    scratch.drop(likely, texts)
    return found


def _members(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(bucket, node, size, met) of buckets with two nodes or more; met: others in all bands."""
    by_band = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    shared = by_band.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = scratch.table(by_band.join(shared, "bucket").distinct(), "members")
    met = members.groupBy("node").agg(F.sum("n").alias("met"))
    ranked = members.join(met, "node").select("bucket", "node", "size", "met")
    ranked = scratch.table(ranked, "ranked")
    scratch.drop(members)
    return ranked


def _likely_stars(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's centre and another node that may be similar."""
    best = F.max(F.struct("met", (-F.col("node")).alias("minus"), "node", "size"))
    centres = members.groupBy("bucket").agg(best.alias("best")).select(
        "bucket", F.col("best.node").alias("a"), F.col("best.size").alias("size_a")
    )
    pairs = members.join(centres, "bucket").where(F.col("a") != F.col("node"))
    pairs = pairs.where(_sizes_allow("size", "size_a")).select("a", F.col("node").alias("b")).distinct()
    checks = nodes.select("node", "checks")
    return (
        pairs.join(checks.toDF("b", "checks_b"), "b")
        .join(checks.toDF("a", "checks_a"), "a")
        .where(_alike("checks_a", "checks_b"))
        .select("a", "b")
    )


def _joined(label: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """One of ``others`` for each label that is not i's; all these labels become i's."""
    labels, first = np.unique(label[others], return_index=True)
    new = labels != label[i]
    label[np.isin(label, labels[new])] = label[i]
    return others[first[new]]


def _forest(node: np.ndarray, found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Pairs (a, b) of nodes from the places that ``_joined`` gave."""
    none = [np.empty(0, np.int64)]
    a = np.concatenate(none + [node[others] for _, others in found])
    b = np.concatenate(none + [np.full(len(others), node[i]) for i, others in found])
    return pa.record_batch({"a": pa.array(a), "b": pa.array(b)})


def _compared(block: pa.Table) -> pa.RecordBatch:
    """Likely pairs of the left nodes of a block (outside the largest component) and all:
    as many as connect what all of them would connect."""
    left = block["left"].to_numpy()
    node, size, component = (block[c].to_numpy() for c in ("node", "size", "component"))
    outside = block["outside"].to_numpy()
    checks = np.frombuffer(b"".join(block["checks"].to_pylist()), np.uint8).reshape(-1, HASHES)
    right = np.flatnonzero(block["right"].to_numpy())
    label = np.unique(node, return_inverse=True)[1]  # a node may stand on both sides
    found = []
    for i in np.flatnonzero(left):
        # Of two nodes that are both outside, the smaller has the larger on its right.
        fit = right[(component[right] != component[i]) & ~(outside[right] & (node[right] < node[i]))]
        fit = fit[label[fit] != label[i]]
        least, most = np.minimum(size[fit], size[i]), np.maximum(size[fit], size[i])
        fit = fit[100 * least >= SIMILARITY * most]
        fit = fit[(checks[fit] == checks[i]).sum(1) >= LEAST_EQUAL]
        found.append((i, _joined(label, i, fit)))
    return _forest(node, found)


def _verified(block: pa.Table) -> pa.RecordBatch:
    """Similar pairs of a block's left and right texts: a forest over their components."""
    node = block["node"].to_numpy()
    left, right = (np.flatnonzero(block[c].to_numpy()) for c in ("left", "right"))
    if not len(left) or not len(right):
        return _forest(node, [])
    sets = [_hashed(words_of(text.as_py())) for text in block["text"]]
    label = np.unique(block["component"].to_numpy(), return_inverse=True)[1]
    size = np.array([len(own) for own in sets])
    values, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(numbers, np.cumsum(size)[:-1])
    on_right = np.concatenate([own[j] for j in right])
    starts = np.r_[0, np.cumsum(size[right])[:-1]]
    marked = np.zeros(len(values), np.int64)
    found = []
    for i in left:
        if (label[right] == label[i]).all():
            continue
        marked[own[i]] = 1
        both = np.add.reduceat(marked[on_right], starts)
        marked[own[i]] = 0
        similar = 100 * both >= SIMILARITY * (size[i] + size[right] - both)
        found.append((i, _joined(label, i, right[similar])))
    return _forest(node, found)


def _by_block(
    batches: Iterator[pa.RecordBatch], body: Callable[[pa.Table], pa.RecordBatch], *names: str
) -> Iterator[pa.RecordBatch]:
    """``body`` of every run of rows with one value of the number columns ``names``."""
    parts: list[pa.Table] = []  # of the run that may go on in the next batch
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        keys = [table[c].to_numpy() for c in names]
        change = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        starts = np.r_[0, np.flatnonzero(change) + 1, len(table)]
        for start, end in zip(starts[:-1], starts[1:]):
            key = tuple(k[start] for k in keys)
            if parts and key != last:
                yield body(pa.concat_tables(parts))
                parts = []
            parts.append(table.slice(start, end - start))
            last = key
    if parts:
        yield body(pa.concat_tables(parts))
    give_back_memory()


def _likely_rest(members: DataFrame, components_: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of different components in one bucket that may be similar, as forests."""
    named = members.join(components_.toDF("node", "component"), "node", "left").select(
        "bucket", "node", "size", F.coalesce("component", "node").alias("component")
    )
    parts = named.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    totals = parts.groupBy("bucket").agg(
        F.max(F.struct("n", "component")).alias("largest"), F.sum("n").alias("all")
    ).where(F.col("all") > F.col("largest.n"))
    blocks = totals.select(
        "bucket",
        F.col("largest.component").alias("largest"),
        F.ceil((F.col("all") - F.col("largest.n")) / BLOCK).cast("int").alias("left_blocks"),
        F.ceil(F.col("all") / BLOCK).cast("int").alias("right_blocks"),
    )
    open_ = named.join(blocks, "bucket").join(nodes.select("node", "checks"), "node")
    open_ = scratch.table(
        open_.withColumn("outside", F.col("component") != F.col("largest")).drop("largest"), "open"
    )

    columns = ("node", "size", "component", "outside", "checks")

    def dealt(rows: DataFrame, left: bool, own: str, other: str) -> DataFrame:
        """Each row to one block of its own side and to all blocks of the other."""
        return rows.select(
            "bucket",
            F.pmod(F.xxhash64("node"), F.col(f"{own}s")).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other),
            F.lit(left).alias("left"), F.lit(not left).alias("right"), *columns,
        )

    # Most buckets are one block, where a row is on both sides and is sent once.
    small = F.col("right_blocks") == 1
    block = F.lit(0).alias("left_block"), F.lit(0).alias("right_block")
    once = open_.where(small).select(
        "bucket", *block, F.col("outside").alias("left"), F.lit(True).alias("right"), *columns
    )
    large = open_.where(~small)
    both = once.unionByName(
        dealt(large.where("outside"), True, "left_block", "right_block")
    ).unionByName(dealt(large, False, "right_block", "left_block"))
    keys = ("bucket", "left_block", "right_block")
    kind = nodes.schema["node"].dataType.simpleString()
    grouped = both.repartition(*keys).sortWithinPartitions(*keys)
    return grouped.mapInArrow(
        lambda batches: _by_block(batches, _compared, *keys), f"a {kind}, b {kind}"
    ).distinct()


def _similar_rest(
    likely: DataFrame, components_: DataFrame, texts: DataFrame, scratch: Scratch
) -> DataFrame:
    """Similar pairs (a, b) of different components in one cluster of likely pairs, as forests."""
    pointers = components(likely.toDF("u", "v"), scratch).toDF("node", "cluster")
    tops = pointers.select(F.col("cluster").alias("node"), "cluster").distinct()
    clusters = scratch.table(pointers.unionByName(tops), "pointers")
    texts = _texts_of(clusters.select("node"), texts, scratch)
    rows = clusters.join(texts, "node").join(
        components_.toDF("node", "component"), "node", "left"
    ).select("cluster", "node", F.coalesce("component", "node").alias("component"), "text")
    rows = scratch.table(rows, "clusters")
    scratch.drop(texts, clusters)
    # A text has no more shingles than half its bytes.
    shingles = F.sum(F.octet_length("text")) / 2
    blocks = rows.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / SIDE, shingles / SIDE_SHINGLES)).cast("int").alias("blocks")
    )
    own, other = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.col("other")
    met = rows.join(blocks, "cluster").select(
        "cluster", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
        "node", "component", "text",
    ).select(
        "cluster", F.least("own", "other").alias("left_block"), F.greatest("own", "other").alias("right_block"),
        (F.col("own") <= other).alias("left"), (F.col("own") >= other).alias("right"),
        "node", "component", "text",
    )
    keys = ("cluster", "left_block", "right_block")
    kind = texts.schema["node"].dataType.simpleString()
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        lambda batches: _by_block(batches, _verified, *keys), f"a {kind}, b {kind}"
    )


def link_components(nodes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v): v is the smallest node of u's component, for all u that aren't the smallest."""
    members = _members(nodes, scratch)
    links = _links(_likely_stars(members, nodes), texts, scratch)
    found = components(links, scratch)
    likely = scratch.table(_likely_rest(members, found, nodes, scratch), "likely_rest")
    more = _links(_similar_rest(likely, found, texts, scratch), texts, scratch)
    scratch.drop(members, links, likely)
    return found if more.isEmpty() else components(found.unionByName(more), scratch)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    signed = scratch.table(signatures(docs), "signed")
    classes = signed.where("n_shingles > 0").groupBy("content").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("rows"),
        F.first("n_shingles").alias("size"), F.first("bands").alias("bands"),
        F.first("checks").alias("checks"),
    ).where("node IS NOT NULL")
    classes = scratch.table(classes, "classes")
    texts = docs.select(F.col("doc_id").alias("node"), "text").where(F.col("text").rlike(_WORD))
    found = link_components(classes.select("node", "size", "bands", "checks"), texts, scratch)

    # Only classes of several rows or with links need a look-up; others name themselves.
    named = (
        classes.select("content", "node", "rows")
        .join(found.toDF("node", "component"), "node", "left")
        .where("rows > 1 OR component IS NOT NULL")
        .select("content", F.coalesce("component", "node").alias("component"))
    )
    out = signed.select("doc_id", "n_shingles", "content").join(named, "content", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(read(spark, sf_dir, "documents"))
