"""Byte-level BPE encoding and decoding through one table of distinct words.

A byte-level tokenizer cuts a text into words before it merges anything, and no merge
crosses a cut.  So a text's ids are those of its words one after the other, and the
bytes that they stand for are those of its words too.

1. Split: each task cuts its texts into words, block by block.  A block has a table of
   its distinct words, and a text is the places of its words in that table.
2. Table: the words of all blocks meet in one shuffle by word and are sorted there, so
   that each distinct word of the corpus stands in one place.  It is encoded there once,
   and spelled once by joining its ids with the tokenizer's table of ids and pieces,
   which every task holds.
3. Back: ids and spelling return to each block by one shuffle, where every text's ids
   and its decoded text are put together by position.

What is shuffled is a row per block and distinct word, the ids of those words in bundles
by block, and each block once as packed word numbers.  A block is bounded by ``BLOCK`` characters (or is one longer text),
and a word is at most once in a block, so neither a frequent word nor a group of copies
makes a large group.  ``decode`` does the same for any table of ids, by a broadcast join:
the table of pieces has as many rows as the vocabulary.

``docs`` is read twice, for the words and for the blocks, so it should be a written
table.  A block's name holds a digest of its words: should the two reads differ, the
job fails and gives no wrong ids.

Words are cut where every tokenizer of this kind cuts: at white space as the library knows it,
and between letters and a mark behind them.  Special tokens are cut out first, as the
library does.  A tokenizer with another splitter or a normalizer is refused.

Cases: null text is empty, and an empty text has no ids and decodes to empty text; very
long texts and words are whole; equal texts and repeated rows give equal rows; an empty
table gives no rows; a null doc_id stays null; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens.llm.common import Scratch, read, unused

BLOCK = 48_000_000  # characters
SLICE = 4_000_000  # characters split at a time
PUT_TOGETHER = 1_000_000  # words put together at a time
BUNDLE = 200_000  # words of a task that are bundled by block at a time
LEVEL = 3  # of compression

# White space as the tokenizers library knows it; letters that are always
# letters; marks that end a run of letters.
_SPACE = "\t-\r \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = ".,;:!?"
# A run without white space, with one plain space before it; of several spaces the last
# one belongs to what follows, and a run of spaces at the end stays whole.
_WORD = re.compile(
    f" ?[{_LETTERS}]++(?=[{_MARKS}])| ?[^{_SPACE}]++|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]"
)


class Splitter:
    """Cuts texts into words that the tokenizer never merges across."""

    def __init__(self, tokenizer_file: str):
        settings = json.loads(Path(tokenizer_file).read_text())
        before = settings["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True)
        if settings["normalizer"] or not plain or before.get("add_prefix_space"):
            raise ValueError("not a plain byte-level tokenizer")
        special = settings["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in special):
            raise ValueError("special tokens of this tokenizer depend on their surroundings")
        names = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None

    def words(self, text: str) -> list[str]:
        if not self.special or not self.special.search(text):
            return _WORD.findall(text)
        parts = self.special.split(text)  # every second part is a special token
        return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else _WORD.findall(p))]


@cache
def _splitter(tokenizer_file: str) -> Splitter:
    return Splitter(tokenizer_file)


@cache
def _tokenizer(tokenizer_file: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, the other bytes in their
    order for the characters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@cache
def _spelling(tokenizer_file: str) -> pa.Array:
    """The bytes that each id stands for; those of an id without a piece are empty."""
    letters = byte_letters()
    vocabulary = _tokenizer(tokenizer_file).get_vocab(with_added_tokens=True)
    found = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        own = letters.keys() >= set(piece)
        found[i] = bytes(map(letters.get, piece)) if own else piece.encode()
    return pa.array(found, pa.binary())


def pieces(spark: SparkSession, tokenizer_file: str) -> DataFrame:
    """(id, spelling): the bytes of each id, a row per vocabulary entry."""
    spelling = _spelling(tokenizer_file)
    ids = pa.array(np.arange(len(spelling), dtype=np.int32))
    return spark.createDataFrame(pa.table({"id": ids, "spelling": spelling}))


def decode(encoded: DataFrame, tokenizer_file: str) -> DataFrame:
    """``encoded`` with the text of its ``ids`` in place of them, as ``decoded``.

    Null ids decode to empty text, as no ids do; an id without a piece gives nothing; bytes
    that are no UTF-8 become U+FFFD.
    """
    (row,) = unused(encoded, "row")
    numbered = encoded.withColumn(row, F.monotonically_increasing_id())
    numbered = Scratch(encoded.sparkSession).table(numbered, "ids")  # read twice
    table = F.broadcast(pieces(encoded.sparkSession, tokenizer_file))
    one = numbered.select(F.col(row).alias("key"), F.posexplode("ids").alias("at", "id"))
    placed = F.array_sort(F.collect_list(F.struct("at", F.hex("spelling").alias("hex"))))
    spelled = one.join(table, "id").groupBy("key").agg(placed.alias("placed"))
    data = F.unhex(F.array_join(F.transform("placed", lambda x: x["hex"]), ""))
    spelled = spelled.select(F.col("key").alias(row), F.make_valid_utf8(data.cast("string")).alias("decoded"))
    kept = [c for c in encoded.columns if c.lower() not in ("ids", "decoded")]
    return numbered.select(*kept, row).join(spelled, row, "left").select(
        *kept, F.coalesce("decoded", F.lit("")).alias("decoded")
    )


def _slices(texts: list[str | None]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size >= SLICE:
            yield part
            part, size = [], 0
    if part:
        yield part


class _Block:
    """The texts of a block as numbers of its distinct words."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.documents: list[pa.Array] = []
        self.counts: list[int] = []
        self.size = 0

    def add(self, documents: pa.Array, words: list[list[str]], size: int) -> None:
        self.documents.append(documents)
        self.counts.extend(map(len, words))
        self.words.append(pa.array(list(chain.from_iterable(words)), pa.string()))
        self.size += size

    def numbered(self, place: tuple[int, int]) -> tuple[int, pa.Array, np.ndarray]:
        """Name of the block, its distinct words, and the number of every word."""
        encoded = pa.chunked_array(self.words, pa.string()).dictionary_encode().combine_chunks()
        if isinstance(encoded, pa.ChunkedArray):
            encoded = encoded.chunk(0) if encoded.num_chunks else pa.array([], pa.string()).dictionary_encode()
        # By frequency, as small numbers take less room.
        counts = np.bincount(encoded.indices.to_numpy(), minlength=len(encoded.dictionary))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        words = encoded.dictionary.take(pa.array(order))
        digest = xxhash.xxh64(repr((place, sum(self.counts))))
        digest.update(pc.binary_length(words).to_numpy().tobytes())
        digest.update("".join(words.to_pylist()))
        return digest.intdigest() - (1 << 63), words, rank[encoded.indices.to_numpy()]


def _blocks(tokenizer_file: str, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """A function over batches of rows that yields (place, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], _Block]]:
        split, task = _splitter(tokenizer_file).words, TaskContext.get().partitionId()
        current, done = _Block(), 0
        for batch in batches:
            at = 0
            for texts in _slices(batch["text"].to_pylist()):
                current.add(batch["doc_id"].slice(at, len(texts)), list(map(split, texts)), sum(map(len, texts)))
                at += len(texts)
                if current.size >= block:
                    yield (task, done), current
                    current, done = _Block(), done + 1
        if current.counts:
            yield (task, done), current

    return run


def _block_words(docs: DataFrame, tokenizer_file: str, block: int) -> DataFrame:
    """block, number, word: every block's distinct words."""
    blocks = _blocks(tokenizer_file, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, found in blocks(batches):
            name, words, _ = found.numbered(place)
            for start in range(0, len(words), 50_000):
                part = words.slice(start, 50_000)
                numbers = pa.array(np.arange(start, start + len(part), dtype=np.int32))
                names = pa.array(np.full(len(part), name, np.int64))
                yield pa.record_batch({"block": names, "number": numbers, "word": part})

    return docs.select("doc_id", "text").mapInArrow(run, "block long, number int, word string")


def _packed(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))
    with pa.ipc.new_stream(out, table.schema, options=options) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _block_texts(docs: DataFrame, tokenizer_file: str, block: int) -> DataFrame:
    """A row for each block: its documents, the words of each by number, and the words."""
    blocks = _blocks(tokenizer_file, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, found in blocks(batches):
            name, words, numbers = found.numbered(place)
            counts = pa.array(found.counts, pa.int32())
            documents = pa.table({"doc_id": pa.chunked_array(found.documents), "count": counts})
            # All low bytes, then the next ones: these compress better than whole numbers.
            planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).ravel()
            yield pa.record_batch(
                {
                    "block": pa.array([name], pa.int64()),
                    "documents": pa.array([_packed(documents)], pa.binary()),
                    "numbers": pa.array([_packed(pa.table({"n": planes}))], pa.binary()),
                    "words": pa.array([_packed(pa.table({"word": words}))], pa.binary()),
                }
            )

    schema = "block long, documents binary, numbers binary, words binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(offsets), values)


def _joined(values: pa.Array, counts: np.ndarray, between: str | bytes) -> pa.Array:
    return pc.binary_join(_lists(values, counts), pa.scalar(between, values.type))


def _encoded(
    batches: Iterator[pa.RecordBatch], tokenizer, spelling: pa.Array, width: int
) -> Iterator[pa.RecordBatch]:
    """Rows sorted by word, with the ids of the word in place of it, and its spelling if
    that is not the word itself.  Equal words are encoded once, also across batches.
    """
    last: tuple[str, list[int]] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch["word"].dictionary_encode()
        words = coded.dictionary.to_pylist()
        known = [last[1]] if last and last[0] == words[0] else []
        new = tokenizer.encode_batch_fast(words[len(known) :], add_special_tokens=False)
        ids = known + [x.ids for x in new]
        last = words[-1], ids[-1]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), f"<u{width}")
        packed = pa.array([np.asarray(x, f"<u{width}").tobytes() for x in ids], pa.binary())
        spelled = _joined(spelling.cast(pa.large_binary()).take(pa.array(flat)), counts, b"").cast(pa.binary())
        odd = pc.not_equal(spelled, coded.dictionary.cast(pa.binary()))
        surface = pc.if_else(odd, spelled, pa.scalar(None, pa.binary()))
        yield pa.record_batch(
            {
                "block": batch["block"],
                "number": batch["number"],
                "ids": packed.take(coded.indices),
                "surface": surface.take(coded.indices),
            }
        )


def _width(tokenizer_file: str) -> int:
    """Bytes of an id."""
    return 2 if len(_spelling(tokenizer_file)) <= 1 << 16 else 4


def _bundle(numbers: np.ndarray, lengths: np.ndarray, ids: bytes) -> bytes:
    """Numbers (rising) and ids of some words of a block; compressed if they are many."""
    head = np.concatenate([np.diff(numbers, prepend=0), lengths]).astype("<u4")
    many = len(numbers) > 50
    planes = head.view(np.uint8).reshape(-1, 4).T.tobytes() if many else head.tobytes()
    start = np.array([len(numbers), many], "<u4").tobytes()
    return start + (zstandard.compress(planes + ids, LEVEL) if many else planes + ids)


def _unbundle(data: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    n, many = (int(x) for x in np.frombuffer(data, "<u4", 2))
    body = zstandard.decompress(data[8:]) if many else data[8:]
    head = body[: 8 * n]
    if many:
        head = np.ascontiguousarray(np.frombuffer(head, np.uint8).reshape(4, -1).T).tobytes()
    values = np.frombuffer(head, "<u4").astype(np.int64)
    return np.cumsum(values[:n]), values[n:], body[8 * n :]


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encoded words, those of one block together; as many rows as a bundle has blocks."""

    def rows(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        blocks, numbers = table["block"].to_numpy(), table["number"].to_numpy()
        order = np.lexsort((numbers, blocks))
        blocks, numbers = blocks[order], numbers[order]
        place = pa.array(order)
        ids, surface = table["ids"].combine_chunks().take(place), table["surface"].combine_chunks().take(place)
        lengths = pc.binary_length(ids).to_numpy()
        borders = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
        found = {"block": [], "words": [], "odd": []}
        for start, end in zip(borders, borders[1:]):
            own = surface.slice(start, end - start)
            odd = [] if own.null_count == len(own) else [
                {"number": int(numbers[start + k]), "spelling": x} for k, x in enumerate(own.to_pylist()) if x is not None
            ]
            data = b"".join(ids.slice(start, end - start).to_pylist())
            found["block"].append(int(blocks[start]))
            found["words"].append(_bundle(numbers[start:end], lengths[start:end], data))
            found["odd"].append(odd)
        kind = pa.list_(pa.struct([("number", pa.int32()), ("spelling", pa.binary())]))
        return pa.record_batch(
            {
                "block": pa.array(found["block"], pa.int64()),
                "words": pa.array(found["words"], pa.binary()),
                "odd": pa.array(found["odd"], kind),
            }
        )

    parts, size = [], 0
    for batch in batches:
        parts.append(batch)
        size += batch.num_rows
        if size >= BUNDLE:
            yield rows(parts)
            parts, size = [], 0
    if size:
        yield rows(parts)


def encode_words(words: DataFrame, tokenizer_file: str) -> DataFrame:
    """Rows of block, number and word as bundles of numbers and ids, several for each block."""
    width = _width(tokenizer_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _bundled(_encoded(batches, _tokenizer(tokenizer_file), _spelling(tokenizer_file), width))

    together = words.repartition("word").sortWithinPartitions("word")
    return together.mapInArrow(run, "block long, words binary, odd array<struct<number: int, spelling: binary>>")


def _put_together(texts: pa.Table, found: pa.Table, width: int, digests: bool) -> Iterator[pa.Table]:
    """The documents of one block, from its numbers and its part of the word table."""
    if not texts.num_rows:
        return
    bundles = [_unbundle(x) for x in found["words"].to_pylist()]
    numbers_found = np.concatenate([x for x, _, _ in bundles] or [np.empty(0, np.int64)])
    place = np.empty(len(numbers_found), np.int64)
    place[numbers_found] = np.arange(len(place))
    lengths = np.concatenate([x for _, x, _ in bundles] or [np.empty(0, np.int64)]) // width
    flat = np.frombuffer(b"".join([x for _, _, x in bundles]), f"<u{width}").astype(np.int32)
    ids = _lists(pa.array(flat), lengths).take(pa.array(place))
    n_ids = lengths[place]
    shown = _joined(ids.flatten().cast(pa.large_string()), n_ids, ",")
    del bundles, flat
    odd = {x["number"]: x["spelling"] for row in found["odd"].to_pylist() for x in row}
    for row in texts.to_pylist():
        documents, words = _unpacked(row["documents"]), _unpacked(row["words"])["word"].combine_chunks()
        planes = _unpacked(row["numbers"])["n"].to_numpy()
        numbers = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()
        if len(place) != len(words):
            raise ValueError("the documents were not the same when they were read again")
        spelled = words.cast(pa.large_binary())
        if odd:
            spelled = pa.array([odd.get(k, x) for k, x in enumerate(spelled.to_pylist())], pa.large_binary())

        counts = documents["count"].to_numpy().astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(counts)])
        first = 0
        while first < len(counts):
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + PUT_TOGETHER, "right")) - 1)
            part = pa.array(numbers[starts[first] : starts[last]])
            own = counts[first:last]
            per_document = np.add.reduceat(np.append(n_ids[part.to_numpy()], 0), starts[first:last] - starts[first])
            per_document[own == 0] = 0
            decoded = _joined(spelled.take(part), own, b"").to_pylist()
            if odd:
                decoded = [x.decode("utf-8", "replace").encode() for x in decoded]
            columns = {"doc_id": documents["doc_id"].slice(first, last - first)}
            if digests:
                text = _joined(shown.take(part), own, ",").to_pylist()
                columns["n_tokens"] = pa.array(per_document, pa.int64())
                columns["ids_sha256"] = [hashlib.sha256(x.encode()).hexdigest() for x in text]
                columns["decoded_sha256"] = [hashlib.sha256(x).hexdigest() for x in decoded]
            else:
                values = _lists(ids.take(part).flatten(), per_document)
                columns["ids"] = values.cast(pa.list_(pa.int32()))
                columns["decoded"] = pa.array([x.decode() for x in decoded], pa.string())
            yield pa.table(columns)
            first = last
    pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, tokenizer_file: str, digests: bool = False, block: int = BLOCK) -> DataFrame:
    """doc_id with ``ids`` and ``decoded`` text, or with their number and digests."""
    found = encode_words(_block_words(docs, tokenizer_file, block), tokenizer_file)
    width = _width(tokenizer_file)
    kind = docs.schema["doc_id"].dataType.simpleString()
    if digests:
        schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    else:
        schema = f"doc_id {kind}, ids array<int>, decoded string"
    empty = pa.table({"doc_id": pa.array([], pa.int64())})

    def put_together(texts: pa.Table, part: pa.Table) -> pa.Table:
        rows = list(_put_together(texts, part, width, digests))
        return pa.concat_tables(rows) if rows else empty.slice(0, 0)

    texts = _block_texts(docs, tokenizer_file, block)
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(put_together, schema)


def op13_bpe(spark: SparkSession, sf_dir: str, tokenizer_file: str | None = None) -> DataFrame:
    """Every whole text encoded and decoded again, as digests."""
    import public_tokenizers

    tokenizer_file = tokenizer_file or public_tokenizers.path("byte_bpe_50k.json")
    return encode(read(spark, sf_dir, "documents"), tokenizer_file, digests=True)
