"""Best-fit packing of documents into token sequences by exact complements.

1. Every text is tokenized; a document is its ids and an end id.  Documents longer
   than a sequence are cut into full pieces and a last one.
2. Only the number of pieces of each length matters for where they go.  That table
   has at most ``capacity`` rows however many documents there are, and the plan is
   made from it: the longest piece leaves a gap, and single lengths, pair sums and
   triple sums are looked up that fill it exactly.  Each find is used as often as
   the counts allow, so one step places thousands of pieces alike.  What has no
   exact complement goes best-fit decreasing into the smallest gap left.
3. The plan says for each length which numbers of that length go where.  Pieces get
   their number by one range sort, and look their place up in the plan.

Steps 1 and 3 are Spark work over all pieces; the plan grows with ``capacity``, not
with the data.

Cases: null text is empty, and an empty document is its end id alone; equal and
repeated rows are packed one by one; an empty table gives no rows; extra columns are
not read; a null doc_id stays null.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens.llm.byte_pairs import byte_letters
from cargolens.llm.common import Scratch, dense_slots, give_back_memory, read

CAPACITY = 4096
END_ID = 1
MOST_BYTES = 120 << 20  # of one generation of a worker's table of words
ENTRY = 200  # bytes of an entry beside its characters and ids
LONGEST_KEPT = 64  # characters
MARKS = ".,;:!?"

# A pattern is what one sequence holds: (length, times) in order of place.
Pattern = tuple[tuple[int, int], ...]


class _Words(dict):
    """Ids of words, each distinct word of a task tokenized once; of whole texts by ``ids``.

    The vocabulary's normalizer and splitter treat white space as a border, so the
    ids of a text are those of its words.  Only the plain space and the line feed
    are used to cut; any other space inside a word is left to the tokenizer.

    A word that is not in the table is tokenized when it is looked up, so what a text costs
    does not depend on the size of the table.  There are two generations of at most
    ``MOST_BYTES`` each (and one text): a word of the older one moves to the newer when it
    is met again, and when the newer is full the older is forgotten.  So frequent words stay
    and memory is bounded.  A task starts with an empty table, so idle workers hold none.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(file)
        # Words of Latin-1 letters alone normalize to their lower case and are never split:
        # they go to the merges directly, as the letters that stand for their bytes.
        self.merges = self.tokenizer.model.tokenize
        self.byte_letters = {b: letter for letter, b in byte_letters().items() if ord(letter) != b}
        self.marks = {mark: self._whole(mark) for mark in MARKS}
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.older: dict[str, bytes] = {}
        self.size = 0

    def _whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _new(self, word: str) -> bytes:
        if word.isalpha() and max(word) < "\u0100":
            lower = word.lower()
            if lower != word:
                return self[lower]
            if not word.isascii():
                lower = word.encode().decode("latin-1").translate(self.byte_letters)
            return array("I", [token.id for token in self.merges(lower)]).tobytes()
        if (mark := self.marks.get(word[-1:])) and word[:-1].isalpha() and max(word) < "\u0100":
            return self[word[:-1]] + mark  # a mark behind letters is a token of its own
        return self._whole(word) if word else b""

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self._new(word)
        if len(word) <= LONGEST_KEPT:
            self[word] = found
            self.size += len(word) + len(found) + ENTRY
        return found

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        for text in texts:
            if self.size > MOST_BYTES:
                older = dict(self)
                self.forget()
                self.older = older
            yield b"".join(map(self.__getitem__, (text or "").replace("\n", " ").split(" ")))


_words: dict[str, _Words] = {}


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    step, end = 4 * capacity, np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_file not in _words:
            _words[tokenizer_file] = _Words(tokenizer_file)
        own = _words[tokenizer_file]
        for batch in batches:
            rows = []
            for i, ids in enumerate(own.ids(batch["text"].to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)))
            row, piece, start, length, crc = zip(*rows) if rows else [()] * 5
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"].take(pa.array(row, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )
        own.forget()  # an idle worker keeps no words
        give_back_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class _Exact:
    """Combinations of one to three available lengths with a given sum."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    def _pair(self, total: int, least: int = 0) -> tuple[int, int] | None:
        """The available pair of this sum with the longest first member."""
        half = (total + 1) // 2
        longer = np.arange(half, total)
        ok = (self.counts[longer] > 0) & (self.counts[total - longer] > 0)
        if total % 2 == 0 and half < total:
            ok[0] &= self.counts[half] > 1
        hits = np.flatnonzero(ok)
        return (int(longer[hits[-1]]), int(total - longer[hits[-1]])) if len(hits) else None

    def fill(self, gap: int) -> tuple[int, ...] | None:
        counts = self.counts
        if counts[gap]:
            return (gap,)
        if pair := self._pair(gap):
            return pair
        for a in np.flatnonzero(counts[: max(gap - 1, 0)])[::-1]:
            counts[a] -= 1
            pair = self._pair(gap - int(a))
            counts[a] += 1
            if pair:
                return (int(a), *pair)
        return None


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and how many sequences have each; uses every piece exactly once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    done: list[tuple[Pattern, int]] = []
    if left[capacity]:
        done.append((((capacity, 1),), int(left[capacity])))
        left[capacity] = 0

    rest: dict[int, int] = {}  # pieces without an exact complement
    exact = _Exact(left)
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            left[length] -= 1
            found = exact.fill(capacity - length)
            left[length] += 1
            if not found:
                rest[length], left[length] = int(left[length]), 0
                break
            need: dict[int, int] = defaultdict(int)
            for x in (length, *found):
                need[x] += 1
            times = min(int(left[x]) // k for x, k in need.items())
            for x, k in need.items():
                left[x] -= times * k
            done.append((tuple(sorted(need.items(), reverse=True)), times))
    return done + _best_fit(rest, capacity)


def _best_fit(rest: Mapping[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing, with sequences that are alike handled together."""
    open_: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            gaps = [g for g, found in open_.items() if g >= length and found]
            if not gaps:
                each = capacity // length
                if n // each:
                    open_[capacity - each * length].append((((length, each),), n // each))
                if n % each:
                    open_[capacity - n % each * length].append((((length, n % each),), 1))
                break
            gap = min(gaps)
            pattern, times = open_[gap].pop()
            # One after the other a sequence takes what fits, as best fit would.
            each = min(gap // length, n)
            used = min(times, n // each)
            if used < times:
                open_[gap].append((pattern, times - used))
            open_[gap - each * length].append(((*pattern, (length, each)), used))
            n -= used * each
    return [entry for found in open_.values() for entry in found]


def _placements(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by their number among that length."""
    rows, taken, sequence = [], defaultdict(int), 0
    for pattern, times in patterns:
        offset = 0
        for length, each in pattern:
            rows.append((length, taken[length], sequence, each, offset))
            taken[length] += times * each
            offset += length * each
        sequence += times
    rows.sort()
    names = ("length", "number", "sequence", "each", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T))


def pack(parts: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (with ``length`` from 1 to ``capacity``) plus sequence_id and offset."""
    scratch = Scratch(parts.sparkSession)
    ranked = dense_slots(parts, "length", order, scratch, "number")
    counts = parts.groupBy("length").count().collect()  # at most ``capacity`` rows
    places = _placements(plan({r["length"]: r["count"] for r in counts}, capacity))
    low = int(places["length"].min()) if len(places["length"]) else 0

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        length, number = (np.asarray(x, np.int64) for x in (length, number))
        # Both keys in one: lengths are whole steps, numbers a place below one step.
        step = np.int64(1) << 48
        keys = (places["length"] - low) * step + places["number"]
        wanted = (length - low) * step + number
        at = np.searchsorted(keys, wanted, "right") - 1
        nth = number - places["number"][at]
        each = places["each"][at]
        return pa.StructArray.from_arrays(
            [pa.array(places["sequence"][at] + nth // each),
             pa.array(places["offset"][at] + nth % each * length)],
            ["sequence_id", "offset"],
        )

    placed = ranked.withColumn("number", place("length", "number"))
    return placed.select(*parts.columns, "number.sequence_id", "number.offset")


def pack_documents(
    docs: DataFrame, tokenizer_file: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    import public_tokenizers

    file = tokenizer_file or public_tokenizers.path("word_bpe_49k.json")
    # Written, as the lengths are read twice; tokenizing is the dear part.
    written = Scratch(docs.sparkSession).table(pieces(docs, file, capacity), "pieces")
    numbered = written.withColumn("row_in_scan", F.monotonically_increasing_id())
    placed = pack(numbered, ["doc_id", "piece", "row_in_scan"], capacity)
    return placed.drop("row_in_scan")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack_documents(read(spark, sf_dir, "documents"))
