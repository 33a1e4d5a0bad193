"""Spelling variants: words one edit away from a much more frequent word.

1. Words are counted over all documents, by column functions alone and pre-aggregated in
   each task.  Those long and frequent enough are the vocabulary.
2. The vocabulary goes into blocked Bloom filters, one shard for each word length; a word
   sets one bit in each of the eight numbers of one block.  Shards are built by Spark
   (a row per block) and broadcast in parts of at most ``PART`` bytes: a shard beyond that
   is probed part by part, by the words of its lengths only.
3. Tasks generate the edits of each word and probe them.  Two words that differ by an
   inserted or deleted character differ by a deletion in the longer one, and of two words
   that differ by a replaced character one is smaller; so all deletions and all
   replacements by a greater character meet every pair once.  An edit's hash comes
   from the word's hash, so no edit is written out that the filter doesn't know.
4. Only the positives are shuffled, to an exact join with the vocabulary, which removes
   false ones.
5. Each word takes its most frequent near word as its form if that is frequent enough, and
   forms are followed to the last one by doubling: every round follows all links twice as far.

A word has at most some thousand possible neighbours (its length times the alphabet), so
no group grows with the corpus.  Hot words are pre-aggregated before the only shuffle
that counts occurrences.

Cases: null text has no words; very long texts and runs are whole; repeated rows count each;
with a null doc_id no character is struck; an empty table gives no rows; extra columns are
not read.  Of equally frequent near words the smallest by code points counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens.llm.common import Scratch, read

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5  # a form is at least so many times as frequent
STRUCK = 199  # one occurrence of so many loses a character
BITS = 20  # of the filter for each word
PART = 32 << 20  # bytes of a filter that are broadcast at once
WORDS_PER_TASK = 20_000
_RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(docs: DataFrame) -> DataFrame:
    """``word`` for each run of letters of every text, some of them with a character struck."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({_RUN})"), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= LEAST_LENGTH)  # striking only shortens
    # Only A-Z are lower-cased; a run that is its own lower case has none of them.
    plain = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    runs = runs.select("doc_id", plain.alias("run"))
    key = F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run"))
    hashed = runs.select("run", F.crc32(key).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    struck = F.when(F.col("h") % STRUCK == 0, cut).otherwise(F.col("run"))
    return hashed.select(struck.alias("word")).where(F.char_length("word") >= LEAST_LENGTH)


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of every word with enough occurrences."""
    return occurrences(docs).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


# Hashes of words, in 64 bits.  All characters are below 256, so a word is a row of bytes.

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)


def _mixed(h: np.ndarray, by: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(by)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@dataclass(frozen=True)
class Shards:
    """Where the blocks of each word length are among all blocks."""

    first: dict[int, int]
    blocks: dict[int, int]

    @staticmethod
    def of(counts: dict[int, int]) -> Shards:
        first, at = {}, 0
        blocks = {length: -(-n * BITS // 512) for length, n in sorted(counts.items())}
        for length, n in blocks.items():
            first[length] = at
            at += n
        return Shards(first, blocks)

    @property
    def total(self) -> int:
        return sum(self.blocks.values())

    def place(self, h: np.ndarray, length: int) -> np.ndarray:
        """The block of each hash of a word of this length."""
        high = _mixed(h, 0x94D049BB133111EB) >> np.uint64(32)
        return (high * np.uint64(self.blocks[length]) >> np.uint64(32)).astype(np.int64) + self.first[length]


def _bits(h: np.ndarray) -> list[np.ndarray]:
    """The bit of each hash in each of the eight numbers of its block."""
    mixed = _mixed(h, 0xD6E8FEB86659FD93)
    return [np.uint64(1) << (mixed >> np.uint64(6 * k) & np.uint64(63)) for k in range(8)]


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, bytes as rows) of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        data = "".join([words[i] for i in places]).encode("latin-1")
        yield places, np.frombuffer(data, np.uint8).reshape(-1, length)


def _hashes(rows: np.ndarray) -> np.ndarray:
    return (rows.astype(np.uint64) * _powers(rows.shape[1])[: rows.shape[1]]).sum(axis=1, dtype=np.uint64)


def _filter_rows(words: DataFrame, shards: Shards, start: int, end: int) -> DataFrame:
    """Blocks ``start`` to ``end`` of the filters, as eight numbers each."""
    columns = [f"b{k}" for k in range(8)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows in _by_length(batch["word"].to_pylist()):
                h = _hashes(rows)
                block = shards.place(h, rows.shape[1])
                own = (block >= start) & (block < end)
                bits = [b.view(np.int64) for b in _bits(h[own])]
                yield pa.record_batch({"block": block[own], **dict(zip(columns, bits))})

    lengths = [x for x in shards.blocks if shards.first[x] < end and shards.first[x] + shards.blocks[x] > start]
    rows = words.where(F.char_length("word").between(min(lengths), max(lengths))).select("word")
    found = rows.mapInArrow(run, "block long, " + ", ".join(f"{c} long" for c in columns))
    return found.groupBy("block").agg(*[F.bit_or(c).alias(c) for c in columns])


def _filter(words: DataFrame, shards: Shards, start: int, end: int) -> np.ndarray:
    """At most ``PART`` bytes, however large the vocabulary is."""
    table = _filter_rows(words, shards, start, end).toArrow()
    out = np.zeros((8, end - start), np.uint64)
    at = table["block"].to_numpy() - start
    for k in range(8):
        out[k, at] = table[f"b{k}"].to_numpy().view(np.uint64)
    return out


def _known(h: np.ndarray, length: int, shards: Shards, part: np.ndarray, start: int) -> np.ndarray:
    """Places of the hashes that this part of the filter knows."""
    if length not in shards.blocks:
        return np.empty(0, np.int64)
    block = shards.place(h, length) - start
    left = np.flatnonzero((block >= 0) & (block < part.shape[1]))
    for k, bits in enumerate(_bits(h)):
        left = left[part[k, block[left]] & bits[left] != 0]
    return left


def _edits(rows: np.ndarray, letters: np.ndarray, known) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, edits as rows of bytes) of the edits that ``known`` lets through."""
    length = rows.shape[1]
    wide, powers = rows.astype(np.uint64), _powers(length)
    terms = wide * powers[:length]
    h = terms.sum(axis=1, dtype=np.uint64)
    # Deletions: what is before the place, and what is behind it, one place further left.
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    moved = np.zeros_like(terms)
    moved[:, 1:] = wide[:, 1:] * powers[: length - 1]
    behind = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
    for p in range(length):
        # In a run of one character all deletions give the same word: the first counts.
        use = np.arange(len(rows)) if p == 0 else np.flatnonzero(rows[:, p] != rows[:, p - 1])
        hit = use[known(before[use, p] + behind[use, p], length - 1)]
        if len(hit):
            yield hit, np.delete(rows[hit], p, axis=1)
    for p in range(length):
        row, letter = np.nonzero(letters[None, :] > rows[:, p : p + 1])
        to = letters[letter]
        hit = known(h[row] + (to.astype(np.uint64) - wide[row, p]) * powers[p], length)
        if len(hit):
            out = rows[row[hit]]
            out[:, p] = to[hit]
            yield row[hit], out


def _alphabet(words: DataFrame) -> np.ndarray:
    """The characters of the vocabulary, at most 90."""
    found = words.select(F.explode(F.split("word", "")).alias("c")).where("c != ''").distinct().collect()
    return np.array(sorted(ord(r["c"]) for r in found), np.uint8)


def _positives(words: DataFrame, letters: np.ndarray, shards: Shards, start: int, end: int) -> DataFrame:
    """word, n, edit for every edit that blocks ``start`` to ``end`` know."""
    part = words.sparkSession.sparkContext.broadcast(_filter(words, shards, start, end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch["word"].to_pylist()
            for places, rows in _by_length(listed):
                probe = lambda h, length: _known(h, length, shards, part.value, start)
                for hit, edits in _edits(rows, letters, probe):
                    data, width = edits.tobytes().decode("latin-1"), edits.shape[1]
                    found = [data[k * width : (k + 1) * width] for k in range(len(edits))]
                    at = pa.array(places[hit])
                    yield pa.record_batch({"word": batch["word"].take(at), "n": batch["n"].take(at), "edit": found})

    touched = [x for x in shards.blocks if shards.first[x] < end and shards.first[x] + shards.blocks[x] > start]
    probing = words.where(F.char_length("word").between(min(touched), max(touched) + 1))
    return probing.select("word", "n").mapInArrow(run, "word string, n long, edit string")


def near_words(words: DataFrame, scratch: Scratch, part_bytes: int = PART) -> DataFrame:
    """word, n, near, near_n: every pair of words of the table one edit apart, once."""
    counts = {r["length"]: r["count"] for r in words.groupBy(F.char_length("word").alias("length")).count().collect()}
    shards, letters = Shards.of(counts), _alphabet(words)
    tasks = max(1, -(-sum(counts.values()) // WORDS_PER_TASK))
    dealt = words.repartition(tasks, "word")
    step = max(1, part_bytes // 64)
    found = [
        scratch.table(_positives(dealt, letters, shards, start, min(start + step, shards.total)), "positives")
        for start in range(0, shards.total, step)
    ]
    known = words.select(F.col("word").alias("edit"), F.col("n").alias("near_n"))
    if not found:
        return words.join(known, F.lit(False)).select("word", "n", F.col("edit").alias("near"), "near_n")
    positives = reduce(DataFrame.unionByName, found)
    return positives.join(known, "edit").select("word", "n", F.col("edit").alias("near"), "near_n")


def _forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n of every word."""
    sides = F.array(
        F.struct(F.col("word"), F.col("near"), F.col("near_n").alias("m")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("m")),
    )
    both = pairs.select(F.inline(sides))
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("near"))).alias("best")
    per_word = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    enough = -F.col("best.m") >= RATIO * F.col("n")
    return words.join(per_word, "word", "left").select(
        "word", "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.m")).alias("form_n"),
    )


def _roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root for rows of word and form: the end of each chain of forms.

    Counts grow along a chain, so it ends; each round doubles how far links reach.
    """
    current = scratch.table(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = current.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        after = scratch.table(further, "roots")
        scratch.drop(current)
        current = after.select("word", "root")
        if after.where("moved").isEmpty():
            return current


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a table of word and n."""
    scratch = Scratch(words.sparkSession)
    listed = scratch.table(words.select("word", "n"), "vocabulary")
    forms = scratch.table(_forms(listed, near_words(listed, scratch)), "forms")
    roots = _roots(forms.where("form IS NOT NULL"), scratch)
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of all documents with its form and the root of its forms."""
    return variants(vocabulary(read(spark, sf_dir, "documents")))
