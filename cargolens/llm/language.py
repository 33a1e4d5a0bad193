"""Language identification with string kernels.

The kernel of two texts is the number of n-grams (one to three characters) that both
hold, over the geometric mean of how many each holds: a blended-spectrum presence
kernel, normalised.  A bounded sample of labelled texts is the training set.  Some of
its texts are Nystroem landmarks: a text becomes the vector of its kernels with the
landmarks, whitened by their own kernel matrix, and one-versus-rest kernel ridge
regression has one linear function per language on it.  A batch of texts is scored by
two matrix products: presence times landmark presence, then times the weights.

N-grams are taken from the whole text, lower-cased, with every run of characters that
are no letters as one space.  The spectrum is that of the training sample: n-grams
that it does not hold match nothing.

Bounds (parameters): ``per_language`` training texts for each label, ``landmarks`` of
them, and ``most_grams`` n-grams.  Texts of more than ``most_chars`` characters teach,
whole, only where a label has too few shorter ones.  Texts are taken by the order of their
hash, so the sample does not depend on the layout of the table, and copies of one text
count once: a label with fewer different texts than wanted gives them all.

Cases: a text that is null or without a letter is ``und`` with score 0; rows with null
text or label teach nothing; with no labelled text at all every text is ``und``; very
long texts are read in parts; equal texts get equal results; an empty table gives no
rows.  The prediction reads the text alone.

A worker holds the model, one Arrow batch, ``_BLOCK`` of its texts and the arrays of one
part of them, and gives free memory back when its task ends.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargolens.llm.common import Scratch, give_back_memory, read

UNKNOWN = "und"
_SPACE = 32
_TABLE_BITS = 18
_MIX = np.uint64(0x9E3779B97F4A7C15)  # a fixed odd number that spreads codes over the table
_PART = 200_000  # characters that are turned into n-grams at a time, at some 80 bytes each
_BLOCK = 128  # texts that are scored at a time

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Code point to lower-case letter, or a space; made once per process."""
    if not _letters:
        table = np.full(0x110000, _SPACE, np.uint32)
        for i in range(0x110000):
            if (c := chr(i)).isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _letters.append(table)
    return _letters[0]


def _slots(codes: np.ndarray) -> np.ndarray:
    return ((codes * _MIX) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, n-gram code) arrays of texts together; codes hold up to three characters."""
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    chars = _letter_table()[joined]
    # One space for a run of them within a text.
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != _SPACE) | (chars[:-1] != _SPACE) | (row[1:] != row[:-1])
    chars, row = chars[keep].astype(np.uint64), row[keep]
    code = chars
    for n in range(3):
        if n:
            code = code[:-1] | (chars[n:] << np.uint64(21 * n))
        size = len(code)
        if size <= 0:
            return
        inside = row[n:] == row[:size]
        inside &= chars[:size] != _SPACE if n == 0 else True
        yield row[:size][inside], code[inside]


def _parts(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Rows and texts, about ``_PART`` characters at a time; longer texts in overlapping parts."""
    rows, found, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text), 1), _PART):
            part = text[at : at + _PART + 2]
            if size and size + len(part) > _PART:
                yield rows, found
                rows, found, size = [], [], 0
            rows.append(i)
            found.append(part)
            size += len(part)
    if found:
        yield rows, found


def _unpacked(texts: pa.Array) -> Iterator[str | None]:
    """Values of an Arrow array; only ``_BLOCK`` of them are Python objects at a time."""
    for at in range(0, len(texts), _BLOCK):
        yield from texts.slice(at, _BLOCK).to_pylist()


def _lettered(texts: Iterable[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Places and values of the texts that hold a letter, ``_BLOCK`` at a time."""
    found = ((i, t) for i, t in enumerate(texts) if t and any(map(str.isalpha, t)))
    while block := list(islice(found, _BLOCK)):
        yield [i for i, _ in block], [t for _, t in block]


@dataclass
class Model:
    """Weights and the spectrum; a few megabytes at most, whatever the corpus."""

    languages: list[str]
    gram_of_slot: np.ndarray  # id of the n-gram in a hash slot, or -1
    code_of_slot: np.ndarray
    n_grams: int
    landmarks: np.ndarray  # presence, n-grams x landmarks
    landmark_sizes: np.ndarray
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray

    def presence(self, texts: list[str]) -> np.ndarray:
        """0/1 matrix of texts by n-grams."""
        out = np.zeros((len(texts), self.n_grams), np.float32)
        for rows, part in _parts(texts):
            rows = np.array(rows)
            for row, code in _grams(part):
                slot = _slots(code)
                known = self.code_of_slot[slot] == code
                out[rows[row[known]], self.gram_of_slot[slot[known]]] = 1
        return out

    def kernels(self, presence: np.ndarray) -> np.ndarray:
        sizes = np.maximum(presence.sum(1, keepdims=True), 1)
        return presence @ self.landmarks / np.sqrt(sizes * self.landmark_sizes)

    def predict(self, texts: list[str | None] | pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and its part (0 to 1) of all positive scores."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        for block, own in _lettered(_unpacked(texts) if isinstance(texts, pa.Array) else texts):
            kernels = self.kernels(self.presence(own))
            values = kernels @ self.weights + self.bias
            best = values.argmax(1)
            positive = np.maximum(values, 0)
            top = positive[np.arange(len(block)), best]
            scores[block] = top / np.maximum(positive.sum(1), 1e-12)
            for i, k in zip(block, best):
                names[i] = self.languages[k]
        return names, scores


def fit(
    texts: list[str],
    languages: list[str],
    landmarks: int = 96,
    most_grams: int = 20_000,
    ridge: float = 1e-3,
) -> Model:
    """Learn from labelled texts; they are few, so this runs where it is called."""
    import pandas as pd  # not needed by the workers, which only predict

    names = sorted(set(languages))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for rows, part in _parts(texts):
        rows = np.array(rows)
        found += [(rows[r], c) for r, c in _grams(part)]
    codes = np.empty(0, np.uint64)
    if found:
        pairs = pd.DataFrame(
            {"row": np.concatenate([r for r, _ in found]), "code": np.concatenate([c for _, c in found])}
        ).drop_duplicates()
        counts = pairs["code"].value_counts().reset_index().sort_values(
            ["count", "code"], ascending=[False, True]
        )
        codes = counts["code"].to_numpy(np.uint64)[:most_grams]
    # Of n-grams that share a slot of the table the most frequent stays.
    slots, first = np.unique(_slots(codes), return_index=True)
    gram_of_slot = np.full(1 << _TABLE_BITS, -1, np.int32)
    code_of_slot = np.full(1 << _TABLE_BITS, np.uint64(2**64 - 1), np.uint64)
    gram_of_slot[slots] = np.arange(len(slots))
    code_of_slot[slots] = codes[first]

    n = max(len(slots), 1)
    model = Model(
        names, gram_of_slot, code_of_slot, n, np.zeros((n, 0), np.float32),
        np.zeros(0, np.float32), np.zeros((0, len(names))), np.zeros(len(names)),
    )
    if not names:
        return model
    presence = model.presence(texts)
    # As many landmarks of each language, as far as they go.
    order = pd.Series(languages).groupby(languages).cumcount().sort_values(kind="stable").index
    chosen = presence[order[:landmarks]]
    model.landmarks = np.ascontiguousarray(chosen.T)
    model.landmark_sizes = np.maximum(chosen.sum(1), 1)

    values, vectors = np.linalg.eigh(model.kernels(chosen).astype(np.float64))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = model.kernels(presence) @ whiten
    targets = (np.array(languages)[:, None] == np.array(names)).astype(float)
    mean_x, mean_y = features.mean(0), targets.mean(0)
    centred = features - mean_x
    gram = centred.T @ centred + ridge * len(texts) * np.eye(centred.shape[1])
    beta = np.linalg.solve(gram, centred.T @ (targets - mean_y))
    model.weights = whiten @ beta
    model.bias = mean_y - mean_x @ beta
    return model


def training_sample(
    labelled: DataFrame, per_language: int = 150, most_chars: int = 20_000
) -> tuple[list[str], list[str]]:
    """Texts and labels, bounded; ``labelled`` has ``text`` and ``lang``."""
    spark = labelled.sparkSession
    usable = labelled.select("text", "lang").where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).withColumn("hash", F.xxhash64("text"))
    # Copies of a text are one row before anything is counted or drawn.
    scratch = Scratch(spark)
    different = scratch.table(
        usable.groupBy("hash").agg(
            F.min("lang").alias("lang"), (F.min(F.length("text")) > most_chars).alias("long")
        ),
        "different",
    )
    counts = {(r["lang"], r["long"]): r["count"] for r in different.groupBy("lang", "long").count().collect()}
    if not counts:
        scratch.drop(different)
        return [], []
    # About twice the wanted number of each label by hash, then the exact number.
    whole = 1 << 30
    limits = spark.createDataFrame(
        [
            (lang, long, min(whole, 1 + whole * (2 * per_language + 50) // n))
            for (lang, long), n in counts.items()
            if not long or counts.get((lang, False), 0) < per_language
        ],
        "lang string, long boolean, below long",
    )
    bound = 4 * (per_language + 50) * len(counts)
    drawn = (
        different.withColumn("part", F.pmod(F.xxhash64("hash"), F.lit(whole)))
        .join(F.broadcast(limits), ["lang", "long"]).where("part < below")
        .orderBy("long", "part", "hash").select("hash", "lang").limit(bound).collect()
    )
    scratch.drop(different)
    taken: dict[str, int] = {}
    kept = []
    for row in drawn:  # short texts first
        if taken.setdefault(row["lang"], 0) < per_language:
            taken[row["lang"]] += 1
            kept.append((len(kept), row["hash"], row["lang"]))
    chosen = spark.createDataFrame(kept, "place long, hash long, label string")
    rows = (
        usable.join(F.broadcast(chosen), "hash")
        .groupBy("place", "label").agg(F.min("text").alias("text")).orderBy("place").collect()
    )
    return [r["text"] for r in rows], [r["label"] for r in rows]


def language(spark: SparkSession, model: Model, text: Column) -> Column:
    """Struct of lang_pred and score for a text column."""
    shared = spark.sparkContext.broadcast(model)  # bounded by the model's parameters

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = shared.value.predict(texts)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"]
            )
        give_back_memory()

    return predict(text)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the documents that are not held out."""
    docs = read(spark, sf_dir, "documents")
    model = fit(*training_sample(docs.where(~held_out(F.col("doc_id")))))
    found = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        language(spark, model, F.col("text")).alias("found"),
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
