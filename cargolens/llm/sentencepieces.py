"""SentencePiece encoding and decoding through a table of distinct chunks.

In a model whose pieces never hold a whitespace marker behind another character, no
merge crosses the border between a word and the marker after it.  A text is then
the sequence of its marked words (markers plus what follows them), and its ids are
the ids of those words one after the other.  Each worker keeps a table of the
distinct marked words it met; a batch's new ones are segmented together, once, and
every text's ids are put together from the table by position.  The table lives in
the task's process and not in a shuffled table: one row per word and position would
be many times the text.  It starts anew at ``MOST_CHUNKS`` entries, so memory is
bounded; that changes only how often a word is segmented, never the ids.

A model with pieces across markers is refused.

Cases: null text is empty text (only the end id); very long texts are cut into
words like others, and a marked word too long for the table is segmented where it
stands; equal texts give equal rows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cargolens.llm.common import read

MARK = "▁"
MOST_CHUNKS = 400_000
LONGEST_KEPT = 64  # characters
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

_codecs: dict[str, Codec] = {}


class Codec:
    """Encodes and decodes whole texts; one per model and process."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("pieces of this model cross whitespace markers")
        if not lib.normalize("a").startswith(MARK):
            raise ValueError("this model does not mark the start of a text")
        self.end = str(lib.eos_id())
        # A word in front, so that what the library strips at a text's start is not
        # stripped from a later word.
        self._front = lib.encode("a")
        self._strip = len(lib.decode(self._front))
        self._mark = lib.encode("a" + MARK)[len(self._front) :]
        self._ids: dict[str, str] = {}
        self._odd: dict[str, str] = {}  # words that don't decode to themselves

    def _segment(self, words: list[str], ids: dict[str, str], odd: dict[str, str]) -> None:
        # The library marks the start itself, so one marker is left out; but it does not
        # mark an empty text, so a marker alone is segmented behind a word.
        found = self.library.encode([w.removeprefix(MARK) for w in words], num_threads=1)
        found = [self._mark if w == MARK else x for w, x in zip(words, found)]
        surfaces = self.library.decode([self._front + x for x in found], num_threads=1)
        for word, x, surface in zip(words, found, surfaces):
            ids[word] = " ".join(map(str, x))
            if (surface := surface[self._strip:]) != word.replace(MARK, " "):
                odd[word] = surface

    def run(self, texts: list[str | None]) -> Iterator[tuple[str, str]]:
        """(decimal ids with the end id, joined by a space; decoded text) of each text."""
        chunked = [_CHUNK.findall(self.library.normalize(t)) if t else [] for t in texts]
        wanted = {c for chunks in chunked for c in chunks}
        if len(self._ids) > MOST_CHUNKS:
            self._ids, self._odd = {}, {}
        ids, odd = self._ids, self._odd
        new = [c for c in wanted if c not in ids]
        long = {c for c in new if len(c) > LONGEST_KEPT}
        self._segment([c for c in new if c not in long], ids, odd)
        if long:
            ids, odd = dict(ids), dict(odd)  # for this batch alone
            self._segment(sorted(long), ids, odd)
        for chunks in chunked:
            parts = [ids[c] for c in chunks]
            if odd and not odd.keys().isdisjoint(chunks):
                decoded = "".join(odd.get(c) or c.replace(MARK, " ") for c in chunks)
            else:
                decoded = "".join(chunks).replace(MARK, " ")
            yield " ".join([*parts, self.end]), decoded[1:]


def codec(model_file: str) -> Codec:
    if model_file not in _codecs:
        _codecs[model_file] = Codec(model_file)
    return _codecs[model_file]


def _slices(texts: list[str | None], most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > most:
            yield start, i
            start, size = i, 0
        size += len(text or "")
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, model_file: str, digests: bool = False) -> DataFrame:
    """doc_id with ``ids`` (array) and ``decoded``, or with their digests.

    Extra columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for start, end in _slices(texts):
                rows = list(own.run(texts[start:end]))
                keys = batch["doc_id"].slice(start, end - start)
                if digests:
                    sha = [[hashlib.sha256(x.encode()).hexdigest() for x in row] for row in rows]
                    yield pa.record_batch(
                        {
                            "doc_id": keys,
                            "n_tokens": pa.array([i.count(" ") + 1 for i, _ in rows], pa.int64()),
                            "ids_sha256": pa.array([i for i, _ in sha], pa.string()),
                            "decoded_sha256": pa.array([d for _, d in sha], pa.string()),
                        }
                    )
                else:
                    ids = [list(map(int, i.split(" "))) for i, _ in rows]
                    yield pa.record_batch(
                        {
                            "doc_id": keys,
                            "ids": pa.array(ids, pa.list_(pa.int32())),
                            "decoded": pa.array([d for _, d in rows], pa.string()),
                        }
                    )

    kind = docs.schema["doc_id"].dataType.simpleString()
    if digests:
        schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    else:
        schema = f"doc_id {kind}, ids array<int>, decoded string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str | None = None) -> DataFrame:
    """Every whole text encoded with an end id and decoded again, as digests."""
    import public_tokenizers

    model_file = model_file or public_tokenizers.path("piece_bpe_32k.model")
    return encode(read(spark, sf_dir, "documents"), model_file, digests=True)
