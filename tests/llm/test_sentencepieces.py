import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from cargolens.llm import sentencepieces
from cargolens.llm.sentencepieces import Codec, encode, op6_sentencepiece
from tests.llm.frames import clashing, corpus, documents, edges, folder

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _want(rows):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_eos=True)
        yield i, ids, library.decode(ids)


@pytest.mark.parametrize("rows", [[], edges(), corpus()])
def test_same_as_the_library_on_whole_texts(spark, tmp_path, rows):
    docs = clashing(documents(spark, rows))
    found = op6_sentencepiece(spark, folder(docs, tmp_path / "in")).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter((i, len(ids), sha(" ".join(map(str, ids))), sha(text)) for i, ids, text in _want(rows))
    assert Counter(tuple(r) for r in found) == want


def test_ids_and_texts(spark):
    found = {r["doc_id"]: r for r in encode(documents(spark, corpus()), MODEL).collect()}
    for i, ids, text in _want(corpus()):
        assert (found[i]["ids"], found[i]["decoded"]) == (ids, text)


def test_a_word_is_segmented_once(monkeypatch):
    own = Codec(MODEL)
    calls = []
    real = Codec._segment
    monkeypatch.setattr(Codec, "_segment", lambda self, words, *a: (calls.append(list(words)), real(self, words, *a)))
    list(own.run(["alpha beta alpha", "beta gamma"]))
    list(own.run(["gamma alpha delta"]))
    words = [w for call in calls for w in call]
    assert sorted(words) == sorted(set(words)) and len(words) == 4


def test_a_full_table_starts_anew_with_the_same_ids(monkeypatch):
    monkeypatch.setattr(sentencepieces, "MOST_CHUNKS", 3)
    own, texts = Codec(MODEL), [r[1] for r in corpus()]
    assert [x for t in texts for x in own.run([t])] == list(Codec(MODEL).run(texts))
