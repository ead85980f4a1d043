"""token_counts with a tokenizer that keeps blanks, and the shortcuts by word against the library."""

from __future__ import annotations

import random

import public_tokenizers
import pytest

from cardlake.llm import sp_codec, token_cache
from cardlake.llm.common import scratch_path

TEXTS = ["a b  c", "two  blanks\t\n here ", "", None, "  ", "a b  c", "a b c", "Word, word. WORD! word?! 'word' don't it's 12.5, x..y",
         "Größe, groß. naïve… (see) <|endoftext|>, <|ENDOFTEXT|> İstanbul. ΑΣ.", "ok. " * 3000 + "end"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_are_the_library_s(spark, name):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    rnd = random.Random(3)
    texts = TEXTS + ["".join(rnd.choice("aZß.,;:!?'12 \n<|>é…") for _ in range(50)) for _ in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    cache = scratch_path(spark, "cache")
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    for _ in range(2):      # the second time everything is in the cache
        got = token_cache.token_counts(docs, path, cache).collect()
        assert len(got) == len(texts) and {r.doc_id: r.n_tokens for r in got} == want


def test_small_caches_change_nothing(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    text = token_cache.tokenizer_text(path)
    texts = [(t or "").encode() for t in TEXTS]
    want = token_cache.count_tokens(texts, "a", text, True)
    monkeypatch.setattr(token_cache, "KNOWN_WORDS", 2)
    monkeypatch.setattr(token_cache, "BLOCK_BYTES", 10)
    assert token_cache.count_tokens(texts, "b", text, True) == want
    model = sp_codec.Pieces(sp_codec.read_model(public_tokenizers.path("piece_bpe_32k.model")))
    ids = model.encode([t or "" for t in TEXTS])
    monkeypatch.setattr(sp_codec, "KNOWN_BYTES", 1)
    monkeypatch.setattr(sp_codec, "KNOWN_PAIRS", 2)
    monkeypatch.setattr(sp_codec, "KEPT_BYTES", 1)
    model.rest()
    assert not model.words
    assert [model.encode([t or ""])[0] for t in TEXTS] == ids


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(sp_codec.read_model(public_tokenizers.path("piece_bpe_32k.model")))
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    with pytest.raises(ValueError):
        sp_codec.Pieces(proto.SerializeToString())
    proto.trainer_spec.model_type = proto.trainer_spec.BPE
    proto.normalizer_spec.add_dummy_prefix = False
    with pytest.raises(ValueError):
        sp_codec.Pieces(proto.SerializeToString())
