"""Operator 11 against the library: ids, spans, decoding, and normalisation by compiled maps."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from eventloom.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CHARS = list(" ▁ab etThe.0123,\n\t\0é漢字かな😀ﬁ​ñß") + ["é", "﻿", " ", " ", "㍿"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    with open(MODEL, "rb") as f:
        return pieces.Codec(f.read())


def texts(n):
    rng = random.Random(7)
    made = ["".join(rng.choice(CHARS) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return made + [" " * k for k in range(70)] + ["a" * 300, "漢字" * 300, " " * 1000 + "x" + " " * 37, "x" * 47 + " " * 49]


def encoded(coder, text):
    parts = list(coder.encode_parts(text))
    return [np.concatenate([p[k] for p in parts]).tolist() if parts else [] for k in range(3)]


def test_ids_spans_and_text_equal_the_library(coder, library):
    for t in texts(1500):
        ids, begins, ends = encoded(coder, t)
        proto = library.encode(t, return_type="proto")
        assert ids == [p.id for p in proto.pieces]
        assert list(zip(begins, ends)) == [(p.begin, p.end) for p in proto.pieces]
        assert coder.decode(np.array(ids, dtype=np.int64)).decode() == library.decode(ids)


def test_long_texts_in_slices(coder, library, monkeypatch):
    rng = random.Random(5)
    words = ["The", "quick", "brown", "  ", "fox", "\n", "漢字かな", "12345", "x" * 90]
    t = " ".join(rng.choice(words) for _ in range(3000))
    monkeypatch.setattr(pieces, "SLICE", 100)
    assert len(list(coder.slices(t))) > 20
    ids, begins, ends = encoded(coder, t)
    proto = library.encode(t, return_type="proto")
    assert ids == [p.id for p in proto.pieces]
    assert list(zip(begins, ends)) == [(p.begin, p.end) for p in proto.pieces]
    digest = coder.digest(t)
    assert digest[0] == len(ids) and digest[1] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert digest[2] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_any_ids_decode_as_in_the_library(coder, library):
    rng = random.Random(3)
    for _ in range(2000):
        kinds = [0, 1, 2, 29871, *(rng.randint(3, 258) for _ in range(4)), *(rng.randint(128, 258) for _ in range(4)), rng.randint(259, 31999)]
        ids = [rng.choice(kinds) for _ in range(rng.randint(1, 12))]
        assert coder.decode(np.array(ids, dtype=np.int64)).decode() == library.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_compiled_maps(rule, prefix, squeeze):
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    spec, model = sentencepiece_model_pb2.ModelProto(), sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(made.serialized_model_proto())
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.CopyFrom(spec.normalizer_spec)
    coder, library = pieces.Codec(model.SerializeToString()), sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    for t in texts(400):
        got = "".join(map(chr, coder.normalised(t).points.tolist())) if t else ""
        assert got == made.normalize(t)
        proto = library.encode(t, return_type="proto")
        assert list(zip(*encoded(coder, t))) == [(p.id, p.begin, p.end) for p in proto.pieces]


def test_unknown_pieces_without_bytes():
    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.byte_fallback = False
    kept = [p for p in model.pieces if p.type != 6]
    del model.pieces[:]
    model.pieces.extend(kept)
    coder, library = pieces.Codec(model.SerializeToString()), sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    for t in texts(400):
        proto = library.encode(t, return_type="proto")
        assert list(zip(*encoded(coder, t))) == [(p.id, p.begin, p.end) for p in proto.pieces]


def test_other_models_are_refused():
    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.pieces[300].type = 4
    with pytest.raises(ValueError):
        pieces.Codec(model.SerializeToString())


def test_query_edges_and_round_trip(spark, sf, library):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "Hello  world", "c"), (3, "Hello  world", "c"), (4, "\x00 漢", None), (5, "word " * 200_000, "d")], "doc_id long, text string, ids string")
    rows = {r.doc_id: r for r in pieces.op11_sentencepiece(docs).collect()}
    assert pieces.op11_sentencepiece(docs).count() == 6
    for r in docs.collect():
        ids = library.encode(r.text or "")
        assert rows[r.doc_id].n_tokens == len(ids)
        assert rows[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert pieces.op11_sentencepiece(docs.limit(0)).count() == 0
    coded = pieces.encode(docs)
    assert coded.columns == ["doc_id", "text", "ids", "encoded"]
    back = coded.filter("doc_id in (3, 4)").select("text", pieces.decoder(spark)(F.col("encoded.ids")).alias("back")).collect()
    assert all(r.text == r.back for r in back)
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.op11_sentencepiece(documents).collect()}
    for r in documents.collect():
        ids = library.encode(r.text or "")
        assert got[r.doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
