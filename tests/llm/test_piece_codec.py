import io

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_docs import ODD, make_docs
from pyspark.sql import functions as F

from rivulet.llm.piece_codec import BPE, UNIGRAM, Codec, Model, encode_decode


@pytest.fixture(scope="module")
def file():
    import public_tokenizers
    return open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


def test_the_model_file_is_read_whole(file):
    model, library = Model.parse(file), sentencepiece.SentencePieceProcessor(model_proto=file)
    assert model.kind == BPE and model.byte_fallback and len(model.pieces) == library.get_piece_size()
    for i in range(0, len(model.pieces), 97):
        assert model.pieces[i][0] == library.id_to_piece(i)
        assert model.pieces[i][1] == pytest.approx(library.get_score(i))


def test_whole_table(docs, file):
    library = sentencepiece.SentencePieceProcessor(model_proto=file)
    rows = {r["doc_id"]: r for r in encode_decode(docs, file).collect()}
    for d in docs.collect():
        r = rows[d["doc_id"]]
        assert r["ids"] == library.encode(d["text"]) and r["parity"] and r["n_tokens"] == len(r["ids"])
        assert r["decoded"] == library.decode(r["ids"])


def test_odd_rows(spark, file):
    ids = [None, 1, 1, *range(3, len(ODD))]
    docs = make_docs(spark, ODD, ids=ids).withColumn("ids", F.lit("clash"))
    rows = encode_decode(docs, file).collect()
    assert len(rows) == len(ODD) and all(r["parity"] for r in rows)
    assert all(r["ids"] == [] for r in rows if r["decoded"] == "")
    assert encode_decode(docs.limit(0), file).count() == 0
    assert encode_decode(docs, file, verify=False).first()["parity"] is None


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab ▁é日!\n\t<s></s>1", max_size=50))
def test_any_text(text):
    import public_tokenizers
    file = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
    codec = test_any_text.__dict__.setdefault("codec", Codec(file))
    library = test_any_text.__dict__.setdefault("library", sentencepiece.SentencePieceProcessor(model_proto=file))
    assert codec.encode([text])[0].tolist() == library.encode(text)


def handmade_unigram():
    """A unigram model file written field by field."""
    def varint(n):
        out = b""
        while True:
            out += bytes([n & 0x7F | (0x80 if n > 0x7F else 0)])
            n >>= 7
            if not n:
                return out

    def field(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    import struct
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("▁", -2.0, 1), ("a", -2.5, 1), ("b", -2.6, 1),
              ("ab", -3.0, 1), ("▁ab", -3.2, 1), ("ba", -4.0, 1), ("▁a", -3.9, 1)]
    out = b"".join(field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + b"\x18" + varint(kind)) for p, s, kind in pieces)
    out += field(2, b"\x18\x01")
    return out + field(3, field(1, b"identity") + b"\x18\x01\x20\x01\x28\x01")


@pytest.mark.parametrize("text", ["ab ab", "  a  b ", "abba", "", "a b ab ba", "bab aab"])
def test_unigram_scores(text):
    file = handmade_unigram()
    assert Model.parse(file).kind == UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=file)
    assert Codec(file).encode([text])[0].tolist() == library.encode(text)
