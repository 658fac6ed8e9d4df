import pytest
from odd_docs import ODD, make_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rivulet.llm.common import vocabulary
from rivulet.llm.token_counts import MergeTable, counter, token_counts


@pytest.fixture(scope="module")
def file():
    return vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(file):
    tok = Tokenizer.from_str(file)
    return lambda t: len(tok.encode(t, add_special_tokens=False).ids)


def test_counts_equal_the_library(docs, file, library):
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in token_counts(docs, file).collect()}
    want = {r["doc_id"]: (len(r["text"].encode()), library(r["text"])) for r in docs.collect()}
    assert got == want


def test_odd_rows(spark, file, library):
    docs = make_docs(spark, ODD, ids=[None, 1, 1, *range(3, len(ODD))]).withColumn("n_tokens", F.lit("clash"))
    rows = token_counts(docs, file).collect()
    want = sorted((len((t or "").encode()), library(t or "")) for t in ODD)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert token_counts(docs.limit(0), file).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aab '\n\té日!1<|endoftext|>", max_size=60), min_size=1, max_size=5))
def test_any_text(texts):
    file = vocabulary("byte_bpe_50k.json")
    tok = test_any_text.__dict__.setdefault("tok", Tokenizer.from_str(file))
    count = test_any_text.__dict__.setdefault("count", counter(MergeTable(file)))
    assert count(texts) == [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_one_place_at_a_time_gives_the_same(file):
    table = MergeTable(file)
    tokens = [b"aaaaaaa", b"banana", b" hello", b"!!!!!", b"x"]
    all_places = table.count(tokens).tolist()
    table.all_places = False
    assert table.count(tokens).tolist() == all_places
