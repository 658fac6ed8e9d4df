import zlib
from collections import defaultdict

import numpy as np
from odd_docs import ODD, make_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rivulet.llm.common import vocabulary
from rivulet.llm.packing import cut_lengths, pack, pack_worker, piece_class, word_encoder

FILE = vocabulary("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_str(FILE)


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(rows, texts):
    """texts: (doc_id, text) pairs; every id lies in one piece, sequences are gapless and within capacity."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for i, t in texts:
        ids, at = ids_of(t), 0
        for n in cut_lengths(len(ids)):
            want[i].append((at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids)))
            at += n
        assert at == len(ids)
    assert {i: sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in p) for i, p in by_doc.items()} \
        == {i: sorted(p) for i, p in want.items()}
    for places in by_sequence.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048
    return {s: sum(n for _, n in p) for s, p in by_sequence.items()}


def test_whole_table(docs):
    rows = pack(docs, FILE).collect()
    used = check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    padding = sum(2048 - n for n in used.values() if n & (n - 1))
    assert padding < 0.03 * sum(used.values())


def test_many_workers_and_odd_rows(spark):
    ids = [None, 1, 1, *range(3, len(ODD))]
    docs = make_docs(spark, ODD, ids=ids).withColumn("length", F.lit("clash")).withColumn("worker", F.lit(-1))
    check(pack(docs, FILE, worker_bytes=1000).collect(), list(zip(ids, ODD, strict=True)))
    assert pack(docs.limit(0), FILE).count() == 0


def test_pieces_are_reciprocals_but_for_the_tail():
    for n in range(1, 5000):
        cut = cut_lengths(n)
        assert sum(cut) == n and all(2048 // k == x for x in cut[:-1] for k in [2048 // x])
        assert len(cut) <= n // 2048 + 6


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 2048), max_size=400))
def test_bins_of_a_class_hold_a_fixed_count(lengths):
    lengths = np.array(lengths, np.int64)
    sequence, offset = pack_worker(lengths)
    total = np.bincount(sequence, weights=lengths) if len(lengths) else np.zeros(0)
    assert (total <= 2048).all() and (total > 0).all()
    assert all(piece_class(int(n)) * n <= 2048 for n in lengths)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abZ. ,'\n\té́日!1Σ<|endoftext|>", max_size=80))
def test_encoder_equals_the_library(text):
    encode = test_encoder_equals_the_library.__dict__.setdefault("encode", word_encoder(TOKENIZER))
    assert encode([text])[0].tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
