"""Both substring operators and the parts they are made of, against brute force."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_docs import ODD, make_docs
from pyspark.sql import functions as F

from rivulet.llm import substring_dedup, suffix_dedup
from rivulet.llm.fm_index import FMIndex
from rivulet.llm.suffix_dedup import common_prefixes, two_stage
from rivulet.llm.windows import Unit, segments


def slow_words(texts, window=35):
    """Per text: words, removed words, kept words joined."""
    cut = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in cut for i in range(len(w) - window + 1))
    out = []
    for w in cut:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def slow_bytes(rows, window=100):
    """Rows (id, text) in order of the table; per row: bytes, removed, spans, kept."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0], i))
    seen, out = set(), [None] * len(rows)
    for i in order:
        t = (rows[i][1] or "").encode()
        gone = bytearray(len(t))
        for k in range(len(t) - window + 1):
            part = t[k:k + window]
            if part in seen:
                gone[k:k + window] = b"\1" * window
            seen.add(part)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone, strict=True) if not g))
    return out


def words_of(frame):
    return [(r["n_words"], r["n_removed"], r["kept"]) for r in sorted(frame.collect(), key=lambda r: r["row"])]


def bytes_of(frame):
    return [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in sorted(frame.collect(), key=lambda r: r["row"])]


@pytest.mark.parametrize("hot", [100_000, 3])
def test_words_of_the_whole_table(docs, hot):
    texts = [r["text"] for r in docs.collect()]
    got = words_of(substring_dedup.remove_repeats(docs, shard_bytes=100_000, hot=hot))
    assert got == slow_words(texts)
    assert sum(r[1] for r in got) > 0


@pytest.mark.parametrize("hot", [100_000, 3])
def test_bytes_of_the_whole_table(docs, hot):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = bytes_of(suffix_dedup.remove_repeats(docs, shard_bytes=100_000, hot=hot))
    assert got == slow_bytes(rows)
    assert sum(r[1] for r in got) > 0


SHARED = " ".join(f"w{i}" for i in range(60))
REPEATING = ODD + [SHARED, "before " + SHARED, SHARED + " after", "x y " * 80, "x y " * 80, "p " + "x y " * 80 + SHARED,
                   "é" * 150, "a" + "é" * 150, "ab" * 120, "zyxwvutsrqponmlkjihgfedcba" * 9, SHARED[:150], SHARED[:99]]


@pytest.mark.parametrize("hot", [100_000, 2])
def test_odd_rows(spark, hot):
    ids = [None, 7, 7, *range(len(REPEATING) - 3, 0, -1)]
    docs = make_docs(spark, REPEATING, ids=ids).coalesce(1).withColumn("row", F.lit("clash")).withColumn("copies", F.lit(0))
    assert words_of(substring_dedup.remove_repeats(docs, hot=hot)) == slow_words(REPEATING)
    assert bytes_of(suffix_dedup.remove_repeats(docs, hot=hot)) == slow_bytes(list(zip(ids, REPEATING, strict=True)))
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=40).map(str.encode), min_size=1, max_size=8), st.integers(2, 6))
def test_two_stage_order_and_common_prefixes(parts, depth):
    text = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int16) + 1, 0) for p in parts]).astype(np.int16)
    raw = b"\0".join(parts) + b"\0"
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
    wanted = np.array([b + i for b, p in zip(begins, parts, strict=False) for i in range(len(p) - depth + 1)], np.int64)
    got = two_stage(text, wanted, depth)
    kept = [int(i) for i in got if i in set(wanted.tolist())]
    assert sorted(kept) == sorted(wanted.tolist())
    cut = [raw[i:i + depth] for i in kept]
    assert cut == sorted(cut)
    if kept:
        lcp = common_prefixes(np.frombuffer(raw, np.uint8), np.array(kept), depth)
        for k in range(1, len(kept)):
            want = next((j for j in range(depth) if cut[k][j] != cut[k - 1][j]), depth)
            assert lcp[k] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 5), max_size=30), min_size=1, max_size=6), st.integers(1, 9))
def test_backward_search_gives_matching_statistics(parts, longest):
    text = np.array([x for p in parts for x in [*p, 0]], np.int64)
    index = FMIndex(text, longest)
    ends = np.array([i for i in range(longest, len(text) + 1)], np.int64)
    ends = ends[[0 not in text[e - longest:e] for e in ends]] if len(ends) else ends
    listed = text.tolist()

    def occurrences(pattern):
        return sum(listed[i:i + len(pattern)] == pattern for i in range(len(listed)))

    got = index.matching(text, ends, longest)
    for e, n in zip(ends.tolist(), got.tolist(), strict=True):
        want = max([k for k in range(1, longest + 1) if occurrences(listed[e - k:e]) >= 2], default=0)
        assert n == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=60), min_size=1, max_size=6))
def test_segments_cover_every_window_once(texts):
    unit = Unit(False, 12, 4)
    codes = [unit.codes(t) for t in texts]
    text, start, count, anchor = segments(np.concatenate(codes), np.array([len(t) for t in texts]), unit)
    got = Counter((int(t), int(s) + k) for t, s, n in zip(text, start, count, strict=True) for k in range(n))
    assert got == Counter((i, k) for i, t in enumerate(texts) for k in range(len(t) - 11))
    by_window = {}
    for t, s, n, a in zip(text, start, count, anchor, strict=True):
        for k in range(int(s), int(s + n)):
            assert by_window.setdefault(texts[t][k:k + 12], int(a)) == int(a)
