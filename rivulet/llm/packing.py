"""Harmonic packing of tokenised documents into fixed-length sequences.

A document's ids are cut into pieces whose lengths are reciprocals of the
capacity where possible: whole sequences first, then again and again the
largest ``capacity // k`` that the rest still fills, until less than
``capacity // MAX_CLASS`` ids are left, which stay one piece.  A piece of
length n belongs to class ``k = capacity // n`` (short tails: to the next power
of two above it), and a bin of class k takes exactly k pieces, so bins of exact
reciprocals lose less than k tokens.

Pieces are dealt by hash to workers of a fixed amount of text.  Every worker
fills its classes' bins on its own; the few pieces that are left over when a
class's last bin is not full (less than one bin for each class) are packed
together, largest first.  Only piece descriptions (ids' count, position and
checksum) are shuffled, never ids or texts.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, table_bytes

CAPACITY = 2048
#: Pieces longer than capacity // MAX_CLASS have a class of their own k.
MAX_CLASS = 64
#: Bytes of text whose pieces one worker packs.
WORKER_BYTES = 4 << 20
#: Words whose ids a worker remembers; once so many are known, further ones are encoded again where they occur.
MAX_KNOWN = 3 << 17
MARKS = re.compile(r"(?<=[A-Za-z0-9])([.,])(?=[ \n]|$)")


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _word_model(tokenizer):
    """The tokenizer's own model cut at spaces only, and which ids end a word; (None, None) where words have no such end."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    spec = json.loads(tokenizer.to_str())["model"]
    end = spec.get("end_of_word_suffix")
    if spec["type"] != "BPE" or not end or any(c not in spec["vocab"] for x in string.ascii_lowercase for c in (x, x + end)):
        return None, None
    model = Tokenizer(models.BPE(spec["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["merges"]],
                                 end_of_word_suffix=end))
    model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    last = np.zeros(tokenizer.get_vocab_size(), bool)
    last[[i for t, i in spec["vocab"].items() if t.endswith(end)]] = True
    return model, last


def word_encoder(tokenizer):
    """A function from texts to id arrays, equal to the tokenizer's own.

    For a tokenizer that drops white space and splits letters from points and
    commas, the ids of a text are those of its parts between spaces, line
    feeds and such marks in a row, so each distinct part is encoded once:
    many to a call, with a special token between them.
    """
    mark = next(iter(tokenizer.get_added_tokens_decoder().values())).content
    mark_id = tokenizer.token_to_id(mark)
    plain, last = _word_model(tokenizer)
    known = _Numbers()
    flat, start, size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids_of(model, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(parts: list[str]) -> None:
        """Ids of the parts that were numbered last."""
        nonlocal flat, start, size
        first = len(start)
        where = dict(zip(parts, range(first, first + len(parts)), strict=True))
        simple, odd, rest, old = {}, [], [], []
        for w, i in where.items():
            if mark in w:
                odd.append(w)
            elif plain is not None and w.isascii() and w.isalpha():
                # letters a-z in lower case need no normalising; the last id of a word tells its end
                low = w.lower()
                j = known.get(low, first)
                if j < first:
                    old.append((i, j))
                else:
                    simple.setdefault(low, []).append(i)
            else:
                rest.append(w)
        lower = list(simple)
        found = ids_of(plain, [" ".join(lower[i:i + 256]) for i in range(0, len(lower), 256)])
        sizes = [np.diff(np.r_[-1, np.flatnonzero(last[ids])]) for ids in found]
        marked = ids_of(tokenizer, [mark.join(rest[i:i + 64]) for i in range(0, len(rest), 64)])
        sizes += [np.diff(np.r_[-1, np.flatnonzero(ids == mark_id), len(ids)]) - 1 for ids in marked]
        alone = ids_of(tokenizer, odd)
        sizes.append(np.array([len(x) for x in alone], np.int64))
        lengths = np.concatenate(sizes)
        begin = len(flat) + np.cumsum(lengths) - lengths
        flat = np.concatenate([flat, *found, *(ids[ids != mark_id] for ids in marked), *alone])
        start, size = (np.r_[x, np.zeros(len(parts), np.int64)] for x in (start, size))
        owners = [i for low in lower for i in simple[low]] + [where[w] for w in rest + odd]
        times = [len(simple[low]) for low in lower] + [1] * (len(rest) + len(odd))
        start[owners], size[owners] = np.repeat(begin, times), np.repeat(lengths, times)
        if old:
            mine, theirs = np.array(old).T
            start[mine], size[mine] = start[theirs], size[theirs]

    def encode(texts: list[str]) -> list[np.ndarray]:
        nonlocal flat, start, size
        before, used = len(start), len(flat)
        places = []
        for text in texts:
            words = MARKS.sub(r" \1", text).replace("\n", " ").split(" ")
            places.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        new = list(itertools.islice(reversed(known), len(known) - before))[::-1]
        if new:
            learn(new)
        out = []
        for place in places:
            sizes = size[place]
            first = np.repeat(start[place] - (np.cumsum(sizes) - sizes), sizes)
            out.append(flat[first + np.arange(len(first))])
        if len(known) > MAX_KNOWN:  # the new ones served this call only
            for w in new:
                del known[w]
            flat, start, size = flat[:used].copy(), start[:before].copy(), size[:before].copy()
        return out

    return encode


@functools.lru_cache(1)
def _encoder(tokenizer_json: str):
    """The encoder of a worker process; the tasks it runs share its dictionary."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
    from tokenizers import Tokenizer

    return word_encoder(Tokenizer.from_str(tokenizer_json))


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of n ids."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest >= max(2, capacity // MAX_CLASS):
        size = capacity // -(-capacity // rest)  # the largest capacity // k up to the rest
        out.append(size)
        rest -= size
    return out + [rest] * (rest > 0)


def piece_class(length: int, capacity: int = CAPACITY) -> int:
    k = capacity // length
    return k if k <= MAX_CLASS else 1 << (k.bit_length() - 1)


def pack_worker(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece of one worker, the sequences numbered from 0."""
    n = len(lengths)
    sequence, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    if not n:
        return sequence, offset
    kinds = np.array([piece_class(x, capacity) for x in range(1, capacity + 1)])[lengths - 1]
    order = np.argsort(kinds, kind="stable")
    used, left = 0, []
    bounds = np.flatnonzero(np.r_[True, np.diff(kinds[order]) != 0, True])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        members, k = order[a:b], int(kinds[order[a]])
        full = len(members) // k * k
        sizes = lengths[members[:full]].reshape(-1, k)
        sequence[members[:full]] = used + np.repeat(np.arange(len(sizes)), k)
        offset[members[:full]] = (np.cumsum(sizes, axis=1) - sizes).ravel()
        used += len(sizes)
        left.append(members[full:])
    rest = np.concatenate(left) if left else np.zeros(0, np.int64)
    room: list[int] = []
    for i in rest[np.argsort(-lengths[rest], kind="stable")]:
        at = next((j for j, r in enumerate(room) if r >= lengths[i]), len(room))
        if at == len(room):
            room.append(capacity)
        sequence[i], offset[i] = used + at, capacity - room[at]
        room[at] -= int(lengths[i])
    return sequence, offset


def pieces(docs: DataFrame, tokenizer_json: str, end_id: int = 1, doc_id: str = "doc_id",
           text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value)
        for batch in batches:
            texts, keys = batch.column("__text"), batch.column("doc_id")
            sizes = pa.compute.binary_length(texts).to_pylist()
            for a, b in chunks(sizes):
                rows, out = [], []
                for row, ids in enumerate(encode(texts.slice(a, b - a).to_pylist()), start=a):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    start = 0
                    for n in cut_lengths(len(ids), capacity):
                        rows.append(row)
                        out.append((start, n, zlib.crc32(ids[start:start + n].tobytes()), len(ids)))
                        start += n
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows)), *(pa.array(c, pa.int64()) for c in columns)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return frame.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer_json: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, worker_bytes: int = WORKER_BYTES) -> DataFrame:
    """Pieces with their place: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its text's ids followed by ``end_id``; null or empty text is
    the end id alone.  Rows are independent, so repeated rows and null ids
    are packed like any others; an empty table gives no rows; further columns
    are ignored.  A document of any length is spread over all workers, since
    pieces and not documents are dealt.
    """
    workers = max(1, table_bytes(docs, text) // worker_bytes)
    placed = pieces(docs, tokenizer_json, end_id, doc_id, text, capacity).withColumn(
        "worker", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(workers)))
    kind = placed.schema["doc_id"].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        sequence, offset = pack_worker(group["length"].to_numpy(np.int64), capacity)
        return group.drop(columns="worker").assign(
            sequence_id=(int(group["worker"].iloc[0]) << 32) + sequence, offset=offset)

    return placed.groupBy("worker").applyInPandas(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
             "sequence_id long, offset long")
