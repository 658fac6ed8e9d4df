"""Encoding and decoding by SentencePiece models through the tokenizers library.

The model's protocol buffer is read field by field; from it the library's parts
are rebuilt: the normaliser (precompiled map, extra spaces, the marker that
stands for a space), the unigram scores or the merges that the scores of a BPE
model imply, and byte fallback.  Where no piece of the model holds a marker
behind another character, texts fall apart at their markers without any loss,
and each distinct part is encoded once: many to a call.

Every encoded text can be verified against the sentencepiece library itself.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks
from .windows import spread

MARKER = "▁"
PART = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")
#: Kinds of pieces and models in the format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Parts whose ids a worker remembers; further ones are encoded again where they occur.
MAX_KNOWN = 1 << 20


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = varint() if size is None else size
            yield key >> 3, message[at:at + size]
            at += size


@dataclass
class Model:
    """What a model file holds."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # piece, score, kind
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    extra_spaces: bool = True  # runs of spaces are reduced
    escape: bool = True  # spaces become markers

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out = cls()
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                out.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                spec = dict(fields(value))
                out.kind, out.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(fields(value))
                out.charsmap = spec.get(2, b"")
                out.dummy_prefix, out.extra_spaces, out.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        if out.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are rebuilt")
        return out

    @property
    def unknown(self) -> int | None:
        return next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), None)

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces in the order in which their joined piece is preferred."""
        ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER, UNUSED)}
        found = []
        for piece, i in ids.items():
            for k in range(1, len(piece)):
                if piece[:k] in ids and piece[k:] in ids:
                    found.append((-self.pieces[i][1], ids[piece[:k]], ids[piece[k:]], piece[:k], piece[k:]))
        return [pair[3:] for pair in sorted(found)]

    def tokenizer(self):
        """The library's tokenizer of this model, without special tokens added."""
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        unk = self.unknown
        if self.kind == BPE:
            vocab = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            model = models.BPE(vocab, self.merges(), unk_token=None if unk is None else self.pieces[unk][0],
                               fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], unk, self.byte_fallback)
        out = Tokenizer(model)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.extra_spaces:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.escape:
            steps += [normalizers.Replace(" ", MARKER)]
        if self.dummy_prefix:
            steps += [normalizers.Prepend(MARKER if self.escape else " ")]
        if steps:
            out.normalizer = normalizers.Sequence(steps)
        if self.splits:
            out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARKER}*[^{MARKER}]+|{MARKER}+"), "isolated")
        ends = [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
        out.decoder = decoders.Sequence(ends + [decoders.Strip(" ", 1, 0)] * self.dummy_prefix)
        if own := [p for p, _, kind in self.pieces if kind == USER]:
            out.add_tokens([AddedToken(p, normalized=False) for p in own])
        return out

    @functools.cached_property
    def splits(self) -> bool:
        """Whether no piece holds a marker behind another character."""
        return not any(MARKER in p.lstrip(MARKER) for p, _, kind in self.pieces if kind in (NORMAL, USER, UNUSED))

    @property
    def plain(self) -> bool:
        """Whether a normalised text is the text with spaces marked and one marker before it, so that parts can be encoded alone."""
        return (self.splits and self.escape and not self.charsmap and not self.extra_spaces
                and not any(kind == USER for _, _, kind in self.pieces))


class _Numbers(dict):
    """Numbers parts in the order in which they are first asked for."""

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        return number


class Codec:
    """Ids from texts and texts from ids."""

    def __init__(self, data: bytes, threads: int = 1):
        # the library's pool is made at its first call in a process: as many threads as Spark gives a task cores
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model = Model.parse(data)
        self.tokenizer = self.model.tokenizer()
        self.known = _Numbers()
        self.flat, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.texts: list[str] = []  # what each part decodes to
        self.alone = None
        if self.model.plain:  # parts are normalised here, so the library need not do it
            from tokenizers import Tokenizer

            self.alone = Tokenizer.from_str(self.tokenizer.to_str())
            self.alone.normalizer = None
            self.marked = np.array([p.startswith(MARKER) for p, _, _ in self.model.pieces])

    def _parts(self, text: str) -> list[str]:
        """The text's parts, each with the markers before it."""
        words = text.split(" ")
        if self.model.dummy_prefix and text:
            words.insert(0, "")
        if "" not in words[1:] and MARKER not in text:
            return words[:1] * bool(words[0]) + [MARKER + w for w in words[1:]]
        return PART.findall(MARKER.join(words))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.alone.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[str]) -> None:
        """Ids of the parts that were numbered last."""
        # a part with one marker has one piece that starts with it, its first: such parts can follow each other
        rows = [p for p in parts if p[0] == MARKER and MARKER not in p[1:] and len(p) > 1]
        lone = [p for p in parts if not (p[0] == MARKER and MARKER not in p[1:] and len(p) > 1)]
        found = self._ids(["".join(rows[i:i + 256]) for i in range(0, len(rows), 256)])
        sizes = [np.diff(np.r_[np.flatnonzero(self.marked[x]), len(x)]) for x in found]
        alone = self._ids(lone)
        sizes.append(np.array([len(x) for x in alone], np.int64))
        lengths = np.concatenate(sizes)
        order = np.array([self.known[p] for p in rows + lone]) - len(self.start)
        start, size = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        start[order], size[order] = len(self.flat) + np.cumsum(lengths) - lengths, lengths
        self.flat = np.concatenate([self.flat, *found, *alone])
        ends = (start + size).tolist()
        back = self.decode([self.flat[a:b].tolist() for a, b in zip(start.tolist(), ends, strict=True)])
        if self.model.dummy_prefix:  # the decoder takes the first space, which only a text's own first one is
            back = [" " + t if p[0] == MARKER else t for p, t in zip(parts, back, strict=True)]
        self.texts += back
        self.start, self.size = np.r_[self.start, start], np.r_[self.size, size]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.round_trip(texts)[0]

    def round_trip(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """Ids of each text, and the text that they decode to (no byte or piece reaches over a marker)."""
        if self.alone is None:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return [np.array(x, np.int32) for x in ids], self.decode(ids)
        before, used = len(self.start), len(self.flat)
        places = []
        for text in texts:
            parts = self._parts(text)
            places.append(np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts)))
        new = list(itertools.islice(reversed(self.known), len(self.known) - before))[::-1]
        if new:
            self._learn(new)
        out = [self.flat[spread(self.start[place], self.size[place])] for place in places]
        back = ["".join(map(self.texts.__getitem__, place.tolist())) for place in places]
        if self.model.dummy_prefix:
            back = [t.removeprefix(" ") for t in back]
        if len(self.known) > MAX_KNOWN:  # the new ones served this call only
            for p in new:
                del self.known[p]
            self.flat, self.start, self.size = self.flat[:used].copy(), self.start[:before].copy(), self.size[:before].copy()
            del self.texts[before:]
        return out, back

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


@functools.lru_cache(1)
def _codec(data: bytes, threads: int) -> Codec:
    return Codec(data, threads)


@functools.lru_cache(1)
def _library(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


def encode_decode(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text", verify: bool = True) -> DataFrame:
    """``doc_id, ids, decoded, n_tokens, ids_crc32, parity`` of every row.

    ``model`` is the content of a model file.  ``parity`` says whether
    sentencepiece gives the same ids (null without ``verify``).  Both
    libraries encode a batch with as many threads as ``spark.task.cpus`` gives a task.  Null text
    counts as empty and has no ids; null ids and repeated rows pass; further
    columns are ignored; an empty table gives no rows.
    """
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    context = docs.sparkSession.sparkContext
    shared, threads = context.broadcast(model), int(context.getConf().get("spark.task.cpus", "1"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, threads)
        for batch in batches:
            texts = batch.column("__text")
            for a, b in chunks(pc.binary_length(texts).to_pylist()):
                some = texts.slice(a, b - a).to_pylist()
                arrays, decoded = codec.round_trip(some)
                ids = [x.tolist() for x in arrays]
                parity: list = [None] * len(some)
                if verify:
                    parity = [x == y for x, y in zip(ids, _library(shared.value).encode(some, num_threads=threads), strict=True)]
                ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                listed = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), listed, pa.array(decoded, pa.string()),
                     pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in arrays], pa.int64()), pa.array(parity, pa.bool_())],
                    names=["doc_id", "ids", "decoded", "n_tokens", "ids_crc32", "parity"])

    return frame.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string, n_tokens long, ids_crc32 long, parity boolean")
