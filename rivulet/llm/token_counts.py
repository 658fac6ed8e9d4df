"""Token counts by rank-synchronous merging of byte-level BPE pre-tokens.

Each Arrow batch is cut into pre-tokens by the tokenizer's own pattern.  The
distinct ones not met before are held as ragged numpy arrays of byte symbols;
in each round every sequence applies its lowest-ranked adjacent pair, all at
once, until no sequence has a ranked pair.  A pre-token's count is the number
of symbols that survive; a document's count is the sum over its pre-tokens.
The work is row-local: no shuffle, whole texts, memory bounded by one chunk of
text plus a dictionary of about ``MAX_KNOWN`` pre-tokens.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

#: Pre-tokens whose counts a worker remembers; once so many are known, further ones are counted again where they occur.
MAX_KNOWN = 1 << 19
NO_RANK = np.iinfo(np.int32).max

#: Fixed value: the pattern by which byte-level BPE files of this kind split text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """Vocabulary of a byte-level BPE file as sorted arrays of pair keys and ranks."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without normaliser or prefix space is needed")
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.symbol = np.zeros(256, np.int64)
        for char, byte in byte_alphabet().items():
            self.symbol[byte] = vocab[char]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.made = made
        # with one rule per token no merge of rank r can enable one of a lower
        # rank, so all places of the lowest pair may be merged in one round
        self.all_places = len(np.unique(made)) == len(made)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.split = regex.compile(PATTERN)
        self._index()

    def _index(self) -> None:
        """A hash table of the pair keys, each within a few probes of its home."""
        self.bits = max(4, int(len(self.keys)).bit_length() + 2)
        size = 1 << self.bits
        self.slot_key, self.slot_rank = np.full(size + 64, -1, np.int64), np.full(size + 64, NO_RANK, np.int32)
        todo, self.probes = np.arange(len(self.keys)), 0
        home = self._home(self.keys)
        while len(todo):
            if self.probes == 64:
                raise ValueError("the pair keys collide too often")
            at = home[todo] + self.probes
            free = self.slot_key[at] < 0
            _, first = np.unique(at, return_index=True)
            take = np.zeros(len(todo), bool)
            take[first] = True
            take &= free
            self.slot_key[at[take]], self.slot_rank[at[take]] = self.keys[todo[take]], self.ranks[todo[take]]
            todo, self.probes = todo[~take], self.probes + 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        home, out = self._home(keys), np.full(len(keys), NO_RANK, np.int32)
        for p in range(self.probes):
            hit = self.slot_key[home + p] == keys
            out[hit] = self.slot_rank[home[hit] + p]
        return out

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Surviving symbols of each byte string."""
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        out = sizes.copy()
        sym = self.symbol[np.frombuffer(b"".join(tokens), np.uint8)]
        row = np.repeat(np.arange(len(tokens)), sizes)
        rank = np.full(len(sym), NO_RANK, np.int32)  # of the pair that starts here
        if len(sym) > 1:
            inside = np.flatnonzero(row[1:] == row[:-1])
            rank[inside] = self.rank_of(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            low = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(sym)])
            live = low < NO_RANK
            out[row[starts]] = lengths
            if not live.all():  # finished sequences leave the arrays
                keep = np.repeat(live, lengths)
                sym, row, rank = sym[keep], row[keep], rank[keep]
                if not len(sym):
                    break
                low, lengths = low[live], lengths[live]
                starts = np.r_[0, np.cumsum(lengths)[:-1]]
            at = np.flatnonzero(rank == np.repeat(low, lengths))
            if self.all_places:  # of overlapping places (a a a), every second from the left
                run = np.r_[True, np.diff(at) != 1]
                index = np.arange(len(at))
                at = at[(index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 0]
            else:
                at = at[np.r_[True, row[at][1:] != row[at][:-1]]]
            sym[at] = self.made[rank[at]]
            gone = np.zeros(len(sym), bool)
            gone[at + 1] = True
            touched = np.zeros(len(sym), bool)
            touched[at] = True
            has_left = (at > 0) & (row[np.maximum(at - 1, 0)] == row[at])
            before = at[has_left] - 1
            before -= gone[before]  # the left neighbour may itself be a merged pair
            touched[before] = True
            keep = ~gone
            sym, row, rank, touched = sym[keep], row[keep], rank[keep], touched[keep]
            todo = np.flatnonzero(touched)
            inside = todo + 1 < len(sym)
            inside[inside] = row[todo[inside]] == row[todo[inside] + 1]
            rank[todo] = NO_RANK
            todo = todo[inside]
            rank[todo] = self.rank_of(sym[todo], sym[todo + 1])
        return out


def counter(table: MergeTable):
    """A function from texts to token counts that remembers the pre-tokens it has counted."""
    known: dict[str, int] = {}

    def of_texts(texts: list[str]) -> list[int]:
        cut, specials = [], []
        for text in texts:
            parts = table.special.split(text) if table.special else [text]
            specials.append(len(parts) - 1)
            tokens = table.split.findall(parts[0])
            for part in parts[1:]:
                tokens += table.split.findall(part)
            cut.append(tokens)
        new = list({t for tokens in cut for t in tokens if t not in known})
        if new:
            known.update(zip(new, table.count([t.encode() for t in new]).tolist(), strict=True))
        out = [sum(map(known.__getitem__, tokens)) + n for tokens, n in zip(cut, specials, strict=True)]
        if len(known) > MAX_KNOWN:  # the new ones served this call only
            for t in new:
                del known[t]
        return out

    return of_texts


@functools.lru_cache(1)
def _counter(tokenizer_json: str):
    """The counter of a worker process; the tasks it runs share its dictionary."""
    return counter(MergeTable(tokenizer_json))


def token_counts(docs: DataFrame, tokenizer_json: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``n_bytes`` and ``n_tokens`` (long).

    ``tokenizer_json`` is the content of a byte-level BPE file.  Strings of its
    added tokens inside a text count as one token each, as the library counts
    them by default.  Null text counts as empty (0 and 0); repeated rows,
    null ids and further columns pass through unchanged; columns named
    ``n_bytes`` or ``n_tokens`` are replaced.
    """
    rest = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens")]
    frame = docs.select(*rest, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]),
                        "n_bytes long", "n_tokens long"])
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_texts = _counter(shared.value)
        for batch in batches:
            texts = batch.column("__text")
            sizes = pc.binary_length(texts).cast(pa.int64())
            counts: list[int] = []
            for a, b in chunks(sizes.to_pylist()):
                counts += of_texts(texts.slice(a, b - a).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), sizes, pa.array(counts, pa.int64())],
                names=[*rest, "n_bytes", "n_tokens"])

    return frame.mapInArrow(run, schema)
