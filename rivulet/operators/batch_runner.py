"""Scoring that continues on error.

A scorer is a plain function from a pandas batch to its output columns.  Where
it raises, the batch is cut in halves and each half is tried on its own, down
to the rows that raise by themselves; they go to the dead-letter sink with the
message, all others are scored.  No batch and no job ends for a bad row, and
none vanishes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

#: Column that holds the message of a row whose scoring failed.
ERROR = "error"

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


def _attempt(scorer: Scorer, rows: pd.DataFrame, outputs: Sequence[str]) -> pd.DataFrame:
    found = scorer(rows.copy())
    if len(found) != len(rows):
        raise ValueError(f"the scorer returned {len(found)} rows for {len(rows)}")
    missing = [c for c in outputs if c not in found.columns]
    if missing:
        raise ValueError(f"the scorer returned no {', '.join(missing)}")
    return found


def _objects(column: pd.Series) -> np.ndarray:
    """Values to put into a column of objects, where whole numbers stay whole beside missing ones."""
    values = column.to_numpy()
    return values if values.dtype.kind in "biuf" else column.astype(object).to_numpy()


def _joined(pieces: Sequence[tuple[np.ndarray, pd.Series]], n: int) -> np.ndarray:
    """A column of ``n`` rows from pieces at their places, missing elsewhere.

    Floats of one type stay what they are, as in a batch that was scored at once; all
    others become objects.
    """
    types = {str(piece.dtype) for _, piece in pieces}
    plain = len(types) == 1 and types <= {"float32", "float64"}
    column = np.full(n, np.nan, dtype=types.pop()) if plain else np.full(n, None, dtype=object)
    for places, piece in pieces:
        column[places] = piece.to_numpy() if plain else _objects(piece)
    return column


class Suspicion:
    """What the failing rows of a task so far have in common, by the kind of their message.

    The values in which all failing rows of a kind agree say which rows are tried
    apart from the others.  It is a guess that only orders the calls: every row is
    scored or raises by itself.
    """

    #: Kinds of messages that are followed.
    MOST_KINDS = 16

    def __init__(self) -> None:
        self._shared: dict[str, dict] = {}
        self._rows: dict[str, int] = {}

    def learn(self, rows: pd.DataFrame, place: int, message: str) -> bool:
        """Take up the failing row at ``place``; whether other rows than before are suspected."""
        kind = re.sub(r"'[^']*'|\d+", "", message)
        if kind not in self._shared:
            if len(self._shared) < self.MOST_KINDS:
                self._shared[kind] = {c: v for c in rows.columns if pd.api.types.is_scalar(v := rows[c].array[place])}
                self._rows[kind] = 1
            return False
        shared = self._shared[kind]  # only its columns are looked up, each by itself: a row of several types costs more than the call
        agreed = {c: v for c, v in shared.items()
                  if pd.api.types.is_scalar(x := rows[c].array[place]) and (pd.isna(x) if pd.isna(v) else not pd.isna(x) and bool(v == x))}
        self._shared[kind] = agreed
        self._rows[kind] += 1
        return len(agreed) < len(shared) or self._rows[kind] == 2

    def of(self, rows: pd.DataFrame) -> np.ndarray:
        """Which rows agree with the failing rows of a kind; one failing row alone says nothing."""
        found = np.zeros(len(rows), dtype=bool)
        for kind, shared in self._shared.items():
            if shared and self._rows[kind] > 1:
                like = np.ones(len(rows), dtype=bool)
                for c, v in shared.items():
                    like &= self._agrees(rows[c], v)
                found |= like
        return found

    @staticmethod
    def _agrees(column: pd.Series, value) -> np.ndarray:
        """Which values of a column are ``value``, or missing if it is."""
        if pd.isna(value):
            return column.isna().to_numpy()
        if isinstance(column.dtype, np.dtype) and column.dtype.kind in "biuf":
            return column.to_numpy() == value
        return (column == value).to_numpy(dtype=bool, na_value=False)


def _search(scorer: Scorer, rows: pd.DataFrame, outputs: Sequence[str],
            suspicion: Suspicion) -> tuple[list[tuple[int, int, pd.DataFrame]], dict[int, str], int]:
    """Scored pieces, messages of the rows that raised by themselves, and how many rows are done:
    all, or those up to a failing row that changed the suspicion.

    From the first such row on, a piece is as long as the failing
    rows are apart, a half whose other half went well is halved without a call (the
    failing row is in it), and what lies behind a failing half is tried with the rows
    that follow: a failing row costs about as many calls as its place needs bits.
    """
    waiting, good, failed = [(0, len(rows), False)], [], {}
    sure = False  # the failing row of the piece before lies in the one on top
    while waiting:
        start, end, first = waiting.pop()
        known, sure = sure, False
        step = max(1, 7 * start // (10 * len(failed))) if failed and not (first or known) else end - start
        if end - start > step:
            waiting.append((start + step, end, False))
            end = start + step
        if end - start == 1 or not known:
            try:
                good.append((start, end, _attempt(scorer, rows.iloc[start:end], outputs)))
                sure = first and bool(failed)
                continue
            except Exception as failure:  # whatever a scorer raises concerns its rows only
                message = f"{type(failure).__name__}: {failure}"
        if first and failed and len(waiting) > 1:
            behind, after = waiting.pop(), waiting.pop()
            waiting.append((behind[0], after[1], False))
        if end - start > 1:
            half = start + (end - start) // 2
            waiting += [(half, end, False), (start, half, True)]
        else:
            failed[start] = message
            if suspicion.learn(rows, start, message):
                return good, failed, end
    return good, failed, len(rows)


def score_pieces(scorer: Scorer, rows: pd.DataFrame, outputs: Sequence[str], suspicion: Suspicion | None = None) -> Iterator[pd.DataFrame]:
    """``rows`` with the outputs and ``error``, in order and as one frame: what leaves a
    task are batches as large as those that came, however many pieces were scored.

    Rows that agree with those that failed before are tried apart from the
    others (see :class:`Suspicion`), so that a failing row costs about one call where failing
    rows share a value, and as many as its place needs bits where they share none.
    """
    rows = rows.copy()  # a copy holds the columns of a type together, so that pieces are cut cheaply
    rows.index = pd.RangeIndex(len(rows))
    suspicion = suspicion or Suspicion()
    todo, good, failed = [np.arange(len(rows))], [], {}
    while todo:
        places = todo.pop()
        part = rows if len(places) == len(rows) else rows.iloc[places]
        like = suspicion.of(part)
        if like.any() and not like.all():
            todo += [places[like], places[~like]]
            continue
        pieces, messages, done = _search(scorer, part, outputs, suspicion)
        good += [(places[start:end], piece) for start, end, piece in pieces]
        failed |= {int(places[i]): message for i, message in messages.items()}
        if done < len(places):
            todo.append(places[done:])
    if failed or len(good) > 1:
        found = pd.DataFrame({c: _joined([(places, piece[c]) for places, piece in good], len(rows)) for c in outputs})
    else:
        found = good[0][1][list(outputs)].reset_index(drop=True)
    message = np.full(len(rows), None, dtype=object)
    for place, text in failed.items():
        message[place] = text
    found[ERROR] = pd.Series(message, dtype=object)
    yield pd.concat([rows, found], axis=1)


def score_batches(df: DataFrame, scorer: Scorer, outputs: str) -> DataFrame:
    """``df`` with the scorer's ``outputs`` (a DDL text) and ``error``, null where scoring went well.

    Outputs and ``error`` replace columns of their names.  A batch costs one
    call, and a task's first failing row two calls more for every halving; one among
    some hundred rows then costs about eight, or one where failing rows share
    a value (see :func:`score_pieces`).  An empty batch is not scored.
    """
    added = T.StructType(T.StructType.fromDDL(outputs).fields + [T.StructField(ERROR, T.StringType())])
    rest = df.select(*[c for c in df.columns if c not in added.names])
    schema = T.StructType(rest.schema.fields + added.fields)
    names = [f.name for f in added.fields[:-1]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        suspicion = Suspicion()
        for rows in batches:
            if len(rows):
                yield from score_pieces(scorer, rows, names, suspicion)  # columns in the order of the schema

    return rest.mapInPandas(run, schema)


def scored(rows: DataFrame) -> DataFrame:
    """The rows that were scored."""
    return rows.where(F.col(ERROR).isNull()).drop(ERROR)


def dead_letters(rows: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """The rows that could not be scored: their input columns and the message."""
    return rows.where(F.col(ERROR).isNotNull()).select(*inputs, ERROR)


def write_sinks(rows: DataFrame, inputs: Sequence[str], valid_path: str, dead_path: str) -> None:
    """Both branches of :func:`score_batches` as Parquet; the scorer runs once (its result is written before it is split)."""
    once = materialize(rows, "scored")
    scored(once).write.mode("overwrite").parquet(valid_path)
    dead_letters(once, inputs).write.mode("overwrite").parquet(dead_path)


def score_stream_batches(scorer: Scorer, outputs: str, valid_path: str, dead_path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch scorer that continues on error: both sinks per ``batch_id``, so that a replay replaces its own."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write_sinks(score_batches(batch, scorer, outputs), batch.columns,
                    f"{valid_path}/batch_id={batch_id}", f"{dead_path}/batch_id={batch_id}")

    return run
