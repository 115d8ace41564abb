"""Periodic runs of words, found by a dictionary of basic factors.

The dictionary names the factors of length 1, 2, 4, ... of a text: equal factors have equal names, and a name of the next
length is a pair of names of this one. For each length, an occurrence is followed by its successors; where two successors
lie within twice the length and equally far apart, the three form an arithmetic progression whose difference is proposed as
a period. Neighbouring starts with one difference belong to one repetition, so the first and the last of such a stretch
give how far it extends. The same run may be proposed by several lengths; it is kept once.

Why nothing is missed or proposed falsely, for a run of smallest period ``q`` that has at least four periods: let ``L`` be
the power of two with ``q <= L < 2q``. Within the run a factor of length ``L >= q`` comes again exactly after ``q`` words,
because its root is primitive, and from the run's start both successors still lie within it. Conversely a progression with
a difference ``d <= L`` has the smallest period ``d``: a shorter one would have a nearer successor.

A factor that occurs once in its text cannot belong to a repetition; it is left out of all greater lengths, so ordinary
prose costs little more than the names of its words. Texts are worked on in tasks, some hundred thousand words together; a
text is never cut, and takes memory in proportion to its words.

Edge cases: a null or empty text has no words and no runs, a null id is an id, repeated rows are each judged alone, an
empty table gives no rows; of the input only ``key`` and ``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.llm.words import REMEMBERED_WORDS, release

#: A run has at least so many periods and so many words. The proof above needs no fewer than four periods.
PERIODS, SHORTEST = 4, 6
#: Words worked on together; a longer text is worked on alone.
TOGETHER = 300_000

SCHEMA = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, n_dropped bigint, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def runs_of(words: np.ndarray, lengths: np.ndarray, periods: int = PERIODS, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of all runs of texts laid end to end, by start, then period; starts count from the first text."""
    if periods < 4:
        raise ValueError("a run has four periods or more")
    total = len(words)
    text = np.repeat(np.arange(len(lengths)), lengths)
    end, size = np.repeat(np.cumsum(lengths), lengths), np.repeat(lengths, lengths)
    at = np.flatnonzero(size >= max(periods, shortest))
    _, name = np.unique(words[at], return_inverse=True)
    pair = text[at] * (len(at) + 1) + name
    names = np.full(total, -1, np.int64)
    found, length = [], 1
    while len(at):
        order = np.argsort(pair, kind="stable")
        pair, at = pair[order], at[order]
        same = pair[1:] == pair[:-1]
        gap = np.where(same, np.diff(at), 0)
        # three occurrences, the last within twice the length of the first
        step = np.flatnonzero((gap[:-1] > 0) & (gap[:-1] <= length) & (gap[:-1] == gap[1:]))
        if len(step):
            found.append(_stretches(at[step], gap[step], length))
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        group = np.cumsum(np.r_[True, ~same]) - 1
        names[:] = -1
        names[at[again]] = group[again]
        at = np.sort(at[again])
        # a period of more than this length fits four times into the text, and both halves must come again
        at = at[(at + 2 * length <= end[at]) & (size[at] > periods * length)]
        other = names[at + length]
        at, other = at[other >= 0], other[other >= 0]
        pair = names[at] * (len(group) + 1) + other
        length *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, stop, period = np.unique(np.concatenate(found, axis=1), axis=1)
    long = stop - start >= np.maximum(shortest, periods * period)
    start, stop, period = start[long], stop[long], period[long]
    order = np.lexsort((period, start))
    return start[order], (stop - start)[order], period[order]


def _stretches(at: np.ndarray, gap: np.ndarray, length: int) -> np.ndarray:
    """Start, end and period of each stretch of neighbouring progressions with one difference."""
    order = np.argsort(at)
    at, gap = at[order], gap[order]
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(gap) != 0))
    first, last = np.r_[0, cut + 1], np.r_[cut, len(at) - 1]
    return np.stack([at[first], at[last] + 2 * gap[last] + length, gap[first]])


def find_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    periods: int = PERIODS,
    shortest: int = SHORTEST,
    tail: Callable[[object, int], tuple[int, int] | None] | None = None,
) -> DataFrame:
    """``key, n_words, runs, n_dropped, collapsed``, one row per document.

    ``runs`` holds start, length and period by start, then period. ``collapsed`` joins by one space the words outside
    runs and those of the first period of every run that covers them; it is empty for a null text. With ``tail``, the
    words from ``a`` on repeat the ``p`` words at ``a`` before anything is looked for, where ``tail(key, n_words)`` gives
    ``(a, p)``; where it gives nothing the text stays as it is.
    """

    def answer(keys: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        lengths = np.array([len(x) for x in texts], np.int64)
        ends = np.cumsum(lengths)
        flat = REMEMBERED_WORDS.of([w for x in texts for w in x])
        start, size, period = runs_of(flat, lengths, periods, shortest)
        edges = np.zeros(len(flat) + 1, np.int64)
        np.add.at(edges, start + period, 1)
        np.add.at(edges, start + size, -1)
        gone = np.cumsum(edges[:-1]) > 0
        begins = ends - lengths
        cuts = np.searchsorted(start, ends)  # runs before each text's end
        dropped = np.diff(np.r_[0, np.cumsum(gone)][np.r_[0, ends]])
        collapsed = []
        for words, begin, end, n in zip(texts, begins.tolist(), ends.tolist(), dropped.tolist(), strict=True):
            kept = words if not n else [words[i] for i in np.flatnonzero(~gone[begin:end]).tolist()]
            collapsed.append(b" ".join(kept))
        of = np.searchsorted(ends, start, side="right")
        structs = pa.StructArray.from_arrays([pa.array(start - begins[of]), pa.array(size), pa.array(period)], ["start", "length", "period"])
        runs = pa.ListArray.from_arrays(pa.array(np.r_[0, cuts], pa.int32()), structs)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, kind), pa.array(lengths), runs.cast(_RUNS), pa.array(dropped), pa.array(collapsed, pa.binary()).cast(pa.string())],
            names=["k", "n_words", "runs", "n_dropped", "collapsed"],
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, n = [], [], 0
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = x.as_buffer().to_pybytes().split() if x.is_valid else []
                shape = tail(k, len(words)) if tail and words else None
                if shape:
                    a, p = shape
                    words = words[:a] + [words[a + i % p] for i in range(len(words) - a)]
                keys.append(k)
                texts.append(words)
                n += len(words)
                if n >= TOGETHER:
                    yield answer(keys, texts)
                    keys, texts, n = [], [], 0
            if keys:
                yield answer(keys, texts)
        release()

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema[key].dataType)
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("x")).mapInArrow(each, f"k {docs.schema[key].dataType.simpleString()}, {SCHEMA}")
    return out.select(F.col("k").alias(key), "n_words", "runs", "n_dropped", "collapsed")
