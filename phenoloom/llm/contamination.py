"""Removal of benchmark text from training documents by a generalised suffix automaton.

The normalised test items are put into one automaton over words: every factor of every item is a path from its root, and a
state stands for the factors that end at the same places. A document's words are streamed through it; the automaton is at
all times in the state of the longest factor that ends at the current word, and falls back along suffix links where the
items do not go on. A window is ``width`` consecutive words of an item, or all of an item that has fewer. Each window
belongs to one state, and occurs wherever the longest match is at least as long as it and its state lies on the suffix
links of the current one; an occurrence marks its words. So an item is found by the length of a match, or, if it is
short, by its full coverage.

Items are cut into pieces that overlap by ``width - 1`` words and dealt into blocks of at most ``BLOCK_WORDS`` words.
Tasks build the automaton of each block (at most two states and three edges a word) and store it; it is broadcast only
after its size was counted. Documents pass through ``BLOCKS_AT_ONCE`` automata in one go; a benchmark of more blocks takes
more passes over them, each written down.

Before the automaton, pairs of neighbouring words are looked up: a stretch in which every pair is an item's, and that is as
long as the shortest window, is all that can hold an occurrence, and only stretches are streamed.

Edge cases: a null text has no words; an item without words has no window; repeated items count once; an item without an
id marks words but is not listed; without items every document is clean; repeated rows are each judged alone; empty tables
give no rows; other columns of the tables are not read, so they may have any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.llm.frames import stored

WIDTH = 10
#: Words in a piece of an item, and in a block of pieces; blocks whose automata a worker holds at once.
PIECE_WORDS, BLOCK_WORDS, BLOCKS_AT_ONCE = 10_000, 100_000, 4
#: Words of documents looked at together.
TOGETHER = 200_000

_ASCII = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

AUTOMATON = (
    "block bigint, words array<string>, link array<int>, longest array<int>, source array<int>, label array<int>, target array<int>, "
    "holder array<int>, size array<int>, members array<array<int>>, items array<string>"
)
_STATE = "k {kind}, x string, n_words bigint, longest int, spans array<struct<start:int,end:int>>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and anything beyond ASCII."""
    return text.translate(_ASCII).split()


class Automaton:
    """Suffix automaton of several word sequences, built by adding one word at a time."""

    def __init__(self):
        self.next, self.link, self.longest = [{}], [-1], [0]

    def _state(self, longest: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.longest.append(longest)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The part of ``target`` that is reached from ``state``: itself, or a copy with shorter factors."""
        if self.longest[target] == self.longest[state] + 1:
            return target
        copy = self._state(self.longest[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            known = self.next[last].get(word)
            if known is not None:  # an earlier sequence went this way
                last = self._split(last, word, known)
                continue
            new, state = self._state(self.longest[last] + 1, {}, 0), last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            if state >= 0:
                self.link[new] = self._split(state, word, self.next[state][word])
            last = new

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest factor that ends here, after ``word``."""
        while True:
            target = self.next[state].get(word)
            if target is not None:
                return target, length + 1
            if not state:
                return 0, 0
            state = self.link[state]
            length = self.longest[state]

    def windows(self, sequences: list[list[int]], width: int) -> dict[tuple[int, int], list[int]]:
        """``(state, words)`` of every window, with the numbers of the sequences that hold it."""
        found: dict[tuple[int, int], dict[int, None]] = {}
        for number, sequence in enumerate(sequences):
            size, state, length = min(width, len(sequence)), 0, 0
            for word in sequence:
                state, length = self.step(state, length, word)
                while self.longest[self.link[state]] >= size:  # to the state of the last ``size`` words alone
                    state = self.link[state]
                length = min(length, size)
                if length == size:
                    found.setdefault((state, size), {})[number] = None
        return {k: list(v) for k, v in found.items()}


def pieces(items: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``item, words``: distinct items as pieces that share ``width - 1`` words with the next, each of at most ``PIECE_WORDS`` words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words = [], []
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                of = [w.decode() for w in words_of((x or "").encode())]
                for i in range(0, max(1, len(of) - width + 1), PIECE_WORDS - width + 1):
                    if of:
                        ids.append(k)
                        words.append(of[i : i + PIECE_WORDS])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(words, pa.list_(pa.string()))], names=["item", "words"])

    return items.select(F.col(key).cast("string"), F.col(text)).mapInArrow(each, "item string, words array<string>").distinct()


def automata(items: DataFrame, key: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """One stored row for each block of items: its automaton as flat arrays."""
    if not 1 <= width < PIECE_WORDS:
        raise ValueError(f"width must lie between 1 and {PIECE_WORDS - 1}")
    cut = stored(pieces(items, key, text, width))
    total = cut.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 0
    blocks = -(-total // BLOCK_WORDS)
    if not blocks:
        return stored(cut.sparkSession.createDataFrame([], AUTOMATON))
    while True:  # pieces are distinct and small, so more blocks always even them out
        dealt = cut.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)))
        fullest = dealt.groupBy("block").agg(F.sum(F.size("words")).alias("n")).agg(F.max("n").alias("n")).first()["n"]
        if fullest <= BLOCK_WORDS or fullest <= PIECE_WORDS:
            break
        blocks *= 2

    def build(table: pa.Table) -> pa.Table:
        ids, texts = table.column("item").to_pylist(), table.column("words").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] or "", texts[i]))
        numbers: dict[str, int] = {}
        sequences = [[numbers.setdefault(w, len(numbers)) for w in texts[i]] for i in order]
        automaton = Automaton()
        for sequence in sequences:
            automaton.add(sequence)
        windows = automaton.windows(sequences, width)
        edges = [(s, w, t) for s, out in enumerate(automaton.next) for w, t in out.items()]
        columns = {
            "block": [table.column("block")[0].as_py()], "words": [list(numbers)], "link": [automaton.link], "longest": [automaton.longest],
            "source": [[x[0] for x in edges]], "label": [[x[1] for x in edges]], "target": [[x[2] for x in edges]],
            "holder": [[s for s, _ in windows]], "size": [[n for _, n in windows]], "members": [list(windows.values())], "items": [[ids[i] for i in order]],
        }
        return pa.table({f.name: pa.array(columns[f.name], f.type) for f in schema})

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(AUTOMATON))
    return stored(dealt.groupBy("block").applyInArrow(build, AUTOMATON))


class Matcher(Automaton):
    """A stored automaton ready to read documents."""

    def __init__(self, row: dict):
        self.words = {w.encode(): i for i, w in enumerate(row["words"])}
        self.link, self.longest = row["link"], row["longest"]
        self.next = [{} for _ in self.link]
        for s, w, t in zip(row["source"], row["label"], row["target"], strict=True):
            self.next[s][w] = t
        self.members = [[row["items"][i] for i in x if row["items"][i] is not None] for x in row["members"]]
        self.held: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for window, (state, size) in enumerate(zip(row["holder"], row["size"], strict=True)):
            self.held[state].append((size, window))
        # the nearest state with a window, among a state and those on its suffix links
        self.nearest = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.longest.__getitem__):
            self.nearest[state] = state if self.held[state] else self.nearest[self.link[state]]
        self.least = min(row["size"])
        pairs = [a * len(self.words) + b for a, t in self.next[0].items() for b in self.next[t]]
        self.pairs = np.sort(np.array(pairs, np.int64))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))

    def stretches(self, numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``(first, last + 1)`` of what can hold a window, over texts laid end to end."""
        known = numbers >= 0
        joined = known[:-1] & known[1:]
        ends = np.cumsum(lengths)
        joined[ends[(ends > 0) & (ends < len(numbers))] - 1] = False
        i = np.flatnonzero(joined)
        if len(self.pairs) and len(i):
            pair = numbers[i] * len(self.words) + numbers[i + 1]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[i[self.pairs[at] != pair]] = False
        else:
            joined[:] = False
        begins = np.flatnonzero(known & ~np.r_[False, joined])
        stops = np.flatnonzero(known & ~np.r_[joined, False]) + 1
        long = stops - begins >= self.least
        return np.stack([begins[long], stops[long]], axis=1)

    def read(self, numbers: list[int]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Merged intervals of marked words, the windows that occur, and the longest match."""
        spans, seen, most = [], set(), 0
        state = length = 0
        for i, word in enumerate(numbers, 1):
            state, length = self.step(state, length, word)
            most = max(most, length)
            begin, at = i, self.nearest[state]
            while at > 0:
                for size, window in self.held[at]:
                    if size <= length:
                        seen.add(window)
                        begin = min(begin, i - size)
                at = self.nearest[self.link[at]]
            if begin < i:
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, i))
        return spans, seen, most


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without what stands from the first to the last word of each span."""
    at = [m.span() for m in _WORD.finditer(text)]
    kept, done = [], 0
    for begin, end in spans:
        kept.append(text[done : at[begin][0]])
        done = at[end - 1][1]
    return b"".join([*kept, text[done:]])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    most_coverage: float = 0.5,
) -> DataFrame:
    """``key, n_words, n_hit, longest, spans, items, kept_text, dropped``, one row per document.

    ``spans`` are the maximal intervals of marked words, ``items`` the ids (as strings, sorted) whose windows occur,
    ``longest`` the longest match with any item, as far as stretches of item pairs go that can hold a window (0 if there
    is none). ``kept_text`` is the text without the spans; a document of which more than ``most_coverage`` is marked is
    ``dropped`` as a whole.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    schema = _STATE.format(kind=kind)
    blank = [F.lit(0).cast("long").alias("n_words"), F.lit(0).alias("longest"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items")]
    state = docs.select(F.col(key).alias("k"), F.col(text).alias("x"), *blank)
    table = automata(items, item_key, item_text, width)
    numbers = [r["block"] for r in table.select("block").distinct().collect()]
    for first in range(0, max(1, len(numbers)), BLOCKS_AT_ONCE):
        if first:
            state = stored(state)
        models = [spark.sparkContext.broadcast(table.where(F.col("block") == b).first().asDict()) for b in numbers[first : first + BLOCKS_AT_ONCE]]
        state = state.mapInArrow(_marker(models), schema)
    cut = _cutter()
    out = state.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]))
    kept = F.when(F.col("n_hit") == 0, F.col("x")).otherwise(cut(F.col("x"), F.col("spans")))
    return out.select(
        F.col("k").alias(key), "n_words", "n_hit", "longest", "spans", "items", kept.alias("kept_text"), (F.col("n_hit") > F.lit(most_coverage) * F.col("n_words")).alias("dropped")
    )


def _cutter():
    @F.pandas_udf("string")
    def cut(texts, spans):  # noqa: ANN001
        import pandas as pd

        return pd.Series([without_spans(t.encode(), [(s["start"], s["end"]) for s in x]).decode() if t is not None and len(x) else t for t, x in zip(texts, spans, strict=True)])

    return cut


def _marker(models: list):
    def answer(part: pa.RecordBatch, texts: list[list[bytes]], matchers: list[Matcher]) -> pa.RecordBatch:
        lengths = np.array([len(x) for x in texts], np.int64)
        ends = np.cumsum(lengths)
        flat = [w for x in texts for w in x]
        spans, items, longest = part.column("spans").to_pylist(), part.column("items").to_pylist(), part.column("longest").to_pylist()
        spans = [[(s["start"], s["end"]) for s in x] for x in spans]
        for matcher in matchers:
            numbers = matcher.numbers(flat)
            for first, stop in matcher.stretches(numbers, lengths).tolist():
                d = int(np.searchsorted(ends, first, side="right"))
                begin = int(ends[d] - lengths[d])
                found, seen, most = matcher.read(numbers[first:stop].tolist())
                longest[d] = max(longest[d], most)
                if seen:
                    spans[d] = merged(spans[d] + [(a + first - begin, b + first - begin) for a, b in found])
                    items[d] = sorted({*items[d], *(m for w in seen for m in matcher.members[w])})
        return pa.RecordBatch.from_arrays(
            [part.column("k"), part.column("x"), pa.array(lengths), pa.array(longest, pa.int32()),
             pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
             pa.array(items, pa.list_(pa.string()))],
            names=["k", "x", "n_words", "longest", "spans", "items"],
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = [Matcher(m.value) for m in models]
        for batch in batches:
            first, n, texts = 0, 0, []
            for i, x in enumerate(batch.column("x")):
                texts.append(words_of(x.as_buffer().to_pybytes()) if x.is_valid else [])
                n += len(texts[-1])
                if n >= TOGETHER or i + 1 == batch.num_rows:
                    yield answer(batch.slice(first, i + 1 - first), texts, matchers)
                    first, n, texts = i + 1, 0, []

    return each
