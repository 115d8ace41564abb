"""Best-fit packing by minimum bin slack.

Texts become token pieces of at most ``capacity`` tokens. Only the number of pieces of each length, at most ``capacity``
numbers, decides how sequences are filled: per bin, a bitset subset-sum over the lengths still available finds the
fullest feasible combination around the longest of them, which is then removed, as often as the counts allow. Pieces are
ranked within their length, in many buckets of a hash, and read their sequence off the list of combinations. Nothing
that grows with the data leaves the executors.

Edge cases: a null text is empty and becomes the end token alone; a repeated row is packed each time; an empty table
gives no rows; null ids are packed like others.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.llm.frames import stored
from phenoloom.llm.words import release
from phenoloom.operators.ordered import hashed_rank

CAPACITY = 2048
#: Words whose tokens a task remembers. Beyond, between batches, it forgets those that no second batch has asked for.
REMEMBERED = 250_000
#: Lower-case letters that normalisation leaves alone: a run of them is exactly one token word. So are a few signs after it.
_TAILED = re.compile(r"([a-zß-öø-ÿœ]+)([.,;:!?#$%&*)]{0,4})").fullmatch
#: Lead bytes of combining marks, which may join a letter differently in upper and lower case, and of special tokens.
_AS_IS = (b"\xcc", b"\xcd", b"<|")


class WordTokens:
    """Token ids of whole texts, from the ids of their words.

    The tokenizer drops white space and never joins what it separates, so the ids of a text are those of its words in
    order. Each distinct word is encoded once while it is remembered: plain ones many at a time, told apart by the
    tokens that end a word and cut at spaces alone, which is all that normalisation and patterns do to them; a plain
    word with signs after it from the word and the signs; all others on their own.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.bare = Tokenizer.from_str(tokenizer_json), Tokenizer.from_str(tokenizer_json)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.place, self.ids = {}, np.zeros(0, np.uint32)
        self.starts, self.sizes, self.often = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @staticmethod
    def _encode(tokenizer, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def forget(self) -> None:
        """Words asked for by a second batch stay, unless they are too many themselves."""
        kept = np.flatnonzero(self.often)
        if len(kept) > REMEMBERED // 2:
            kept = kept[:0]
        words = list(self.place)  # in the order of their places
        ids, sizes = self._gather(kept), self.sizes[kept]
        self.place, self.ids = {}, np.zeros(0, np.uint32)
        self.starts, self.sizes, self.often = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self._add([words[i] for i in kept.tolist()], sizes, ids)

    def _add(self, words: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.starts), len(self.starts) + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        self.often = np.concatenate([self.often, np.zeros(len(words), bool)])

    def _gather(self, at: np.ndarray) -> np.ndarray:
        sizes = self.sizes[at]
        upto = np.cumsum(sizes)
        return self.ids[np.repeat(self.starts[at] - (upto - sizes), sizes) + np.arange(int(upto[-1]) if len(upto) else 0)]

    def learn(self, words: list[bytes]) -> None:
        """``words`` are distinct and new."""
        plain, tailed, stems, tails, other = set(), [], [], [], set()
        for word in words:
            found = _TAILED(word.decode())
            if found is None:
                other.add(word)
            elif not (tail := len(found[2])):
                plain.add(word)
            else:
                tailed.append(word)
                stems.append(word[:-tail])
                tails.append(word[-tail:])
        plain.update(w for w in stems if w not in self.place)
        other.update(w for w in set(tails) if w not in self.place)
        for i in range(0, len(plain := list(plain)), 5000):
            some = plain[i : i + 5000]
            got = self._encode(self.bare, [b" ".join(some[j : j + 100]).decode() for j in range(0, len(some), 100)])
            ids = np.fromiter(chain.from_iterable(got), np.uint32)
            last = np.flatnonzero(self.ends[ids])
            self._add(some, np.diff(last, prepend=-1), ids)
        for i in range(0, len(other := list(other)), 2000):
            some = other[i : i + 2000]
            got = self._encode(self.tokenizer, [w.decode() for w in some])
            self._add(some, np.fromiter(map(len, got), np.int64, len(got)), np.fromiter(chain.from_iterable(got), np.uint32))
        # a word's stem, then its tail
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(zip(stems, tails, strict=True))), np.int64, 2 * len(tailed))
        self._add(tailed, self.sizes[at].reshape(-1, 2).sum(1), self._gather(at))

    def encode(self, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, each text closed by ``end``, and where each text begins (one more entry than texts)."""
        if len(self.place) > REMEMBERED:
            self.forget()
        raw = [(text or "").encode() for text in texts]
        # made anew here, as arrays that are slices of others are not lower-cased rightly in Arrow
        whole = pa.array([x if any(y in x for y in _AS_IS) else x.lower() for x in raw], pa.large_string())
        words = pc.ascii_split_whitespace(whole)
        owner, flat = pc.list_parent_indices(words), words.flatten()
        real = pc.not_equal(flat, "")  # beside white space at either end of a text
        counts = np.bincount(owner.filter(real).to_numpy(), minlength=len(texts))
        said = flat.filter(real).dictionary_encode()
        distinct = said.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        before = len(self.place)
        if new := [w for w in distinct if w not in self.place]:
            self.learn(new)
        at = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))
        self.often[at[at < before]] = True
        at = at[said.indices.to_numpy()]
        upto = np.concatenate([[0], np.cumsum(self.sizes[at])])
        owner_end = upto[np.cumsum(counts)]  # ids before the end of each text, without end tokens
        bounds = np.concatenate([[0], owner_end + np.arange(1, len(texts) + 1)])
        out = np.full(bounds[-1], end, np.uint32)
        mask = np.ones(len(out), bool)
        mask[bounds[1:] - 1] = False
        out[mask] = self._gather(at)
        return out, bounds


def pieces(docs: DataFrame, tokenizer_json: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = 0, with_ids: bool = False) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` per piece, and the ``ids`` themselves if asked for."""
    types = f"`{key}` {docs.schema[key].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema = types + (", ids array<int>" if with_ids else "")
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # what another operator's tasks left in this worker
        tokens = WordTokens(shipped.value)
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                ids, bounds = tokens.encode(part.column(1).to_pylist(), end)
                n = np.diff(bounds)
                many = -(-n // capacity)
                owner = np.repeat(np.arange(len(n)), many)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(n[owner] - start, capacity)
                raw = memoryview(np.ascontiguousarray(ids.astype("<u4", copy=False))).cast("B")
                first = bounds[owner] + start
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(first.tolist(), length.tolist(), strict=True)]
                cols = [part.column(0).take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([first, bounds[-1:]]), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=[key, "piece", "start", "length", "ids_crc32", "ids"][: len(cols)])
        del tokens
        release()

    return docs.select(key, text).mapInArrow(cut, schema)


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Combinations ``([(length, copies), ...], times)`` that use up all counts.

    The longest length left opens the bin. For the room beside it, bit t of a Python integer says that t tokens can be
    reached exactly; lengths are added from the longest down, in binary lots of their copies, until the room can be
    filled to the last token or all lengths were tried. The combination is removed as often as every length in it
    allows; so the number of combinations depends on the number of distinct lengths, not on the number of pieces.
    """
    left = {k: v for k, v in counts.items() if v > 0}
    lengths = sorted(left, reverse=True)
    out = []
    while lengths:
        longest = lengths[0]
        room = capacity - longest
        reach, full, steps = 1, (1 << (room + 1)) - 1, []
        for x in lengths:
            if reach >> room & 1:
                break
            copies, lot = min(left[x] - (x == longest), room // x), 1
            while copies > 0 and not reach >> room & 1:
                lot = min(lot, copies)
                grown = (reach | reach << lot * x) & full
                if grown != reach:
                    steps.append((x, lot, reach))
                    reach = grown
                copies -= lot
                lot *= 2
        at, use = reach.bit_length() - 1, {longest: 1}
        for x, lot, before in reversed(steps):
            if not before >> at & 1:
                use[x] = use.get(x, 0) + lot
                at -= lot * x
        times = min(left[x] // k for x, k in use.items())
        out.append((sorted(use.items(), reverse=True), times))
        for x, k in use.items():
            left[x] -= k * times
        lengths = [x for x in lengths if left[x]]
    return out


def places(combinations: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows ``(length, first rank, copies, first sequence, offset)``: where the pieces of each length and rank go."""
    rows, used, sequence = [], {}, 0
    for use, times in combinations:
        offset = 0
        for x, k in use:
            rows.append((x, used.get(x, 0), k, sequence, offset))
            used[x] = used.get(x, 0) + k * times
            offset += k * x
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces, which are stored once."""
    cut = stored(pieces)
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row per length, at most capacity
    table = cut.sparkSession.sparkContext.broadcast(places(minimum_bin_slack(counts, capacity)))
    who = F.concat_ws("|", F.col(key).cast("string"), F.col("piece"), F.col("ids_crc32"))
    ranked = hashed_rank(cut, who, "pack", by=["length"], out="_rank", digits=2)

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = table.value
        by_length = {x: place[a:b] for x, a, b in zip(*_runs(place[:, 0]), strict=True)}
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "_rank"))
            rank = rank - 1
            row = np.zeros((len(rank), 5), np.int64)
            for x in np.unique(length):
                mine = np.flatnonzero(length == x)
                rows = by_length[x]
                row[mine] = rows[np.searchsorted(rows[:, 1], rank[mine], side="right") - 1]
            lot, within = np.divmod(rank - row[:, 1], row[:, 2])
            keep = [i for i, n in enumerate(batch.schema.names) if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(row[:, 3] + lot), pa.array(row[:, 4] + within * length)],
                names=[*(batch.schema.names[i] for i in keep), "sequence_id", "offset"],
            )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return ranked.mapInArrow(look_up, f"{types}, sequence_id bigint, offset bigint")


def _runs(values: np.ndarray) -> tuple[list, list, list]:
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return values[first].tolist(), first.tolist(), [*first[1:].tolist(), len(values)]
