"""Masked pseudo-likelihood of documents under a bidirectional window network.

A text is a sequence of units that cover all its words: frequent words, frequent parts of the other words, and single
bytes. A word is cut, with a space in front, by the longest unit that fits from the left, unless it is a unit itself.
Every unit is predicted from the units on both sides of it: rows of a table for each place in the window are added and
squashed, and a two-level softmax gives first the cluster of the unit and then the unit. A document's score is the sum
of the logarithms over all its units.

Units and the frequencies that the network starts from are counted over all documents. Training deals the positions of
every document over the rounds by a hash of its text, so that the rounds together visit every position once: each round
every task improves the shared parameters on its own part in numpy, and the parameters are averaged over tasks, weighted
by positions, slice by slice in two steps. What is gathered grows with the corpus; what reaches the driver is the units
and one set of parameters.

Edge cases: a null text or one without words has no words, a sum of 0 and a null mean; an empty corpus has bytes as its
only units, all alike; repeated rows count and train each; ties in frequency go by the word or the part's bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.llm.words import mixed, release

CLUSTERS, IN_CLUSTER, HIDDEN = 64, 64, 16
#: Units. One more row stands for the text's edge.
CLASSES = CLUSTERS * IN_CLUSTER
EDGE = CLASSES
#: Units that are whole words, and units that are parts of other words, of so many bytes; the rest are the 256 bytes.
WHOLE, LONGEST = 2048, 6
PARTS = CLASSES - 256 - WHOLE
AROUND = (-2, -1, 1, 2)
#: Passes over the corpus, which share its positions; positions in a step; step size.
ROUNDS, STEP, RATE = 2, 8192, 0.2
#: A row that adds up the columns of a matrix.
ONES = np.ones(max(CLUSTERS, IN_CLUSTER), np.float32)
#: Positions scored together.
BLOCK = 32_768
#: Sums within it need no care before their exponentials are added.
SAFE = 60.0
#: Columns taken together: so many of 64 numbers stay in the cache through products, exponentials, sums and gradients.
COLUMNS = 480
REMEMBERED, SLICES = 500_000, 32
#: Bytes of text split together: more have fewer different words each.
LOT = 4 << 20
SHAPES = {
    "around": (len(AROUND), CLASSES + 1, HIDDEN), "bias": (HIDDEN,), "cluster": (HIDDEN, CLUSTERS), "cluster_bias": (CLUSTERS,),
    "word": (CLUSTERS, IN_CLUSTER, HIDDEN), "word_bias": (CLUSTERS, IN_CLUSTER),
}


def _exp(x: np.ndarray, most: float) -> np.ndarray:
    """Exponentials in place, of numbers of at most ``most`` in size or, where that is too large, less each column's greatest."""
    if most > SAFE:
        x -= x.max(0)
    return np.exp(x, out=x)


def _softmax(x: np.ndarray, most: float, whole: float = 1.0) -> np.ndarray:
    """Of each column, in place; columns add up to ``whole``."""
    x = _exp(x, most)
    x *= whole / _sums(x)
    return x


def _sums(x: np.ndarray) -> np.ndarray:
    """Of each column."""
    return ONES[: len(x)] @ x


def _log_share(x: np.ndarray, picked: np.ndarray, most: float) -> np.ndarray:
    """Logarithm of the softmax at one row per column; ``x`` is used up."""
    return _log_share_at(x, _cells(picked, np.array([x.shape[1]])), most)


def _log_share_at(x: np.ndarray, cells: np.ndarray, most: float) -> np.ndarray:
    if most > SAFE:
        x -= x.max(0)
    own = x.take(cells)
    np.exp(x, out=x)
    return own - np.log(_sums(x))


def _cells(picked: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where the picked row of each column is, in matrices of so many columns one after the other whose rows lie end to end."""
    ends = np.cumsum(sizes)
    return picked * np.repeat(sizes, sizes) + np.arange(len(picked)) - np.repeat(ends - sizes, sizes)


def _blocks(n: int) -> np.ndarray:
    """Sizes of blocks of columns."""
    return np.diff(np.append(np.arange(0, n, COLUMNS), n))


def _bounds(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The greatest size of any sum of a row of weights times numbers from -1 to 1, and its bias."""
    return (np.abs(weights) @ np.ones(weights.shape[-1], weights.dtype) + np.abs(bias)).max(-1)


def _times(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """``a @ x`` by blocks of columns, each small enough for the cache."""
    if x.shape[1] <= COLUMNS:
        return a @ x
    out = np.empty((len(a), x.shape[1]), np.result_type(a, x))
    for i in range(0, x.shape[1], COLUMNS):
        out[:, i : i + COLUMNS] = a @ x[:, i : i + COLUMNS]
    return out


def _against(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x @ y.T`` by blocks of columns."""
    if x.shape[1] <= COLUMNS:
        return x @ y.T
    out = x[:, :COLUMNS] @ y[:, :COLUMNS].T
    for i in range(COLUMNS, x.shape[1], COLUMNS):
        out += x[:, i : i + COLUMNS] @ y[:, i : i + COLUMNS].T
    return out


def _apart(rows: int, columns: int, dtype: np.dtype) -> np.ndarray:
    """An empty matrix whose rows do not begin at the same place of a page each, where they would fight for the cache."""
    return np.empty((rows, columns + 16 + -columns % 64), dtype)[:, :columns]


def _with_bias(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Rows of weights, each with its bias behind it."""
    return np.concatenate([weights, bias[..., None]], -1)


def _pull(rows: np.ndarray, back: np.ndarray, x: np.ndarray, cells: np.ndarray, most: float, each: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``each`` times the sum of the columns' negative log-shares at ``cells``: by the rows, and by ``x`` without
    the ones below it, for which ``back`` has the rows' weights as columns."""
    d = _softmax(_times(rows, x), most, each)
    d.reshape(-1)[cells] -= each
    return _against(d, x), _times(back, d)


def _by_row(near: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that occur in ``near``, and for each the sum of its columns of ``back``."""
    seen = np.bincount(near)
    rows = np.flatnonzero(seen)
    seen[rows] = np.arange(len(rows))
    at = seen.take(near)
    return rows, np.array([np.bincount(at, x, len(rows)) for x in back]).T


def _split(texts: list[str | None]) -> tuple[pa.StringArray, np.ndarray]:
    """Words of all texts end to end, A-Z in lower case, and how many each text has."""
    words = pc.ascii_split_whitespace(pa.array([(x or "").encode().lower() for x in texts], pa.string()))
    flat, ends = words.flatten(), words.offsets.to_numpy()
    counts = np.diff(ends).astype(np.int64)
    # beside white space at either end of a text
    void = np.flatnonzero(pc.equal(flat, "").to_numpy(zero_copy_only=False))
    if len(void):
        counts -= np.bincount(np.searchsorted(ends, void, "right") - 1, minlength=len(counts))
        flat = flat.filter(pc.not_equal(flat, ""))
    return flat, counts


def _lots(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch: each row goes to the part its bytes end in, of ``LOT`` bytes of a column."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    ends = np.flatnonzero(np.diff(upto // LOT, append=-1)) + 1
    for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False):
        yield batch.slice(a, b - a)


class Model:
    def __init__(self, vocabulary: list[bytes], spelling: np.ndarray, weights: dict[str, np.ndarray]):
        """``vocabulary``: units of two bytes and more; every byte is one besides. ``spelling``: logarithm of the frequency
        of each byte, and of the end of a word; scores do not use it."""
        self.vocabulary, self.spelling, self.weights = vocabulary, spelling, weights
        # ranks are dealt over the clusters, so that all are about equally frequent
        self.ids = {w: (k % CLUSTERS) * IN_CLUSTER + k // CLUSTERS for k, w in enumerate([*vocabulary, *(bytes([b]) for b in range(256))])}
        # a space is only in front, so beyond it only shorter units can match
        self.longest = max(map(len, self.ids))
        self.inner = max(len(w) for w in self.ids if not w.startswith(b" "))
        self.finder = None
        self._forget()

    def _forget(self) -> None:
        self.place, self.units, self.first, self.size = {}, np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def cut(self, word: bytes) -> list[int]:
        """Units of a word with a space in front."""
        marked = b" " + word
        one = self.ids.get(marked)
        if one is not None:
            return [one]
        out, at, get, longest = [], 0, self.ids.get, self.longest
        while at < len(marked):
            for size in range(min(longest, len(marked) - at), 0, -1):
                one = get(marked[at : at + size])
                if one is not None:
                    break
            out.append(one)
            at += size
            longest = self.inner
        return out

    def cut_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Units of many words end to end, as :func:`cut` gives them, and how many each has.

        Every byte is a unit and no unit goes on beyond a space, so the leftmost longest matches in the words end to end,
        each with a space in front, are those of the words.
        """
        if self.finder is None:
            import ahocorasick

            self.finder, self.opens = ahocorasick.Automaton(), np.zeros(CLASSES, bool)
            for unit, one in self.ids.items():
                self.finder.add_word(unit.decode("latin-1"), one)
                self.opens[one] = unit.startswith(b" ")
            self.finder.make_automaton()
        text = b"".join([b" " + w for w in words]).decode("latin-1")
        units = np.array([one for _, one in self.finder.iter_long(text)], np.int64)
        first = np.flatnonzero(self.opens[units])
        return units, np.diff(np.append(first, len(units)))

    def _learn(self, new: list[bytes]) -> None:
        units, sizes = self.cut_all(new)
        self.place.update(zip(new, range(len(self.size), len(self.size) + len(new)), strict=True))
        self.first = np.concatenate([self.first, len(self.units) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.units = np.concatenate([self.units, units.astype(np.uint16)])

    def units_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units of all words end to end, and the numbers of words and of units of each text."""
        if len(self.place) > REMEMBERED:
            self._forget()
        words, counts = _split(texts)
        words = words.dictionary_encode()
        distinct = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        places = [*map(self.place.get, distinct.tolist())]
        if None in places:
            places = np.array([-1 if x is None else x for x in places])
            new = np.flatnonzero(places < 0)
            places[new] = len(self.size) + np.arange(len(new))
            self._learn(distinct[new].tolist())
        at = np.asarray(places, np.int64).take(words.indices.to_numpy())
        sizes = self.size.take(at)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        units = self.units.take(np.repeat(self.first.take(at) - ends[:-1], sizes) + np.arange(ends[-1]))
        upto = ends[np.concatenate([[0], np.cumsum(counts)])]
        return units, counts, np.diff(upto)

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units end to end, what each adds beyond the network (nothing), and the number of units of each text."""
        units, _, counts = self.units_of(texts)
        return units, np.zeros(len(units)), counts

    @staticmethod
    def context(words: np.ndarray, counts: np.ndarray, some: np.ndarray | None = None) -> np.ndarray:
        """The classes around each word, or around some, place by word; beyond a text's ends is the edge."""
        wide = max(map(abs, AROUND))
        shift = np.repeat(np.arange(len(counts)), counts) * wide + wide
        at = np.arange(len(words)) + shift
        padded = np.full(len(words) + wide * (len(counts) + 1), EDGE, np.uint16)
        padded[at] = words
        if some is not None:
            at = at[some]
        return np.stack([padded.take(at + o) for o in AROUND])

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """What the network makes of each context, column by column, and a row of ones below it for the biases."""
        w = self.weights
        total = w["around"][0].take(context[0], axis=0)
        for k in range(1, len(AROUND)):
            total += w["around"][k].take(context[k], axis=0)
        out = _apart(HIDDEN + 1, len(total), total.dtype)
        out[-1] = 1
        np.add(total.T, w["bias"][:, None], out=out[:-1])
        np.tanh(out[:-1], out=out[:-1])
        return out

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights and biases of the clusters, and of the units of each cluster."""
        w = self.weights
        return _with_bias(w["cluster"].T, w["cluster_bias"]), _with_bias(w["word"], w["word_bias"])

    def bounds(self) -> tuple[float, list[float]]:
        """Of the logits of the clusters, and of the units of each cluster."""
        w = self.weights
        return float(_bounds(w["cluster"].T, w["cluster_bias"])), _bounds(w["word"], w["word_bias"]).tolist()

    def log_probabilities(self, words: np.ndarray, context: np.ndarray) -> np.ndarray:
        out = np.empty(len(words), np.float64)
        clusters, units = self.rows()
        first, second = self.bounds()
        for i in range(0, len(words), BLOCK):
            order = np.argsort(words[i : i + BLOCK].astype(np.uint16), kind="stable")
            these = words[i : i + BLOCK][order]
            cluster, inner = these // IN_CLUSTER, these % IN_CLUSTER
            x = self.hidden(context[:, i : i + BLOCK].take(order, axis=1).astype(np.intp))
            part = np.empty(len(these), np.float64)
            cells = _cells(cluster, _blocks(len(these)))
            for a in range(0, len(these), COLUMNS):
                some = slice(a, a + COLUMNS)
                part[some] = _log_share_at(clusters @ x[:, some], cells[some], first)
            ends = np.searchsorted(cluster, np.arange(CLUSTERS + 1, dtype=cluster.dtype))
            cells, ends = _cells(inner, np.diff(ends)), ends.tolist()
            for c, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                if a < b:
                    part[a:b] += _log_share_at(_times(units[c], x[:, a:b]), cells[a:b], second[c])
            out[i + order] = part
        return out

    def slopes(self, words: np.ndarray, context: np.ndarray) -> tuple[dict[str, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
        """Gradients of the mean negative log-probability; those of the tables around place by place, for the rows that occur."""
        n = len(words)
        order = np.argsort(words.astype(np.uint16), kind="stable")
        words = words[order]
        context = context.take(order, axis=1).astype(np.intp)
        cluster, inner = words // IN_CLUSTER, words % IN_CLUSTER
        x = self.hidden(context)
        clusters, units = self.rows()
        first, second = self.bounds()
        top, under, back = np.zeros_like(clusters), np.zeros_like(units), _apart(HIDDEN, n, x.dtype)
        down, cells = self.weights["cluster"], _cells(cluster, _blocks(n))
        for a in range(0, n, COLUMNS):
            some = slice(a, a + COLUMNS)
            more, back[:, some] = _pull(clusters, down, x[:, some], cells[some], first, 1 / n)
            top += more
        down = np.ascontiguousarray(self.weights["word"].transpose(0, 2, 1))
        ends = np.searchsorted(cluster, np.arange(CLUSTERS + 1, dtype=cluster.dtype))
        cells, ends = _cells(inner, np.diff(ends)), ends.tolist()
        for c, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            if a < b:
                under[c], more = _pull(units[c], down[c], x[:, a:b], cells[a:b], second[c], 1 / n)
                back[:, a:b] += more
        back *= 1 - x[:-1] * x[:-1]
        whole = {"bias": back.sum(1), "cluster": top[:, :-1].T, "cluster_bias": top[:, -1], "word": under[..., :-1].copy(), "word_bias": under[..., -1]}
        back = back.astype(np.float64)
        return whole, [_by_row(near, back) for near in context]

    def gradients(self, words: np.ndarray, context: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability."""
        out, around = self.slopes(words, context)
        out["around"] = np.zeros_like(self.weights["around"])
        for k, (rows, g) in enumerate(around):
            out["around"][k][rows] = g
        return out


class Trainer:
    """Steps of one task from the shared parameters; each parameter's step shrinks with its gradients so far."""

    def __init__(self, model: Model):
        self.model, self.seen = model, 0
        self.squares = {k: np.full_like(v, 1e-8) for k, v in model.weights.items()}

    def step(self, words: np.ndarray, context: np.ndarray) -> None:
        self.seen += len(words)
        weights, squares = self.model.weights, self.squares
        whole, around = self.model.slopes(words, context)
        for k, g in whole.items():
            squares[k] += g * g
            weights[k] -= RATE * g / np.sqrt(squares[k])
        # rows that do not occur have no gradients and stay as they are
        for w, square, (rows, g) in zip(weights["around"], squares["around"], around, strict=True):
            g = g.astype(w.dtype, "C")
            sums = square.take(rows, axis=0)
            sums += g * g
            square[rows] = sums
            g *= RATE
            g /= np.sqrt(sums, out=sums)
            w[rows] = np.subtract(w.take(rows, axis=0), g, out=g)


def masked(seeds: np.ndarray, counts: np.ndarray, round_number: int, rounds: int = ROUNDS) -> np.ndarray:
    """Positions to train on in a round: each is in one round, by a hash of the text and the position."""
    within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.flatnonzero(mixed(np.repeat(mixed(seeds), counts) + within.astype(np.uint64)) % np.uint64(rounds) == round_number)


def _flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def _unflat(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = math.prod(shape)
        out[k] = flat[at : at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n`` over all documents; A-Z in lower case. Tasks add up what they see before it is shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def together(some: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(some).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        def told(seen: pa.Table) -> Iterator[pa.RecordBatch]:
            return iter(seen.cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches())

        seen, rows = [], 0
        for batch in batches:
            for part in _lots(batch, 0):
                found = _split(part.column(0).to_pylist())[0].value_counts()
                seen.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
                rows += len(found)
                if rows > 2 * REMEMBERED:
                    seen = [together(seen)]
                    rows = len(seen[0])
                    if rows > REMEMBERED // 2:
                        yield from told(seen[0])
                        seen, rows = [], 0
        if seen:
            yield from told(together(seen))

    return docs.select(text).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def part_counts(counts: DataFrame) -> DataFrame:
    """``part, gain``: runs of 2 to ``LONGEST`` bytes in words with a space in front, and the bytes but the first that all save.

    A part is a number: its bytes, and above them its length.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = [b" " + w.encode() for w in batch.column(0).to_pylist()]
            sizes = np.fromiter(map(len, marked), np.int64, len(marked))
            flat = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
            n = np.repeat(batch.column(1).to_numpy(), sizes)
            left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))
            value = flat
            for size in range(2, LONGEST + 1):
                value = (value[: max(0, len(flat) - size + 1)] << np.uint64(8)) | flat[size - 1 :]
                inner = np.flatnonzero(left[: len(value)] >= size)
                found, back = np.unique(value[inner], return_inverse=True)
                gain = np.bincount(back, n[inner], len(found)).astype(np.int64) * (size - 1)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64) + (size << 48)), pa.array(gain)], names=["part", "gain"])

    return counts.select("word", "n").mapInArrow(run, "part bigint, gain bigint").groupBy("part").agg(F.sum("gain").alias("gain"))


def start(docs: DataFrame, text: str = "text", seed: int = 11) -> Model:
    """Units and a network that predicts by their frequency alone."""
    from phenoloom.llm.frames import stored

    counts = stored(word_counts(docs, text))
    rows = counts.orderBy(F.desc("n"), "word").limit(WHOLE).collect()  # a fixed number of words
    last = rows[-1] if rows else {"n": 0, "word": ""}
    others = counts.where((F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("word") > last["word"])))
    parts = part_counts(others).orderBy(F.desc("gain"), "part").limit(PARTS).collect()  # a fixed number of parts
    raw = [(r["part"] & ((1 << 48) - 1)).to_bytes(r["part"] >> 48, "big") for r in parts]
    vocabulary = list(dict.fromkeys([*(b" " + r["word"].encode() for r in rows), *raw]))
    cutter = Model(vocabulary, np.zeros(257), {})
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def use(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, sums, spelt = Model(shipped.value, np.zeros(257), {}), np.zeros(CLASSES, np.int64), np.zeros(257, np.int64)
        for batch in batches:
            words, n = [w.encode() for w in batch.column(0).to_pylist()], batch.column(1).to_numpy()
            units, sizes = mine.cut_all(words)
            sums += np.bincount(units, np.repeat(n, sizes), CLASSES).astype(np.int64)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            spelt += np.bincount(np.frombuffer(b"".join(words), np.uint8), np.repeat(n, lengths), 257).astype(np.int64)
            spelt[256] += n.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES + 257)), pa.array(np.concatenate([sums, spelt]))], names=["unit", "n"])

    used = counts.mapInArrow(use, "unit bigint, n bigint").groupBy("unit").agg(F.sum("n").alias("n")).collect()  # a row per unit and byte
    share, freq = np.full(CLASSES, 0.5), np.ones(257)
    for r in used:
        if r["unit"] < CLASSES:
            share[r["unit"]] += r["n"]
        else:
            freq[r["unit"] - CLASSES] += r["n"]
    draw = np.random.default_rng(seed)
    weights = {k: draw.normal(0, 0.1, s).astype(np.float32) if k in ("around", "cluster", "word") else np.zeros(s, np.float32) for k, s in SHAPES.items()}
    grid = share.reshape(CLUSTERS, IN_CLUSTER)
    weights["cluster_bias"][:] = np.log(grid.sum(1) / share.sum())
    weights["word_bias"][:] = np.log(grid / grid.sum(1, keepdims=True))
    return Model(cutter.vocabulary, np.log(freq / freq.sum()), weights)


def read_words(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, words, seed``: the units of all words as bytes, a hash of the text.

    Stored, it lets every round and the scores read two bytes a unit instead of the text.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.spelling))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Model(*shipped.value, {})
        for batch in batches:
            for part in _lots(batch, 1):
                texts = part.column(1).to_pylist()
                units, words, counts = mine.units_of(texts)
                ends = 2 * np.cumsum(counts)
                raw = units.astype("<u2").tobytes()
                lists = [raw[a:b] for a, b in zip((ends - 2 * counts).tolist(), ends.tolist(), strict=True)]
                seeds = np.array([xxhash.xxh3_64_intdigest(x or "") for x in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words), pa.array(lists, pa.binary()), pa.array(seeds)], names=[key, "n_words", "words", "seed"])
        del mine
        release()

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_words bigint, words binary, seed bigint")


def _parts(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Small parts of batches of read words, with the units end to end and the number of units of each text."""
    for batch in batches:
        for part in (batch.slice(i, rows) for i in range(0, batch.num_rows, rows)):
            raw = part.column("words").to_pylist()
            yield part, np.frombuffer(b"".join(raw), "<u2"), np.fromiter(map(len, raw), np.int64, len(raw)) // 2


def improve(read: DataFrame, model: Model, round_number: int, rounds: int = ROUNDS) -> Model:
    """One round over all read texts: train in each task on its positions of the round, average the parameters."""
    shipped = read.sparkSession.sparkContext.broadcast(model.weights)
    rows = read.select("words", "seed")

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Model([], np.zeros(257), {k: v.copy() for k, v in shipped.value.items()})
        trainer, kept_words, kept_context = Trainer(mine), [], []
        waiting = 0

        def work(everything: bool) -> int:
            words, context = np.concatenate(kept_words), np.concatenate(kept_context, 1)
            upto = len(words) if everything else len(words) // STEP * STEP
            for i in range(0, upto, STEP):
                trainer.step(words[i : min(i + STEP, upto)], context[:, i : min(i + STEP, upto)])
            kept_words[:], kept_context[:] = [words[upto:]], [context[:, upto:]]
            return len(words) - upto

        for part, words, counts in _parts(batches, 500):
            some = masked(part.column("seed").to_numpy().view(np.uint64), counts, round_number, rounds)
            kept_words.append(words[some])
            kept_context.append(mine.context(words, counts, some))
            waiting += len(some)
            if waiting >= 8 * STEP:
                waiting = work(False)
        if waiting:
            work(True)
        if trainer.seen:
            flat = _flat(mine.weights).astype(np.float64) * trainer.seen
            parts = [x.astype(np.float32).tobytes() for x in np.array_split(flat, SLICES)]
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(SLICES)), pa.array([task] * SLICES, pa.int64()), pa.array([trainer.seen] * SLICES, pa.int64()), pa.array(parts, pa.binary())], names=["slice", "task", "n", "v"]
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(0, np.float64)
        for raw in table.column("v"):
            one = np.frombuffer(raw.as_py(), np.float32).astype(np.float64)
            total = one if not len(total) else total + one
        n = int(np.sum(table.column("n").to_numpy()))
        return pa.table({"slice": [table.column("slice")[0].as_py()], "n": [n], "v": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    lots = math.isqrt(rows.rdd.getNumPartitions()) + 1
    out = rows.mapInArrow(train, "slice bigint, task bigint, n bigint, v binary").withColumn("lot", F.col("task") % lots)
    first = out.groupBy("slice", "lot").applyInArrow(add, "slice bigint, n bigint, v binary")
    sums = first.groupBy("slice").applyInArrow(add, "slice bigint, n bigint, v binary").orderBy("slice").collect()  # one set of parameters
    if not sums:
        return model
    flat = np.concatenate([np.frombuffer(r["v"], np.float32).astype(np.float64) / r["n"] for r in sums])
    return Model(model.vocabulary, model.spelling, _unflat(flat))


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> Model:
    from phenoloom.llm.frames import stored

    model = start(docs, text)
    read = stored(read_words(docs.withColumn("_one", F.lit(0)), model, "_one", text))
    for k in range(rounds):
        model = improve(read, model, k, rounds)
    return model


def score_read(read: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key, n_words, log_prob, mean_log_prob``: sums over every unit of every text, and their mean by word."""
    shipped = read.sparkSession.sparkContext.broadcast(model.weights)
    kind = read.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Model([], np.zeros(257), shipped.value)
        for part, words, counts in _parts(batches, 250):
            each = mine.log_probabilities(words, mine.context(words, counts))
            sums = np.bincount(np.repeat(np.arange(len(counts)), counts), each, len(counts)).astype(np.float64)
            n = part.column("n_words").to_numpy()
            mean = pa.array(sums / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(sums), mean], names=[key, "n_words", "log_prob", "mean_log_prob"])

    return read.select(key, "n_words", "words").mapInArrow(run, f"`{key}` {kind}, n_words bigint, log_prob double, mean_log_prob double")


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    return score_read(read_words(docs, model, key, text), model, key)


def train_and_score(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Train on all documents and score them; their words are read once."""
    from phenoloom.llm.frames import stored

    model = start(docs, text)
    read = stored(read_words(docs, model, key, text))
    for k in range(rounds):
        model = improve(read, model, k, rounds)
    return score_read(read, model, key)
