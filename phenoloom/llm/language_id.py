"""Language identification by a bidirectional gated recurrent network over bytes.

Two recurrent layers read the bytes of a word from either side and label every byte position with a probability for each
language; a document's probabilities are the mean over all its positions. The state starts anew at white space and after
``LONGEST`` bytes, so equal words have equal labels, and a task runs the network once for each distinct word that it
remembers. Letters A-Z are lower-cased first.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled texts, chosen by a hash
of the text and so alike for every partitioning. Edge cases: a text that is null or has no letter is ``und`` with score
0; ties go to the first language in order; without any labelled text every text is ``und``; repeated texts train once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.llm.words import release

#: Bounds of the training sample: distinct texts, and distinct words of those with their language.
SAMPLE_TEXTS, SAMPLE_WORDS = 4000, 30_000
HIDDEN, LONGEST, EPOCHS, BATCH, RATE = 12, 24, 8, 512, 0.01
#: Words that a task remembers, and words run through the network at once.
REMEMBERED, AT_ONCE = 250_000, 4096
NO_LANGUAGE = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Gru:
    """One direction. ``table`` holds the input part of the three gates for each byte, ``state`` the recurrent part."""

    def __init__(self, table: np.ndarray, state: np.ndarray):
        self.table, self.state = table, state

    def forward(self, steps: np.ndarray, alive: np.ndarray, keep: bool = False):
        """``steps``: bytes, time by word; ``alive``: whether the word has that byte. States after each step."""
        h = np.zeros((steps.shape[1], HIDDEN), np.float32)
        out, tape = np.empty((*steps.shape, HIDDEN), np.float32), []
        for t in range(len(steps)):
            given, back = self.table[steps[t]], h @ self.state
            gates = _sigmoid(given[:, : 2 * HIDDEN] + back[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = np.tanh(given[:, 2 * HIDDEN :] + r * back[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            new = np.where(alive[t][:, None], new, h)
            if keep:
                tape.append((h, z, r, n, back[:, 2 * HIDDEN :]))
            h = out[t] = new
        return out, tape

    def backward(self, steps: np.ndarray, alive: np.ndarray, tape: list, above: np.ndarray):
        """Gradients of ``table`` and ``state``, given those of the states."""
        d_table, d_state = np.zeros_like(self.table), np.zeros_like(self.state)
        carry = np.zeros((steps.shape[1], HIDDEN), np.float32)
        for t in reversed(range(len(steps))):
            h, z, r, n, back = tape[t]
            d = carry + above[t]
            live = alive[t][:, None]
            dn = np.where(live, d * (1 - z) * (1 - n * n), 0)
            dz = np.where(live, d * (h - n) * z * (1 - z), 0)
            dr = dn * back * r * (1 - r)
            d_given = np.concatenate([dz, dr, dn], 1)
            d_back = np.concatenate([dz, dr, dn * r], 1)
            np.add.at(d_table, steps[t], d_given)
            d_state += h.T @ d_back
            carry = np.where(live, d * z, d) + d_back @ self.state.T
        return d_table, d_state


def lay_out(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes forwards, bytes backwards, and which positions exist, time by word; words end at ``LONGEST`` bytes."""
    lengths = np.array([len(w) for w in words], np.int64)
    width = int(lengths.max())
    flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    back = np.take_along_axis(flat, np.maximum(lengths[:, None] - 1 - np.arange(width), 0), 1)
    alive = np.arange(width)[:, None] < lengths[None, :]
    return flat.T, back.T, alive


def _flip(states: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Turn what was read backwards into the order of the bytes; its own inverse."""
    lengths = alive.sum(0)
    at = np.maximum(lengths[None, :] - 1 - np.arange(len(states))[:, None], 0)
    return np.take_along_axis(states, at[:, :, None], 0)


class Network:
    def __init__(self, languages: list[str], weights: dict[str, np.ndarray] | None = None, seed: int = 5):
        self.languages = languages
        if weights is None:
            draw = np.random.default_rng(seed)
            k = len(languages)
            weights = {n: draw.normal(0, s, shape).astype(np.float32) for n, s, shape in (
                ("tf", 0.3, (256, 3 * HIDDEN)), ("sf", 0.25, (HIDDEN, 3 * HIDDEN)), ("tb", 0.3, (256, 3 * HIDDEN)),
                ("sb", 0.25, (HIDDEN, 3 * HIDDEN)), ("w", 0.3, (2 * HIDDEN, k)), ("c", 0.0, (k,)))}
        self.weights = weights

    def run(self, words: list[bytes], keep: bool = False):
        """Probabilities, time by word by language, and whether the position exists."""
        w = self.weights
        ahead, back, alive = lay_out(words)
        f, tape_f = Gru(w["tf"], w["sf"]).forward(ahead, alive, keep)
        b, tape_b = Gru(w["tb"], w["sb"]).forward(back, alive, keep)
        both = np.concatenate([f, _flip(b, alive)], 2)
        raw = both @ w["w"] + w["c"]
        raw -= raw.max(2, keepdims=True)
        p = np.exp(raw)
        p /= p.sum(2, keepdims=True)
        return p, alive, (ahead, back, tape_f, tape_b, both)

    def gradients(self, words: list[bytes], targets: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        p, alive, (ahead, back, tape_f, tape_b, both) = self.run(words, keep=True)
        d = p.copy()
        d[:, np.arange(len(words)), targets] -= 1
        d *= (alive * weight[None, :] / max(1e-9, float((alive * weight[None, :]).sum())))[:, :, None].astype(np.float32)
        d_both = d @ w["w"].T
        d_b = _flip(d_both[:, :, HIDDEN:], alive) * alive[:, :, None]
        out = {"w": np.tensordot(both, d, ([0, 1], [0, 1])), "c": d.sum((0, 1))}
        out["tf"], out["sf"] = Gru(w["tf"], w["sf"]).backward(ahead, alive, tape_f, d_both[:, :, :HIDDEN])
        out["tb"], out["sb"] = Gru(w["tb"], w["sb"]).backward(back, alive, tape_b, d_b)
        return out

    def train(self, words: list[bytes], targets: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        draw, step = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        total = max(1, epochs * -(-len(words) // BATCH))
        for _ in range(epochs):
            order = draw.permutation(len(words))
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                step += 1
                rate = RATE * (1 - (step - 1) / total) + 1e-4
                for k, g in self.gradients([words[j] for j in some], targets[some], weight[some]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    size = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
                    self.weights[k] = (self.weights[k] - size).astype(np.float32)


def cut(word: bytes) -> list[bytes]:
    return [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)]


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", texts: int = SAMPLE_TEXTS, words: int = SAMPLE_WORDS) -> Network:
    """Train on at most ``texts`` distinct texts and ``words`` of their (word, language) pairs, both in hash order."""
    known = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("x"), F.col(lang).cast("string").alias("l"), F.xxhash64(text).alias("h"))
    chosen = known.groupBy("h").agg(F.min("l").alias("l")).orderBy(F.xxhash64("h", F.lit(1)), "h").limit(texts)
    sample = known.select("x", "h").join(F.broadcast(chosen), "h").dropDuplicates(["h"])
    lower = F.translate("x", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    pairs = sample.select("l", F.explode(F.split(lower, r"[ \t\n\x0B\f\r]+")).alias("w")).where("w <> ''").groupBy("l", "w").agg(F.count("*").alias("n"))
    rows = pairs.orderBy(F.xxhash64("w", "l"), "w", "l").limit(words).collect()
    languages = sorted({r["l"] for r in rows})
    parts = [(p, languages.index(r["l"]), r["n"]) for r in rows for p in cut(r["w"].encode())]
    network = Network(languages)
    if len(languages) > 1:
        network.train([p for p, _, _ in parts], np.array([k for _, k, _ in parts]), np.sqrt(np.array([n for _, _, n in parts], np.float64)))
    return network


class WordLabels:
    """For each remembered word its number of positions and the sum of their probabilities."""

    def __init__(self, network: Network):
        self.network = network
        self.forget()

    def forget(self) -> None:
        self.place, self.sums = {}, np.zeros((0, len(self.network.languages)), np.float32)

    def _sums(self, pieces: list[bytes]) -> np.ndarray:
        out = np.empty((len(pieces), len(self.network.languages)), np.float32)
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        for i in range(0, len(order), AT_ONCE):
            some = order[i : i + AT_ONCE]
            p, alive, _ = self.network.run([pieces[j] for j in some])
            out[some] = (p * alive[:, :, None]).sum(0)
        return out

    def learn(self, words: list[bytes]) -> None:
        pieces = [cut(w) for w in words]
        many = np.array([len(x) for x in pieces])
        sums = np.add.reduceat(self._sums([p for x in pieces for p in x]), np.cumsum(many) - many, axis=0)
        self.place.update(zip(words, range(len(self.sums), len(self.sums) + len(words)), strict=True))
        self.sums = np.concatenate([self.sums, sums])

    def documents(self, texts: list[str | None]) -> np.ndarray:
        """Sum of probabilities over all positions of each text."""
        if len(self.place) > REMEMBERED:
            self.forget()
        words, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            mine = (text or "").encode().lower().split()
            counts[i] = len(mine)
            words += mine
        if new := set(words).difference(self.place):
            self.learn(list(new))
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        out = np.zeros((len(texts), self.sums.shape[1]))
        full = np.flatnonzero(counts)
        if len(full):
            out[full] = np.add.reduceat(self.sums[at], (np.cumsum(counts) - counts)[full], axis=0, dtype=np.float64)
        return out


def predict(docs: DataFrame, network: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score``: the language with the highest mean probability, and that mean."""
    shipped = docs.sparkSession.sparkContext.broadcast((network.languages, network.weights))
    kind = docs.schema[key].dataType.simpleString()

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, weights = shipped.value
        labels = WordLabels(Network(languages, weights)) if languages else None
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                texts = part.column(1).to_pylist()
                names, scores = [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
                if labels is not None:
                    sums = labels.documents(texts)
                    mean = sums / np.maximum(sums.sum(1, keepdims=True), 1e-12)
                    best = mean.argmax(1)
                    for i, x in enumerate(texts):
                        if x and any(map(str.isalpha, x)):
                            names[i], scores[i] = languages[best[i]], min(1.0, float(mean[i, best[i]]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores)], names=[key, "lang_pred", "score"])
        del labels
        release()

    return docs.select(key, text).mapInArrow(label, f"`{key}` {kind}, lang_pred string, score double")
