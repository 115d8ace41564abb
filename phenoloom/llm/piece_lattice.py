"""SentencePiece encoding and decoding as a relational lattice.

A text is normalised as the model says: spaces become U+2581, and one is put in front. It is cut into words before every
run of U+2581, after a letter that no letter or number follows, and around line breaks and tabs. No piece crosses such a
place, so each distinct word is segmented once. All its substrings up to the longest piece are equi-joined to the piece
table, whose size is fixed; a character without a piece of its own gets the unknown edge. The edges of a word are
gathered, sorted, and folded by ``aggregate`` into the best score and last edge of every position; a second fold reads
the segmentation off backwards. Unknown characters become byte pieces.

The segmentation has the highest sum of piece scores, among equals the one whose last piece is longest, which is the
meaning of a unigram model. A model trained by merges means something else by its scores: the best adjacent pair is
merged until none is a piece. For such models :func:`merge` folds the same edges that way.

Whole documents go through the same lattice in their tasks: the distinct words of some texts at a time, their substrings
looked up in the piece table size by size as long as a piece begins with them, and all words folded together, a position
or a merge of each per step. So no occurrence of a word is shuffled, and words of any length are kept whole.

:func:`words_of` cuts runs beyond the lengths below where they stand. Edge cases: null and empty texts have no words and
no ids; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.llm.frames import stored
from phenoloom.llm.words import release

SPACE = "▁"
#: Most leading spaces, characters of a run, runs before the last letters, and last letters of a word.
SPACES, RUN, RUNS, LETTERS = 32, 32, 40, 96
#: A word is its spaces, then anything up to the last letter before something that is neither letter nor number: no piece
#: goes on there. Line breaks and tabs, which no piece holds, stand alone.
WORD = (
    rf"[\n\t]|{SPACE}{{0,{SPACES}}}(?:[^{SPACE}\n\t\p{{L}}]{{1,{RUN}}}|\p{{L}}{{1,{RUN}}}(?=\p{{N}})){{0,{RUNS}}}\p{{L}}{{0,{LETTERS}}}"
)


#: Texts, in characters, whose distinct words are told apart at once; characters of words segmented at once.
TEXTS_AT_ONCE, WORDS_AT_ONCE = 500_000, 100_000
#: Rows spelt at once.
ROWS_AT_ONCE = 500
#: Words up to so long are merged side by side, a pair of each per step; longer ones with a heap of their pairs.
SIDE_BY_SIDE = 64
_CODES = 21  # bits of a code point


@dataclass
class Pieces:
    """``table``: ``piece, id, score`` of ordinary pieces, ``ordinary`` the same as a list. ``spelt``: all pieces as UTF-8 bytes."""

    table: DataFrame
    ordinary: list[tuple[str, int, float]]
    spelt: list[bytes]
    longest: int
    unknown: int
    unknown_score: float
    first_byte: int


def pieces(spark: SparkSession, model_file: str) -> Pieces:
    """Read the piece table of a model; its size is that of the vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(model.get_piece_size())
    ordinary = [i for i in ids if not (model.is_byte(i) or model.is_unknown(i) or model.is_control(i) or model.is_unused(i))]
    names = {i: model.id_to_piece(i) for i in ids}
    for name in map(names.get, ordinary):
        inner = name.lstrip(SPACE)
        if set(inner) & {SPACE, "\n", "\t"} or any(a.isalpha() and not b.isalnum() for a, b in zip(inner, inner[1:], strict=False)):
            raise ValueError(f"{name!r} crosses a place where words are cut")
    byte_ids = [i for i in ids if model.is_byte(i)]
    if [names[i] for i in byte_ids] != [f"<0x{b:02X}>" for b in range(256)] or byte_ids[-1] - byte_ids[0] != 255:
        raise ValueError("byte pieces must be complete and in order")
    scores = {i: float(model.get_score(i)) for i in ordinary}
    listed = [(names[i], i, scores[i]) for i in ordinary]
    table = spark.createDataFrame(listed, "piece string, id int, score double")
    spelt = [bytes([i - byte_ids[0]]) if model.is_byte(i) else names[i].encode() if i in scores else b"" for i in ids]
    return Pieces(table, listed, spelt, max(len(names[i]) for i in ordinary), model.unk_id(), min(scores.values()) - 10.0, byte_ids[0])


def words_of(text: Column) -> Column:
    """Words of a text, in order."""
    marked = F.concat(F.lit(SPACE), F.translate(text, " ", SPACE))
    found = F.filter(F.regexp_extract_all(marked, F.lit(WORD), F.lit(0)), lambda w: w != "")
    return F.when(F.length(text) > 0, found)


def edges(words: DataFrame, model: Pieces) -> DataFrame:
    """``word, start, end, score, id``: substrings that are pieces, and unknown characters. Keeps the partitioning."""
    cut = words.withColumn("start", F.explode(F.sequence(F.lit(0), F.length("word") - 1)))
    cut = cut.withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.lit(model.longest), F.length("word") - F.col("start")))))
    cut = cut.withColumn("piece", F.expr("substring(word, start + 1, size)"))
    found = cut.join(F.broadcast(model.table), "piece", "left").where(F.col("id").isNotNull() | (F.col("size") == 1))
    return found.withColumn("end", F.col("start") + F.col("size")).withColumn("score", F.coalesce("score", F.lit(model.unknown_score))).withColumn("id", F.coalesce("id", F.lit(model.unknown)))


def fold(lattice: Column, length: Column) -> Column:
    """Best segmentation ``(start, end, id)`` from the edges sorted by end and start.

    The state has the best last edge of every position up to the one before, and of the position now reached; an edge
    that ends one further closes the latter. Every position has an edge that ends there, if only of one character.
    """
    node = "struct<score:double,start:int,id:int>"
    state = f"struct<before:array<{node}>,now:{node},at:int>"
    origin = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"), F.lit(-1).alias("id")).cast(node)
    begin = F.struct(F.array().cast(f"array<{node}>").alias("before"), origin.alias("now"), F.lit(0).alias("at")).cast(state)

    def relax(s: Column, e: Column) -> Column:
        further = e["end"] > s["at"]
        here = F.when(further & (e["start"] == s["at"]), s["now"]["score"]).otherwise(F.get(s["before"], e["start"])["score"])
        new = F.struct((here + e["score"]).alias("score"), e["start"].alias("start"), e["id"].alias("id"))
        closed = F.struct(F.concat(s["before"], F.array(s["now"])).alias("before"), new.alias("now"), e["end"].alias("at"))
        better = F.struct(s["before"].alias("before"), new.alias("now"), s["at"].alias("at"))
        return F.when(further, closed).when(here + e["score"] > s["now"]["score"], better).otherwise(s)

    def back(s: Column) -> Column:
        path = "struct<at:int,done:array<struct<start:int,end:int,id:int>>>"
        first = F.struct(length.alias("at"), F.array().alias("done")).cast(path)

        def step(acc: Column, at: Column) -> Column:
            last = F.when(at == s["at"], s["now"]).otherwise(F.get(s["before"], at))
            one = F.struct(last["start"].alias("start"), at.alias("end"), last["id"].alias("id"))
            return F.when(acc["at"] == at, F.struct(last["start"].alias("at"), F.concat(F.array(one), acc["done"]).alias("done")).cast(path)).otherwise(acc)

        return F.aggregate(F.sequence(length, F.lit(1), F.lit(-1)), first, step, lambda acc: acc["done"])

    return F.aggregate(lattice, begin, relax, back)


def merge(lattice: Column, length: Column) -> Column:
    """Segmentation ``(start, end, id)`` by merging, always the pair with the best score, the first among equals.

    The state is the list of places where pieces meet. An edge can be merged if both its ends are such places and exactly
    one lies between them.
    """
    wide = F.filter(lattice, lambda e: e["end"] - e["start"] > 1)

    def step(state: Column, _: Column) -> Column:
        at, left = state["at"], state["left"]
        place = lambda x: F.array_position(at, x).cast("int")  # noqa: E731  of an end of a piece, from 1; so also the next one, from 0
        fits = F.filter(left, lambda e: (F.get(at, place(e["start"]) + 1) == e["end"]) & (place(e["start"]) > 0))
        best = F.array_max(F.transform(fits, lambda e: F.struct(e["score"].alias("score"), (-e["start"]).alias("minus"))))
        # an array of one element names the best pair, which is then computed once
        cut = F.get(F.transform(F.array(best), lambda b: F.when(b.isNull(), at).otherwise(F.array_remove(at, F.get(at, place(-b["minus"]))))), F.lit(0))
        return F.struct(cut.alias("at"), left.alias("left"))

    def read(state: Column) -> Column:
        at = state["at"]
        return F.filter(lattice, lambda e: F.get(at, F.array_position(at, e["start"]).cast("int")) == e["end"])

    start = F.struct(F.sequence(F.lit(0), length).alias("at"), wide.alias("left"))
    return F.aggregate(F.sequence(F.lit(1), length), start, step, lambda s: F.filter(read(s), lambda e: F.array_contains(s["at"], e["start"])))


def encode_words(words: DataFrame, model: Pieces, merges: bool = False) -> DataFrame:
    """Adds ``ids`` to distinct words (column ``word``; other columns stay), and ``merged_ids`` if asked for."""
    keys = words.columns
    gathered = edges(words, model).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("end", "start", "score", "id"))).alias("lattice"))
    best = gathered.withColumn("path", fold(F.col("lattice"), F.length("word")))
    if merges:
        best = best.withColumn("merged", merge(F.col("lattice"), F.length("word")))

    def ids_of(p: Column) -> Column:
        # two hex digits for each byte of the unknown character
        raw = F.hex(F.encode(F.substring(F.col("word"), p["start"] + 1, p["end"] - p["start"]), "UTF-8"))
        spelt = F.transform(F.sequence(F.lit(1), F.length(raw) - 1, F.lit(2)), lambda i: F.conv(F.substring(raw, i, F.lit(2)), 16, 10).cast("int") + model.first_byte)
        return F.when(p["id"] == model.unknown, spelt).otherwise(F.array(p["id"]))

    more = [F.flatten(F.transform("merged", ids_of)).alias("merged_ids")] if merges else []
    return best.select(*keys, F.flatten(F.transform("path", ids_of)).alias("ids"), *more)


def decode(rows: DataFrame, model: Pieces, keys: list[str], ids: str = "ids") -> DataFrame:
    """``keys, decoded``: the marked text of each row's ids, if there are any; :func:`unmarked` gives the text."""
    shipped = rows.sparkSession.sparkContext.broadcast(model.spelt)

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt = pa.array(shipped.value, pa.large_binary())
        for batch in (whole.slice(i, ROWS_AT_ONCE) for whole in batches for i in range(0, whole.num_rows, ROWS_AT_ONCE)):
            said = batch.column(len(keys))
            each = spelt.take(said.flatten())
            if each.offset or each.null_count:
                raise ValueError("an id is null")
            # the bytes of all pieces lie end to end, so those of a row are a stretch of them
            ends = np.frombuffer(each.buffers()[1], np.int64, len(each) + 1) if len(each) else np.zeros(1, np.int64)
            bounds = np.concatenate([[0], np.cumsum(said.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))])
            offsets = ends[bounds]
            raw = pa.Array.from_buffers(pa.large_binary(), len(said), [None, pa.py_buffer(offsets), each.buffers()[2] or pa.py_buffer(b"")]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], raw], names=[*batch.schema.names[: len(keys)], "raw"])
        release()

    wanted = rows.where(F.size(ids) > 0).select(*keys, F.col(ids).alias("said_ids"))
    types = ", ".join(f"`{k}` {wanted.schema[k].dataType.simpleString()}" for k in keys)
    return wanted.mapInArrow(spell, f"{types}, raw binary").select(*keys, F.decode("raw", "UTF-8").alias("decoded"))


def unmarked(decoded: Column) -> Column:
    """Spaces again, without the one put in front."""
    return F.regexp_replace(F.translate(decoded, SPACE, " "), "^ ", "")


def vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n``: distinct words of all texts with their occurrences."""
    return docs.select(F.explode(words_of(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@cache
def _kinds() -> np.ndarray:
    """By code point: 1 a letter, 2 a number, 0 anything else."""
    return np.fromiter((1 if x.isalpha() else 2 if x.isalnum() else 0 for x in map(chr, range(0x110000))), np.uint8, 0x110000)


def _bytes_of(codes: np.ndarray) -> np.ndarray:
    """How many bytes each code point has in UTF-8."""
    return 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many of each, end to end."""
    upto = np.cumsum(sizes)
    return np.repeat(starts - (upto - sizes), sizes) + np.arange(int(upto[-1]) if len(upto) else 0)


def trie(model: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the pieces' prefixes, as parent and next character in one number, and the piece that each prefix is, or -1.

    Prefix ``n`` is that of edge ``n - 1``; prefix 0 is empty.
    """
    nodes: dict[int, int] = {}
    found = {}
    for name, number, _ in model.ordinary:
        node = 0
        for x in name:
            node = nodes.setdefault((node << _CODES) | ord(x), len(nodes) + 1)
        found[node] = number
    return np.fromiter(nodes, np.int64, len(nodes)), np.array([found.get(n, -1) for n in range(len(nodes) + 1)], np.int32)


class Lattice:
    """The lattice of many words at once: for every place and size the piece that begins there, or -1."""

    def __init__(self, edges: np.ndarray, pieces: np.ndarray, scores: np.ndarray, longest: int, unknown_score: float, first_byte: int):
        """``scores`` by id; its last entry is that of no piece."""
        self.edges, self.pieces, self.scores = pd.Index(edges), pieces, scores
        self.longest, self.unknown_score, self.first_byte = longest, unknown_score, first_byte

    def edges_of(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Words lie end to end and begin at ``starts``."""
        n = len(codes)
        at = np.full((n, self.longest + 1), -1, np.int32)
        left = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n))) - np.arange(n)
        place, node = np.arange(n), np.zeros(n, np.int64)
        for size in range(1, self.longest + 1):
            inside = left[place] >= size
            place, node = place[inside], node[inside]
            node = self.edges.get_indexer((node << _CODES) | codes[place + size - 1]) + 1
            place, node = place[node > 0], node[node > 0]
            at[place, size] = self.pieces[node]
        return at

    def best(self, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Mask of the places where pieces begin, in the segmentation with the highest sum of scores."""
        n = len(at)
        sizes = np.diff(np.append(starts, n))
        # a word has one place more than characters
        own = starts + np.arange(len(starts))
        score, back = np.full(n + len(starts), -np.inf), np.zeros(n + len(starts), np.int64)
        score[own] = 0.0
        begins = np.zeros(n, bool)
        order = np.argsort(-sizes, kind="stable")
        reach = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)))  # words longer than a place
        for p, count in enumerate(reach):
            which = order[:count]
            for size in range(1, self.longest + 1):
                piece = at[starts[which] + p, size]
                gain = self.scores[piece]
                if size == 1:
                    gain = np.where(piece < 0, self.unknown_score, gain)
                to, total = own[which] + p + size, score[own[which] + p] + gain
                fits = (p + size <= sizes[which]) & (gain > -np.inf)
                to, total = to[fits], total[fits]
                better = total > score[to]  # longer pieces came before
                score[to[better]], back[to[better]] = total[better], size
        end, base = own + sizes, np.arange(len(starts))
        while len(end):
            end = end - back[end]
            begins[end - base] = True
            end, base = end[end > own[base]], base[end > own[base]]
        return begins

    def merged(self, at: np.ndarray) -> np.ndarray:
        """Mask of the places where pieces begin, after merging always the best pair of a word, the first among equals."""
        n = len(at)
        where, size = np.nonzero(at[:, 2:] >= 0)
        crossed = np.cumsum(np.bincount(where + 1, minlength=n + 1) - np.bincount(where + size + 2, minlength=n + 1))[:n]
        begins = crossed == 0  # no piece of several characters crosses such a place, so no merge does
        first = np.flatnonzero(begins)
        sizes = np.diff(np.append(first, n))
        for a, length in zip(first[sizes > SIDE_BY_SIDE].tolist(), sizes[sizes > SIDE_BY_SIDE].tolist(), strict=True):
            begins[a : a + length] = self._merged_alone(at[a : a + length])
        some = (sizes > 1) & (sizes <= SIDE_BY_SIDE)
        start = _stretches(first[some], sizes[some])
        end, unit = start + 1, np.repeat(np.arange(int(some.sum())), sizes[some])

        def pairs(i: np.ndarray) -> np.ndarray:
            j = np.minimum(i + 1, len(start) - 1)
            wide = end[j] - start[i]
            fits = (j > i) & (unit[j] == unit[i]) & (wide <= self.longest)
            return np.where(fits, self.scores[at[start[i], np.where(fits, wide, 0)]], -np.inf)

        value = pairs(np.arange(len(start)))
        while len(start):
            heads = np.flatnonzero(np.diff(unit, prepend=-1))
            top = np.repeat(np.maximum.reduceat(value, heads), np.diff(np.append(heads, len(unit))))
            going = top > -np.inf
            begins[start[~going]] = True
            hit = np.flatnonzero(going & (value == top))
            hit = hit[np.diff(unit[hit], prepend=-1) != 0]
            end[hit] = end[hit + 1]
            kept = going.copy()
            kept[hit + 1] = False
            hit = (np.cumsum(kept) - 1)[hit]
            start, end, unit, value = start[kept], end[kept], unit[kept], value[kept]
            changed = np.concatenate([hit, hit[hit > 0] - 1])
            value[changed] = pairs(changed)
        return begins

    def _merged_alone(self, at: np.ndarray) -> np.ndarray:
        """The same for one long word, whose pairs wait in a heap."""
        n = len(at)
        begins = np.ones(n, bool)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def wait(i: int) -> None:
            if after[i] < n and (k := after[after[i]]) - i <= self.longest and (piece := at[i, k - i]) >= 0:
                heapq.heappush(heap, (-self.scores[piece], i, k))

        for i in range(n):
            wait(i)
        while heap:
            _, i, k = heapq.heappop(heap)
            if begins[i] and after[i] < n and after[after[i]] == k:  # else one of the two was merged otherwise
                begins[after[i]] = False
                after[i] = k
                if k < n:
                    before[k] = i
                wait(i)
                if before[i] >= 0:
                    wait(before[i])
        return begins

    def ids(self, codes: np.ndarray, starts: np.ndarray, merges: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that lie end to end, and how many each word has."""
        at = self.edges_of(codes, starts)
        begins = np.flatnonzero(self.merged(at) if merges else self.best(at, starts))
        piece = at[begins, np.diff(np.append(begins, len(codes)))]
        none = piece < 0
        spelt = codes[begins[none]]
        sizes = np.ones(len(piece), np.int64)
        sizes[none] = _bytes_of(spelt)
        out = np.repeat(piece, sizes)
        out[np.repeat(none, sizes)] = np.frombuffer(spelt.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8).astype(np.int32) + self.first_byte
        return out, np.add.reduceat(sizes, np.searchsorted(begins, starts)) if len(starts) else sizes

    def encode(self, texts: list[str | None], merges: bool) -> pa.Array:
        """Per text the ids of each of its words."""
        marked = [SPACE + text.replace(" ", SPACE) if text else "" for text in texts]
        raw = "".join(marked)
        codes = np.frombuffer(raw.encode("utf-32-le"), "<u4")
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))])
        kind, space, alone = _kinds()[codes], codes == ord(SPACE), (codes == 9) | (codes == 10)
        cut = np.zeros(len(codes) + 1, bool)
        cut[1:-1] = (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1] | ((kind[:-1] == 1) & (kind[1:] == 0))
        cut[bounds] = True
        starts = np.flatnonzero(cut[:-1])
        of_text = np.searchsorted(starts, bounds)
        place = np.concatenate([[0], np.cumsum(_bytes_of(codes), dtype=np.int64)])
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(place[np.append(starts, len(codes))]), pa.py_buffer(raw.encode())])
        said = words.dictionary_encode()
        which, sizes = said.indices.to_numpy(), np.diff(np.append(starts, len(codes)))
        seen = np.empty(len(said.dictionary), np.int64)
        seen[which[::-1]] = np.arange(len(which))[::-1]  # one occurrence of each distinct word
        starts, sizes = starts[seen], sizes[seen]
        found, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        part = (np.cumsum(sizes) - sizes) // WORDS_AT_ONCE
        for some in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(part)) + 1) if len(sizes) else []:
            got, many = self.ids(codes[_stretches(starts[some], sizes[some])].astype(np.int64), np.cumsum(sizes[some]) - sizes[some], merges)
            found.append(got)
            counts.append(many)
        found, counts = np.concatenate(found), np.concatenate(counts)
        values = found[_stretches((np.cumsum(counts) - counts)[which], counts[which])]
        inner = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts[which])]), pa.int32()), pa.array(values, pa.int32()))
        return pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), inner)


def word_ids(docs: DataFrame, model: Pieces, key: str = "doc_id", text: str = "text", merges: bool = False) -> DataFrame:
    """``key, words`` per row: the ids of each word of its text. No shuffle."""
    scores = np.full(len(model.spelt) + 1, -np.inf)
    for _, number, score in model.ordinary:
        scores[number] = score
    shipped = docs.sparkSession.sparkContext.broadcast((*trie(model), scores, model.longest, model.unknown_score, model.first_byte))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shipped.value)
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy().astype(np.int64)
            part = (np.cumsum(sizes) - sizes) // TEXTS_AT_ONCE
            for some in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(part)) + 1):
                rows = batch.slice(int(some[0]), len(some)) if len(some) else batch
                yield pa.RecordBatch.from_arrays([rows.column(0), lattice.encode(rows.column(1).to_pylist(), merges)], names=[key, "words"])
        del lattice
        release()

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, words array<array<int>>")


def encode_documents(docs: DataFrame, model: Pieces, key: str = "doc_id", text: str = "text", merges: bool = False) -> DataFrame:
    """``key, ids`` per document. ``key`` is unique; rows that share one have their words put together place by place."""
    said = stored(word_ids(docs, model, key, text, merges))
    again = stored(said.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(F.col(key).alias("again")))
    flat = said.select(key, F.flatten("words").alias("ids"))
    if again.isEmpty():
        return flat
    shared = F.col(key).eqNullSafe(F.col("again"))
    told = said.join(again, shared, "left_semi").select(key, F.posexplode("words").alias("i", "ids"))
    mixed = told.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("i", "ids"))).alias("w")).select(key, F.flatten(F.col("w.ids")).alias("ids"))
    return flat.join(again, shared, "left_anti").unionByName(mixed).unionByName(flat.where("size(ids) = 0").join(again, shared, "left_semi"))
