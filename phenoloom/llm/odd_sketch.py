"""Near-duplicate groups by MinHash bands, odd sketches and full sets.

A text's set holds its distinct shingles of four words. Texts with equal sets form one class, and only classes go on.
Bands of MinHash samples deal classes into buckets. All samples of a class are also folded into a bitmap, each flipping
one bit; the population count of the XOR of two bitmaps estimates their similarity, which is precise when it is high.
Inside a bucket these estimates give the candidate links, and connected candidates form a cluster. Clusters are then
searched on full sets: from a class to all unvisited classes with at least the similarity asked for, and on from those.

No bucket or cluster needs its pairs: a search compares a class with what is still unvisited, and one link to a visited
class is enough. Buckets beyond a fixed size make one cluster without estimates. Clusters beyond a fixed size are
searched in blocks that share some classes; then the classes outside their largest group, which may have missed a link
across blocks, are compared with all other blocks. So any link between two texts in a common bucket is found; a pair at
the threshold misses all buckets with a chance of (1 - 0.8**4)**32, about 5 in 100 million.

Edge cases: texts without words, null ones included, have empty sets and link with nothing; a text of fewer words than a
shingle has its whole sequence as its only shingle; rows repeated in id and text are in one group; null ids take part
and a group of null ids only has a null component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.llm.frames import components, small, stored
from phenoloom.llm.words import REMEMBERED_WORDS, Windows, inside, mixed, release

SHINGLE = 4
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 1024
#: Pairs with a lower estimate are no candidates: five standard deviations of the samples below the threshold.
LEAST_ESTIMATE = PERCENT / 100 - 5 * (PERCENT / 100 * (1 - PERCENT / 100) / SAMPLES) ** 0.5 - 0.02
#: Largest bucket that is searched with sketches, largest block of classes searched at once, classes shared by blocks.
BUCKET, BLOCK, SHARED = 4096, 2048, 64

_draw = np.random.default_rng(20250131)
_TIMES = _draw.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _draw.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_BAND_WEIGHT = _draw.integers(0, 1 << 62, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BIT_WEIGHT = _draw.integers(0, 1 << 62, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def most_bits(least: float, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> int:
    """Set bits of the XOR expected at similarity ``least``: 2k(1-J) samples differ, each flips a random bit."""
    return int(bits / 2 * (1 - np.exp(-4 * samples * (1 - least) / bits)))


def shingle_sets(texts: list[str | None], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """All sets end to end, each sorted, and where each begins (one more entry than texts)."""
    words, lengths = [], np.zeros(len(texts), np.int64)
    short: list[tuple[int, int]] = []
    for i, text in enumerate(texts):
        mine = (text or "").encode().lower().split()
        lengths[i] = len(mine)
        words += mine
        if 0 < len(mine) < width:
            short.append((i, xxhash.xxh3_64_intdigest(b" ".join(mine), seed=len(mine))))
    flat = REMEMBERED_WORDS.of(words)
    starts = np.flatnonzero(inside(lengths, width))
    owner = np.repeat(np.arange(len(texts)), lengths)[starts]
    values = mixed(Windows(width).of(flat)[starts]) if len(starts) else np.zeros(0, np.uint64)
    if short:
        owner = np.concatenate([owner, [i for i, _ in short]])
        values = np.concatenate([values, np.array([h for _, h in short], np.uint64)])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash samples of the non-empty sets, one row each."""
    first = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(first), SAMPLES), np.uint32)
    x = (values >> np.uint64(32)).astype(np.uint32)
    for i in range(SAMPLES):
        out[:, i] = np.minimum.reduceat(x * _TIMES[i] + _PLUS[i], first)
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps, ``SKETCH_BITS`` bits a row, packed."""
    bit = (mixed(samples * _BIT_WEIGHT[None, :]) % np.uint64(SKETCH_BITS)).astype(np.int64)
    at = (np.arange(len(samples)) * SKETCH_BITS)[:, None] + bit
    odd = np.bincount(at.ravel(), minlength=len(samples) * SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, SKETCH_BITS), axis=1)


def band_keys(samples: np.ndarray) -> np.ndarray:
    return np.stack([mixed((samples[:, ROWS * b : ROWS * (b + 1)] * _BAND_WEIGHT[b][None, :]).sum(1) + np.uint64(b)) for b in range(BANDS)], 1)


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, class, bands, sketch``; the last three are null for an empty set."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 250) for i in range(0, batch.num_rows, 250)):
                values, bounds = shingle_sets(part.column(1).to_pylist())
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                classes, bands, sketches = [None] * len(sizes), [None] * len(sizes), [None] * len(sizes)
                if len(full):
                    samples = signatures(values, bounds)
                    keys, odd = band_keys(samples).view(np.int64), odd_sketches(samples)
                    raw = memoryview(values).cast("B")
                    for row, i in enumerate(full.tolist()):
                        classes[i] = xxhash.xxh3_128_digest(raw[8 * bounds[i] : 8 * bounds[i + 1]])
                        bands[i], sketches[i] = keys[row], odd[row].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), pa.array(classes, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                    names=[key, "n_shingles", "class", "bands", "sketch"],
                )
        release()

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_shingles bigint, class binary, bands array<bigint>, sketch binary")


def search(n: int, neighbours) -> np.ndarray:
    """Label of each of ``n`` things, the first of its group; ``neighbours(i, unvisited)`` gives linked unvisited ones."""
    label = np.full(n, -1)
    left = np.ones(n, bool)
    for seed in range(n):
        if not left[seed]:
            continue
        left[seed], label[seed], waiting = False, seed, [seed]
        while waiting and left.any():
            found = neighbours(waiting.pop(), left)
            left[found], label[found] = False, seed
            waiting += found.tolist()
    return label


def search_sketches(odd: np.ndarray, most: int) -> np.ndarray:
    rows = odd.view(np.uint64)

    def near(i: int, left: np.ndarray) -> np.ndarray:
        those = np.flatnonzero(left)
        return those[np.bitwise_count(rows[those] ^ rows[i]).sum(1) <= most]

    return search(len(rows), near)


class SetIndex:
    """Postings of the shingles of some sets, to intersect one set with all of them."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.owner, ranked = owner[order], flat[order]
        new = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, np.int64)
        self.values, self.first = ranked[new], np.append(new, len(ranked))

    def common(self, one: np.ndarray) -> np.ndarray:
        """Size of the intersection of ``one`` with each set."""
        at = np.searchsorted(self.values, one)
        ok = at < len(self.values)
        at, one = at[ok], one[ok]
        at = at[self.values[at] == one]
        n = self.first[at + 1] - self.first[at]
        total = int(n.sum())
        take = np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(total)
        return np.bincount(self.owner[take], minlength=len(self.sizes))

    def links(self, one: np.ndarray, percent: int) -> np.ndarray:
        common = self.common(one)
        return 100 * common >= percent * (self.sizes + len(one) - common)


def search_sets(sets: list[np.ndarray], percent: int) -> np.ndarray:
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([0, int(100 * common < percent * (len(sets[0]) + len(sets[1]) - common))])
    index = SetIndex(sets)
    return search(len(sets), lambda i, left: np.flatnonzero(index.links(sets[i], percent) & left))


def _by(column: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of each run of equal values, whatever their order."""
    order = np.argsort(column, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(column[order])) + 1) if len(order) else ()


def candidate_edges(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: a spanning forest of the candidate links of each bucket."""
    least = most_bits(LEAST_ESTIMATE)
    bands = nodes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("members"), F.min("node").alias("hub")).where("members > 1")
    met = stored(bands.join(shared, "band"))
    groups = max(1, met.count() // 20_000)

    def inside_buckets(table: pa.Table) -> pa.Table:
        band, node = (table.column(c).to_numpy() for c in ("band", "node"))
        odd = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
        a, b = [], []
        for rows in _by(band):
            rows = rows[np.argsort(node[rows])]
            label = search_sketches(odd[rows], least)
            hung = np.flatnonzero(label != np.arange(len(rows)))
            a.append(node[rows[hung]])
            b.append(node[rows[label[hung]]])
        out = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
        return pa.table({"a": out[:, 0], "b": out[:, 1]})

    some = met.where(F.col("members") <= bucket).join(nodes.select("node", "sketch"), "node")
    some = some.withColumn("g", F.pmod(F.xxhash64("band"), F.lit(groups)))
    few = some.select("g", "band", "node", "sketch").groupBy("g").applyInArrow(inside_buckets, "a bigint, b bigint")
    many = met.where((F.col("members") > bucket) & (F.col("node") != F.col("hub"))).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return few.unionByName(many)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, bucket: int = BUCKET, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """One row per document: ``key, n_shingles, component_id, kept``."""
    kind = docs.schema[key].dataType.simpleString()
    facts = stored(sketch(docs, key, text))
    classes = facts.where("class is not null").groupBy("class").agg(F.min(key).alias(key), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"))
    nodes = stored(classes.withColumn("node", F.monotonically_increasing_id()))
    clusters = components(candidate_edges(nodes, bucket)).withColumnRenamed("component", "cluster")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("members"))
    members = stored(clusters.join(sizes, "cluster").join(nodes.select("node", F.col(key).alias("_key"), "class"), "node"))

    def with_sets(who: DataFrame, schema: str) -> DataFrame:
        """Full sets of classes, from the text of their first document."""
        names = [c for c in who.columns if c not in ("_key", "class")]

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(i, 250) for i in range(0, batch.num_rows, 250)):
                    values, bounds = shingle_sets(part.column(0).to_pylist())
                    raw = memoryview(values).cast("B")
                    sets = [bytes(raw[8 * a : 8 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    # another document may bear the same id
                    own = [i for i, c in enumerate(part.column(1).to_pylist()) if xxhash.xxh3_128_digest(sets[i]) == c]
                    yield pa.RecordBatch.from_arrays([*(part.column(n).take(pa.array(own, pa.int64())) for n in names), pa.array([sets[i] for i in own], pa.binary())], names=[*names, "set"])
            release()

        read = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(small(who), F.col("_id").eqNullSafe(F.col("_key")))
        return read.select("_text", "class", *names).mapInArrow(run, schema)

    groups = max(1, members.count() // block)
    salt = lambda pieces: F.pmod(F.xxhash64("node", F.lit(7)), pieces)
    blocks = F.ceil(F.col("members") / block)
    large = F.col("members") > block
    from pyspark.sql import Window

    first = F.row_number().over(Window.partitionBy("cluster").orderBy(F.xxhash64("node", F.lit(3)), "node")) <= shared
    own = F.struct(F.when(large, F.col("cluster")).otherwise(-1 - F.pmod(F.xxhash64("cluster"), F.lit(groups))).alias("c"), F.when(large, salt(blocks)).otherwise(F.lit(0).cast("long")).alias("s"))
    whole = members.where(~large).withColumn("g", own)
    parts = members.where(large).withColumn("g", own)
    hubs = members.where(large).withColumn("_first", first).where("_first").drop("_first")
    hubs = hubs.withColumn("g", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long")), lambda s: F.struct(F.col("cluster").alias("c"), s.alias("s")))))

    def links_inside(table: pa.Table) -> pa.Table:
        cluster, node = table.column("cluster").to_numpy(), table.column("node").to_numpy()
        raw = table.column("set")
        out_a, out_b, out_c = [], [], []
        for rows in _by(cluster):
            rows = rows[np.unique(node[rows], return_index=True)[1]]
            label = search_sets([np.frombuffer(raw[i].as_py(), np.uint64) for i in rows.tolist()], percent)
            out_a.append(node[rows])
            out_b.append(node[rows[label]])
            out_c.append(cluster[rows])
        return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b), "cluster": np.concatenate(out_c)})

    todo = whole.unionByName(parts).unionByName(hubs).select("node", "cluster", "g", "_key", "class")
    sets = with_sets(todo, "node bigint, cluster bigint, g struct<c:bigint,s:bigint>, set binary")
    inner = stored(sets.groupBy("g").applyInArrow(links_inside, "a bigint, b bigint, cluster bigint"))
    big = members.where(large).select("cluster", "node", "members", "_key", "class")
    split = big.limit(1).count() > 0
    found = inner.select("a", "b")
    if split:
        label = F.coalesce("component", "node").alias("label")
        so_far = stored(big.join(components(inner.join(big.select("cluster").distinct(), "cluster").select("a", "b")), "node", "left").select("cluster", "node", "members", "_key", "class", label))
        found = found.unionByName(_links_across(so_far, with_sets, percent, block))
    groups_of = components(found)
    low = nodes.join(groups_of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = low.groupBy("component").agg(F.min(key).alias("component_id"))
    ids = low.select("class", "component").join(least, "component").select("class", "component_id")
    linked = facts.where("class is not null").select(key, "n_shingles", "class").join(ids, "class").drop("class")
    alone = facts.where("class is null").select(key, "n_shingles", F.col(key).alias("component_id"))
    out = linked.select(key, "n_shingles", "component_id").unionByName(alone)
    return out.select(key, "n_shingles", F.col("component_id").cast(kind).alias("component_id"), F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)).alias("kept"))


def _links_across(so_far: DataFrame, with_sets, percent: int, block: int) -> DataFrame:
    """Links between blocks of large clusters: whoever is not in its cluster's largest group, against all blocks."""
    from pyspark.sql import Window

    counts = so_far.groupBy("cluster", "label").agg(F.count("*").alias("n"))
    best = Window.partitionBy("cluster").orderBy(F.col("n").desc(), "label")
    main = counts.withColumn("r", F.row_number().over(best)).where("r = 1").select("cluster", F.col("label").alias("main"), F.col("n").alias("in_main"))
    rows = so_far.join(main, "cluster").withColumn("m", F.ceil(F.col("members") / block)).withColumn("o", F.ceil((F.col("members") - F.col("in_main")) / block)).where("o > 0")
    spread = lambda seed, n: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    cell = lambda i, j: F.struct(F.col("cluster").alias("c"), i.alias("i"), j.alias("j"))
    outside = rows.where("label <> main").withColumn("g", F.explode(F.transform(upto("m"), lambda j: cell(spread(11, "o"), j)))).withColumn("side", F.lit(0))
    others = rows.withColumn("g", F.explode(F.transform(upto("o"), lambda i: cell(i, spread(13, "m"))))).withColumn("side", F.lit(1))

    def compare(table: pa.Table) -> pa.Table:
        side, label = table.column("side").to_numpy(), table.column("label").to_numpy()
        raw = table.column("set")
        all_rows = np.flatnonzero(side == 1)
        index = SetIndex([np.frombuffer(raw[i].as_py(), np.uint64) for i in all_rows.tolist()])
        theirs, seen = label[all_rows], set()
        for i in np.flatnonzero(side == 0).tolist():
            hit = np.unique(theirs[index.links(np.frombuffer(raw[i].as_py(), np.uint64), percent)])
            seen.update((int(label[i]), x) for x in hit.tolist() if x != label[i])
        pairs = np.array(sorted(seen), np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    todo = outside.unionByName(others).select("label", "side", "g", "_key", "class")
    sets = with_sets(todo, "label bigint, side int, g struct<c:bigint,i:bigint,j:bigint>, set binary")
    return stored(sets.groupBy("g").applyInArrow(compare, "a bigint, b bigint"))
