"""Near-duplicate vectors by an inverted multi-index.

Vectors of one label are cut into halves, and an independent codebook for each half deals every vector into a cell of
the product grid. A vector visits cells in the order of a multi-sequence traversal: nearest pairs of codewords first,
where a codeword is as near as the plane that separates its region from the vector's own. The traversal goes on until
the cells visited hold the target share of all places a partner at the threshold could be; that radius is measured on a
bounded sample, by turning sampled vectors by the threshold's angle in random directions. What is found is verified by
cosine in double precision; a pair counts once and for both, whichever of the two found it.

Vectors that are equal once scaled are one class with its number of copies, and only classes are compared. Cells with many
classes are cut into blocks of a fixed size, and every block meets each of its visitors' blocks; a block answers with counts
per class and a spanning forest of its links, never with pairs.

Only vectors of one length can link. Each length of more than ``PER_CELL`` classes has an index of its own; the classes of
a rarer length and one label are one cell.

Edge cases: null labels, null or zero vectors, and vectors with null or non-finite components link with nothing; equal
vectors link; repeated ids are other vectors, though one node; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.llm.frames import components, small, stored

COSINE = 0.98
#: Bounded sample that fits codebooks and radius; share of partners at the threshold whose cell must be visited.
SAMPLE, TARGET = 16_384, 0.9995
#: Vectors per cell aimed at, most codewords of a half, and vectors in a block.
PER_CELL, MOST_WORDS, BLOCK = 64, 1024, 1024


def codebook(points: np.ndarray, words: int, seed: int, rounds: int = 12) -> np.ndarray:
    """k-means in numpy; an empty codeword takes the point farthest from its own."""
    draw = np.random.default_rng(seed)
    words = min(words, len(points))
    centres = points[draw.choice(len(points), words, replace=False)].copy()
    for _ in range(rounds):
        far = ((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]).clip(0)
        own = far.argmin(1)
        n = np.bincount(own, minlength=words)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        spare = np.flatnonzero(n == 0)
        centres[spare] = points[np.argsort(-far[np.arange(len(points)), own], kind="stable")[: len(spare)]]
    return centres


def nearness(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own codeword of each point, and its squared distance from the plane towards the region of each codeword."""
    far = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    own = far.argmin(1)
    between = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))
    np.fill_diagonal(between, 1)
    gap = far - far[np.arange(len(points)), own][:, None]
    return own, (gap / (2 * between[own] + 1e-12)) ** 2


def radius(points: np.ndarray, books: list[np.ndarray], cosine: float, target: float, seed: int = 3) -> float:
    """Squared distance that covers ``target`` of partners at exactly ``cosine``, drawn around the sampled vectors."""
    draw = np.random.default_rng(seed)
    needed = []
    for _ in range(max(1, 20_000 // len(points))):
        turn = draw.normal(size=points.shape)
        turn -= (turn * points).sum(1, keepdims=True) * points
        turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-12)
        partner = cosine * points + np.sqrt(1 - cosine * cosine) * turn
        half = points.shape[1] // 2
        total = np.zeros(len(points))
        for k, part in enumerate((slice(None, half), slice(half, None))):
            _, near = nearness(points[:, part], books[k])
            theirs, _ = nearness(partner[:, part], books[k])
            total += near[np.arange(len(points)), theirs]
        needed.append(total)
    return float(np.quantile(np.concatenate(needed), target))


class Index:
    """Two codebooks and a radius; cells are numbered ``first * words + second``."""

    def __init__(self, books: list[np.ndarray], reach: float):
        self.books, self.reach, self.half = books, reach, books[0].shape[1]

    def cells(self, points: np.ndarray) -> np.ndarray:
        a, _ = nearness(points[:, : self.half], self.books[0])
        b, _ = nearness(points[:, self.half :], self.books[1])
        return a * len(self.books[1]) + b

    def visits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(point, cell)`` of all cells within the radius: a multi-sequence traversal for each point.

        Codewords of either half are sorted by nearness. For the i-th nearest of the first half, the traversal takes
        those of the second half up to what the radius leaves, which is a prefix that shrinks as i grows.
        """
        _, a = nearness(points[:, : self.half], self.books[0])
        _, b = nearness(points[:, self.half :], self.books[1])
        order_a, order_b = np.argsort(a, 1, kind="stable"), np.argsort(b, 1, kind="stable")
        a, b = np.take_along_axis(a, order_a, 1), np.take_along_axis(b, order_b, 1)
        rows, cells = [], []
        for i in range(a.shape[1]):
            going = np.flatnonzero(a[:, i] <= self.reach)
            if not len(going):
                break
            depth = (a[going, i][:, None] + b[going] <= self.reach).sum(1)
            row = np.repeat(going, depth)
            within = np.arange(len(row)) - np.repeat(np.cumsum(depth) - depth, depth)
            rows.append(row)
            cells.append(order_a[row, i] * len(self.books[1]) + order_b[row, within])
        return np.concatenate(rows), np.concatenate(cells)


def fit(vectors: DataFrame, rows: int, cosine: float = COSINE, target: float = TARGET, sample: int = SAMPLE) -> Index | None:
    """Fit on at most ``sample`` of the stored classes' unit vectors ``v``, in the order of a hash; all are indexed later."""
    some = vectors.select("v").orderBy(F.xxhash64("v"), "v").limit(sample).collect()
    if not some:
        return None
    points = np.stack([np.frombuffer(r["v"], np.float64) for r in some])
    words = int(np.clip(np.sqrt(rows / PER_CELL), 1, min(MOST_WORDS, max(1, len(points) // 8))))
    half = points.shape[1] // 2
    books = [codebook(points[:, :half], words, 1), codebook(points[:, half:], words, 2)] if half else [codebook(points[:, :0], 1, 1), codebook(points, words, 2)]
    return Index(books, radius(points, books, cosine, target))


def unit_vectors(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``node, key, label, v``: usable vectors, scaled to length one, as bytes of doubles; ``v`` is null for the others."""

    def scale(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, known in zip(batch.column(2).to_pylist(), batch.column(1).is_valid().to_pylist(), strict=True):
                one = np.array(x, np.float64) if known and x and None not in x else np.zeros(0)
                ok = len(one) and np.isfinite(one).all() and (top := np.abs(one).max()) > 0
                out.append((one / top / np.linalg.norm(one / top)).tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["key", "label", "v"])

    kinds = [rows.schema[c].dataType.simpleString() for c in (key, label)]
    scaled = rows.select(key, label, vector).mapInArrow(scale, f"key {kinds[0]}, label {kinds[1]}, v binary")
    return scaled.withColumn("node", F.monotonically_increasing_id())


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, target: float = TARGET, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``key, n_links, component_id, kept``."""
    kind = rows.schema[key].dataType.simpleString()
    every = stored(unit_vectors(rows, key, vector, label))
    classes = stored(every.where("v is not null").groupBy("label", "v").agg(F.min("node").alias("node"), F.count("*").alias("copies")).withColumn("w", F.octet_length("v")))
    widths = classes.groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") > PER_CELL).collect()
    shipped = rows.sparkSession.sparkContext.broadcast({r["w"]: (x.books, x.reach) for r in widths if (x := fit(classes.where(F.col("w") == r["w"]), r["n"], cosine, target))})

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = {w: Index(*x) for w, x in shipped.value.items()}
        for batch in batches:
            width = batch.column(4).to_numpy()
            for w in np.unique(width):
                mine = batch.take(pa.array(np.flatnonzero(width == w)))
                for part in (mine.slice(i, 512) for i in range(0, mine.num_rows, 512)):
                    if (own := indexes.get(int(w))) is None:
                        home, lists = np.zeros(part.num_rows, np.int64), [[0]] * part.num_rows
                    else:
                        points = np.frombuffer(b"".join(part.column(2).to_pylist()), np.float64).reshape(part.num_rows, -1)
                        at, cell = own.visits(points)
                        home = own.cells(points)
                        lists = np.split(cell[np.argsort(at, kind="stable")], np.cumsum(np.bincount(at, minlength=part.num_rows))[:-1])
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home), pa.array(lists, pa.list_(pa.int64()))], names=["node", "label", "v", "copies", "w", "cell", "visits"])

    label_kind = rows.schema[label].dataType.simpleString()
    dealt = stored(classes.select("node", "label", "v", "copies", "w").mapInArrow(deal, f"node bigint, label {label_kind}, v binary, copies bigint, w int, cell bigint, visits array<bigint>"))
    place = ["label", "w", "cell"]
    # blocks of a cell's own classes, and of its visitors
    lots = lambda name: F.ceil(F.col(name) / block)
    homes = stored(dealt.groupBy(*place).agg(F.count("*").alias("members")))
    calls = dealt.select("node", "label", "w", "v", "copies", F.col("cell").alias("home"), F.explode("visits").alias("cell"))
    guests = stored(calls.groupBy(*place).agg(F.count("*").alias("callers")).join(homes, place))
    spread = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), n)
    sizes = small(guests.select(*place, lots("members").alias("m"), lots("callers").alias("q")))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    group = lambda i, j: F.struct("label", "w", "cell", i.alias("i"), j.alias("j"))
    asking = calls.join(sizes, place).withColumn("s", spread(F.col("q"), 5)).withColumn("j", F.explode(upto("m"))).withColumn("g", group(F.col("s"), F.col("j")))
    asked = dealt.select("node", "label", "w", "v", "copies", F.col("cell").alias("home"), "cell").join(sizes, place).withColumn("s", spread(F.col("m"), 9)).withColumn("i", F.explode(upto("q"))).withColumn("g", group(F.col("i"), F.col("s")))
    meet = asking.select("g", F.lit(0).alias("side"), "node", "home", "copies", "v").unionByName(asked.select("g", F.lit(1).alias("side"), "node", "home", "copies", "v"))

    def compare(table: pa.Table) -> pa.Table:
        index = shipped.value.get(table.column("g")[0].as_py()["w"])
        side, node, home, copies = (table.column(c).to_numpy() for c in ("side", "node", "home", "copies"))
        points = np.frombuffer(b"".join(table.column("v").to_pylist()), np.float64).reshape(len(node), -1)
        q, m = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        hit_q, hit_m = np.nonzero(points[q] @ points[m].T >= cosine)
        q, m = q[hit_q], m[hit_m]
        other = node[q] != node[m]
        q, m = q[other], m[other]
        # the one called upon counts the link too, unless it calls back; in a length without an index all call on all
        if index is None:
            once = np.zeros(len(m), bool)
        else:
            at = np.unique(m)
            rows_of, cells_of = Index(*index).visits(points[at]) if len(at) else (at, at)
            known = set(zip(at[rows_of].tolist(), cells_of.tolist(), strict=True))
            once = np.array([(a, b) not in known for a, b in zip(m.tolist(), home[q].tolist(), strict=True)], bool)
        nodes, back = np.unique(np.concatenate([node[q], node[m[once]]]), return_inverse=True)
        n = np.zeros(len(nodes), np.int64)
        np.add.at(n, back, np.concatenate([copies[m], copies[q[once]]]))
        # a spanning forest: the lowest of the labels of both ends, until nothing changes
        ends, flat = np.unique(np.concatenate([node[q], node[m]]), return_inverse=True)
        a, b = flat[: len(q)], flat[len(q) :]
        low = np.arange(len(ends))
        while True:
            new = low.copy()
            np.minimum.at(new, a, low[b])
            np.minimum.at(new, b, low[a])
            new = new[new]
            if (new == low).all():
                break
            low = new
        hung = np.flatnonzero(low != np.arange(len(ends)))
        return pa.table(
            {
                "node": np.concatenate([nodes, ends[hung]]),
                "n": pa.array(np.concatenate([n, np.zeros(len(hung), np.int64)])),
                "root": pa.array([None] * len(nodes) + ends[low[hung]].tolist(), pa.int64()),
            }
        )

    found = stored(meet.groupBy("g").applyInArrow(compare, "node bigint, n bigint, root bigint"))
    links = found.where("root is null").groupBy("node").agg(F.sum("n").alias("n_links"))
    # every vector and its class; an unusable vector is a class of its own
    held = classes.select("label", "v", F.col("node").alias("class"), "copies")
    known = every.where("v is not null").join(held, (every["label"] == held["label"]) & (every["v"] == held["v"])).select("key", "class", "copies")
    ids = stored(known.unionByName(every.where("v is null").select("key", F.col("node").alias("class"), F.lit(1).cast("long").alias("copies"))))
    # rows that share an id are one node of the answer
    hubs = ids.where("key is not null").groupBy("key").agg(F.min("class").alias("hub"), F.count("*").alias("c")).where("c > 1")
    same = ids.join(hubs, "key").where("class <> hub").select(F.col("class").alias("a"), F.col("hub").alias("b"))
    groups = components(found.where("root is not null").select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(same))
    least = ids.groupBy("class").agg(F.min("key").alias("key"), F.max("copies").alias("copies"))
    by_class = least.join(links.withColumnRenamed("node", "class"), "class", "left").join(groups.withColumnRenamed("node", "class"), "class", "left")
    by_class = stored(by_class.withColumn("component", F.coalesce("component", "class")))
    first = by_class.groupBy("component").agg(F.min("key").alias("component_id"))
    answers = stored(by_class.join(first, "component").select("class", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id"))
    out = ids.join(answers, "class").select(F.col("key").alias(key), "n_links", F.col("component_id").cast(kind).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
