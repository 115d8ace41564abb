"""Quality rules: fixed limits first, then robust multivariate outliers of text statistics.

Statistics of a text are counted in its task. For every language and source, location and scatter of the transformed
statistics are estimated by minimum covariance determinant: starting from all rows, concentration steps keep the share of
rows with the smallest Mahalanobis distances and estimate again from those. A step is two grouped aggregates over all
rows: a histogram of distances, whose bins give the cut, and sums of products below it. A group's estimate is drawn
towards its language's and that towards the whole's, with a weight that falls with its rows. A text whose distance
exceeds the cutoff is rejected.

Edge cases: a null text has no words and fails the fixed limits; a null language or source is a group of its own; a statistic that hardly varies keeps a least variance; an empty
table gives no rows; repeated rows count each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.llm.frames import small, stored
from phenoloom.llm.words import REMEMBERED_WORDS, Windows, covered, inside, mixed, release

SYMBOLS, SPACE = b"#*$%&|<>", b" \t\n\r\x0b\x0c"
REPEAT_WIDTH = 8
#: Fixed limits: fewest words, and the most words in repeated windows of a hundred.
FEWEST_WORDS, MOST_REPEATED = 20, 30


def statistics_of(texts: list[str | None]) -> dict[str, np.ndarray]:
    """Counts per text, whole texts only."""
    out = {k: np.zeros(len(texts), np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_kinds")}
    words, lengths = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        mine = raw.split()
        lengths[i] = len(mine)
        words += mine
        out["word_chars"][i] = len(text or "") - len(raw) + len(raw.translate(None, SPACE))
        out["n_symbols"][i] = len(raw) - len(raw.translate(None, SYMBOLS))
        lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
    out["n_words"] = lengths
    flat = REMEMBERED_WORDS.of(words)
    owner = np.repeat(np.arange(len(texts)), lengths)
    if len(flat):
        # distinct words per text, and repeated windows per text: the text's number is mixed into the hash
        salt = mixed(owner.astype(np.uint64) + np.uint64(1))
        kinds = np.unique(mixed(flat ^ salt), return_index=True)[1]
        out["n_kinds"] = np.bincount(owner[kinds], minlength=len(texts)).astype(np.int64)
        starts = np.flatnonzero(inside(lengths, REPEAT_WIDTH))
        own = mixed(Windows(REPEAT_WIDTH).of(flat)[starts] ^ salt[starts])
        order = np.argsort(own, kind="stable")
        same = own[order][1:] == own[order][:-1]
        again = np.zeros(len(own), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        mask = covered(starts[again], len(flat), REPEAT_WIDTH)
        out["n_repeat_words"] = np.bincount(owner[mask], minlength=len(texts)).astype(np.int64)
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_kinds")


def text_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                found = statistics_of(part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(found[c]) for c in COUNTS)], names=[*keep, *COUNTS])
        release()

    return docs.select(*keep, text).mapInArrow(count, ", ".join([*kinds, *(f"{c} bigint" for c in COUNTS)]))


#: Transformed statistics and the least standard deviation that each keeps.
MEASURES = {
    "log_words": (lambda: F.log("n_words"), 0.1),
    "log_kinds": (lambda: F.log("n_kinds"), 0.05),
    "word_length": (lambda: F.log(F.col("word_chars") / F.col("n_words")), 0.05),
    "symbols": (lambda: F.sqrt(F.col("n_symbols") / F.col("n_words")), 0.1),
    "repeats": (lambda: F.sqrt(F.col("n_repeat_words") / F.col("n_words")), 0.2),
    "dup_lines": (lambda: F.log1p("n_dup_lines"), 0.5),
}
P = len(MEASURES)
#: Share of a group's rows in the concentrated set, number of concentration steps, and the chance to reject a normal row.
CORE, STEPS, CHANCE = 0.75, 5, 1e-6
#: An estimate from n rows weighs n / (n + PRIOR_ROWS), that of the larger group around it the rest.
PRIOR_ROWS = 100
#: Bins of a doubling of (1 + distance), and width of a bin of a statistic in the starting quartiles.
BINS, WIDTH_OF_BIN = 32, 0.02


def chi2_above(x: float, dof: int) -> float:
    """Upper tail for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for k in range(1, dof // 2):
        term *= x / 2 / k
        total += term
    return float(np.exp(-x / 2) * total)


def chi2_cut(tail: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_above(mid, dof) > tail else (low, mid)
    return high


#: The scatter of the inner rows of a normal sample is smaller than that of all by this factor.
CONSISTENT = CORE / (1 - chi2_above(chi2_cut(1 - CORE, P), P + 2))


def _distance(p: int = P):
    """Squared Mahalanobis distance of array ``x`` from ``centre`` under the flat inverse scatter ``inverse``."""
    off = [F.get("x", F.lit(i)) - F.get("centre", F.lit(i)) for i in range(p)]
    return sum(off[i] * off[j] * F.get("inverse", F.lit(i * p + j)) * (1 if i == j else 2) for i in range(p) for j in range(i, p))


def _bin_at(counts: DataFrame, by: list[str], bins: str, shares: dict[str, float]) -> DataFrame:
    """For each group the first bin at which each share of its rows is reached; the bins of a group are few and fixed."""
    from pyspark.sql import Window

    whole = Window.partitionBy(*by)
    run = counts.withColumn("_c", F.sum("n").over(whole.orderBy(bins))).withColumn("_n", F.sum("n").over(whole))
    return run.groupBy(*by).agg(
        F.max("_n").alias("rows"), *[F.min(F.when(F.col("_c") >= F.col("_n") * s, F.col(bins))).alias(k) for k, s in shares.items()]
    )


def minimum_covariance(rows: DataFrame, by: str = "grp", steps: int = STEPS) -> DataFrame:
    """``by, centre, inverse, rows`` from stored rows with ``by`` and array ``x``, each group on its own."""
    parts = rows.select(by, F.posexplode("x").alias("i", "v")).withColumn("b", F.floor(F.col("v") / WIDTH_OF_BIN))
    quart = _bin_at(parts.groupBy(by, "i", "b").agg(F.count("*").alias("n")), [by, "i"], "b", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    floors = F.array(*[F.lit(f * f) for _, f in MEASURES.values()])
    spread = F.pow((F.col("q3") - F.col("q1")) * (WIDTH_OF_BIN / 1.349), 2) + F.get(floors, F.col("i"))
    start = quart.groupBy(by).agg(
        F.sort_array(F.collect_list(F.struct("i", ((F.col("q2") + 0.5) * WIDTH_OF_BIN).alias("m"), (1 / spread).alias("w")))).alias("s"), F.max("rows").alias("rows")
    )
    weight = lambda i, j: F.get("s", F.lit(i))["w"] if i == j else F.lit(0.0)
    now = stored(start.select(by, F.col("s.m").alias("centre"), F.array(*[weight(i, j) for i in range(P) for j in range(P)]).alias("inverse"), "rows"))

    least = np.diag([f * f for _, f in MEASURES.values()])

    def invert(batches):
        for pdf in batches:
            centres, inverses = [], []
            for n, s, ss in zip(pdf["k"], pdf["s"], pdf["ss"], strict=True):
                mean = np.asarray(s) / n
                scatter = np.zeros((P, P))
                scatter[np.triu_indices(P)] = np.asarray(ss) / n
                scatter = scatter + np.triu(scatter, 1).T - np.outer(mean, mean)
                centres.append(mean.tolist())
                inverses.append(np.linalg.inv(scatter * CONSISTENT + least).ravel().tolist())
            yield pdf[[by, "rows"]].assign(centre=centres, inverse=inverses)[[by, "centre", "inverse", "rows"]]

    kind = rows.schema[by].dataType.simpleString()
    for _ in range(steps):
        near = rows.join(small(now.drop("rows")), by).withColumn("b", F.floor(BINS * F.log2(1 + _distance())))
        cut = _bin_at(near.groupBy(by, "b").agg(F.count("*").alias("n")), [by], "b", {"cut": CORE})
        core = near.join(small(stored(cut)), by).where("b <= cut")
        value = [F.get("x", F.lit(i)) for i in range(P)]
        sums = core.groupBy(by).agg(
            F.count("*").alias("k"), F.max("rows").alias("rows"), F.array(*[F.sum(v) for v in value]).alias("s"),
            F.array(*[F.sum(value[i] * value[j]) for i in range(P) for j in range(i, P)]).alias("ss"),
        )
        now = stored(sums.mapInPandas(invert, f"`{by}` {kind}, centre array<double>, inverse array<double>, rows bigint"))
    return now


def shrunk(n: int, own: tuple[np.ndarray, np.ndarray], around: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Centre and scatter of a mixture of a group's estimate from ``n`` rows and that of the group around it."""
    w, off = n / (n + PRIOR_ROWS), own[0] - around[0]
    return around[0] + w * off, w * own[1] + (1 - w) * around[1] + w * (1 - w) * np.outer(off, off)


def shrink(found: DataFrame, inside: DataFrame) -> DataFrame:
    """``grp, centre, inverse`` of each row of ``inside`` (``grp, around``) from the stored estimates; that of all is named all."""
    whole = found.where("grp = 'all'").first()  # one row, or none if there is nothing to judge
    both = inside.join(found, "grp").join(small(found.select(F.col("grp").alias("around"), F.col("rows").alias("_n"), F.col("centre").alias("_c"), F.col("inverse").alias("_i"))), "around")
    of = lambda centre, inverse: (np.asarray(centre, float), np.linalg.inv(np.reshape(inverse, (P, P)).astype(float)))
    top = whole and (list(whole["centre"]), list(whole["inverse"]))

    def run(batches):
        for pdf in batches:
            centres, inverses = [], []
            for r in pdf.itertuples(index=False):
                centre, scatter = shrunk(r.rows, of(r.centre, r.inverse), shrunk(r.around_rows, of(r.around_centre, r.around_inverse), of(*top)))
                centres.append(centre.tolist())
                inverses.append(np.linalg.inv(scatter).ravel().tolist())
            yield pdf[["grp"]].assign(centre=centres, inverse=inverses)

    named = both.select("grp", "rows", "centre", "inverse", F.col("_n").alias("around_rows"), F.col("_c").alias("around_centre"), F.col("_i").alias("around_inverse"))
    return named.mapInPandas(run, "grp string, centre array<double>, inverse array<double>")


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", chance: float = CHANCE) -> DataFrame:
    """One row per document: ``key``, the counts, ``base_failed``, ``distance`` and ``kept``."""
    facts = text_statistics(docs, text, (key, lang, source))
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    around, group = F.concat(F.lit("language/"), named(lang)), F.concat_ws("/", F.lit("group"), named(lang), named(source))
    measured = F.array(*[f().cast("double") for f, _ in MEASURES.values()])
    # all columns at once: the table may have had columns of these names
    facts = stored(facts.select(key, *COUNTS, failed.alias("base_failed"), group.alias("grp"), around.alias("around"), F.when(~failed, measured).alias("x")))
    rows = facts.where("not base_failed").select(F.explode(F.array("grp", "around", F.lit("all"))).alias("grp"), "x")
    found = minimum_covariance(rows)
    inside_of = stored(facts.where("not base_failed").select("grp", "around").distinct())
    both = facts.join(small(stored(shrink(found, inside_of))), "grp", "left")
    judged = both.withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return judged.select(key, *COUNTS, "base_failed", "distance", (~F.col("base_failed") & (F.col("distance") <= chi2_cut(chance, P))).alias("kept"))
