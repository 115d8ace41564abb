"""Many penalised logistic fits in one scan: folds, repeats and settings advance together.

A fit is a setting (mixing and penalty) on a group of rows: all of them, or all but one fold of a repeat. Every round is
one aggregate over the data: each row adds to the gradient and the Hessian of every fit whose group it is in, tasks emit
their partial sums, and the driver, which holds nothing but models, moves all fits by one step. Ridge fits take a Newton step;
with an absolute penalty the quadratic model is minimised by coordinate descent, for all fits of a block at once. A path is
walked from the largest penalty down in blocks of neighbouring points, each starting from the point before it. Features that
the strong rule discards stay out of the Hessian until a gradient of a later round, which covers all features, wants them in.

The objective of a fit is the mean weighted log loss plus ``penalty * (mixing * |c|_1 + (1 - mixing) / 2 * |c|_2^2)`` over its
coefficients, without the intercept. Rows are centred and scaled by the moments of their own group inside the tasks, which
keeps the steps well conditioned; ``scale`` says on which coefficients the penalty is: ``none`` on those of the features as
they are, ``population`` or ``sample`` on those of features divided by that standard deviation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers that a task sums up at once; more fits are advanced in several blocks.
CELLS = 4_000_000
#: A fit is done when no optimality condition is off by more; rounds and sweeps are bounds for fits that do not get there.
TOLERANCE, ROUNDS, SWEEPS = 1e-8, 100, 1000
SCALES = ("none", "population", "sample")


@dataclass(frozen=True)
class Group:
    """Rows that are not in ``fold`` of ``repeat``; all rows if there is no fold."""

    repeat: int = 0
    fold: int | None = None


@dataclass(frozen=True)
class Setting:
    mixing: float = 0.0
    penalty: float = 0.0


@dataclass
class Fitted:
    """Coefficients of the features as they are, and how far the worst optimality condition is off."""

    intercept: float
    coefficients: np.ndarray
    off: float
    rounds: int
    loss: float


def _folds(repeats: Sequence[int]) -> Column:
    """The map from repeat to fold as an array, in the order of ``repeats``."""
    return F.array(*[F.col("folds")[r] for r in repeats]).alias("folds")


def _repeats(groups: Sequence[Group]) -> list[int]:
    return sorted({g.repeat for g in groups if g.fold is not None})


def _fold_matrix(batch: pa.RecordBatch, n_repeats: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("folds")).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_repeats)


def _members(batch: pa.RecordBatch, groups: Sequence[Group], repeats: list[int]) -> list[np.ndarray]:
    """Which rows of a batch are in each group."""
    everyone = np.ones(batch.num_rows, bool)
    folds = _fold_matrix(batch, len(repeats)) if repeats else None
    return [everyone if g.fold is None else folds[:, repeats.index(g.repeat)] != g.fold for g in groups]


#: Rows packed into one block of bytes, so that a round moves no row on its own from Spark to Python.
BLOCK = 8192


def packed(data: DataFrame, width: int, n_repeats: int) -> DataFrame:
    """``n, y, features, folds``: runs of rows as bytes, which :func:`_unpacked` turns into batches of the same columns again."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(i, BLOCK)
                y = batch.column(batch.schema.get_field_index("y")).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
                folds = _fold_matrix(batch, n_repeats).astype(np.int32) if n_repeats else np.zeros((0, 0), np.int32)
                parts = [y.tobytes(), np.ascontiguousarray(_matrix(batch, width)).tobytes(), folds.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int32()), *[pa.array([p], pa.binary()) for p in parts]], names=["n", "y", "features", "folds"])

    return data.mapInArrow(each, "n int, y binary, features binary, folds binary")


def _unpacked(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    for n, y, x, folds in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(np.frombuffer(x, np.float64)), width)]
        names = ["y", "features"]
        if folds:
            flat = np.frombuffer(folds, np.int32)
            lists, names = [*lists, pa.FixedSizeListArray.from_arrays(pa.array(flat), len(flat) // n)], [*names, "folds"]
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(y, np.float64)), *lists], names=names)


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index("features")).flatten()
    if flat.null_count or len(flat) != width * batch.num_rows:
        raise ValueError("every row needs the same number of features and no nulls")
    return flat.to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, width)


def _summed(frame: DataFrame, partial, shape: tuple[int, int], width: int) -> np.ndarray:
    """Sum ``partial(batch)``, matrices of this shape, over all packed rows: one aggregate whose result has the size of the matrix."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for blocks in batches:
            for batch in _unpacked(blocks, width):
                total += partial(batch)
        row, at = np.nonzero(total)
        for i in range(0, len(row), 100_000):
            s = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(row[s], pa.int32()), pa.array(at[s], pa.int32()), pa.array(total[row[s], at[s]])], names=["row", "at", "value"])

    out = np.zeros(shape)
    sums = frame.mapInArrow(each, "row int, at int, value double").groupBy("row", "at").agg(F.sum("value").alias("value")).toArrow()
    out[sums.column("row").to_numpy(), sums.column("at").to_numpy()] = sums.column("value").to_numpy()
    return out


@dataclass
class Moments:
    """Per group: rows, their mean and standard deviation, and the weight of each class."""

    n: np.ndarray
    mean: np.ndarray
    sd: np.ndarray
    weight: np.ndarray
    cases: np.ndarray


def moments(frame: DataFrame, groups: Sequence[Group], width: int, balanced: bool, repeats: list[int]) -> Moments:
    """Two aggregates for all groups: means, then squares about the mean of all rows and the class counts."""

    def first(batch: pa.RecordBatch) -> np.ndarray:
        return np.r_[batch.num_rows, _matrix(batch, width).sum(axis=0)][None]

    whole = _summed(frame, first, (1, width + 1), width)[0]
    centre = whole[1:] / max(whole[0], 1)

    def second(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch, width) - centre
        y = batch.column(batch.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
        parts = []
        for rows in _members(batch, groups, repeats):
            parts.append(np.r_[rows.sum(), y[rows].sum(), x[rows].sum(axis=0), (x[rows] ** 2).sum(axis=0)])
        return np.stack(parts)

    sums = _summed(frame, second, (len(groups), 2 + 2 * width), width)
    n, cases = sums[:, 0], sums[:, 1]
    if not np.isfinite(sums).all():
        raise ValueError("features must be finite")
    if not ((cases > 0) & (cases < n)).all():
        raise ValueError("the outcome needs at least two classes in every group")
    shift = sums[:, 2 : 2 + width] / n[:, None]
    sd = np.sqrt(np.maximum(sums[:, 2 + width :] / n[:, None] - shift**2, 0.0))
    sd[sd <= 1e-12 * np.maximum(1.0, np.abs(centre))] = 0.0
    weight = np.stack([n / (2 * (n - cases)), n / (2 * cases)], axis=1) if balanced else np.ones((len(groups), 2))
    return Moments(n, centre + shift, sd, weight, cases)


@dataclass
class _Block:
    """Fits that advance together. Coefficients are those of centred and scaled features, the intercept first."""

    group: np.ndarray
    l1: np.ndarray
    l2: np.ndarray
    c: np.ndarray


def _penalties(setting: Setting, scale: str, sd: np.ndarray, n: float) -> tuple[np.ndarray, np.ndarray]:
    """Absolute and squared penalty of each coefficient of the scaled features; none on the intercept."""
    # a coefficient of the feature as it is, or divided by a deviation, is so many times the one of the scaled feature
    factor = 1.0 / np.where(sd > 0, sd, 1.0) if scale == "none" else np.full(len(sd), 1.0 if scale == "population" else np.sqrt(n / max(n - 1, 1)))
    l1, l2 = setting.penalty * setting.mixing * factor, setting.penalty * (1.0 - setting.mixing) * factor**2
    return np.r_[0.0, l1], np.r_[0.0, l2]


def _round(frame: DataFrame, block: _Block, groups: Sequence[Group], m: Moments, used: np.ndarray, repeats: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean loss, gradient of all coefficients and Hessian of those ``used``, of every fit of the block."""
    width, fits = m.mean.shape[1], len(block.group)
    here = np.unique(block.group)
    own = [groups[g] for g in here]
    mean, sd, weight, c = m.mean[here], np.where(m.sd[here] > 0, m.sd[here], 1.0), m.weight[here], block.c
    of = [np.flatnonzero(block.group == g) for g in here]
    upper = np.triu_indices(len(used))
    size = 1 + (width + 1) + len(upper[0])

    def partial(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch, width)
        y = batch.column(batch.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
        out = np.zeros((fits, size))
        for k, rows in enumerate(_members(batch, own, repeats)):
            z = np.empty((int(rows.sum()), width + 1))
            z[:, 0], z[:, 1:] = 1.0, (x[rows] - mean[k]) / sd[k]
            t = y[rows]
            w = weight[k][t.astype(int)]
            eta = z @ c[of[k]].T
            p = 1.0 / (1.0 + np.exp(-np.clip(eta, -700, 700)))
            out[of[k], 0] = (w[:, None] * (np.maximum(eta, 0) + np.log1p(np.exp(-np.abs(eta))) - t[:, None] * eta)).sum(axis=0)
            out[of[k], 1 : width + 2] = ((w[:, None] * (p - t[:, None])).T @ z)
            part = z[:, used]
            for f, curve in zip(of[k], (w[:, None] * p * (1.0 - p)).T, strict=True):
                out[f, width + 2 :] = ((part * curve[:, None]).T @ part)[upper]
        return out

    sums = _summed(frame, partial, (fits, size), width) / m.n[block.group][:, None]
    hess = np.zeros((fits, len(used), len(used)))
    hess[:, upper[0], upper[1]] = sums[:, width + 2 :]
    hess[:, upper[1], upper[0]] = sums[:, width + 2 :]
    return sums[:, 0], sums[:, 1 : width + 2], hess


def _off(c: np.ndarray, g: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """How far each coefficient's optimality condition is off."""
    slope = g + l2 * c
    return np.where(c != 0, np.abs(slope + l1 * np.sign(c)), np.maximum(np.abs(slope) - l1, 0.0))


def _descend(c: np.ndarray, g: np.ndarray, hess: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """Where the penalised quadratic models are least: by one solve without absolute penalties, else by coordinate descent."""
    n = c.shape[1]
    # a floor far below any tolerance keeps constant features and separable data solvable
    curve = hess + 1e-12 * np.eye(n)
    if not l1.any():
        full = curve + l2[:, :, None] * np.eye(n)
        return c - np.linalg.solve(full, (g + l2 * c)[..., None])[..., 0]
    new, slope = c.copy(), g.copy()
    diagonal = np.einsum("fii->fi", curve)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(n):
            raw = diagonal[:, j] * new[:, j] - slope[:, j]
            to = np.sign(raw) * np.maximum(np.abs(raw) - l1[:, j], 0.0) / (diagonal[:, j] + l2[:, j])
            step = to - new[:, j]
            if step.any():
                slope += step[:, None] * curve[:, j]
                new[:, j] = to
                moved = max(moved, float(np.abs(step * diagonal[:, j]).max()))
        if moved < TOLERANCE / 10:
            break
    return new


def _fit_block(frame: DataFrame, block: _Block, groups: Sequence[Group], m: Moments, used: np.ndarray, repeats: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Advance a block until all conditions hold. Returns how far they are off, rounds, losses and gradients."""
    n = len(block.group)
    step, best = np.zeros_like(block.c), np.full(n, np.inf)
    off, rounds, losses, slopes = np.full(n, np.inf), np.zeros(n, int), np.zeros(n), np.zeros_like(block.c)
    live = np.arange(n)
    for _ in range(ROUNDS):
        now = _Block(block.group[live], block.l1[live], block.l2[live], block.c[live])
        loss, g, hess = _round(frame, now, groups, m, used, repeats)
        rounds[live] += 1
        value = loss + (now.l1 * np.abs(now.c) + now.l2 * now.c**2 / 2).sum(axis=1)
        apart = _off(now.c, g, now.l1, now.l2)
        off[live], losses[live], slopes[live] = apart.max(axis=1), loss, g
        worse = value > best[live] + 1e-12 * np.abs(value)
        # what a discarded feature's gradient wants in comes in for all
        wanted = np.flatnonzero((apart > TOLERANCE).any(axis=0))
        grown = np.union1d(used, wanted)
        new = now.c.copy()
        if len(grown) == len(used):
            new[:, used] = _descend(now.c[:, used], g[:, used], hess, now.l1[:, used], now.l2[:, used])
            step[live[~worse]] = (new - now.c)[~worse]
            best[live] = np.where(worse, best[live], value)
            step[live[worse]] /= 2.0
            block.c[live] = np.where(worse[:, None], now.c - step[live], new)
        else:
            best[live] = np.where(worse, best[live], value)
        used = grown
        # a fit that is optimal stays where it was judged
        done = apart.max(axis=1) <= TOLERANCE
        block.c[live[done]] = now.c[done]
        live = live[~done]
        if not len(live):
            break
    return off, rounds, losses, slopes


def fit_many(
    frame: DataFrame, settings: Sequence[Setting], groups: Sequence[Group] = (Group(),), scale: str = "none", balanced: bool = False, label: str = "outcome", features: str = "features"
) -> dict[tuple[int, int], Fitted]:
    """Fit every setting on every group. Keys of the result are places in ``settings`` and ``groups``.

    ``frame`` has a label of 0 and 1, ``features ARRAY<DOUBLE>`` and, for groups with a fold, ``folds`` (repeat to fold).
    Settings of one mixing are walked from the largest penalty down.
    """
    if scale not in SCALES:
        raise ValueError(f"invalid scale {scale!r}")
    if any(not 0 <= s.mixing <= 1 or s.penalty < 0 for s in settings):
        raise ValueError("mixing must lie between 0 and 1 and penalties must not be negative")
    repeats = _repeats(groups)
    data = frame.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), F.col(features).alias("features"), *([_folds(repeats)] if repeats else []))
    width = data.select(F.max(F.size("features")).alias("n")).first()["n"]
    if width is None:
        raise ValueError("there are no rows to fit")
    data = packed(data, width, len(repeats)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_all(data, settings, groups, scale, balanced, width, repeats)
    finally:
        data.unpersist()


def _fit_all(
    data: DataFrame, settings: Sequence[Setting], groups: Sequence[Group], scale: str, balanced: bool, width: int, repeats: list[int]
) -> dict[tuple[int, int], Fitted]:
    """The fits of :func:`fit_many` on packed rows."""
    m = moments(data, groups, width, balanced, repeats)
    order = sorted(range(len(settings)), key=lambda i: (settings[i].mixing, -settings[i].penalty))
    fits = [(i, g) for i in order for g in range(len(groups))]
    start = np.zeros((len(groups), width + 1))
    start[:, 0] = 0.0 if balanced else np.log(m.cases / (m.n - m.cases))
    absolute = any(s.mixing > 0 and s.penalty > 0 for s in settings)
    at_start = None
    if absolute:
        none = _Block(np.arange(len(groups)), np.zeros_like(start), np.zeros_like(start), start)
        at_start = _round(data, none, groups, m, np.zeros(0, int), repeats)[1]
    out: dict[tuple[int, int], Fitted] = {}
    last: dict[tuple[float, int], tuple[np.ndarray, np.ndarray, float]] = {}
    first = 0
    while first < len(fits):
        # blocks are sized as if all features were used
        spare = max(1, CELLS // (2 + width + (width + 1) * (width + 2) // 2))
        some = fits[first : first + spare]
        first += len(some)
        l1, l2 = (np.stack(x) for x in zip(*[_penalties(settings[i], scale, m.sd[g], m.n[g]) for i, g in some], strict=True))
        c, used = np.empty((len(some), width + 1)), np.zeros(width + 1, bool)
        used[0] = True
        for k, (i, g) in enumerate(some):
            mixing = settings[i].mixing
            c[k], slope, before = last.get((mixing, g), (start[g], None if at_start is None else at_start[g], np.inf))
            if not l1[k].any():
                used[:] = True
                continue
            reference = before if before < np.inf else float(np.max(np.abs(slope[1:]) / np.where(l1[k, 1:] > 0, l1[k, 1:], 1.0))) * settings[i].penalty
            used |= np.abs(slope) >= l1[k] * (2.0 - reference / settings[i].penalty)
        block = _Block(np.array([g for _, g in some]), l1, l2, c)
        off, rounds, losses, slopes = _fit_block(data, block, groups, m, np.flatnonzero(used), repeats)
        for k, (i, g) in enumerate(some):
            sd = np.where(m.sd[g] > 0, m.sd[g], 1.0)
            raw = block.c[k, 1:] / sd
            out[i, g] = Fitted(float(block.c[k, 0] - raw @ m.mean[g]), raw, float(off[k]), int(rounds[k]), float(losses[k]))
            last[settings[i].mixing, g] = (block.c[k].copy(), slopes[k], settings[i].penalty)
    return out


def scores_of(frame: DataFrame, key: str, models: dict[tuple[int, int], Fitted], groups: Sequence[Group], label: str = "outcome") -> DataFrame:
    """Out-of-fold scores ``(setting, repeat, fold, key, actual, prediction, score)`` of all fits in one scan."""
    by = {(i, groups[g].repeat, groups[g].fold): f for (i, g), f in models.items() if groups[g].fold is not None}
    settings, repeats = sorted({i for i, _, _ in by}), sorted({r for _, r, _ in by})
    width = len(next(iter(by.values())).coefficients)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, n = _matrix(batch, width), batch.num_rows
            folds = _fold_matrix(batch, len(repeats)).astype(np.int32)
            for r, fold in zip(repeats, np.ascontiguousarray(folds.T), strict=True):
                for i in settings:
                    eta = np.full(n, np.nan)
                    for k in np.unique(fold):
                        if f := by.get((i, r, int(k))):
                            rows = fold == k
                            eta[rows] = x[rows] @ f.coefficients + f.intercept
                    p = 1.0 / (1.0 + np.exp(-eta))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, i, np.int32)), pa.array(np.full(n, r, np.int32)), pa.array(fold), batch.column(0), batch.column(1), pa.array((p > 0.5).astype(np.int32)), pa.array(p)],
                        names=["setting", "repeat", "fold", "k", "actual", "prediction", "score"],
                    )

    kinds = [frame.schema[c].dataType.simpleString() for c in (key, label)]
    schema = f"setting int, repeat int, fold int, k {kinds[0]}, actual {kinds[1]}, prediction int, score double"
    out = frame.select(F.col(key).alias("k"), F.col(label).alias("actual"), "features", _folds(repeats)).mapInArrow(each, schema)
    return out.where("not isnan(score)").withColumnRenamed("k", key)


def top_penalty(frame: DataFrame, label: str = "outcome", features: str = "features") -> float:
    """The least penalty at a mixing of one that leaves the unweighted model of scaled features empty."""
    y = F.col("y")
    cells = frame.select(F.col(label).cast("double").alias("y"), F.posexplode(features).alias("feature", "value"))
    spread: Column = F.stddev_pop("value")
    per = cells.groupBy("feature").agg((F.abs(F.covar_pop("value", y)) / F.when(spread > 0, spread)).alias("c"))
    return per.agg(F.max("c").alias("c")).first()["c"] or 0.0


def elastic_net_path(
    frame: DataFrame, names: Sequence[str], mixings: Sequence[float] = (0.5,), length: int = 80, least: float = 1e-4, balanced: bool = False, label: str = "outcome", features: str = "features"
) -> list[dict]:
    """The whole path of each mixing, from the penalty that empties the model down to ``least`` of it, log-spaced."""
    if any(a <= 0 for a in mixings):
        raise ValueError("a path needs mixings above 0")
    top = top_penalty(frame, label, features)
    settings = [Setting(a, float(v)) for a in mixings for v in np.geomspace(top / a, top / a * least, length)]
    fitted = fit_many(frame, settings, scale="population", balanced=balanced, label=label, features=features)
    out = []
    for i, s in enumerate(settings):
        f = fitted[i, 0]
        out.append({"alpha": s.mixing, "step": i % length, "penalty": s.penalty, "intercept": f.intercept, "coefficients": dict(zip(names, map(float, f.coefficients), strict=True)),
                    "n_features": int((f.coefficients != 0).sum()), "loss": f.loss, "off": f.off, "rounds": f.rounds})
    return out
