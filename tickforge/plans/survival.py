"""Survival model and its metrics as Spark jobs.

Times are grid indices (whole multiples of a tenth of a day), so tables per distinct
time are bounded by the time span of the data, not by its row count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickforge.operators.ordering import exact_cut_points
from tickforge.operators.timeline import Timeline

GRID_DAYS = 0.1


# -- curves ----------------------------------------------------------------------


def counts_by_time(df: DataFrame, time: str, event: str) -> DataFrame:
    """(time, deaths, censored, at_risk): at risk means known to reach ``time``."""
    per_time = df.groupBy(F.col(time).alias("time")).agg(
        F.count_if(F.col(event)).alias("deaths"), F.count_if(~F.col(event)).alias("censored")
    )
    # One row per grid time.
    later = Window.orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, 0)
    return per_time.withColumn("at_risk", F.sum(F.col("deaths") + F.col("censored")).over(later))


def kaplan_meier(df: DataFrame, time: str, event: str, censoring: bool = False) -> DataFrame:
    """(time, survival). ``censoring`` gives the curve of staying uncensored, where deaths
    at a time leave before the censored ones are counted."""
    counts = counts_by_time(df, time, event)
    if censoring:
        hazard = F.col("censored") / F.nullif(F.col("at_risk") - F.col("deaths"), F.lit(0))
    else:
        hazard = F.col("deaths") / F.col("at_risk")
    kept = 1 - F.coalesce(hazard, F.lit(0.0))
    upto = Window.orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    # A product as a sum of logarithms; one zero factor makes all later values zero.
    gone = F.max(F.when(kept <= 0, 1).otherwise(0)).over(upto)
    log_sum = F.sum(F.when(kept > 0, F.log(kept)).otherwise(0.0)).over(upto)
    return counts.withColumn("survival", F.when(gone == 1, F.lit(0.0)).otherwise(F.exp(log_sum)))


# -- Cox regression -----------------------------------------------------------------


@dataclass
class CoxModel:
    features: list[str]
    coefficients: list[float]
    means: list[float]
    times: list[float]
    hazard: list[float]
    log_likelihood: float
    steps: int
    converged: bool = True
    #: ``hazard`` in logarithms; empty in models stored without them
    log_hazard: list[float] = field(default_factory=list)


#: Rows of the design, and of the second-moment matrix, handled at once; flags of a wide category handled at once (with
#: all times at most so many cells), and numbers held of them before a task passes them on.
_ROWS = 2048
_PANEL = 64
_FLAG_PANEL = 1024
_FLAG_CELLS = 1 << 20
_HELD = 4_000_000
_SUMS = "key long, top double, sums binary"
_FLAG_SUMS = "key long, codes binary, sums binary, cells binary, weights binary"


def _chunks(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(time, event, centred features, flag) of the design's rows, some at a time; unknown features are NaN."""
    for batch in batches:
        for first in range(0, len(batch), _ROWS):
            part = batch.slice(first, _ROWS)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
            d = part.column("_d").fill_null(False).to_numpy(zero_copy_only=False)
            yield part.column("_t").to_numpy(), d, x - centre, part.column("_c").to_numpy()


def _add(total: dict[int, tuple[float, np.ndarray]], key: int, top: float, sums: np.ndarray) -> None:
    """Adds sums kept over exp(top) to those known of the key."""
    if key in total:
        known, kept = total[key]
        new = max(top, known)
        top, sums = new, kept * np.exp(known - new) + sums * np.exp(top - new)
    total[key] = top, sums


def _packed(total: dict[int, tuple[float, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for key, (top, sums) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([float(top)]), pa.array([sums.tobytes()])], names=["key", "top", "sums"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, tuple[float, np.ndarray]] = {}
    for batch in batches:
        for key, top, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            _add(total, key, top, np.frombuffer(sums))
    yield from _packed(total)


def _sums_by_key(design: DataFrame, part: Callable) -> dict[int, tuple[float, np.ndarray]]:
    """(exponent, sums over its exponential) by key: summed by task, then by key."""
    rows = design.mapInArrow(part, _SUMS).repartition("key").mapInArrow(_merge, _SUMS).collect()
    return {r["key"]: (r["top"], np.frombuffer(r["sums"])) for r in rows}


def _moments(p: int):
    """Per partition: number and sum of the known values, smallest, largest, and sum of the rows with the event."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[float, np.ndarray]] = {}
        low, high = np.full(p, np.inf), np.full(p, -np.inf)
        for _, d, x, _ in _chunks(batches, np.zeros(p)):
            _add(total, 0, 0.0, np.concatenate([np.isfinite(x).sum(axis=0), np.nansum(x, axis=0), x[d].sum(axis=0)]))
            low, high = np.fmin(low, np.fmin.reduce(x, axis=0)), np.fmax(high, np.fmax.reduce(x, axis=0))
        yield from _packed(total)
        # Kept apart by partition: extremes are no sums.
        if total:
            yield from _packed({1 + TaskContext.get().partitionId(): (0.0, np.concatenate([low, high]))})

    return run


def _time_sums(centre: np.ndarray, beta: np.ndarray, flag_beta: np.ndarray):
    """Per partition and time: largest exponent, and sums of weights and of weighted features over its exponential.

    Weights far apart, as of a feature that nearly tells the time, then neither overflow nor vanish.
    """
    by_code = np.append(flag_beta, 0.0)  # the last for rows without a flag

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[float, np.ndarray]] = {}
        for t, _, x, c in _chunks(batches, centre):
            order = np.argsort(t, kind="stable")
            t, x, c = t[order], x[order], c[order]
            exponent = x @ beta + by_code[c]
            moments, first, size = np.unique(t, return_index=True, return_counts=True)
            top = np.maximum.reduceat(exponent, first)
            weight = np.exp(exponent - np.repeat(top, size))
            sums = np.add.reduceat(np.column_stack([weight, x * weight[:, None]]), first, axis=0)
            for key, high, row in zip(moments.tolist(), top.tolist(), sums, strict=True):
                _add(total, key, high, row)
        yield from _packed(total)

    return run


def _gram(centre: np.ndarray, beta: np.ndarray, flag_beta: np.ndarray, times: np.ndarray, log_hazard: np.ndarray):
    """Per partition: sum of x x' weighted by exp(x beta) times the hazard so far, by panels of rows."""
    by_code = np.append(flag_beta, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = len(centre)
        total = np.zeros((p, p))
        for t, _, x, c in _chunks(batches, centre):
            place = np.searchsorted(times, t, side="right") - 1
            x, c, place = x[place >= 0], c[place >= 0], place[place >= 0]
            # Deaths expected of a row: at most as many as there are, however large either factor.
            x = x * np.exp((x @ beta + by_code[c] + log_hazard[place]) / 2)[:, None]
            total += x.T @ x
        yield from _packed({first: (0.0, total[first : first + _PANEL]) for first in range(0, p, _PANEL)})

    return run


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, sums of their values)."""
    order = np.argsort(keys, kind="stable")
    some, first = np.unique(keys[order], return_index=True)
    return some, np.add.reduceat(values[order], first, axis=0) if len(some) else values


def _flag_sums(
    centre: np.ndarray, beta: np.ndarray, flag_beta: np.ndarray, times: np.ndarray, log_hazard: np.ndarray, peak: np.ndarray, width: int
):
    """Per partition, by panels of flags: the flags' part of the second moments, and weights by time and flag.

    A row has one flag at most: the flags' own second moments are a diagonal, beside their products with the features.
    Weights are over the exponential of ``peak``, the largest exponent of the rows at risk from a time on.
    """
    by_code = np.append(flag_beta, 0.0)
    n_times = len(times)

    def packed(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        codes, sums = _summed(*(np.concatenate(v) for v in list(zip(*held, strict=True))[:2]))
        cells, weights = _summed(*(np.concatenate(v) for v in list(zip(*held, strict=True))[2:]))
        for panel in np.unique(codes // width).tolist():
            some = slice(*np.searchsorted(codes, [panel * width, (panel + 1) * width]))
            part = slice(*np.searchsorted(cells, [panel * width * n_times, (panel + 1) * width * n_times]))
            row = [codes[some] - panel * width, sums[some], cells[part] - panel * width * n_times, weights[part]]
            arrays = [pa.array([panel]), *(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in row)]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "codes", "sums", "cells", "weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        numbers = 0
        for t, _, x, c in _chunks(batches, centre):
            place = np.searchsorted(times, t, side="right") - 1
            some = (place >= 0) & (c >= 0)
            if not some.any():
                continue
            x, c, place = x[some], c[some].astype(np.int64), place[some]
            exponent = x @ beta + by_code[c]
            expected = np.exp(exponent + log_hazard[place])[:, None]
            held.append((*_summed(c, np.column_stack([expected, x * expected])), *_summed(c * n_times + place, np.exp(exponent - peak[place]))))
            numbers += held[-1][1].size + held[-1][3].size
            if numbers >= _HELD:
                yield from packed(held)
                held, numbers = [], 0
        if held:
            yield from packed(held)

    return run


def _merge_flags(n_sums: int):
    """One row a panel, of rows in the order of their panels."""

    def packed(key: int, held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        codes, sums, cells, weights = (np.concatenate(v) for v in zip(*held, strict=True))
        row = [*_summed(codes, sums), *_summed(cells, weights)]
        arrays = [pa.array([key]), *(pa.array([v.tobytes()], pa.binary()) for v in row)]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "codes", "sums", "cells", "weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        last = None
        for key, *row in _flag_rows(batches, n_sums):
            if held and key != last:
                yield packed(last, held)
                held = []
            last = key
            held.append(row)
        if held:
            yield packed(last, held)

    return run


def _flag_rows(batches: Iterator[pa.RecordBatch], n_sums: int) -> Iterator[tuple]:
    """(panel, flags in it, their sums, (flag, time) cells, their weights) of each row."""
    for batch in batches:
        for i in range(len(batch)):
            key, codes, sums, cells, weights = (column[i].as_py() for column in batch.columns)
            yield key, np.frombuffer(codes, np.int64), np.frombuffer(sums).reshape(-1, n_sums), np.frombuffer(cells, np.int64), np.frombuffer(weights)


class _FlagSystem:
    """The flags' part of a Newton step from rows of ``_merge_flags``: a panel at a time, whatever the number of flags.

    S - M' M has, for the flags, the diagonal ``own`` and the products ``cross`` with the features in S, and in M one row
    a time: the share of the weights at risk that the flag has.
    """

    def __init__(self, n: int, p: int, width: int, ridge: float, d: np.ndarray, peak: np.ndarray, log_s0: np.ndarray, beta: np.ndarray, dead: np.ndarray):
        self.n, self.p, self.width, self.ridge, self.d, self.beta, self.dead = n, p, width, ridge, d, beta, dead
        self.fade = np.exp(peak[1:] - peak[:-1])
        self.share = np.exp(peak - log_s0)

    def panels(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(panel, flags, own, cross, means over the root of the time's deaths, slope)."""
        d, n_times = self.d, len(self.d)
        for key, codes, sums, cells, weights in _flag_rows(batches, 1 + self.p):
            flags = key * self.width + codes
            at_risk = np.zeros((n_times, len(codes)))
            at_risk[cells % n_times, np.searchsorted(codes, cells // n_times)] = weights
            for i in range(n_times - 2, -1, -1):
                at_risk[i] += at_risk[i + 1] * self.fade[i]
            means = (at_risk * self.share[:, None]).T
            slope = (self.dead[flags] - means @ d) / self.n - self.ridge * self.beta[flags]
            yield key, flags, sums[:, 0] / self.n + self.ridge, sums[:, 1:] / self.n, means * np.sqrt(d / self.n), slope

    def eliminated(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Products of (cross, means, slope) over ``own``, summed over the flags, by panels of rows."""
        m = self.p + len(self.d) + 1
        total = np.zeros((m, m))
        for _, _, own, cross, means, slope in self.panels(batches):
            z = np.column_stack([cross, means, slope])
            total += z.T @ (z / own[:, None])
        yield from _packed({first: (0.0, total[first : first + _PANEL]) for first in range(0, m, _PANEL)})

    def moves(self, both: np.ndarray):
        """Numbers of the flags and their moves, given those of the features and the unknowns of the times."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, flags, own, cross, means, slope in self.panels(batches):
                yield pa.RecordBatch.from_arrays([pa.array(flags), pa.array((slope - cross @ both[: self.p] + means @ both[self.p :]) / own)], names=["flag", "move"])

        return run


def _inner_system(square: np.ndarray, means: np.ndarray, slope: np.ndarray, products: np.ndarray) -> np.ndarray:
    """Moves of the features and the unknowns of the times, after the flags are eliminated."""
    p = len(square)
    left = means - products[p:-1, :p]
    inner = np.block([[square - products[:p, :p], -left.T], [left, products[p:-1, p:-1] - np.eye(len(means))]])
    known = np.concatenate([slope - products[:p, -1], -products[p:-1, -1]])
    both = np.linalg.solve(inner, known)
    return both + np.linalg.solve(inner, known - inner @ both)  # once refined


def fit_cox(
    df: DataFrame,
    features: list[str],
    time: str,
    event: str,
    alpha: float = 0.1,
    grid: float = GRID_DAYS,
    max_steps: int = 30,
    tolerance: float = 1e-9,
    wide: tuple[str, list[str]] | None = None,
) -> CoxModel:
    """Proportional hazards by Newton steps: maximises log likelihood - alpha / 2 * (sum of squared coefficients).

    Steps stop once the objective, divided by the number of rows, changes by at most ``tolerance``. ``converged``
    tells if they did; a step that lowers the objective however short is never taken. Ties follow Breslow. A step is two passes over the cached rows. The first gives, per
    time, the weight and weighted feature sums of rows leaving at it; summed from the
    latest time backwards they are the risk sets. Because each row belongs to the risk
    set of all times up to its own, the second-moment part of the Hessian is one p x p
    sum with each row weighted by the cumulative hazard at its time. Rows without a
    known time are in no risk set. What reaches the driver is one array of p + 1 numbers per grid time and one p x p matrix.

    ``wide`` names one column of numbers and the 0/1 features that they stand for: number k (null: none) sets the k-th.
    These need no columns, and no p x p matrix: a row has one at most, so that theirs is a diagonal. They are eliminated
    first, by panels of flags in tasks, which leaves one unknown a feature and one a grid time; of each flag the driver
    gets its counts and its move.
    """
    number, flag_names = wide or (None, [])
    place_of = {c: i for i, c in enumerate(features)}
    flagged = set(flag_names)
    names = [c for c in features if c not in flagged]
    p, n_flags = len(names), len(flag_names)
    design = df.select(
        F.col(time).cast("long").alias("_t"),
        F.col(event).cast("boolean").alias("_d"),
        F.array(*[F.col(f"`{c}`").cast("double") for c in names]).cast("array<double>").alias("x"),
        F.coalesce(F.col(number).cast("int") if wide else F.lit(None), F.lit(-1)).alias("_c"),
    ).filter("_t is not null").persist()
    try:
        deaths = design.groupBy("_t").agg(F.count(F.lit(1)).alias("n"), F.count_if("_d").alias("d")).toPandas().sort_values("_t")
        n = int(deaths["n"].sum())
        if n == 0:
            raise ValueError("the training set is empty: no row has a known target")
        deaths = deaths[deaths["d"] > 0]
        death_at = deaths["_t"].to_numpy(dtype=np.int64)
        d = deaths["d"].to_numpy(dtype=float)
        if not len(d):
            raise ValueError("the training set has no observed event")
        moments = {k: v for k, (_, v) in _sums_by_key(design, _moments(p)).items()}
        known, total, at_events = np.split(moments.pop(0), 3)
        low, high = np.split(np.stack(list(moments.values())), 2, axis=1)
        centre = total / known
        varies = high.max(axis=0) - low.min(axis=0) > 1e-12
        event_sum = at_events - d.sum() * centre
        # Flags stay 0 or 1 in all sums; their means only move the hazard, at the end.
        share, dead = np.zeros(n_flags), np.zeros(n_flags)
        if n_flags:
            found = design.filter("_c >= 0").groupBy("_c").agg(F.count(F.lit(1)).alias("n"), F.count_if("_d").alias("d")).toArrow()
            share[found["_c"].to_numpy()], dead[found["_c"].to_numpy()] = found["n"].to_numpy() / n, found["d"].to_numpy()
            varies = np.concatenate([varies, (share > 0) & (share < 1)])
            event_sum = np.concatenate([event_sum, dead])
        width = max(1, min(_FLAG_PANEL, _FLAG_CELLS // len(d)))

        def risk_sets(beta: np.ndarray):
            table = _sums_by_key(design, _time_sums(centre, beta[:p], beta[p:]))
            at = np.array(sorted(table))
            peak = np.array([table[t][0] for t in at.tolist()])
            from_here = np.stack([table[t][1] for t in at.tolist()])
            top = np.maximum.accumulate(peak[::-1])[::-1]
            from_here *= np.exp(peak - top)[:, None]
            for i in range(len(at) - 2, -1, -1):
                from_here[i] += from_here[i + 1] * np.exp(top[i + 1] - top[i])
            place = np.searchsorted(at, death_at)
            here = from_here[place]
            log_s0, mean = np.log(here[:, 0]) + top[place], here[:, 1:] / here[:, :1]
            fit = event_sum @ beta - (d * log_s0).sum()
            return log_s0, mean, (fit - 0.5 * alpha * beta @ beta) / n, top[place]

        def newton_move(beta: np.ndarray, log_s0: np.ndarray, mean: np.ndarray, peak: np.ndarray) -> np.ndarray:
            slope = (event_sum[:p] - d @ mean) / n - alpha / n * beta[:p]
            log_hazard = np.logaddexp.accumulate(np.log(d) - log_s0)
            square = alpha / n * np.eye(p)
            for first, (_, sums) in _sums_by_key(design, _gram(centre, beta[:p], beta[p:], death_at, log_hazard)).items():
                square[first : first + _PANEL] += sums.reshape(-1, p) / n
            means = mean * np.sqrt(d / n)[:, None]
            if not n_flags:
                return np.linalg.solve(square - means.T @ means, slope)
            flags = design.mapInArrow(_flag_sums(centre, beta[:p], beta[p:], death_at, log_hazard, peak, width), _FLAG_SUMS)
            flags = flags.repartition("key").sortWithinPartitions("key").mapInArrow(_merge_flags(1 + p), _FLAG_SUMS).persist()
            try:
                system = _FlagSystem(n, p, width, alpha / n, d, peak, log_s0, beta[p:], dead)
                m = p + len(d) + 1
                products = np.zeros((m, m))
                for first, (_, sums) in _sums_by_key(flags, system.eliminated).items():
                    products[first : first + _PANEL] = sums.reshape(-1, m)
                both = _inner_system(square, means, slope, products)
                moved = flags.mapInArrow(system.moves(both), "flag long, move double").toArrow()
            finally:
                flags.unpersist()
            rest = np.zeros(n_flags)  # a flag of no row at risk stays
            rest[moved["flag"].to_numpy()] = moved["move"].to_numpy()
            return np.concatenate([both[:p], rest])

        beta = np.zeros(p + n_flags)
        log_s0, mean, value, peak = risk_sets(beta)
        steps, converged = 0, False
        for steps in range(1, max_steps + 1):
            move = np.where(varies, newton_move(beta, log_s0, mean, peak), 0.0)
            gain = 1.0
            for _ in range(20):  # halve until the objective does not fall
                log_s0_new, mean_new, new, peak_new = risk_sets(beta + gain * move)
                if np.isfinite(new) and new >= value - 1e-12:
                    break
                gain /= 2
            else:
                break  # no shorter step helps: stay here, not converged
            beta = beta + gain * move
            converged = bool(abs(new - value) <= tolerance)
            log_s0, mean, value, peak = log_s0_new, mean_new, new, peak_new
            if converged:
                break
        # Centred as the risk is: exponents without the flags' means.
        log_hazard = np.logaddexp.accumulate(np.log(d) - log_s0) + share @ beta[p:]
    finally:
        design.unpersist()
    order = np.argsort([place_of[c] for c in [*names, *flag_names]])
    beta, centre = beta[order], np.concatenate([centre, share])[order]
    with np.errstate(over="ignore"):
        hazard = np.exp(log_hazard)
    return CoxModel(
        list(features),
        beta.tolist(),
        centre.tolist(),
        (death_at * grid).tolist(),
        hazard.tolist(),
        float(value * n),
        steps,
        converged,
        log_hazard.tolist(),
    )


def risk_score(model: CoxModel) -> Column:
    """Linear predictor of the centred features. One flat array, so that any number of columns makes no deep expression."""
    if not model.features:
        return F.lit(0.0)
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in model.features])
    centred = F.zip_with(values, F.lit(np.array(model.means, dtype=float)), lambda x, m: x - m)
    terms = F.zip_with(centred, F.lit(np.array(model.coefficients, dtype=float)), lambda x, b: x * b)
    return F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)


def median_life(model: CoxModel, risk: Column) -> Column:
    """First grid time where survival is at most one half, else the last time known."""
    times = np.array(model.times)
    if model.log_hazard:
        log_hazard = np.array(model.log_hazard)
    else:
        with np.errstate(divide="ignore"):
            log_hazard = np.log(np.array(model.hazard))
    half = np.log(np.log(2.0))

    @F.pandas_udf("double")
    def first_time(score: pd.Series) -> pd.Series:
        # S = exp(-hazard * e^score) <= 1/2 from the first hazard >= ln 2 / e^score on
        place = np.searchsorted(log_hazard, half - score.to_numpy(dtype=float), side="left")
        return pd.Series(times[np.minimum(place, len(times) - 1)])

    return F.when(risk.isNotNull(), first_time(risk))


# -- ranking metrics ------------------------------------------------------------------


def _pair_counts(groups: DataFrame, keys: list[str], block_rows: int | None) -> DataFrame:
    """Per group: better, tied and all (case, control) pairs by risk, weighted by case.

    Input rows are distinct (group, risk) with ``cases`` (weight) and ``controls``. A case
    should have the higher risk. Controls below come from a running sum in risk order.
    """
    line = Timeline(groups, keys, ["risk"], block_rows).running_sum({"below": F.col("controls")}, own_row=False)
    return line.df.groupBy(*keys).agg(
        F.sum(F.col("cases") * F.col("below")).alias("better"),
        F.sum(F.col("cases") * F.col("controls")).alias("tied"),
        F.sum("cases").alias("cases"),
        F.sum("controls").cast("double").alias("controls"),
    )


def concordance(df: DataFrame, time: str, event: str, risk: str, block_rows: int | None = None) -> DataFrame:
    """One row: comparable pairs, concordant, tied and the concordance index. Exact.

    Pair (i, j) compares when i had the event and left earlier, or left at the same time
    where j did not have it. No pairs are formed: two different times agree on their
    leading binary digits and differ in exactly one first digit, so each pair is counted
    in the one (digit, leading digits) group where i has 0 and j has 1, by a running sum
    in risk order. The cost is the number of rows times the digits of the largest time.
    """
    base = df.select(
        F.col(time).cast("long").alias("t"), F.col(event).cast("boolean").alias("d"), F.col(risk).cast("double").alias("risk")
    ).filter("t is not null and risk is not null")
    per_row = base.groupBy("t", "risk").agg(F.count_if("d").alias("dead"), F.count_if(~F.col("d")).alias("alive"))
    digits = int(base.agg(F.max("t")).first()[0] or 0).bit_length()
    levels = F.explode(F.sequence(F.lit(-1), F.lit(digits - 1)) if digits else F.array(F.lit(-1))).alias("level")
    spread = per_row.select("*", levels)
    zero = F.expr("shiftright(t, cast(greatest(level, 0) as int)) % 2 = 0")
    same_time = F.col("level") == -1
    groups = (
        spread.select(
            "level",
            F.when(same_time, F.col("t")).otherwise(F.expr("shiftright(t, cast(level + 1 as int))")).alias("lead"),
            "risk",
            F.when(same_time | zero, F.col("dead")).otherwise(0).alias("cases"),
            F.when(same_time, F.col("alive")).when(zero, 0).otherwise(F.col("dead") + F.col("alive")).alias("controls"),
        )
        .groupBy("level", "lead", "risk")
        .agg(F.sum("cases").cast("double").alias("cases"), F.sum("controls").alias("controls"))
    )
    total = _pair_counts(groups, ["level", "lead"], block_rows).agg(
        F.sum(F.col("cases") * F.col("controls")).alias("comparable"),
        F.sum("better").alias("concordant"),
        F.sum("tied").alias("tied"),
    )
    return total.withColumn("c_index", (F.col("concordant") + 0.5 * F.col("tied")) / F.nullif(F.col("comparable"), F.lit(0.0)))


def dynamic_auc(
    train: DataFrame,
    test: DataFrame,
    time: str,
    event: str,
    risk: str,
    horizons: list[int],
    block_rows: int | None = None,
) -> DataFrame:
    """(horizon, auc) rows: do rows that fail by the horizon outrank those that outlive it?

    Failures are weighted by the inverse chance of having stayed uncensored until then,
    estimated on train. Horizons outside the test follow-up give null.
    """
    stay = kaplan_meier(train, time, event, censoring=True).select(F.col("time").alias("t"), F.col("survival").alias("g"))
    base = test.select(
        F.col(time).cast("long").alias("t"), F.col(event).cast("boolean").alias("d"), F.col(risk).cast("double").alias("risk")
    )
    per_row = base.groupBy("t", "risk").agg(F.count_if("d").alias("dead"), F.count_if(~F.col("d")).alias("alive"))
    # The censoring curve holds one row per train grid time; step it to the test times.
    times = base.select("t").distinct()
    both = stay.select("t", "g", F.lit(0).alias("s")).unionByName(
        times.select("t", F.lit(None).cast("double").alias("g"), F.lit(1).alias("s"))
    )
    step = Window.orderBy("t", "s").rowsBetween(Window.unboundedPreceding, 0)
    curve = both.withColumn("g", F.last("g", ignorenulls=True).over(step)).filter("s = 1").select(
        "t", F.coalesce("g", F.lit(1.0)).alias("g")
    )
    weighted = per_row.join(curve, "t")
    asked = F.explode(F.array(*[F.lit(h).cast("long") for h in horizons])).alias("horizon")
    groups = (
        weighted.select("*", asked)
        .select(
            "horizon",
            "risk",
            F.when(F.col("t") <= F.col("horizon"), F.col("dead") / F.nullif(F.col("g"), F.lit(0.0))).otherwise(0.0).alias("cases"),
            F.when(F.col("t") > F.col("horizon"), F.col("dead") + F.col("alive")).otherwise(0).alias("controls"),
        )
        .groupBy("horizon", "risk")
        .agg(F.sum("cases").alias("cases"), F.sum("controls").alias("controls"))
    )
    pairs = _pair_counts(groups, ["horizon"], block_rows)
    auc = (F.col("better") + 0.5 * F.col("tied")) / F.nullif(F.col("cases") * F.col("controls"), F.lit(0.0))
    low, high = base.agg(F.min("t")).scalar(), base.agg(F.max("t")).scalar()
    inside = (F.col("horizon") >= low) & (F.col("horizon") < high)
    return pairs.select("horizon", F.when(inside, auc).alias("auc"))


def mean_auc(auc: DataFrame, test: DataFrame, time: str, event: str) -> DataFrame:
    """One row: horizons' AUC averaged by how much test survival drops up to each."""
    curve = kaplan_meier(test, time, event).select(F.col("time").alias("t"), "survival")
    both = curve.select("t", "survival", F.lit(None).cast("double").alias("auc"), F.lit(0).alias("s")).unionByName(
        auc.select(F.col("horizon").alias("t"), F.lit(None).cast("double").alias("survival"), "auc", F.lit(1).alias("s"))
    )
    step = Window.orderBy("t", "s").rowsBetween(Window.unboundedPreceding, 0)
    at = both.withColumn("survival", F.coalesce(F.last("survival", ignorenulls=True).over(step), F.lit(1.0))).filter("s = 1")
    drop = F.lag("survival", 1, 1.0).over(Window.orderBy("t")) - F.col("survival")
    return at.withColumn("drop", drop).agg(
        (F.sum(F.col("auc") * F.col("drop")) / F.nullif(1 - F.min("survival"), F.lit(0.0))).alias("auc_moyen")
    )


# -- feature ranking ---------------------------------------------------------------------


def mutual_information(
    df: DataFrame, features: list[str], target: str, bins: int = 16, small_rows: int | None = None
) -> DataFrame:
    """(feature, mi): information shared with the target after binning both by quantile.

    Cut points are exact at every size; joint counts come from a second pass, reduced on
    the map side to at most bins x bins cells per feature.
    """
    names = [*features, target]
    cuts = exact_cut_points(df, {c: F.col(c) for c in names}, [i / bins for i in range(1, bins)], small_rows)

    def bin_of(c: str) -> Column:
        edges = cuts[c]
        total = F.lit(0)
        for e in edges:
            total = total + F.when(F.col(c) > e, 1).otherwise(0)
        return total

    cells = df.filter(F.col(target).isNotNull()).select(
        bin_of(target).alias("by"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.when(F.col(c).isNotNull(), bin_of(c)).alias("bx")) for c in features])),
    )
    joint = cells.filter("bx is not null").groupBy("feature", "bx", "by").agg(F.count(F.lit(1)).cast("double").alias("n"))
    # At most bins x bins rows per feature from here on.
    per = Window.partitionBy
    parts = joint.withColumns(
        {
            "all": F.sum("n").over(per("feature")),
            "nx": F.sum("n").over(per("feature", "bx")),
            "ny": F.sum("n").over(per("feature", "by")),
        }
    )
    return parts.groupBy("feature").agg(
        F.sum(F.col("n") / F.col("all") * F.log(F.col("n") * F.col("all") / (F.col("nx") * F.col("ny")))).alias("mi")
    )
