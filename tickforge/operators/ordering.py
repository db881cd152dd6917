"""Global ranks and exact quantiles without one task seeing all rows."""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickforge.operators.timeline import Timeline, surely_small
from tickforge.session import checkpoint_dir

SMALL_ROWS = 200_000
# Rank error of the sketch that brackets a quantile, and the bracket around it.
_SKETCH_ACCURACY = 10_000
_BRACKET = 3.0 / _SKETCH_ACCURACY


def rank_all(df: DataFrame, column: str, name: str, small_rows: int | None = None) -> DataFrame:
    """Rank 1..n of distinct values in sort order.

    Unless the scanned tables are small, the values are first written to the checkpoint
    folder, which shows how many there are.
    """
    limit = small_rows if small_rows is not None else SMALL_ROWS
    if surely_small(df, limit):
        return rank_written(df, column, name, True)
    checkpoint_dir(df.sparkSession)
    df = df.checkpoint()
    return rank_written(df, column, name, df.count() <= limit)


def rank_written(df: DataFrame, column: str, name: str, small: bool) -> DataFrame:
    """Ranks of values that are cheap to read again.

    Many values are range-partitioned and sorted, and each row gets (partition, place),
    written so that both uses below see the same partitions even when executors are
    lost. Counts per partition then give each partition its offset.
    """
    if small:
        return df.withColumn(name, F.row_number().over(Window.orderBy(column)).cast("long"))
    placed = (
        df.repartitionByRange(F.col(column))
        .sortWithinPartitions(column)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
        .checkpoint()
    )
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    ranked = placed.join(offsets, "_part")
    return ranked.withColumn(name, F.col("_offset") + F.col("_place") + 1).drop("_part", "_place", "_offset")


def _as_double(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[F.nanvl(c.cast("double"), F.lit(None)).alias(n) for n, c in columns.items()])


def exact_quantiles(
    df: DataFrame, columns: dict[str, Column], q: float, small_rows: int | None = None, block_rows: int | None = None
) -> DataFrame:
    """One row with the linearly interpolated ``q`` quantile of each numeric expression; NaN counts as missing.

    Small inputs use one exact aggregate. Larger ones take two passes: a mergeable
    sketch brackets the quantiles, then only values inside the brackets are counted one by
    one and scanned in order, which gives the exact order statistics.
    """
    return _quantiles(_as_double(df, columns), {n: (n, q) for n in columns}, small_rows, block_rows)


def exact_cut_points(
    df: DataFrame, columns: dict[str, Column], marks: list[float], small_rows: int | None = None, block_rows: int | None = None
) -> dict[str, list[float]]:
    """Distinct exact quantiles of each expression at all ``marks``, in order."""
    wanted = {f"{n}@{i}": (n, q) for n in columns for i, q in enumerate(marks)}
    row = _quantiles(_as_double(df, columns), wanted, small_rows, block_rows).first()
    return {n: sorted({row[f"{n}@{i}"] for i in range(len(marks))} - {None}) for n in columns}


def _quantiles(flat: DataFrame, wanted: dict[str, tuple[str, float]], small_rows: int | None, block_rows: int | None) -> DataFrame:
    """``wanted`` maps an output name to (column of ``flat``, quantile).

    All quantiles of a column share one aggregate, one sketch and one set of brackets, so that memory grows with the
    columns and not with the quantiles asked of each.
    """
    limit = small_rows if small_rows is not None else SMALL_ROWS
    marks: dict[str, list[float]] = {}
    for c, q in wanted.values():
        marks.setdefault(c, []).append(q)
    sources = sorted(marks)
    counted = flat.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(f"`{c}`").alias(c) for c in sources]).first()
    if counted["_rows"] <= limit:
        exact = flat.agg(*[F.percentile(F.col(f"`{c}`"), F.array(*map(F.lit, marks[c]))).alias(c) for c in sources])
        return exact.select(*[F.get(F.col(f"`{c}`"), F.lit(marks[c].index(q))).alias(n) for n, (c, q) in wanted.items()])
    known = [c for c in sources if counted[c]]
    edges = {}
    for c in known:
        reach = max(_BRACKET, 2.0 / counted[c])  # both neighbours of the quantile lie inside
        edges[c] = [(max(0.0, q - reach), min(1.0, q + reach)) for q in marks[c]]
    brackets = {}
    if known:
        asked = [F.percentile_approx(f"`{c}`", F.array(*[F.lit(e) for pair in edges[c] for e in pair]), _SKETCH_ACCURACY).alias(c) for c in known]
        sketch = flat.agg(*asked).first()
        brackets = {c: _disjoint(list(zip(sketch[c][::2], sketch[c][1::2]))) for c in known}
    places = {(c, q): q * (counted[c] - 1) for c in known for q in marks[c]}
    ranks = {c: sorted({min(int(places[c, q] // 1) + k, counted[c] - 1) for q in marks[c] for k in (0, 1)}) for c in known}
    at: dict[tuple[str, int], float] = {}
    while brackets:
        found = _at_ranks(flat, brackets, ranks, block_rows)
        again = {}
        for c, pairs in brackets.items():
            missed = [k for k in ranks[c] if (c, k) not in found or not found[c, k][1]]
            at |= {(c, k): found[c, k][0] for k in ranks[c] if k not in missed}
            if missed:  # a sketch worse than it says: the whole gap that holds the rank
                tops = [-math.inf, *[high for _, high in pairs]]
                gaps = {bisect.bisect_left([low for low, _ in pairs], found[c, k][0]) if (c, k) in found else len(pairs) for k in missed}
                again[c] = _disjoint([(tops[g], [*[low for low, _ in pairs], math.inf][g]) for g in gaps])
                ranks[c] = missed
        brackets = again
    row = []
    for c, q in wanted.values():
        if not counted[c]:
            row.append(None)
            continue
        low = int(places[c, q] // 1)
        share = places[c, q] - low
        row.append(at[c, low] + (at.get((c, low + 1), at[c, low]) - at[c, low]) * share if share else at[c, low])
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in wanted])
    return flat.sparkSession.createDataFrame([tuple(row)], schema)


def _disjoint(pairs: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Closed intervals that cover the same values, in order, none touching another."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(pairs):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _counted_values(edges: list[tuple[np.ndarray, np.ndarray]]):
    """Per column (number), each value inside a bracket with its count, and before each bracket (its start, ``_in`` 0) the
    count of the values between it and the one below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = [np.zeros(len(low) + 1, np.int64) for low, _ in edges]

        def rows(column: int, values: np.ndarray, inside: int, counts: np.ndarray) -> pa.RecordBatch:
            n = len(values)
            arrays = [pa.array(np.full(n, column, np.int32)), pa.array(values), pa.array(np.full(n, inside, np.int32)), pa.array(counts.astype(np.int64))]
            return pa.RecordBatch.from_arrays(arrays, names=["_col", "_v", "_in", "_n"])

        for batch in batches:
            for i, (low, high) in enumerate(edges):
                v = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                place = np.searchsorted(low, v, side="right")
                inside = (place > 0) & (v <= high[place - 1])
                between[i] += np.bincount(place[~inside], minlength=len(low) + 1)
                if inside.any():
                    values, counts = np.unique(v[inside], return_counts=True)
                    yield rows(i, values, 1, counts)
        for i, (low, _) in enumerate(edges):
            if between[i][:-1].any():
                yield rows(i, low, 0, between[i][:-1])

    return run


def _at_ranks(
    flat: DataFrame, brackets: dict[str, list[tuple[float, float]]], ranks: dict[str, list[int]], block_rows: int | None
) -> dict[tuple[str, int], tuple[float, bool]]:
    """(value, whether it is one) at each rank from 0: outside the brackets, the start of the next one."""
    names = list(brackets)
    edges = [tuple(np.array(side, dtype=float) for side in zip(*brackets[c])) for c in names]
    values = flat.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(names)]).mapInArrow(_counted_values(edges), "_col int, _v double, _in int, _n long")
    counts = values.groupBy("_col", "_v", "_in").agg(F.sum("_n").alias("_n"))
    line = Timeline(counts, ["_col"], ["_v", "_in"], block_rows).running_sum({"_upto": F.col("_n")})
    pairs = [(i, k) for i, c in enumerate(names) for k in ranks[c]]
    asked = F.broadcast(flat.sparkSession.createDataFrame(pairs, "_col int, _k long"))  # a few a quantile
    hit = (F.col("_k") < F.col("_upto")) & (F.col("_k") >= F.col("_upto") - F.col("_n"))
    rows = line.df.join(asked, "_col").filter(hit).select("_col", "_k", "_v", "_in").collect()
    return {(names[r["_col"]], r["_k"]): (r["_v"], r["_in"] == 1) for r in rows}
