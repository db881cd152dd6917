"""Ordered history per key, safe when one key holds a large share of all rows.

Window functions put a whole key into one task. ``Timeline`` keeps that plan while
every key is small. A key with more rows than ``block_rows`` is cut along its order
axis into blocks of at most about ``block_rows`` rows: windows then run per
(key, block), and what a block needs from the others travels as one summary row per
block (a prefix scan over summaries). Bounded row frames copy the few rows at each
block border instead. Results are the same in both forms.

The cut is planned from exact counts: one grouped count finds the large keys, a second
one over the large keys only checks the densest cell. Rows with equal (key, axis) stay
together; the data model has one row per key and instant for each reading kind.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickforge.session import checkpoint_dir

BLOCK_ROWS = 1_000_000
# Only this many keys are planned on the driver, largest first. With N rows a key
# left out has at most N / MAX_SPLIT_KEYS rows and simply stays whole.
MAX_SPLIT_KEYS = 20_000
# A step over cut keys reads its input twice (rows and block summaries). After this many
# steps the rows are written to the checkpoint folder, so that a long chain grows
# linearly instead of doubling with every step.
STEPS_PER_CHECKPOINT = 2
_BLOCK = "_block"


def _axis_number(df: DataFrame, axis: str) -> Column:
    """The axis as a number: microseconds for timestamps."""
    kind = df.schema[axis].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(axis).cast("timestamp")).cast("double")
    return F.col(axis).cast("double")


# Rows of Parquet scans by their files and size, so that each is counted once a session.
_ROWS: dict[tuple, int] = {}
_COUNTED: dict[int, int] = {}
# Rows that a scanned row may become before a window (one a sensor), and the bytes a row may take when rows are
# counted: larger scans are not small, and their footers need not be read.
SPREAD = 8
_BYTES_A_ROW = 64


def note_rows(df: DataFrame, rows: int) -> None:
    """Remembers the counted rows of a checkpointed frame, whose plan tells only a guess of its size."""
    if hasattr(df, "_jdf"):
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        if leaves.size() == 1:
            _COUNTED[leaves.apply(0).semanticHash()] = rows


def _scan_rows(df: DataFrame, leaf, most: int) -> int:
    """Rows that one scanned table may give: from its size where that is small enough, else from Parquet footers."""
    known = _COUNTED.get(leaf.semanticHash())
    if known is not None:
        return SPREAD * known
    size = int(str(leaf.stats().sizeInBytes()))
    if 16 * size <= most or size > most * _BYTES_A_ROW or not leaf.getClass().getName().endswith(".LogicalRelation"):
        return 16 * size
    relation = leaf.relation()
    if not relation.getClass().getName().endswith(".HadoopFsRelation") or "Parquet" not in relation.fileFormat().toString():
        return 16 * size
    files = tuple(relation.location().inputFiles())
    if (files, size) not in _ROWS:
        _ROWS[files, size] = df.sparkSession.read.parquet(*files).count()
    return SPREAD * _ROWS[files, size]


def surely_small(df: DataFrame, block_rows: int) -> bool:
    """True when the scanned tables leave no room for ``block_rows`` rows.

    Adds up the rows of each table the plan reads, once per table: joins here add columns, not rows, so output
    estimates (products of sizes) would say nothing. A scanned row may become ``SPREAD`` rows. A wrong answer only costs a larger task, never a result: no
    step chooses its method by it.
    """
    if not hasattr(df, "_jdf"):  # remote session: no plan at hand
        return False
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    scans = {}
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        scans.setdefault(leaf.semanticHash(), leaf)
    return sum(_scan_rows(df, leaf, block_rows) for leaf in scans.values()) <= block_rows


def plan_cells(df: DataFrame, keys: list[str], axis: str, block_rows: int) -> list[tuple]:
    """(key..., low, cell width) of every key that must be cut.

    Cells are equal-width along the axis and get narrower, per key, until the densest
    one fits or the axis cannot be cut further.
    """
    if surely_small(df, block_rows):
        return []
    slim = df.select(*keys, _axis_number(df, axis).alias("_x"))
    large = (
        slim.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        .filter((F.col("_n") > block_rows) & (F.col("_hi") > F.col("_lo")))
        .orderBy(F.desc("_n"))
        .limit(MAX_SPLIT_KEYS)
        .collect()
    )
    if not large:
        return []
    open_cells = {
        tuple(r[k] for k in keys): (r["_lo"], (r["_hi"] - r["_lo"]) / max(1, -(-2 * r["_n"] // block_rows)))
        for r in large
    }
    done: dict[tuple, tuple] = {}
    for _ in range(12):
        rows = [(*key, lo, width) for key, (lo, width) in open_cells.items()]
        cells = _cell_table(df, keys, rows)
        densest = (
            _on_keys(slim, F.broadcast(cells), keys, "inner")
            .groupBy(*keys, F.floor((F.col("_x") - F.col("_lo")) / F.col("_w")).alias("_c"))
            .count()
            .groupBy(*keys)
            .agg(F.max("count").alias("_n"))
            .collect()
        )
        for r in densest:
            key = tuple(r[k] for k in keys)
            lo, width = open_cells[key]
            if r["_n"] <= block_rows or abs(lo) + width == abs(lo):
                done[key] = open_cells.pop(key)
            else:
                open_cells[key] = (lo, width / 2 ** max(1, int(r["_n"] // block_rows).bit_length()))
        if not open_cells:
            break
    done.update(open_cells)
    return [(*key, lo, width) for key, (lo, width) in done.items()]


def _on_keys(df: DataFrame, plan: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys, null included: rows without a key may be many and are cut too."""
    plan = plan.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(plan[f"_k_{k}"]) for k in keys])
    return df.join(plan, on, how).drop(*[f"_k_{k}" for k in keys])


def _cell_table(df: DataFrame, keys: list[str], cells: list[tuple]) -> DataFrame:
    """Planned cells as a small local table: at most MAX_SPLIT_KEYS rows."""
    schema = T.StructType(
        [df.schema[k] for k in keys] + [T.StructField("_lo", T.DoubleType()), T.StructField("_w", T.DoubleType())]
    )
    columns = [list(c) for c in zip(*cells)]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow)]
    return df.sparkSession.createDataFrame(pa.Table.from_arrays(arrays, names=arrow.names))


class Timeline:
    """Rows of ``df`` ordered by ``order`` (axis first, then tie-breakers) within ``keys``.

    Every method returns a new timeline whose ``df`` has further columns. ``plan_on`` is a
    cheaper frame with the same keys and axis (such as the stored rows that a long chain
    starts from) to count instead of ``df``; it only decides where keys are cut.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        order: list[str],
        block_rows: int | None = None,
        plan_on: DataFrame | None = None,
    ):
        self.keys = list(keys)
        self.order = list(order)
        self.block_rows = block_rows or BLOCK_ROWS
        counted = df if plan_on is None else plan_on
        cells = plan_cells(counted, self.keys, self.order[0], self.block_rows)
        self.split = bool(cells)
        self._steps = 0
        if self.split:
            plan = F.broadcast(_cell_table(df, self.keys, cells))
            cell = F.floor((_axis_number(df, self.order[0]) - F.col("_lo")) / F.col("_w"))
            df = (
                _on_keys(df, plan, self.keys, "left")
                .withColumn(_BLOCK, F.coalesce(cell, F.lit(0)).cast("long"))
                .drop("_lo", "_w")
            )
        self._df = df

    @property
    def df(self) -> DataFrame:
        return self._df.drop(_BLOCK)

    def with_columns(self, columns: dict[str, Column]) -> "Timeline":
        return self._with(self._df.withColumns(columns))

    def filter(self, condition: Column) -> "Timeline":
        return self._with(self._df.filter(condition))

    def drop(self, *names: str) -> "Timeline":
        return self._with(self._df.drop(*names))

    # -- windows ---------------------------------------------------------------

    def _with(self, df: DataFrame, steps: int = 0) -> "Timeline":
        other = object.__new__(Timeline)
        other._steps = self._steps + steps
        other.keys, other.order, other.block_rows = self.keys, self.order, self.block_rows
        other.split = self.split
        other._df = df
        return other

    def _settled(self) -> "Timeline":
        if self._steps < STEPS_PER_CHECKPOINT:
            return self
        checkpoint_dir(self._df.sparkSession)
        return self._with(self._df.checkpoint(), -self._steps)

    @property
    def _cells(self) -> list[str]:
        return self.keys + ([_BLOCK] if self.split else [])

    def _window(self, backwards: bool = False):
        """Descending order serves "following" frames: Spark rescans the rest of the
        partition for each row when a frame ends at unbounded following."""
        order = [F.desc(c) if backwards else F.asc(c) for c in self.order]
        return Window.partitionBy(*self._cells).orderBy(*order)

    def _carry(self, summaries: dict[str, Column], scans: Callable[[Column], dict[str, Column]], backwards: bool) -> DataFrame:
        """Summaries per block, scanned over the blocks before (or after) each one."""
        blocks = self._df.groupBy(*self._cells).agg(*[c.alias(n) for n, c in summaries.items()])
        order = F.desc(_BLOCK) if backwards else F.asc(_BLOCK)
        others = Window.partitionBy(*self.keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return blocks.select(*self._cells, *[c.alias(n) for n, c in scans(others).items()])

    def _join_carry(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        on = reduce(lambda a, b: a & b, [df[c].eqNullSafe(carry[c]) for c in self._cells])
        joined = df.join(carry, on, "left")
        return reduce(lambda d, c: d.drop(carry[c]), self._cells, joined)

    def _nearest(self, values: dict[str, Column], backwards: bool, own_row: bool) -> "Timeline":
        window = self._window(backwards).rowsBetween(Window.unboundedPreceding, 0 if own_row else -1)
        near = {n: F.last(v, ignorenulls=True).over(window) for n, v in values.items()}
        if not self.split:
            return self._with(self._df.withColumns(near))
        line = self._settled()
        place = F.struct(*self.order)
        pick = F.min_by if backwards else F.max_by
        carry = line._carry(
            {f"_e_{n}": pick(v, F.when(v.isNotNull(), place)) for n, v in values.items()},
            lambda w: {f"_c_{n}": F.last(f"_e_{n}", ignorenulls=True).over(w) for n in values},
            backwards,
        )
        df = line._join_carry(line._df.withColumns({f"_n_{n}": c for n, c in near.items()}), carry)
        df = df.withColumns({n: F.coalesce(f"_n_{n}", f"_c_{n}") for n in values})
        return line._with(df.drop(*[p + n for n in values for p in ("_n_", "_c_")]), 1)

    # -- public operators --------------------------------------------------------

    def last_valid(self, values: dict[str, Column], own_row: bool = True) -> "Timeline":
        """Latest non-null value at or before each row."""
        return self._nearest(values, backwards=False, own_row=own_row)

    def next_valid(self, values: dict[str, Column], own_row: bool = True) -> "Timeline":
        """First non-null value at or after each row."""
        return self._nearest(values, backwards=True, own_row=own_row)

    def previous_row(self, values: dict[str, Column]) -> "Timeline":
        """Values of the row just before, null values included; null on the first row."""
        packed = F.struct(*[v.alias(n) for n, v in values.items()])
        if not self.split:
            return self._with(self._df.withColumns({n: F.lag(v).over(self._window()) for n, v in values.items()}))
        line = self._nearest({"_prev": packed}, backwards=False, own_row=False)
        df = line._df.withColumns({n: F.col("_prev").getField(n) for n in values})
        return line._with(df.drop("_prev"))

    def running_sum(self, values: dict[str, Column], own_row: bool = True) -> "Timeline":
        """Sum from the first row; 0 before any value."""
        window = self._window().rowsBetween(Window.unboundedPreceding, 0 if own_row else -1)
        if not self.split:
            sums = {n: F.coalesce(F.sum(v).over(window), F.lit(0)) for n, v in values.items()}
            return self._with(self._df.withColumns(sums))
        line = self._settled()
        carry = line._carry(
            {f"_e_{n}": F.sum(v) for n, v in values.items()},
            lambda w: {f"_c_{n}": F.sum(f"_e_{n}").over(w) for n in values},
            backwards=False,
        )
        df = line._join_carry(line._df.withColumns({f"_n_{n}": F.sum(v).over(window) for n, v in values.items()}), carry)
        df = df.withColumns(
            {n: F.coalesce(f"_n_{n}", F.lit(0)) + F.coalesce(f"_c_{n}", F.lit(0)) for n in values}
        )
        return line._with(df.drop(*[p + n for n in values for p in ("_n_", "_c_")]), 1)

    def position(self, name: str) -> "Timeline":
        """1-based row number."""
        if not self.split:
            return self._with(self._df.withColumn(name, F.row_number().over(self._window()).cast("long")))
        return self.running_sum({name: F.lit(1).cast("long")})

    def key_max(self, values: dict[str, Column]) -> "Timeline":
        """Largest value of the whole key on every row."""
        whole = Window.partitionBy(*self._cells)
        if not self.split:
            return self._with(self._df.withColumns({n: F.max(v).over(whole) for n, v in values.items()}))
        line = self._settled()
        blocks = line._df.groupBy(*self._cells).agg(*[F.max(v).alias(f"_e_{n}") for n, v in values.items()])
        per_key = Window.partitionBy(*self.keys)
        top = blocks.select(*self._cells, *[F.max(f"_e_{n}").over(per_key).alias(n) for n in values])
        return line._with(line._join_carry(line._df, top), 1)

    def frames(self, values: dict[str, tuple[Column, int, int]]) -> "Timeline":
        """Aggregates over bounded row frames: name -> (aggregate, rows before, rows after)."""
        if not self.split:
            window = self._window()
            return self._with(
                self._df.withColumns({n: agg.over(window.rowsBetween(-b, a)) for n, (agg, b, a) in values.items()})
            )
        before = max(b for _, b, _ in values.values())
        after = max(a for _, _, a in values.values())
        numbered = self.position("_fpos")
        copies = numbered._copies(before, after)
        window = Window.partitionBy(*self.keys, "_part").orderBy("_fpos")
        df = copies.withColumns({n: agg.over(window.rowsBetween(-b, a)) for n, (agg, b, a) in values.items()})
        return numbered._with(df.filter(F.col("_part") == F.col("_home")).drop("_fpos", "_home", "_part"))

    def _copies(self, before: int, after: int) -> DataFrame:
        """Rows numbered by ``_fpos`` in equal blocks ``_part`` of row positions; a row near a
        border is copied to the neighbour, and ``_home`` is its own block."""
        size = max(self.block_rows, before + after + 1)
        at = F.col("_fpos") - 1
        home = F.floor(at / size)
        homes = F.array(home, F.floor((at - after) / size), F.floor((at + before) / size))
        return self._df.withColumn("_home", home).withColumn("_part", F.explode(F.array_distinct(homes)))

    def map_blocks(self, add: Callable[[pa.Table], dict], fields: list[T.StructField], reach: int) -> "Timeline":
        """Adds columns computed by ``add`` on Arrow blocks of rows in order.

        A row's values may depend on at most ``reach`` rows on either side. ``add`` sees at
        most about ``block_rows`` rows of one key and returns one array per field.
        """
        numbered = self.position("_fpos")
        if self.split:
            df = numbered._copies(reach, reach)
        else:
            df = numbered._df.withColumns({"_home": F.lit(0).cast("long"), "_part": F.lit(0).cast("long")})
        schema = T.StructType([*df.schema.fields, *fields])
        # Sorted partitions are cut into blocks batch by batch: a grouped call for each key costs far more than its rows.
        block = [*self.keys, "_part"]
        # Whole keys are together already where rows were numbered by one window a key.
        ordered = (df.repartition(*block) if self.split else df).sortWithinPartitions(*block, "_fpos")
        out = ordered.mapInArrow(_blocks_function(_block_function(add, [f.name for f in fields]), block), schema)
        return numbered._with(out.filter(F.col("_part") == F.col("_home")).drop("_fpos", "_home", "_part"))


def _starts(table: pa.Table, columns: list[str]) -> np.ndarray:
    """Places of rows that differ from the one before in some column; the first row always."""
    change = np.zeros(len(table), bool)
    change[:1] = True
    for name in columns:
        column = table.column(name).combine_chunks()
        here, before = column.slice(1), column.slice(0, max(0, len(column) - 1))
        same = pc.or_(pc.fill_null(pc.equal(here, before), False), pc.and_(pc.is_null(here), pc.is_null(before)))
        if pa.types.is_floating(column.type):
            same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(here), pc.is_nan(before)), False))
        change[1:] |= ~same.to_numpy(zero_copy_only=False)
    return np.flatnonzero(change)


def _blocks_function(run_block: Callable[[pa.Table], pa.Table], columns: list[str]):
    """Runs ``run_block`` on each block of equal ``columns`` of sorted rows; only the open block is held."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            tail = [held[-1].slice(len(held[-1]) - 1)] if held else []
            starts = _starts(pa.Table.from_batches([*tail, batch]), columns) - len(tail)
            starts = starts[starts >= 0]
            if not len(starts):
                held.append(batch)
                continue
            done = [pa.Table.from_batches([*held, batch.slice(0, starts[0])])] if held else []
            done += [pa.Table.from_batches([batch.slice(a, b - a)]) for a, b in zip(starts[:-1], starts[1:])]
            held = [batch.slice(starts[-1])]
            if done:
                yield from pa.concat_tables([run_block(t) for t in done]).combine_chunks().to_batches()
        if held:
            yield from run_block(pa.Table.from_batches(held)).combine_chunks().to_batches()

    return run


def _block_function(add: Callable[[pa.Table], dict], names: list[str]):
    def run(table: pa.Table) -> pa.Table:
        place = table.column("_fpos").to_numpy()
        if (np.diff(place) < 0).any():
            table = table.take(np.argsort(place))
        columns = add(table)
        for name in names:
            table = table.append_column(name, columns[name])
        return table

    return run
