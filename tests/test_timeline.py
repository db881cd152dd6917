"""The cut form must give what the whole-key windows give."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickforge.operators import timeline as TL
from tickforge.operators.timeline import Timeline


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """One key holds most rows, in a burst and a long thin tail; others are small."""
    burst = spark.range(900).select(F.lit("hot").alias("k"), (F.col("id") + 5000).cast("long").alias("t"))
    tail = spark.range(300).select(F.lit("hot").alias("k"), (F.col("id") * 5000 + 10_000).cast("long").alias("t"))
    rest = spark.range(200).select((F.col("id") % 9).cast("string").alias("k"), F.col("id").alias("t"))
    df = burst.union(tail).union(rest)
    h = F.abs(F.xxhash64("k", "t"))
    df = df.withColumn("v", F.when(h % 3 != 0, (h % 100).cast("double"))).withColumn("flag", (h % 7).cast("int"))
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    df.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def both(df, apply):
    whole = apply(Timeline(df, ["k"], ["t"]))
    cut = apply(Timeline(df, ["k"], ["t"], block_rows=40))
    assert not whole.split and cut.split
    return rows(whole.df, *sorted(whole.df.columns)), rows(cut.df, *sorted(cut.df.columns))


CASES = {
    "last": lambda t: t.last_valid({"x": F.col("v"), "y": F.when(F.col("flag") == 0, F.col("t"))}),
    "last_before": lambda t: t.last_valid({"x": F.col("v")}, own_row=False),
    "next": lambda t: t.next_valid({"x": F.col("v"), "s": F.when(F.col("flag") == 0, F.struct("t", "v"))}),
    "next_after": lambda t: t.next_valid({"x": F.col("v")}, own_row=False),
    "lag": lambda t: t.previous_row({"x": F.col("v"), "f": F.col("flag")}),
    "sum": lambda t: t.running_sum({"x": F.col("flag"), "n": F.when(F.col("flag") == 1, 1)}),
    "sum_before": lambda t: t.running_sum({"x": F.col("flag")}, own_row=False),
    "position": lambda t: t.position("p"),
    "max": lambda t: t.key_max({"m": F.col("t")}),
    "frames": lambda t: t.frames(
        {"n": (F.count("v"), 12, 5), "m": (F.max("v"), 0, 7), "med": (F.percentile("v", F.lit(0.5)), 120, 120)}
    ),
    "chain": lambda t: t.previous_row({"f": F.col("flag")})
    .running_sum({"run": (F.col("flag") != F.col("f")).cast("int")})
    .frames({"c": (F.sum("run"), 3, 0)}),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_cut_equals_whole(hot, name):
    whole, cut = both(hot, CASES[name])
    assert whole == cut


def test_cells_fit(hot):
    cells = TL.plan_cells(hot, ["k"], "t", 40)
    assert [c[0] for c in cells] == ["hot"]
    _, lo, width = cells[0]
    top = hot.filter("k = 'hot'").groupBy(F.floor((F.col("t") - lo) / width)).count().agg(F.max("count")).first()[0]
    assert top <= 40


def test_row_count_is_kept(hot):
    line = Timeline(hot, ["k"], ["t"], block_rows=40).frames({"n": (F.count("v"), 50, 50)})
    assert line.df.count() == hot.count()


def test_rows_without_a_key_are_cut_too(spark):
    df = spark.range(1500).selectExpr("CAST(null AS string) AS k", "id AS at", "id % 7 AS v")
    line = Timeline(df, ["k"], ["at"], block_rows=100)
    assert line.split
    out = line.running_sum({"s": F.col("v")}).df.orderBy("at").collect()
    want = 0
    for r in out:
        want += r["v"]
        assert r["s"] == want
    assert len(out) == 1500


def test_blocks_are_cut_from_sorted_batches():
    """Blocks of equal keys over any batches, null and NaN keys too; one call a block."""
    import pyarrow as pa

    from tickforge.operators.timeline import _blocks_function

    keys = [None, None, "a", "a", "a", "b", "b", "c", "c", "c", "c"]
    real = [1.0, 1.0, 1.0, 1.0, float("nan"), float("nan"), float("nan"), None, None, 2.0, 2.0]
    whole = pa.table({"k": keys, "x": pa.array(real, pa.float64()), "v": list(range(11))})
    for size in (1, 2, 3, 5, 11):
        sizes = []

        def run(table):
            sizes.append(len(table))
            return table.append_column("n", pa.array([len(table)] * len(table)))

        out = list(_blocks_function(run, ["k", "x"])(iter([pa.record_batch(whole.schema.empty_table().to_pydict(), whole.schema), *whole.to_batches(size)])))
        assert sizes == [2, 2, 1, 2, 2, 2]
        assert [v for b in out for v in b.column("v").to_pylist()] == list(range(11))
        assert [v for b in out for v in b.column("n").to_pylist()] == [2, 2, 2, 2, 1, 2, 2, 2, 2, 2, 2]
    assert list(_blocks_function(run, ["k"])(iter([]))) == []
