"""Single operators on small literal tables."""

import datetime as dt
import json
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickforge.functions import compact_utc, epoch_ns, from_epoch_ns, half_even_long, is_close, on_grid, safe_ratio, week_index
from tickforge.operators import quality
from tickforge.operators.asof import active_episode, asof_join
from tickforge.operators.cleaning import centred_medians, clean_sensors, fill_gaps, flag_stuck
from tickforge.operators.episodes import attach_label_ids, build_episodes, sector_history, split_by_prefix
from tickforge.operators.features import censoring_type, deviations, recent_report, since_last_stop
from tickforge.operators.ordering import exact_quantiles, rank_all
from tickforge.operators.reference import (
    decode,
    drop_rows_mentioning,
    extend_keys,
    machine_ages,
    machine_types,
    unique_label_table,
)
from tickforge.operators.reshape import (
    long_to_wide,
    messages_to_long,
    one_hot,
    records,
    series_per_machine,
    series_rows,
    tick_lines,
    two_sided_rows,
    wide_to_long,
)
from tickforge.operators.timeline import Timeline


def at(minute, day=1):
    return dt.datetime(2024, 8, day, 0, 0) + dt.timedelta(minutes=minute)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def labelled(spark, ids, machine="M1"):
    return frame(spark, [(at(i), machine, v) for i, v in enumerate(ids)], "timestamp timestamp_ntz, machine_id string, id_alerte int")


@pytest.mark.parametrize("ids,n", [([4, 4, 4], 1), ([4, 4, 5], 2), ([4, 5, 4], 3), ([None, None], 2)])
def test_episodes_by_id_change(spark, ids, n):
    out = build_episodes(labelled(spark, ids), "id_alerte", "id_alerte", "debut", "fin")
    assert out.columns == ["debut", "fin", "id_alerte", "id_machine"]
    assert out.count() == n


def test_episodes_never_join_machines(spark):
    both = labelled(spark, [4, 4]).union(labelled(spark, [4, 4], "M2"))
    out = build_episodes(both, "id_alerte", "id", "debut", "fin")
    assert rows(out, "id_machine", "debut", "fin") == [("M1", at(0), at(1)), ("M2", at(0), at(1))]


def test_episode_gap_is_unbounded_unless_asked(spark):
    df = frame(spark, [(at(0), "M", 1), (at(600), "M", 1)], "timestamp timestamp_ntz, machine_id string, i int")
    assert build_episodes(df, "i", "i", "a", "b").count() == 1
    assert build_episodes(df, "i", "i", "a", "b", max_gap_seconds=60).count() == 2


def test_sector_history(spark):
    df = frame(
        spark,
        [(at(0), "M", "A"), (at(1), "M", "A"), (at(2), "M", "B"), (at(3), "M", "A")],
        "timestamp timestamp_ntz, machine_id string, secteur string",
    )
    assert rows(sector_history(df)) == [("M", "A", at(0)), ("M", "A", at(3)), ("M", "B", at(2))]


@pytest.fixture()
def alert(spark):
    return frame(
        spark,
        [(at(600), at(660), "M1", 7)],
        "debut_alerte timestamp_ntz, fin_alerte timestamp_ntz, id_machine string, id_alerte long",
    )


def test_open_episode_only_inside(spark, alert):
    readings = frame(
        spark,
        [(at(m), "M1") for m in (540, 600, 630, 660, 720)] + [(at(630), "M2"), (at(630), None)],
        "timestamp timestamp_ntz, id_machine string",
    )
    out = active_episode(readings, alert, "id_machine", "timestamp", "debut_alerte", "fin_alerte", "id_alerte")
    assert out.columns == ["timestamp", "id_machine", "id_alerte"]
    got = {(r.id_machine, r.timestamp): r.id_alerte for r in out.collect()}
    assert len(got) == readings.count()
    assert [got[("M1", at(m))] for m in (540, 600, 630, 660, 720)] == [None, 7, 7, None, None]
    assert got[("M2", at(630))] is None and got[(None, at(630))] is None


def test_no_episode_at_all(spark, alert):
    readings = frame(spark, [(at(1), "M1")], "timestamp timestamp_ntz, id_machine string")
    out = active_episode(readings, alert.limit(0), "id_machine", "timestamp", "debut_alerte", "fin_alerte", "id_alerte")
    assert rows(out) == [(at(1), "M1", None)]


def test_asof_ties_and_directions(spark):
    left = frame(spark, [("k", 10), ("k", 20)], "k string, t long")
    right = frame(spark, [("k", 10, 1), ("k", 10, 2), ("k", 25, 3), ("k", 25, 4)], "k string, t long, v int")
    back = asof_join(left, right, "k", "t", "t", ["v"], "backward", "v")
    assert rows(back) == [("k", 10, 2), ("k", 20, 2)]
    ahead = asof_join(left, right, "k", "t", "t", ["v"], "forward", "v")
    assert rows(ahead) == [("k", 10, 1), ("k", 20, 3)]


def test_asof_equals_pandas_when_cut(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    left = pd.DataFrame({"k": "hot", "t": np.sort(rng.choice(100_000, 400, replace=False))})
    right = pd.DataFrame({"k": "hot", "t": np.sort(rng.choice(100_000, 60, replace=False)), "v": range(60)})
    for direction in ("backward", "forward"):
        want = pd.merge_asof(left, right, on="t", by="k", direction=direction)["v"].fillna(-1).astype(int).tolist()
        out = asof_join(spark.createDataFrame(left), spark.createDataFrame(right), "k", "t", "t", ["v"], direction, block_rows=30)
        assert [r.v for r in out.orderBy("t").select(F.coalesce("v", F.lit(-1)).alias("v")).collect()] == want


def test_attach_label_ids(spark):
    labels = ["Alerte_P4", "Alerte_P9", "Sain", None, "Maintenance_Correctif_P8"]
    df = frame(spark, [(at(i), "M", v) for i, v in enumerate(labels)], "timestamp timestamp_ntz, machine_id string, label_gmao string")
    alerts = frame(spark, [("Alerte_P4", 4), ("Alerte_P5", 5)], "label_gmao string, id int")
    maintenances = frame(spark, [("Maintenance_Correctif_P8", 8)], "label_gmao string, id int")
    a, m = attach_label_ids(df, alerts, maintenances)
    assert rows(a, "label_alerte", "id_alerte") == [("Alerte_P4", 4)]
    assert rows(m, "label_maintenance", "id_maintenance") == [("Maintenance_Correctif_P8", 8)]


def test_prefix_split_and_removal(spark):
    df = frame(spark, [("Alerte_1",), ("x",), (None,)], "label string")
    hit, rest = split_by_prefix(df, "label", "Alerte")
    assert hit.count() == 1 and rest.count() == 2
    words = frame(spark, [("Sain",), ("PANNE moteur",), ("Sain",), ("panne roulement",), (None,)], "label string")
    assert rows(drop_rows_mentioning(words, "label", "panne")) == [("Sain",), ("Sain",), (None,)]
    assert drop_rows_mentioning(words.limit(0), "label", "panne").count() == 0


def test_unique_labels(spark):
    df = frame(spark, [("b",), ("a",), ("b",), ("c",), (None,)], "label string")
    assert rows(unique_label_table(df, "label")) == [("a", 1), ("b", 2), ("c", 3)]
    with pytest.raises(ValueError):
        unique_label_table(df, "other")
    with pytest.raises(ValueError):
        unique_label_table(df.limit(0), "label")
    with pytest.raises(ValueError):
        unique_label_table(df.select(), "label")


def test_machine_dimensions(spark):
    df = frame(
        spark,
        [("M1", None, "T", at(0)), ("M1", 5, "U", at(1)), ("M2", 9, "V", at(3))],
        "machine_id string, age_jours int, type_machine string, timestamp timestamp_ntz",
    )
    assert rows(machine_ages(df)) == [("M1", 5, at(0)), ("M2", 9, at(3))]
    types = frame(spark, [("T", 1), ("U", 2)], "type_machine string, id int")
    assert rows(machine_types(df, types)) == [("M1", 1)]
    with pytest.raises(ValueError, match="type_machine"):
        machine_types(df.drop("type_machine"), types)


def test_decode_rounds_half_to_even(spark):
    df = frame(spark, [(2.5,), (3.5,), (None,)], "i double")
    lookup = frame(spark, [("two", 2), ("four", 4)], "label string, id int")
    assert sorted(str(r[0]) for r in decode(df, lookup, "i", "label").collect()) == ["None", "four", "two"]
    assert decode(df, lookup, "absent", "label") is df


def test_large_rank_equals_small(spark):
    names = spark.range(500).select(F.concat(F.lit("name-"), F.xxhash64("id").cast("string")).alias("n"))
    small = rank_all(names, "n", "r")
    large = rank_all(names, "n", "r", small_rows=0)
    assert rows(small) == rows(large)


def test_new_keys_follow_old(spark):
    known = frame(spark, [("b", 1), ("z", 5)], "agent_id string, agent_key int")
    seen = frame(spark, [("a",), ("b",), ("c",), ("a",), (None,)], "agent_id string")
    out = extend_keys(known, seen, "agent_id", "agent_key")
    assert rows(out) == [("a", 6), ("b", 1), ("c", 7), ("z", 5)]
    first = extend_keys(known.limit(0), seen, "agent_id", "agent_key")
    assert rows(first) == [("a", 1), ("b", 2), ("c", 3)]


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.8, 1.0])
def test_large_quantile_equals_small(spark, q):
    df = spark.range(3001).select((F.xxhash64("id") % 1000).cast("double").alias("a"), F.when(F.col("id") % 3 == 0, F.rand(7)).alias("b"), F.lit(None).cast("double").alias("c"))
    cols = {c: F.col(c) for c in df.columns}
    small = exact_quantiles(df, cols, q).first()
    large = exact_quantiles(df, cols, q, small_rows=0, block_rows=20).first()
    assert small["c"] is None and large["c"] is None
    assert [small["a"], small["b"]] == pytest.approx([large["a"], large["b"]], abs=1e-12)


def test_wide_long_round_trip(spark):
    df = frame(
        spark,
        [(at(0), "M1", 1.0, 2.0), (at(0), "M2", None, 3.0)],
        "timestamp timestamp_ntz, machine_id string, iot_temperature double, iot_vibration_peak double",
    )
    long = wide_to_long(df, ["iot_temperature", "iot_vibration_peak", "iot_absent"])
    assert long.columns == ["id_machine", "sensor", "value", "sensor_timestamp"] and long.count() == 3
    back = long_to_wide(long.withColumnRenamed("sensor_timestamp", "timestamp").withColumn("id_alerte", F.lit(3)), ["iot_temperature", "iot_vibration_peak"])
    assert rows(back, "machine_id", "iot_temperature", "iot_vibration_peak", "id_alerte") == [("M1", 1.0, 2.0, 3), ("M2", None, 3.0, 3)]
    assert long_to_wide(df.withColumnRenamed("machine_id", "id_machine")).columns[1] == "machine_id"


def test_tick_lines(spark):
    iot = frame(spark, [("2024-01-01 00:00:00", "É1", 1.5, None), ("2024-01-01 00:00:30", "M2", None, None)], "timestamp string, machine_id string, a double, b double")
    plc = frame(spark, [("2024-01-01 00:00:00", "É1", 7), ("2024-01-01 00:01:00", "M2", 8)], "timestamp string, machine_id string, p int")
    lines = {r.timestamp: json.loads(r.line) for r in tick_lines(iot, plc, ["a", "b"], ["p"]).collect()}
    assert lines == {
        "2024-01-01 00:00:00": [
            {"timestamp": "2024-01-01 00:00:00", "id_machine": "É1", "a": 1.5},
            {"timestamp": "2024-01-01 00:00:00", "id_machine": "É1", "p": 7},
        ],
        "2024-01-01 00:01:00": [{"timestamp": "2024-01-01 00:01:00", "id_machine": "M2", "p": 8}],
    }
    with pytest.raises(ValueError, match="missing"):
        records(iot, ["nope"])


def test_messages(spark):
    texts = [
        '{"timestamp":"2024-01-01 00:00:00","id_machine":"M1","iot_temp":4.5}',
        '{"timestamp":"2024-01-01 00:00:00","id_machine":"M1","a":1,"b":2}',
        "not json",
        '{"timestamp":"2024-01-01 00:00:00","id_machine":"M1"}',
        '{"id_machine":"M1","a":"high"}',
        '{"a":3}',
    ]
    out = messages_to_long(spark.createDataFrame([(t,) for t in texts], "value string"))
    got = [(r.id_machine, r.sensor, r.value_number, r.accepted) for r in out.collect()]
    assert got == [
        ("M1", "iot_temp", 4.5, True),
        ("M1", "b", 2.0, True),
        ("unknown", None, None, False),
        ("M1", None, None, False),
        ("M1", "a", None, False),
        ("unknown", "a", 3.0, True),
    ]


def test_two_sides_and_one_hot(spark):
    df = frame(spark, [(1, "x", "y")], "m int, a string, b string")
    assert rows(two_sided_rows(df, ["m"], {"me": ("a", "b"), "you": ("b", "a")})) == [(1, "x", "y"), (1, "y", "x")]
    hot = one_hot(frame(spark, [("p",), ("q",), ("new",), (None,)], "c string"), {"c": ["p", "q", "r"]})
    assert hot.columns == ["c_q", "c_r"]
    assert rows(hot) == [(0, 0), (0, 0), (0, 0), (1, 0)]


def history(spark, values, status=None):
    data = [("M", at(i), v, status[i] if status else None) for i, v in enumerate(values)]
    return frame(spark, data, "machine_id string, timestamp timestamp_ntz, x double, iot_statut_machine string")


def test_stuck_equals_run_length(spark):
    values = [1.0] * 7 + [2.0] * 8 + [None] * 9 + [3.0] * 20 + [4.0, 5.0] + [6.0] * 3
    for block in (None, 12):
        out = flag_stuck(Timeline(history(spark, values), ["machine_id"], ["timestamp"], block), ["x"]).df
        flags = [r.x_bloque_suspect for r in out.orderBy("timestamp").collect()]
        assert flags == [0] * 7 + [1] * 8 + [0] * 9 + [1] * 20 + [0] * 5


def test_fill_equals_its_definition(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(3):
        values = [None if rng.random() < 0.6 else float(v) for v in rng.normal(size=60)]
        want = filled_by_hand(values, 3)
        for block in (None, 9):
            out = fill_gaps(Timeline(history(spark, values), ["machine_id"], ["timestamp"], block), ["x"]).df
            got = [r.x for r in out.orderBy("timestamp").collect()]
            assert [v is None for v in got] == [v is None for v in want]
            assert [v for v in got if v is not None] == pytest.approx([v for v in want if v is not None])


def filled_by_hand(values, limit):
    """Straight lines between known values, the nearest one beyond them, at most ``limit`` rows away."""
    known = [i for i, v in enumerate(values) if v is not None]
    out = list(values)
    for i, v in enumerate(values):
        before = max((k for k in known if k <= i), default=None)
        after = min((k for k in known if k >= i), default=None)
        ends = [k for k in (before, after) if k is not None]
        if v is None and ends and min(abs(i - k) for k in ends) <= limit:
            if len(ends) == 1:
                out[i] = values[ends[0]]
            else:
                out[i] = values[before] + (values[after] - values[before]) * (i - before) / (after - before)
    return out


def medians_by_hand(values, half, least):
    out = []
    for i in range(len(values)):
        near = sorted(v for v in values[max(0, i - half) : i + half + 1] if v is not None)
        out.append(statistics.median(near) if len(near) >= least else None)
    return out


def test_cleaning_equals_its_definition_when_cut(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    values = [None if rng.random() < 0.1 else float(v) for v in rng.normal(50, 1, 400)]
    for i in (50, 200, 333):
        values[i] = 500.0
    middle = medians_by_hand(values, 120, 15)
    distance = [None if v is None or m is None else abs(v - m) for v, m in zip(values, middle)]
    unit = medians_by_hand(distance, 120, 15)
    marks = [int(bool(d is not None and u and d / (1.4826 * u) > 8)) for d, u in zip(distance, unit)]
    assert sum(marks) == 3
    want = filled_by_hand([None if k else v for v, k in zip(values, marks)], 3)
    with_nan = [float("nan") if v is None and i % 2 else v for i, v in enumerate(values)]
    df = history(spark, with_nan).withColumnRenamed("x", "iot_temperature")
    for block in (None, 100):
        out = clean_sensors(df, block_rows=block).orderBy("timestamp").collect()
        assert [r.iot_temperature_spike_suspect for r in out] == marks
        got = [r.iot_temperature for r in out]
        assert [v is None for v in got] == [v is None for v in want]
        assert [v for v in got if v is not None] == pytest.approx([v for v in want if v is not None])


def test_pivot_keeps_every_sensor_and_the_last_arrival(spark):
    rows = [("M1", at(0), "iot_vibration_rms", 1.0, at(1)), ("M1", at(0), "new_sensor", 2.0, at(1)), ("M1", at(0), "new_sensor", 1.5, at(2))]
    long = frame(spark, rows, "id_machine string, timestamp timestamp_ntz, sensor string, value double, time timestamp_ntz").withColumn("note", F.lit("kept"))
    wide = long_to_wide(long).first()
    assert (wide.iot_vibration_rms, wide.new_sensor, wide.note) == (1.0, 1.5, "kept")


def test_messages_without_a_number_are_no_readings(spark):
    texts = ['{"id_machine":"M1","iot_x":"NaN"}', '{"id_machine":"M1","iot_x":1.5}']
    got = messages_to_long(frame(spark, [(t,) for t in texts], "value string")).orderBy("accepted").collect()
    assert [(r.accepted, r.value_number) for r in got] == [(False, None), (True, 1.5)]


def test_since_stop_falls_back_to_age(spark):
    df = history(spark, [1.0] * 4, ["Production", "Panne", None, "Production"]).withColumn("age_jours", F.lit(100.0))
    out = since_last_stop(Timeline(df, ["machine_id"], ["timestamp"])).df.orderBy("timestamp").collect()
    assert [r.jours_depuis_dernier_arret for r in out] == pytest.approx([100.0, 0.0, 1 / 1440, 2 / 1440])


def test_recent_report_equals_rolling_max(spark):
    values = [1.0 if i in (2, 9) else None for i in range(15)]
    df = history(spark, values).withColumn("note", F.when(F.col("x").isNotNull(), "seen"))
    out = recent_report(Timeline(df, ["machine_id"], ["timestamp"]), "note", rows=4).df.orderBy("timestamp").collect()
    assert [r.signalement_recent_24h for r in out] == [1 if 2 <= i < 6 or 9 <= i < 13 else 0 for i in range(15)]


def test_censoring_and_deviations(spark):
    labels = ["Alerte_P4", "Maintenance_Correctif_P8", "Alerte_Preventif", "Maintenance_Preventif_X", "Sain", None]
    df = frame(spark, [(x,) for x in labels], "l string").select(censoring_type(F.col("l")).alias("c"))
    assert [r.c for r in df.collect()] == ["Correctif", "Correctif", "Preventif", "Preventif", "Sain", "Sain"]
    d = frame(spark, [(90.0, 100.0, 4.0, 0.0)], "iot_vitesse_rotation double, vitesse_rotation_nominal double, iot_temperature double, temp_base_moteur double")
    got = d.select(*[c.alias(n) for n, c in deviations(d.columns).items()]).first().asDict()
    assert got == {"ecart_vitesse": -10.0, "ecart_relatif_vitesse": -0.1, "ecart_temp": 4.0, "ecart_relatif_temp": None}


def test_quality(spark):
    df = frame(spark, [(1, "ab", 1), (1, "abc", 2), (2, None, 9)], "k int, s string, p int")
    parent = frame(spark, [(1,), (2,)], "id int")
    report = quality.constraint_report("t", df, ["k"], ["s"], {"s": 2}, {"p": (parent, "id")})
    assert {(r.rule, r.violations) for r in report.collect()} == {("not_null:s", 1), ("max_length:s", 1), ("unique:k", 1), ("reference:p", 1)}
    same = frame(spark, [(at(0),), (at(0),)], "timestamp timestamp_ntz")
    quality.require_single_instant(same)
    with pytest.raises(ValueError):
        quality.require_single_instant(same.union(frame(spark, [(at(1),)], "timestamp timestamp_ntz")))


def test_expressions(spark):
    row = spark.range(1).select(
        is_close(F.lit(1.0), F.lit(1.0 + 1e-9)).alias("near"),
        is_close(F.lit(None).cast("double"), F.lit(1.0)).alias("none"),
        safe_ratio(F.lit(1.0), F.lit(0.0)).alias("ratio"),
        half_even_long(F.lit(0.5)).alias("half"),
        on_grid(F.lit(0.25), 0.1).alias("grid"),
        epoch_ns(F.lit("2024-08-01 11:09:00").cast("timestamp_ntz")).alias("ns"),
        from_epoch_ns(F.lit(1722510540000000000)).alias("back"),
        compact_utc(F.lit("2026-06-01 10:00:00").cast("timestamp_ntz")).alias("name"),
        week_index(F.lit("2024-01-15 01:00:00").cast("timestamp_ntz"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("week"),
    ).first()
    assert (row.near, row.none, row.ratio, row.half) == (True, False, None, 0)
    assert row.grid == pytest.approx(0.2)
    assert row.ns == 1722510540000000000 and row.back == dt.datetime(2024, 8, 1, 11, 9)
    assert row.name == "20260601T100000Z" and row.week == 2


def test_labels_of_large_tables_are_broadcast(spark):
    from tickforge.operators.reference import number_labels

    df = spark.range(40).select((F.col("id") % 5).cast("string").alias("l"))
    small, large = number_labels(df, "l"), number_labels(df, "l", small_rows=0)
    assert rows(small) == rows(large) == [(str(i), i + 1) for i in range(5)]
    assert "BroadcastHashJoin" in df.join(large, "l")._jdf.queryExecution().executedPlan().toString()


def test_series_of_any_number_of_machines(spark):
    """More machines than a pivot takes, in blocks of columns; the same cells as one wide table."""
    daily = spark.range(12_000).selectExpr("id % 3 as time", "concat('m', id % 11000) as id_machine", "if(id % 7 = 0, null, id) as value")
    blocks = series_per_machine(daily, "value", width=300)
    assert blocks.count() == 3 * 37 and len(blocks.columns) == 303
    got = rows(series_rows(blocks, "value"), "time", "id_machine", "value")
    assert got == rows(daily.filter("value is not null"), "time", "id_machine", "value")
    few = daily.filter("id_machine in ('m1', 'm2', 'm7', 'm10998')")
    wide = {r["time"]: r for r in series_per_machine(few, "value").collect()}
    for r in series_per_machine(few, "value", width=3).collect():
        for name, v in zip(r["machines"], [r["s0"], r["s1"], r["s2"]]):
            assert wide[r["time"]][name] == v
    named = series_per_machine(daily, "value", ["m2", "m10998", "m1"], width=2)
    assert {tuple(r["machines"]) for r in named.collect()} == {("m2", "m10998"), ("m1",)}


def test_series_query_takes_many_machines(spark, folder):
    from tickforge.catalog.shapes import machine_series

    spark.range(10_500).selectExpr("timestamp'2024-01-01' as ts", "id as user_id", "double(id) as value").write.parquet(f"{folder}/events.parquet")
    assert machine_series(spark, folder).count() == 10_500


def test_medians_of_short_histories_sort_once(monkeypatch):
    """Same medians as frame by frame; a history no longer than half a frame is not copied into frames."""
    rng = np.random.default_rng(3)
    for n, half, least in ((0, 4, 1), (1, 4, 1), (5, 4, 3), (6, 4, 3), (9, 4, 6), (30, 4, 2), (30, 40, 15), (30, 29, 31)):
        values = np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n))
        want = []
        for i in range(n):
            frame = values[max(0, i - half) : i + half + 1]
            frame = frame[~np.isnan(frame)]
            want.append(np.median(frame) if len(frame) >= max(1, least) else np.nan)
        with monkeypatch.context() as m:
            if n <= half + 1:
                m.setattr(np.lib.stride_tricks, "sliding_window_view", None)
            np.testing.assert_array_equal(centred_medians(values, half, least), want)
