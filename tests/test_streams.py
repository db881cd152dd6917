"""Streams give what the batch form gives."""

import json
import os

from pyspark.sql import functions as F

from tests.conftest import rows
from tickforge import catalog
from tickforge.streaming.ingest import known_sensors, message_files, parse_messages, start_export, start_line_flush
from tickforge.streaming.scoring import Refreshed
from tickforge.streaming import scoring
from tickforge.streaming.state import compact_state, keyed_state, latest_values, machine_state, read_state, start_state, state_of

catalog.load_all()


def write_ticks(folder, ticks):
    for i, tick in enumerate(ticks):
        with open(f"{folder}/tick{i}.jsonl", "w") as f:
            f.write("\n".join(json.dumps(m) if isinstance(m, dict) else m for m in tick) + "\n")
        os.utime(f"{folder}/tick{i}.jsonl", (1_700_000_000 + i, 1_700_000_000 + i))  # files are read in order of age


def message(minute, sensor, value, machine="M1"):
    return {"timestamp": f"2024-01-01 00:{minute:02d}:00", "id_machine": machine, sensor: value}


def test_replay_tick_by_tick(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_ticks(source, [
        [message(0, "iot_temperature", 1.0), "not json", message(0, "odd", 1.0)],
        [message(1, "iot_temperature", 2.0), message(1, "id_status_production", 3)],
        [message(2, "id_status_production", 1), message(2, "iot_temperature", 5.0, "M2")],
    ])
    long = known_sensors(parse_messages(message_files(spark, str(source), 1)))
    run = start_export(long, f"{tmp_path}/out", f"{tmp_path}/c1", every=None)
    run.awaitTermination()
    assert len(run.recentProgress) >= 3
    observed = [p["observedMetrics"]["messages"] for p in run.recentProgress if p["observedMetrics"]]
    assert sum(o["received"] for o in observed) == 7 and sum(o["rejected"] for o in observed) == 1
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 5 and out.filter(F.col("time").isNull()).count() == 0
    again = start_export(long, f"{tmp_path}/out", f"{tmp_path}/c1", every=None)
    again.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5
    state = machine_state(out, F.array(F.lit(3).cast("long")), ["iot_temperature", "id_status_production"])
    got = {r.machine_id: r for r in state.collect()}
    assert got["M1"].iot_temperature == 2.0 and got["M1"].id_status_production == 1.0
    assert got["M1"].last_stop.minute == 1 and got["M1"].timestamp.minute == 2
    assert got["M2"].last_stop is None
    assert rows(latest_values(out), "id_machine", "sensor", "value") == [
        ("M1", "id_status_production", 1.0), ("M1", "iot_temperature", 2.0), ("M2", "iot_temperature", 5.0)
    ]
    start_line_flush(long, f"{tmp_path}/lines", f"{tmp_path}/c2", every=None).awaitTermination()
    lines = [r.value for r in spark.read.text(f"{tmp_path}/lines").collect()]
    assert len(lines) == 5 and all(x.startswith("sensor_data,id_machine=M") for x in lines)


def test_export_keeps_late_rows_and_overwrites_repeats(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    ahead = message(0, "iot_temperature", 9.0) | {"timestamp": "2024-09-01 00:00:00"}
    write_ticks(source, [[ahead], [message(5, "iot_temperature", 1.0)], [message(1, "iot_temperature", 2.0)], [message(5, "iot_temperature", 3.0)]])
    long = parse_messages(message_files(spark, str(source), 1))
    for _ in range(2):  # a second run over the same files changes nothing
        start_export(long, f"{tmp_path}/out", f"{tmp_path}/c", every=None).awaitTermination()
        got = spark.read.parquet(f"{tmp_path}/out").orderBy("sensor_timestamp").collect()
        assert [r.value for r in got] == [2.0, 3.0, 9.0]


def test_the_last_arrival_wins_over_several_batches_and_a_restart(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_ticks(source, [[message(5, "iot_temperature", 1.0), message(5, "iot_temperature", 7.0, "M2")], [message(9, "iot_temperature", 2.0)]])
    state = latest_values(parse_messages(message_files(spark, str(source), 1)), "time")
    start_state(state, f"{tmp_path}/out", f"{tmp_path}/c", every=None).awaitTermination()
    write_ticks(source, [[], [], [message(1, "iot_temperature", 3.0)]])  # late, and after a restart
    start_state(state, f"{tmp_path}/out", f"{tmp_path}/c", every=None).awaitTermination()
    got = read_state(spark, f"{tmp_path}/out", ["id_machine", "sensor"])
    assert rows(got, "id_machine", "value") == [("M1", 3.0), ("M2", 7.0)]
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert stored.groupBy("id_machine").count().filter("id_machine = 'M2'").first()["count"] == 1  # unchanged machines are not written again
    compact_state(spark, f"{tmp_path}/out", f"{tmp_path}/small", ["id_machine", "sensor"])
    assert spark.read.parquet(f"{tmp_path}/small").count() == 2


def test_state_from_keyed_readings_equals_state_from_readings(spark):
    r = [("M%d" % (i % 2), "id_status_production" if i % 3 else "iot_vibration_peak", float(i % 4), i) for i in range(40)]
    long = spark.createDataFrame(r, "id_machine string, sensor string, value double, i int").withColumn(
        "sensor_timestamp", F.timestamp_seconds("i").cast("timestamp_ntz")
    )
    for stops in ([1, 3], [2], []):
        ids = F.array(*[F.lit(i).cast("long") for i in stops]).cast("array<bigint>")
        assert rows(state_of(keyed_state(long), ids)) == rows(machine_state(long, ids))


def test_a_changed_lookup_counts_from_the_next_tick(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    write_ticks(source, [[message(1, "id_status_production", 3), message(2, "id_status_production", 5)], [message(3, "iot_vibration_peak", 1.0)]])
    versions = iter([3, 5])

    def load():
        status = spark.createDataFrame([("Panne", next(versions))], "iot_statut_machine string, id long")
        return scoring.References({"production_status": status}, None, None, None, None)

    monkeypatch.setattr(scoring, "score_state", lambda machines, refs: machines.select("machine_id", "last_stop"))
    long = parse_messages(message_files(spark, str(source), 1))
    scoring.start_scoring(long, Refreshed(load, seconds=0), f"{tmp_path}/out", f"{tmp_path}/c", every=None).awaitTermination()
    got = {r["batch"]: r["last_stop"].minute for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {0: 1, 1: 2}


def test_references_survive_a_failed_reload():
    calls = []

    def load():
        calls.append(1)
        if len(calls) == 2:
            raise OSError("down")
        return len(calls)

    refs = Refreshed(load, seconds=0)
    assert [refs.get(), refs.get(), refs.get()] == [1, 1, 3]


def test_every_catalog_query_runs(spark, sf_dir):
    """Row counts on the smallest tables; values are compared by check_queries.py."""
    slow = {"trained_model", "scored_machines"}
    for name, fn in catalog.QUERIES.items():
        if name not in slow:
            assert fn(spark, sf_dir).count() > 0 or name in {"pending_export"}, name


def test_checks_cover_all_but_the_inexpressible():
    assert set(catalog.QUERIES) - set(catalog.CHECKS) == {"cox_fit", "sampled_rows", "trained_model", "scored_machines"}
