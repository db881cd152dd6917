import datetime

import pytest
from pyspark.sql import functions as F

from tickforge.functions.text import base_name
from tickforge.operators.episodes import alert_and_maintenance_episodes, episodes_by_kind
from tickforge.plans import star
from tickforge.schemas import GAME_LOG
from tickforge.sources import commits
from tickforge.sources.readers import read_tick_fields
from tickforge.sources.sinks import write_tick_files

READING = "sensor_timestamp timestamp_ntz, time timestamp_ntz, id_machine string, value double"


def staging(spark, n):
    base = datetime.datetime(2026, 3, 1)
    rows = [(base + datetime.timedelta(minutes=i), base + datetime.timedelta(minutes=i), f"M{i % 3}", float(i)) for i in range(n)]
    return spark.createDataFrame(rows, READING)


def exported(spark, root):
    schema = staging(spark, 1).withColumn("date", F.to_date("time")).schema
    return sorted(r["value"] for r in commits.read_committed(spark, root, "readings", schema).collect())


def test_export_after_a_job_died_between_data_and_commit(spark, folder, monkeypatch):
    rows = staging(spark, 100)
    assert exported(spark, folder) == []
    commits.export_committed(spark, rows, folder, "2026-03-01 00:30:00")
    assert exported(spark, folder) == [float(i) for i in range(30)]

    real = commits.write_batch

    def dies(spark, root, tables, items, partition_by=None):
        real(spark, root, tables, items.select(F.raise_error(F.lit("killed")).cast("string").alias("kind"), F.lit("x").alias("item")), partition_by)

    monkeypatch.setattr(commits, "write_batch", dies)
    with pytest.raises(Exception, match="killed"):
        commits.export_committed(spark, rows, folder, "2026-03-01 01:00:00")
    monkeypatch.setattr(commits, "write_batch", real)
    assert exported(spark, folder) == [float(i) for i in range(30)]
    commits.export_committed(spark, rows, folder, "2026-03-01 01:05:00")
    assert exported(spark, folder) == [float(i) for i in range(65)]


def test_export_of_nothing_moves_the_checkpoint_only(spark, folder):
    got = commits.export_committed(spark, staging(spark, 5).limit(0), folder, "2026-03-01 00:30:00")
    assert got == "2026-03-01 00:29:30.000000" and exported(spark, folder) == []
    assert commits.export_committed(spark, staging(spark, 5), folder, "2026-01-01 00:00:00") == got


def game(spark, run, turns):
    rows = [(f"m{t % 2}", f"a{t % 3}", f"b{t % 2}", t) for t in range(turns)]
    log = spark.createDataFrame(rows, "match_id string, agent1_id string, agent2_id string, turn int")
    extra = {f.name: F.lit(None).cast(f.dataType) for f in GAME_LOG.fields if f.name not in log.columns}
    return star.with_run(log.withColumns(extra), F.lit(f"/x/duel_{run}.jsonl"))


def test_each_run_is_written_once_and_agents_keep_their_keys(spark, folder):
    first, second = game(spark, "20260105_101010", 2), game(spark, "20260106_111111", 6)
    assert star.write_runs(spark, first, folder, F.col("turn")) == 1
    keys = {r["agent_id"]: r["agent_key"] for r in commits.read_committed(spark, folder, "agent_keys", star.KEYS).collect()}
    assert star.write_runs(spark, first.unionByName(second), folder, F.col("turn")) == 1
    assert star.write_runs(spark, first.unionByName(second), folder, F.col("turn")) == 0
    stored = commits.read_committed(spark, folder, "agent_keys", star.KEYS).collect()
    later = {r["agent_id"]: r["agent_key"] for r in stored}
    assert len(stored) == len(later) == len(set(later.values())) == 5 and later.items() >= keys.items()
    facts = commits.read_committed(spark, folder, "fact_turn_play", star.turn_facts(first, spark.createDataFrame([], star.KEYS)).schema)
    assert {r["run_id"]: r["count"] for r in facts.groupBy("run_id").count().collect()}.values() and facts.count() == 2 * (2 + 6)


def test_no_runs_write_nothing(spark, folder):
    assert star.write_runs(spark, game(spark, "20260105_101010", 2).limit(0), folder, F.col("turn")) == 0
    assert commits.commits(spark, folder).count() == 0


@pytest.mark.parametrize("small", [1000, 0])
def test_files_hold_whole_ticks(spark, folder, small):
    rows = staging(spark, 25).unionByName(staging(spark, 25)).repartition(7)
    write_tick_files(rows, f"{folder}/t", 10, "time", small_rows=small)
    stored = spark.read.parquet(f"{folder}/t").groupBy("chunk").agg(F.count_distinct(F.col("_metadata.file_path")), F.min("value"), F.max("value"), F.count("*"))
    assert sorted(tuple(r) for r in stored.collect()) == [(0, 1, 0.0, 9.0, 20), (1, 1, 10.0, 19.0, 20), (2, 1, 20.0, 24.0, 10)]
    write_tick_files(rows.limit(0), f"{folder}/none", 10, "time")


def test_fields_no_schema_knows(spark, folder):
    lines = ['[{"timestamp": "2026-03-01 00:00:00", "id_machine": "M1", "iot_x": 1.5, "novel": {"a": 1}}, {"id_machine": "M2", "note": "é \\"q\\"", "gone": null}]', "", "no json", "[]", "[3]"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{folder}/l")
    got = sorted((r["id_machine"], r["field"], r["value"]) for r in read_tick_fields(spark, f"{folder}/l").collect())
    assert got == [("M1", "iot_x", "1.5"), ("M1", "novel", '{"a":1}'), ("M2", "note", 'é "q"')]
    spark.createDataFrame([], "value string").write.text(f"{folder}/e")
    assert read_tick_fields(spark, f"{folder}/e").count() == 0


def test_both_kinds_in_one_pass_equal_two_passes(spark):
    base = datetime.datetime(2026, 3, 1)
    labels = ["Sain", "Alerte_P4", "Alerte_P4", "Maintenance_X", "Alerte_P4", "Alerte_P5", None, "Maintenance_X"]
    rows = [(base + datetime.timedelta(minutes=i), m, labels[(i * (k + 1)) % 8]) for k, m in enumerate(("M|1", "M2")) for i in range(40)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, machine_id string, label_gmao string")
    alerts = spark.createDataFrame([("Alerte_P4", 4), ("Alerte_P5", 5)], "label_gmao string, id long")
    jobs = spark.createDataFrame([("Maintenance_X", 8)], "label_gmao string, id long")
    a, m = alert_and_maintenance_episodes(df, alerts, jobs)
    want = a.select(F.lit("alerte").alias("kind"), F.col("debut_alerte"), F.col("fin_alerte"), "id_alerte", "id_machine")
    want = want.union(m.select(F.lit("maintenance"), "debut_panne", "fin_panne", "id_panne", "id_machine"))
    assert sorted(map(tuple, episodes_by_kind(df, alerts, jobs).collect())) == sorted(map(tuple, want.collect()))
    assert episodes_by_kind(df.limit(0), alerts, jobs).count() == 0


def test_lines_travel_slim_and_names_are_made_once(spark):
    """No run id goes through the joins of the facts, and a path is evaluated once where its name is asked for."""
    log = star.with_run(game(spark, "20260101_101010", 1), F.concat(F.lit("/x/"), "match_id", F.lit("_20260101_101010.jsonl")))
    joins = star.turn_facts(log, spark.createDataFrame([], star.KEYS))._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" in joins.split("Join")[0] and "sha2" not in joins.split("Join")[-1]
    paths = ["/x/duel_20260101_101010.jsonl", "a", "a.b.c", ".h", "x/", "", "a..b", "/x.y/z", "a.", None]
    named = spark.createDataFrame([(p,) for p in paths], "p string").select(base_name(F.col("p")).alias("n"))
    assert [r.n for r in named.collect()] == ["duel_20260101_101010", "a", "a.b", "", "", "", "a.", "z", "a", None]
    once = spark.range(1).select(base_name(F.concat(F.lit("/x/"), F.uuid())).alias("n"))
    assert once._jdf.queryExecution().optimizedPlan().toString().count("uuid") == 1
