"""Sources, sinks, gold tables and the star schema."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickforge.plans import star
from tickforge.plans.gold import GoldTables, iot_and_plc, nominal_values
from tickforge.schemas import ALERT_EPISODE, NOMINAL_COLUMNS
from tickforge.sources import readers, sinks

DAY = "2024-08-01 00:00:00"


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.fixture()
def iot(spark):
    return spark.createDataFrame(
        [("2024-08-01 00:00:00", "M1", 1.0, None), ("2024-08-02 00:00:00", "M1", 2.0, 3.0)],
        "timestamp string, machine_id string, iot_temperature double, iot_charge_moteur double",
    )


@pytest.fixture()
def plc(spark):
    return spark.createDataFrame(
        [("2024-08-01 00:00:00", "M1", 1), ("2024-08-02 00:00:00", "M1", None)],
        "timestamp string, machine_id string, id_type_metal int",
    )


def test_cold_storage_by_day(spark, iot, plc, folder):
    path = f"{folder}/cold"
    assert sinks.write_cold_storage(iot, plc, path) == 2
    assert sorted(os.path.basename(p) for p in glob.glob(f"{path}/date=*")) == ["date=2024-08-01", "date=2024-08-02"]
    back = readers.read_readings(spark, [path])
    assert back.count() == 4 and {"timestamp", "time", "sensor", "value"} <= set(back.columns)
    assert back.filter("time <> timestamp").count() == 0
    assert sinks.write_cold_storage(iot.limit(0), None, f"{folder}/none") == 0
    assert readers.read_recent_days(spark, path, 0).select("date").distinct().count() == 1
    names = [r.window_name for r in sinks.day_manifest(sinks.cold_rows(iot, plc)).orderBy("date").collect()]
    assert names[0] == "sensor_data_20240801T000000Z_20240801T000000Z"


def test_no_files_and_missing_tables(spark, folder):
    assert readers.read_readings(spark, []).columns == ["id_machine", "sensor", "value", "timestamp", "time"]
    none = readers.alert_episodes(spark, f"{folder}/absent")
    assert none.schema == ALERT_EPISODE and none.count() == 0


def test_window_files(spark):
    names = ["sensor_data_20260601T000000Z_20260610T000000Z.parquet", "sensor_data_20260101T000000Z_20260102T000000Z.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    assert rows(readers.files_in_window(df, 30)) == [(names[0],)]
    with pytest.raises(Exception, match="unexpected file name"):
        readers.files_in_window(spark.createDataFrame([("other.parquet",)], "file_name string"), 30).collect()


def test_silver_csv(spark, folder):
    with open(f"{folder}/s.csv", "w") as f:
        f.write("machine_id,timestamp,iot_temperature,autre\nM1,2024-08-01 00:00:00,NaN,x\nM2,2024-08-01 00:00:30,4.5,y\n")
    df = readers.read_silver_csv(spark, f"{folder}/s.csv")
    assert rows(df) == [("M1", dt.datetime(2024, 8, 1), None, "x"), ("M2", dt.datetime(2024, 8, 1, 0, 0, 30), 4.5, "y")]


def test_tick_lines_round_trip(spark, folder):
    with open(f"{folder}/t.jsonl", "w") as f:
        f.write(json.dumps([{"timestamp": DAY, "id_machine": "M1", "iot_temperature": 4.5}, {"timestamp": DAY, "id_machine": "M1", "id_type_metal": 2, "odd": 1}]) + "\n\n")
    df = readers.read_tick_lines(spark, f"{folder}/t.jsonl")
    assert rows(df, "id_machine", "iot_temperature", "id_type_metal") == [("M1", 4.5, None), ("M1", None, 2.0)]


def test_exact_lines(spark):
    def nanos(text):
        return int(dt.datetime.fromisoformat(text + "+00:00").timestamp()) * 10**9

    rows = [("2025-02-03 04:05:06", "2025-02-03 05:00:00", "press 7", 11), ("2025-03-01 00:00:00", "2025-03-02 12:30:00", "a,b=c", 3)]
    alert = spark.createDataFrame(rows, "debut_alerte string, fin_alerte string, id_machine string, id_alerte int")
    alert = alert.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("debut_alerte", "fin_alerte")})
    names = ["press\\ 7", "a\\,b\\=c"]
    assert [r.line for r in sinks.alert_lines(alert).collect()] == [
        f"alerte,id_machine={name},id_alerte={r[3]} fin_alerte={nanos(r[1])}i {nanos(r[0])}" for name, r in zip(names, rows)
    ]
    fields = {"vitesse_rotation_nominal": 71.5, "courant_moteur_nominal": 8.25, "pression_hydraulique_nominal": 0.5, "temp_base_moteur": 33.0}
    last = {"facteur_cadence": 0.75, "temps_cycle_sec": 9.5}
    nominal = spark.range(2).select(
        ntz("2025-04-05 06:07:08").alias("timestamp"),
        F.lit("saw-9").alias("machine_id"),
        F.lit("OK").alias("statut_nominal"),
        F.when(F.col("id") == 0, 6).alias("id_type_metal"),
        F.lit(9).alias("id_regime_cadence"),
        *[F.lit(v).alias(k) for k, v in {**fields, **last}.items()],
    )
    listed = [f"{k}={v}" for k, v in fields.items()] + ["id_type_metal=6", "id_regime_cadence=9"] + [f"{k}={v}" for k, v in last.items()]
    assert [r.line for r in sinks.nominal_lines(nominal).collect()] == [
        f"nominale_values,machine_id=saw-9,statut_nominal=OK {','.join(listed)} {nanos('2025-04-05 06:07:08')}"
    ]
    when = "2025-05-06 07:08:09"
    prediction = spark.range(1).select(F.lit("saw-9").alias("id_machine"), F.lit(4.25).alias("rul_jours_estime"), F.lit(0.6).alias("risque"), ntz(when).alias("time"))
    assert sinks.prediction_lines(prediction).first().line == f"rul_prediction,id_machine=saw-9 risque=0.6,rul_jours_estime=4.25 {nanos(when)}"


def points(spark, data):
    return spark.createDataFrame(data, "k string, date date, v int, seq int")


def test_upsert_rewrites_only_touched_days(spark, folder):
    path = f"{folder}/up"
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    sinks.upsert_days(spark, points(spark, [("a", one, 1, 1), ("b", two, 1, 1)]), path, ["k", "date"], ["seq"])
    before = set(glob.glob(f"{path}/date=2024-01-02/*.parquet"))
    sinks.upsert_days(spark, points(spark, [("a", one, 9, 2), ("c", one, 3, 2)]), path, ["k", "date"], ["seq"])
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 9), ("b", 1), ("c", 3)]
    assert set(glob.glob(f"{path}/date=2024-01-02/*.parquet")) == before


def test_export_and_watermark(spark, folder):
    staging = spark.range(10).select(
        (ntz("2024-01-01 00:00:00") + F.make_dt_interval(secs=F.col("id") * 10)).alias("time"), F.col("id")
    ).withColumn("sensor_timestamp", F.col("time"))
    out, mark = f"{folder}/out", f"{folder}/mark"
    assert sinks.read_watermark(spark, mark) == sinks.EPOCH
    sinks.export_pending(spark, staging, out, mark, "2024-01-01 00:01:00")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]
    sinks.export_pending(spark, staging, out, mark, "2024-01-01 00:01:05")
    assert sinks.read_watermark(spark, mark) == "2024-01-01 00:00:35"
    sinks.export_pending(spark, staging, out, mark, "2024-01-02 00:00:00")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(10))


def silver(spark):
    data = []
    for i, label in enumerate(["Sain", "Alerte_P4", "Alerte_P4", "Maintenance_Correctif_P8", "Sain"]):
        data.append((f"2024-08-01 00:0{i}:00", "M1", "A", "Presse", "Acier", "Production", "Nominal", label, 100 + i))
    df = spark.createDataFrame(
        data, "timestamp string, machine_id string, secteur string, type_machine string, type_metal string, iot_statut_machine string, regime_cadence string, label_gmao string, age_jours int"
    )
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).withColumn("statut_nominal", F.lit("Production"))
    for c in ("vitesse_rotation_nominal", "courant_moteur_nominal", "pression_hydraulique_nominal", "temp_base_moteur", "facteur_cadence", "temps_cycle_sec", "iot_temperature"):
        df = df.withColumn(c, F.lit(1.0))
    for c in ("iot_vitesse_rotation", "iot_courant_moteur", "iot_pression_hydraulique", "iot_vibration_peak", "iot_charge_moteur", "iot_vibration_rms", "age_virtuel_jours", "RUL_jours"):
        df = df.withColumn(c, F.lit(None).cast("double"))
    return df


def test_gold_tables(spark, folder):
    gold = GoldTables(spark, folder, silver(spark))
    built = gold.build_all()
    at = lambda m: dt.datetime(2024, 8, 1, 0, m)
    assert rows(built["alerte"], "debut_alerte", "fin_alerte", "id_alerte", "id_machine") == [(at(1), at(2), 1, "M1")]
    assert rows(built["maintenance"], "debut_panne", "fin_panne", "id_panne", "id_machine") == [(at(3), at(3), 1, "M1")]
    assert rows(built["machine"]) == [("M1", 1)]
    assert rows(built["age_machine"]) == [("M1", 100, at(0))]
    assert built["nominale_values"].columns == NOMINAL_COLUMNS and built["nominale_values"].count() == 5
    # Stored tables are read back, not built again.
    again = GoldTables(spark, folder, silver(spark).limit(0))
    assert again["type_metal"].count() == 1
    iot, plc = iot_and_plc(silver(spark), built["type_metal"], built["production_status"])
    assert "label_gmao" not in iot.columns and plc.columns == ["machine_id", "timestamp", "id_type_metal", "id_status_production"]
    assert nominal_values(silver(spark), built["type_metal"], built["regime_cadence"]).filter("id_type_metal = 1").count() == 5
    replay = f"{folder}/replay"
    assert gold.split_storage(ntz("2024-08-01 00:02:00"), f"{folder}/cold", replay) == 1
    lines = [json.loads(r.value) for r in spark.read.text(replay).collect()]
    assert len(lines) == 3 and all(len(x) == 3 for x in lines)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        gold.split_storage(ntz("2024-08-01 00:02:00"), f"{folder}/cold", replay)


def test_star_schema(spark, folder):
    def write(name, lines):
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n\n".join(json.dumps(x) for x in lines) + "\n")

    def turn(m, a, b, n, ca, cb):
        return {
            "match_id": m, "agent1_id": a, "agent2_id": b, "turn": n, "timestamp": f"2026-05-27T10:00:0{n}+00:00",
            "agent1_choice": ca, "agent2_choice": cb, "agent1_gain": 3, "agent2_gain": 0,
            "agent1_cumulative_score": 3 * n, "agent2_cumulative_score": 0, "agent1_justification": "why",
        }

    write("duel_20260527_215238.jsonl", [turn("m1", "zoe", "bob", 1, "C", "D"), turn("m1", "zoe", "bob", 2, "D", "D")])
    write("duel_20260526_000000.jsonl", [turn("m0", "ann", "bob", 1, "C", "C")])
    log = star.with_run(readers.read_game_log(spark, folder), F.col("source_file"))
    assert readers.latest_file(log).select("match_id").distinct().count() == 1
    known = spark.createDataFrame([("bob", 4)], "agent_id string, agent_key int")
    keys = star.agent_keys(log, known)
    assert rows(keys) == [("ann", 5), ("bob", 4), ("zoe", 6)]
    facts = star.turn_facts(log, keys)
    assert facts.count() == 6
    assert [f.dataType.simpleString() for f in facts.schema] == ["string", "string", "int", "int", "int", "timestamp", "string", "string", "smallint", "int", "tinyint", "string"]
    assert rows(facts.filter("match_id = 'm1' and agent_key = 4"), "choice", "opponent_choice", "cooperated", "justification") == [("D", "C", 0, ""), ("D", "D", 0, "")]
    matches = star.match_dimension(log, keys, F.col("turn"))
    assert rows(matches, "match_id", "agent1_key", "agent2_key", "total_turns", "run_ts") == [
        ("m0", 5, 4, 1, dt.datetime(2026, 5, 26)), ("m1", 6, 4, 2, dt.datetime(2026, 5, 27, 21, 52, 38))
    ]
    assert star.agent_dimension(log, keys).count() == 4
    done = log.filter("match_id = 'm0'").select("run_id").distinct()
    assert readers.unprocessed(log.select("run_id").distinct(), done).count() == 1
    with pytest.raises(Exception, match="no timestamp"):
        star.with_run(log.drop("run_id", "run_ts"), F.lit("/x/other.jsonl")).collect()
