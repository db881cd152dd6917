"""The star writer leaves no shuffle files behind and joins agents of either side in both forms."""

import time

import pytest
from pyspark.sql import functions as F

from tests.test_commits import game
from tickforge.plans import star
from tickforge.sources import commits


def shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


@pytest.mark.parametrize("broadcast", [500_000, 2, 0])
def test_runs_are_written_with_few_files_and_in_every_join_form(spark, folder, broadcast, monkeypatch):
    monkeypatch.setattr(star, "BROADCAST_KEYS", broadcast)
    log = game(spark, "20260105_101010", 40).unionByName(game(spark, "20260106_111111", 6)).repartition(3)
    before = shuffle_files(spark)
    assert star.write_runs(spark, log, folder, F.col("turn")) == 2
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    keys = {r["agent_id"]: r["agent_key"] for r in commits.read_committed(spark, folder, "agent_keys", star.KEYS).collect()}
    assert sorted(keys) == ["a0", "a1", "a2", "b0", "b1"]
    schema = star.turn_facts(log, spark.createDataFrame([], star.KEYS)).schema
    facts = commits.read_committed(spark, folder, "fact_turn_play", schema)
    got = sorted((r["turn_number"], r["agent_key"], r["opponent_key"]) for r in facts.collect())
    sides = [(t, keys[f"a{t % 3}"], keys[f"b{t % 2}"]) for n in (40, 6) for t in range(n)]
    assert got == sorted([*sides, *((t, b, a) for t, a, b in sides)])
