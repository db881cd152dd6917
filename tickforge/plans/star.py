"""Two-player game logs to a star schema with stable surrogate keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickforge.functions import run_id, run_timestamp
from tickforge.functions.text import base_name
from tickforge.operators.reference import extend_keys
from tickforge.operators.reshape import two_sided_rows
from tickforge.session import checkpoint_dir, shuffles_dropped
from tickforge.sources.commits import commits, read_committed, write_batch
from tickforge.sources.readers import unprocessed


def with_run(log: DataFrame, path: Column | None = None) -> DataFrame:
    """Log rows with run_name, run_id and run_ts read from their file name."""
    name = base_name(path if path is not None else F.col("_metadata.file_path"))
    return _run_fields(log.withColumn("run_name", name))


def _run_fields(df: DataFrame) -> DataFrame:
    return df.withColumns({"run_id": run_id(F.col("run_name")), "run_ts": run_timestamp(F.col("run_name"))})


def agents_seen(log: DataFrame) -> DataFrame:
    """Distinct agents over both roles."""
    sides = log.select(F.explode(F.array("agent1_id", "agent2_id")).alias("agent_id"))
    return sides.filter(F.col("agent_id").isNotNull()).distinct()


def agent_keys(log: DataFrame, known: DataFrame, small_rows: int | None = None) -> DataFrame:
    """Known agent keys plus keys for new agents."""
    return extend_keys(known, agents_seen(log), "agent_id", "agent_key", small_rows)


def _with_keys(log: DataFrame, keys: DataFrame | dict[int, DataFrame]) -> DataFrame:
    """Agent keys in place of agent ids. ``keys`` may be given by side, in the order of the joins."""
    for side, known in (keys if isinstance(keys, dict) else {1: keys, 2: keys}).items():
        pair = known.select(F.col("agent_id").alias(f"agent{side}_id"), F.col("agent_key").alias(f"agent{side}_key"))
        log = log.join(pair, f"agent{side}_id").drop(f"agent{side}_id")
    return log


def _keys_by_side(seen: DataFrame, keys: DataFrame) -> dict[int, DataFrame]:
    """Keys of the agents of each side, the smaller side first; counted ones of at most ``BROADCAST_KEYS`` are broadcast,
    so that the lines are not dealt out by them."""
    rows = seen.groupBy("side").agg(F.count_distinct("agent_id").alias("n")).collect()
    n = {1: 0, 2: 0} | {r["side"]: r["n"] for r in rows}
    out = {}
    for side in sorted(n, key=n.get):
        own = keys.join(seen.filter(F.col("side") == side).select("agent_id").distinct(), "agent_id", "left_semi")
        out[side] = F.broadcast(own) if n[side] <= BROADCAST_KEYS else keys
    return out


def turn_facts(log: DataFrame, keys: DataFrame | dict[int, DataFrame]) -> DataFrame:
    """Two rows per turn, one from each agent's side.

    Only what a fact needs travels to the joins: the run's name, of which its id is made afterwards, and the parsed instant.
    """
    used = [f"agent{side}_{c}" for side in (1, 2) for c in ("id", "choice", "gain", "cumulative_score", "justification")]
    slim = log.select("run_name", "match_id", "turn", F.to_timestamp("timestamp").alias("played_at"), *used)
    keyed = _with_keys(slim, keys).withColumn("run_id", run_id(F.col("run_name")))
    pairs = {
        "agent_key": ("agent1_key", "agent2_key"),
        "opponent_key": ("agent2_key", "agent1_key"),
        "choice": ("agent1_choice", "agent2_choice"),
        "opponent_choice": ("agent2_choice", "agent1_choice"),
        "gain": ("agent1_gain", "agent2_gain"),
        "cumulative_score": ("agent1_cumulative_score", "agent2_cumulative_score"),
        "justification": ("agent1_justification", "agent2_justification"),
    }
    keep = ["run_id", "match_id", F.col("turn").cast("int").alias("turn_number"), "played_at"]
    facts = two_sided_rows(keyed, keep, pairs)
    return facts.select(
        "run_id",
        "match_id",
        F.col("agent_key").cast("int").alias("agent_key"),
        F.col("opponent_key").cast("int").alias("opponent_key"),
        "turn_number",
        "played_at",
        "choice",
        "opponent_choice",
        F.col("gain").cast("smallint").alias("gain"),
        F.col("cumulative_score").cast("int").alias("cumulative_score"),
        F.coalesce(F.col("choice") == "C", F.lit(False)).cast("tinyint").alias("cooperated"),
        F.coalesce("justification", F.lit("")).alias("justification"),
    )


def match_dimension(log: DataFrame, keys: DataFrame | dict[int, DataFrame], sequence: Column) -> DataFrame:
    """One row per match: agents of its last line and its largest turn.

    Run fields are derived after the grouping, once per match instead of once per line.
    """
    last = F.max_by(F.struct("agent1_id", "agent2_id"), sequence)
    matches = log.groupBy("run_name", "match_id").agg(last.alias("_a"), F.max("turn").cast("int").alias("total_turns"))
    return _with_keys(_run_fields(matches).select("run_id", "run_ts", "match_id", "total_turns", "_a.*"), keys).select(
        "run_id", "run_ts", "match_id", "agent1_key", "agent2_key", "total_turns"
    )


def run_agents(log: DataFrame) -> DataFrame:
    """Distinct agents of each run over both roles."""
    return log.select("run_name", F.explode(F.array("agent1_id", "agent2_id")).alias("agent_id")).distinct()


def agent_dimension(log: DataFrame, keys: DataFrame) -> DataFrame:
    """Agents of each run with their keys."""
    return _named_agents(run_agents(log), keys)


def _named_agents(seen: DataFrame, keys: DataFrame) -> DataFrame:
    return _run_fields(seen.join(keys, "agent_id")).select("run_id", "agent_key", "agent_id")


#: Agents of a side, counted, whose keys are broadcast (some 30 bytes each).
BROADCAST_KEYS = 500_000
KEYS = T.StructType([T.StructField("agent_id", T.StringType()), T.StructField("agent_key", T.IntegerType())])


def write_runs(spark: SparkSession, log: DataFrame, root: str, sequence: Column, small_rows: int | None = None) -> int:
    """The three tables of every run not written yet, by run; returns the number of runs written.

    Keys of new agents are stored in the same commit, so an agent keeps its key over all runs, and a second start
    finds every run done and changes nothing.
    """
    with shuffles_dropped(spark):
        return _write_runs(spark, log, root, sequence, small_rows)


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table of the checkpoint folder: a tenth of the size of a checkpoint."""
    place = f"{checkpoint_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)


def _write_runs(spark: SparkSession, log: DataFrame, root: str, sequence: Column, small_rows: int | None) -> int:
    done = commits(spark, root, "run").select(F.col("item").alias("run_id"))
    # The id is a digest of the name: made once a run, not once a line.
    named = log.select("run_name").distinct().withColumn("run_id", run_id(F.col("run_name")))
    runs = _stored(unprocessed(named, done), "runs")
    count = runs.count()
    if not count:
        return 0
    names = runs.select("run_name")
    fresh = log.join(F.broadcast(names) if count <= BROADCAST_KEYS else names, "run_name", "left_semi")
    # Agents by run and side serve the new keys, the agent table and the joins: found once.
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"agent{s}_id").alias("agent_id")) for s in (1, 2)])).alias("_side")
    seen = _stored(fresh.select("run_name", sides).select("run_name", "_side.*").distinct(), "agents-seen")
    known = read_committed(spark, root, "agent_keys", KEYS)
    keys = extend_keys(known, seen, "agent_id", "agent_key", small_rows).select("agent_id", F.col("agent_key").cast("int").alias("agent_key"))
    keys = _stored(keys, "agent-keys")
    by_side = _keys_by_side(seen, keys)
    tables = {
        "fact_turn_play": turn_facts(fresh, by_side),
        "dim_match": match_dimension(fresh, by_side, sequence),
        "dim_agent": _named_agents(seen.select("run_name", "agent_id").distinct(), keys),
        "agent_keys": keys.join(known.select("agent_id"), "agent_id", "left_anti"),
    }
    by_run = {name: ["run_id"] for name in ("fact_turn_play", "dim_match", "dim_agent")}
    write_batch(spark, root, tables, runs.select(F.lit("run").alias("kind"), F.col("run_id").alias("item")), by_run)
    return count

