"""Star schema from two-sided rows: order lines and conversations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from tickforge.catalog import query
from tickforge.catalog.silver import table, us
from tickforge.operators.ordering import rank_all
from tickforge.plans import star
from tickforge.session import checkpoint_dir
from tickforge.sources.commits import read_committed

LOG_SQL = """log AS (SELECT 'duel_' || strftime(date_trunc('year', l_shipdate), '%Y%m%d_%H%M%S') AS run_name, CAST(l_orderkey AS VARCHAR) AS match_id,
  'P' || l_partkey AS agent1_id, 'S' || l_suppkey AS agent2_id, l_linenumber AS turn, l_shipdate, l_extendedprice,
  CASE WHEN l_returnflag = 'R' THEN 'C' ELSE 'D' END AS agent1_choice, CASE WHEN l_linestatus = 'O' THEN 'C' ELSE 'D' END AS agent2_choice,
  l_quantity::SMALLINT AS agent1_gain, (l_quantity + 1)::SMALLINT AS agent2_gain,
  CAST(floor(l_extendedprice) AS INTEGER) AS agent1_cumulative_score, CAST(floor(l_extendedprice / 2) AS INTEGER) AS agent2_cumulative_score,
  CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS agent1_justification FROM lineitem),
agents AS (SELECT agent1_id AS agent_id FROM log UNION SELECT agent2_id FROM log),
keys AS (SELECT agent_id, row_number() OVER (ORDER BY agent_id)::INTEGER AS agent_key FROM agents)"""


def game_log(spark, folder) -> DataFrame:
    """Order lines as turns of a game: part against supplier, one run per ship year."""
    # Digits of the year for a formatter's call a line; years of other lengths keep that.
    lines = table(spark, folder, "lineitem").selectExpr(
        """concat('/bronze/duel_', CASE WHEN year(l_shipdate) BETWEEN 1000 AND 9999 THEN concat(year(l_shipdate), '0101_000000')
          ELSE date_format(date_trunc('year', l_shipdate), 'yyyyMMdd_HHmmss') END, '.jsonl') AS source_file""",
        "string(l_orderkey) AS match_id",
        "concat('P', l_partkey) AS agent1_id",
        "concat('S', l_suppkey) AS agent2_id",
        "l_linenumber AS turn",
        "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS timestamp",
        "l_extendedprice",
        "if(l_returnflag = 'R', 'C', 'D') AS agent1_choice",
        "if(l_linestatus = 'O', 'C', 'D') AS agent2_choice",
        "smallint(l_quantity) AS agent1_gain",
        "smallint(l_quantity + 1) AS agent2_gain",
        "int(floor(l_extendedprice)) AS agent1_cumulative_score",
        "int(floor(l_extendedprice / 2)) AS agent2_cumulative_score",
        "if(l_linenumber % 2 = 0, l_returnflag, null) AS agent1_justification",
        "string(null) AS agent2_justification",
    )
    return star.with_run(lines, F.col("source_file"))


def keys_of(log: DataFrame) -> DataFrame:
    """Keys of a first load: nothing is known before."""
    return rank_all(star.agents_seen(log), "agent_id", "agent_key").select("agent_id", F.col("agent_key").cast("int").alias("agent_key"))


@query(
    "star_facts",
    f"""WITH {LOG_SQL}, f AS (
SELECT *, agent1_id AS a, agent2_id AS o, agent1_choice AS choice, agent2_choice AS opponent_choice, agent1_gain AS gain, agent1_cumulative_score AS cumulative_score, coalesce(agent1_justification, '') AS justification FROM log
UNION ALL SELECT *, agent2_id, agent1_id, agent2_choice, agent1_choice, agent2_gain, agent2_cumulative_score, '' FROM log)
SELECT sha256(run_name) AS run_id, match_id, ka.agent_key, ko.agent_key AS opponent_key, turn AS turn_number, epoch_us(l_shipdate) AS played_us, choice, opponent_choice, gain, cumulative_score,
  (choice = 'C')::TINYINT AS cooperated, justification FROM f JOIN keys ka ON f.a = ka.agent_id JOIN keys ko ON f.o = ko.agent_id""",
)
def star_facts(spark, folder):
    log = game_log(spark, folder)
    facts = star.turn_facts(log, keys_of(log))
    return facts.select(*[c for c in facts.columns if c != "played_at"], us("played_at", "played_us"))


@query(
    "match_dim",
    f"""WITH {LOG_SQL}, m AS (SELECT run_name, match_id, arg_max(agent1_id, (l_shipdate, turn, l_extendedprice, agent1_id)) AS a, arg_max(agent2_id, (l_shipdate, turn, l_extendedprice, agent1_id)) AS o, max(turn) AS total_turns FROM log GROUP BY 1, 2)
SELECT sha256(run_name) AS run_id, match_id, ka.agent_key AS agent1_key, ko.agent_key AS agent2_key, total_turns FROM m JOIN keys ka ON m.a = ka.agent_id JOIN keys ko ON m.o = ko.agent_id""",
)
def match_dim(spark, folder):
    """Agents of the last line of each match and its largest turn."""
    log = game_log(spark, folder)
    last = F.struct("timestamp", "turn", "l_extendedprice", "agent1_id")
    return star.match_dimension(log, keys_of(log), last).drop("run_ts")


@query(
    "agent_dim",
    f"""WITH {LOG_SQL}, s AS (SELECT run_name, agent1_id AS agent_id FROM log UNION SELECT run_name, agent2_id FROM log)
SELECT sha256(run_name) AS run_id, agent_key, agent_id FROM s JOIN keys USING (agent_id)""",
)
def agent_dim(spark, folder):
    log = game_log(spark, folder)
    return star.agent_dimension(log, keys_of(log))


@query(
    "distinct_agents",
    "SELECT 'P' || l_partkey AS agent_id FROM lineitem UNION SELECT 'S' || l_suppkey FROM lineitem",
)
def distinct_agents(spark, folder):
    return star.agents_seen(game_log(spark, folder))


@query(
    "conversation_matches",
    """SELECT conv_id, arg_max(role, turn) AS last_role, max(turn) AS total_turns, count(*) AS n FROM conversations GROUP BY 1""",
)
def conversation_matches(spark, folder):
    rows = table(spark, folder, "conversations")
    return rows.groupBy("conv_id").agg(
        F.max_by("role", "turn").alias("last_role"), F.max("turn").alias("total_turns"), F.count(F.lit(1)).alias("n")
    )


@query(
    "star_runs_written",
    f"""WITH {LOG_SQL}, f AS (SELECT run_name, match_id, agent1_id AS a, agent1_gain AS gain FROM log UNION ALL SELECT run_name, match_id, agent2_id, agent2_gain FROM log)
SELECT sha256(run_name) AS run_id, count(*) AS n_facts, sum(gain)::BIGINT AS gain, count(DISTINCT match_id) AS n_matches, count(DISTINCT a) AS n_agents, count(DISTINCT a) AS n_keys,
  0 AS written_again FROM f GROUP BY run_name""",
)
def star_runs_written(spark, folder):
    """Three tables a run, written in two starts and read back; a third start writes nothing."""
    log = game_log(spark, folder)
    root = f"{checkpoint_dir(spark)}/star-{uuid.uuid4().hex}"
    last = F.struct("timestamp", "turn", "l_extendedprice", "agent1_id")
    star.write_runs(spark, log.filter("run_ts < timestamp_ntz'1995-01-01'"), root, last)
    star.write_runs(spark, log, root, last)
    again = star.write_runs(spark, log, root, last)
    keys = read_committed(spark, root, "agent_keys", star.KEYS)
    facts, matches, agents = (
        read_committed(spark, root, name, like.schema)
        for name, like in (
            ("fact_turn_play", star.turn_facts(log, keys)),
            ("dim_match", star.match_dimension(log, keys, last)),
            ("dim_agent", star.agent_dimension(log, keys)),
        )
    )
    per_run = facts.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_facts"), F.sum("gain").alias("gain"))
    per_run = per_run.join(matches.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_matches")), "run_id")
    named = agents.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_agents"), F.count_distinct("agent_key").alias("n_keys"))
    return per_run.join(named, "run_id").withColumn("written_again", F.lit(again))
