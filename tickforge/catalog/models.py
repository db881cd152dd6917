"""Survival curves, ranking metrics, feature ranking, training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickforge.catalog import query
from tickforge.catalog.history import feature_rows
from tickforge.catalog.joins import training_inputs
from tickforge.catalog.silver import SENSOR_VIEW, SILVER_SQL, events, prop_k, r6, silver
from tickforge.operators.features import build_features
from tickforge.operators.reference import encode
from tickforge.operators.reshape import wide_to_long
from tickforge.plans import survival as S
from tickforge.plans.assembly import training_frame
from tickforge.plans.training import (
    SCORED_ROWS,
    category_labels,
    category_tables,
    encode_categories,
    time_split,
    train,
)
from tickforge.schemas import CATEGORICAL, PLC_READINGS, STOP_STATUSES
from tickforge.streaming.scoring import References, score_state
from tickforge.streaming.state import machine_state, stop_status_ids

CATEGORIES = ["type_metal", "iot_statut_machine", "label_gmao"]


@query(
    "category_codes",
    f"""WITH {SILVER_SQL}, """
    + ", ".join(
        f"c{i} AS (SELECT {c} AS label, dense_rank() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM silver WHERE {c} IS NOT NULL))"
        for i, c in enumerate(CATEGORIES)
    )
    + " SELECT event_id, "
    + ", ".join(f"coalesce(c{i}.code, -1)::INTEGER AS {c}" for i, c in enumerate(CATEGORIES))
    + " FROM silver s "
    + " ".join(f"LEFT JOIN c{i} ON s.{c} = c{i}.label" for i, c in enumerate(CATEGORIES)),
)
def category_codes(spark, folder):
    rows = silver(spark, folder).select("event_id", *CATEGORIES)
    return encode_categories(rows, category_labels(rows, CATEGORIES))


@query(
    "category_tables",
    f"WITH {SILVER_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS label, dense_rank() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM silver WHERE {c} IS NOT NULL)"""
        for c in CATEGORIES
    ),
)
def category_code_tables(spark, folder):
    return category_tables(silver(spark, folder), CATEGORIES)


def lives(spark, folder) -> DataFrame:
    """Survival rows: whole value as time, errors as deaths, a property as risk."""
    return events(spark, folder).select(
        "event_id", "ts", F.floor("value").alias("t"), F.col("event_type").isin("error", "view").alias("d"), prop_k().cast("double").alias("risk")
    )


LIVES = """lives AS (SELECT event_id, ts, floor(value)::BIGINT AS t, event_type IN ('error', 'view') AS d,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS risk FROM events)"""


def _counts(source: str, name: str) -> str:
    return f"""{name} AS (SELECT *, sum(deaths + censored) OVER (ORDER BY time DESC ROWS UNBOUNDED PRECEDING)::BIGINT AS at_risk FROM (
  SELECT t AS time, count(*) FILTER (WHERE d) AS deaths, count(*) FILTER (WHERE NOT d) AS censored FROM {source} GROUP BY 1))"""


def _curve(counts: str, name: str, hazard: str) -> str:
    return f"""{name}0 AS (SELECT *, 1 - coalesce({hazard}, 0) AS kept FROM {counts}),
{name} AS (SELECT *, CASE WHEN min(kept) OVER w <= 0 THEN 0 ELSE exp(sum(CASE WHEN kept > 0 THEN ln(kept) ELSE 0 END) OVER w) END AS survival FROM {name}0
  WINDOW w AS (ORDER BY time ROWS UNBOUNDED PRECEDING))"""


ALIVE = "deaths::DOUBLE / at_risk"
UNCENSORED = "censored::DOUBLE / nullif(at_risk - deaths, 0)"


@query("cox_risk_sets", f"WITH {LIVES}, {_counts('lives', 'c')} SELECT time, deaths, censored, at_risk FROM c")
def cox_risk_sets(spark, folder):
    return S.counts_by_time(lives(spark, folder), "t", "d")


@query(
    "kaplan_meier",
    f"WITH {LIVES}, {_counts('lives', 'c')}, {_curve('c', 'k', ALIVE)}, {_curve('c', 'g', UNCENSORED)} "
    "SELECT 'alive' AS curve, time, round(survival, 6) AS survival FROM k UNION ALL SELECT 'uncensored', time, round(survival, 6) FROM g",
)
def kaplan_meier(spark, folder):
    rows = lives(spark, folder)
    alive = S.kaplan_meier(rows, "t", "d").select(F.lit("alive").alias("curve"), "time", r6("survival"))
    stay = S.kaplan_meier(rows, "t", "d", censoring=True).select(F.lit("uncensored").alias("curve"), "time", r6("survival"))
    return alive.unionByName(stay)


@query(
    "c_index",
    f"""WITH {LIVES}, g AS (SELECT t, risk, count(*) FILTER (WHERE d) AS dead, count(*) AS n, count(*) FILTER (WHERE NOT d) AS alive FROM lives GROUP BY 1, 2),
p AS (SELECT a.risk AS ra, b.risk AS rb, a.dead::DOUBLE * CASE WHEN b.t > a.t THEN b.n ELSE b.alive END AS w FROM g a JOIN g b ON b.t >= a.t WHERE a.dead > 0)
SELECT sum(w) AS comparable, sum(CASE WHEN ra > rb THEN w ELSE 0 END) AS concordant, sum(CASE WHEN ra = rb THEN w ELSE 0 END) AS tied,
  round((sum(CASE WHEN ra > rb THEN w ELSE 0 END) + 0.5 * sum(CASE WHEN ra = rb THEN w ELSE 0 END)) / sum(w), 6) AS c_index FROM p""",
)
def c_index(spark, folder):
    """Exact over all rows: counted by running sums, no pairs are formed."""
    df = S.concordance(lives(spark, folder), "t", "d", "risk")
    return df.select("comparable", "concordant", "tied", r6("c_index"))


HORIZONS = [20, 60, 150]


@query(
    "dynamic_auc",
    f"""WITH {LIVES}, cut AS (SELECT quantile_cont(epoch_us(ts)::DOUBLE, 0.8) AS x FROM lives),
train AS (SELECT * FROM lives, cut WHERE epoch_us(ts) < x), test AS (SELECT * FROM lives, cut WHERE epoch_us(ts) >= x),
{_counts('train', 'c')}, {_curve('c', 'g', UNCENSORED)},
w AS (SELECT s.t, s.d, s.risk, coalesce(g.survival, 1.0) AS g FROM test s ASOF LEFT JOIN g ON s.t >= g.time),
h AS (SELECT unnest({HORIZONS})::BIGINT AS horizon),
a AS (SELECT horizon, c.risk, sum(1 / nullif(c.g, 0)) AS cw FROM h JOIN w c ON c.t <= horizon AND c.d GROUP BY 1, 2),
b AS (SELECT horizon, c.risk, count(*)::DOUBLE AS n FROM h JOIN w c ON c.t > horizon GROUP BY 1, 2)
SELECT a.horizon, round(sum(cw * n * CASE WHEN a.risk > b.risk THEN 1 WHEN a.risk = b.risk THEN 0.5 ELSE 0 END) / sum(cw * n), 6) AS auc
FROM a JOIN b ON a.horizon = b.horizon GROUP BY 1""",
)
def dynamic_auc(spark, folder):
    train_rows, test_rows = time_split(lives(spark, folder), "ts")
    df = S.dynamic_auc(train_rows, test_rows, "t", "d", "risk", HORIZONS)
    return df.select("horizon", r6("auc"))


MI_FEATURES = ["iot_pression_hydraulique", "iot_temperature", "iot_charge_moteur", "facteur_cadence"]


def _bin_sql(c: str) -> str:
    cuts = f"(SELECT list(DISTINCT x) FROM (SELECT unnest(quantile_cont({c}, {[i / 16 for i in range(1, 16)]})) AS x FROM silver))"
    return f"len(list_filter({cuts}, lambda x: {c} > x))"


@query(
    "mutual_information_rank",
    f"""WITH {SILVER_SQL}, b AS (SELECT {_bin_sql('age_jours')} AS yb, {', '.join(f'{_bin_sql(c)} AS b{i}' for i, c in enumerate(MI_FEATURES))} FROM silver),
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, b{i} AS xb, yb FROM b" for i, c in enumerate(MI_FEATURES))}),
j AS (SELECT feature, xb, yb, count(*)::DOUBLE AS n FROM l GROUP BY 1, 2, 3),
p AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS total, sum(n) OVER (PARTITION BY feature, xb) AS nx, sum(n) OVER (PARTITION BY feature, yb) AS ny FROM j)
SELECT feature, round(sum(n / total * ln(n * total / (nx * ny))), 6) AS mi FROM p GROUP BY 1""",
)
def mutual_information_rank(spark, folder):
    df = S.mutual_information(silver(spark, folder), MI_FEATURES, "age_jours")
    return df.select("feature", r6("mi")).orderBy(F.desc("mi"))


@query("cox_fit")
def cox_fit(spark, folder):
    """Coefficients of a fit on all rows."""
    rows = silver(spark, folder).join(lives(spark, folder).select("event_id", "t", "d"), "event_id")
    features = ["iot_temperature", "iot_pression_hydraulique", "temps_cycle_sec", "age_jours"]
    model = S.fit_cox(rows, features, "t", "d")
    pairs = list(zip(model.features, model.coefficients))
    scored = rows.select("event_id", S.risk_score(model).alias("risque"))
    spread = scored.agg(F.avg("risque").alias("m"), F.stddev_pop("risque").alias("s"))
    table = F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(b).alias("coefficient")) for n, b in pairs]))
    return spread.select(table, r6("m", "risk_mean"), r6("s", "risk_spread"))


@query("sampled_rows")
def sampled_rows(spark, folder):
    """A fixed random draw without replacement of at most 20 000 rows."""
    rows = events(spark, folder).select("event_id", "user_id", "value")
    return rows.orderBy(F.xxhash64(F.lit(42), F.col("event_id"))).limit(SCORED_ROWS)


def training_features(spark, folder) -> DataFrame:
    return feature_rows(spark, folder).drop("event_id")


@query("trained_model")
def trained_model(spark, folder):
    """Train end to end on all rows; one row of metrics per trained model."""
    bundle = train(training_features(spark, folder))
    m = bundle.metrics
    return spark.range(1).select(
        F.lit(len(bundle.kept)).alias("n_kept"),
        F.lit(len(bundle.columns)).alias("n_columns"),
        F.lit(m["n_lignes_score"]).cast("long").alias("n_scored"),
        F.lit(m["c_index"]).cast("double").alias("c_index"),
        F.lit(m["auc_moyen"]).cast("double").alias("auc_moyen"),
    )


def live_references(spark, folder, bundle=None) -> tuple[DataFrame, References]:
    """(long readings, references) for scoring the newest state of every machine."""
    _, maintenance, nominal, lookups, alert = training_inputs(spark, folder)
    rows = silver(spark, folder)
    coded = encode(encode(rows, lookups["production_status"], "iot_statut_machine", "id_status_production"), lookups["type_metal"], "type_metal", "id_type_metal")
    long = wide_to_long(coded, SENSOR_VIEW + PLC_READINGS)
    return long, References(lookups, nominal, alert, maintenance, bundle)


@query("scored_machines")
def scored_machines(spark, folder):
    """Every machine's newest state scored by a model trained on the assembled history."""
    long, refs = live_references(spark, folder)
    readings, maintenance, nominal, lookups, alert = training_inputs(spark, folder)
    wide = training_frame(readings, maintenance, nominal, lookups, alert)
    stored = readings.withColumnRenamed("id_machine", "machine_id")
    refs.bundle = train(build_features(wide, plan_on=stored))
    stops = stop_status_ids(lookups["production_status"], STOP_STATUSES)
    state = machine_state(long, F.array(*[F.lit(i).cast("long") for i in stops]))
    return score_state(state, refs).drop("time")
