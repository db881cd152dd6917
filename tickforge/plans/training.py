"""Training set, feature choice, fit, evaluation and the promotion gate."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickforge.functions.mathexpr import grid_index
from tickforge.operators.features import is_stop
from tickforge.operators.ordering import exact_quantiles
from tickforge.operators.reference import number_labels
from tickforge.operators.reshape import one_hot
from tickforge.plans.survival import (
    GRID_DAYS,
    CoxModel,
    concordance,
    dynamic_auc,
    fit_cox,
    mean_auc,
    mutual_information,
    risk_score,
)
from tickforge.schemas import ALWAYS_KEPT, CATEGORICAL, NOT_FEATURES
from tickforge.session import checkpoint_dir
from tickforge.sources.sinks import exists

TOP_FEATURES = 25
RECENT_DAYS = 90
TEST_SHARE = 0.2
HORIZON_DAYS = (1, 2, 7)
SCORED_ROWS = 20_000
#: Labels of a column that become one-hot columns, and labels of all columns that a model may know; more are refused.
MAX_CATEGORIES = 10_000
MAX_LABELS = 5_000_000
#: A category of more labels is joined to its codes, and one such category of a model needs no one-hot columns.
WIDE_LABELS = 64


def category_tables(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, label, code): codes from 0 in alphabetical order within each column."""
    parts = None
    for c in columns:
        codes = number_labels(df.select(F.col(c).cast("string").alias("label")), "label").select(
            F.lit(c).alias("column"), "label", (F.col("id") - 1).alias("code")
        )
        parts = codes if parts is None else parts.unionByName(codes)
    return parts


def category_labels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted labels of each column, for the model bundle.

    A model holds a number per label on the driver, so more than ``MAX_LABELS`` are refused rather than cut.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns]))
    labels = df.select(pairs).filter("label is not null").distinct()
    rows = labels.limit(MAX_LABELS + 1).toArrow()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels cannot be held by a model")
    return {c: sorted(rows.filter(pc.equal(rows["column"], c))["label"].to_pylist()) for c in columns}


def encode_categories(df: DataFrame, labels: dict[str, list[str]]) -> DataFrame:
    """Columns replaced by their code; unknown and null labels become -1."""
    codes = {}
    order = df.columns
    for c, values in labels.items():
        if len(values) > WIDE_LABELS:
            df = with_label_value(df, c, dict(zip(values, range(len(values)))), "_code", "int")
            df = df.withColumn(c, F.coalesce("_code", F.lit(-1))).drop("_code")
        elif values:
            table = F.create_map(*[F.lit(x) for i, v in enumerate(values) for x in (v, i)])
            codes[c] = F.coalesce(F.try_element_at(table, F.col(c).cast("string")), F.lit(-1))
        else:
            codes[c] = F.lit(-1)
    return df.withColumns(codes).select(*[f"`{c}`" for c in order])


def with_label_value(df: DataFrame, column: str, values: dict[str, int] | dict[str, float], name: str, kind: str) -> DataFrame:
    """Adds the value of the column's label, null for other labels, by a join: a map in the plan is searched row by row."""
    schema = T.StructType([T.StructField("_label", T.StringType()), T.StructField(name, T.IntegerType() if kind == "int" else T.DoubleType())])
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(v, f.type) for v, f in zip((values.keys(), values.values()), arrow, strict=True)]
    table = df.sparkSession.createDataFrame(pa.Table.from_arrays(arrays, names=arrow.names))
    return df.join(F.broadcast(table), F.col(f"`{column}`").cast("string") == F.col("_label"), "left").drop("_label")


def survival_rows(features: DataFrame) -> DataFrame:
    """Rows outside stops with ``event_observe`` and ``time_index`` on the 0.1-day grid."""
    rows = features.filter(~is_stop(F.col("iot_statut_machine")))
    return rows.withColumns(
        {
            "event_observe": F.coalesce(F.col("type_censure_futur_audit") == "Correctif", F.lit(False)),
            "time_index": grid_index(F.col("RUL_jours"), GRID_DAYS),
        }
    )


def time_split(df: DataFrame, at: str = "timestamp", share: float = 1 - TEST_SHARE, small_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test): test starts at the ``share`` quantile of time."""
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    cut = exact_quantiles(df, {"cut": micros}, share, small_rows).scalar()
    return df.filter(micros < cut), df.filter(micros >= cut)


def recent(df: DataFrame, at: str = "timestamp", days: float = RECENT_DAYS) -> DataFrame:
    """Rows of the last ``days`` before the newest one."""
    newest = df.agg(F.max(at)).scalar()
    return df.filter(F.col(at) >= newest - F.make_dt_interval(secs=F.lit(days * 86400.0)))


def medians(df: DataFrame, columns: list[str], small_rows: int | None = None) -> dict[str, float]:
    row = exact_quantiles(df, {c: F.col(f"`{c}`") for c in columns}, 0.5, small_rows).first()
    return {c: row[c] for c in columns}


def flag_medians(df: DataFrame, labels: dict[str, list[str]]) -> dict[str, float]:
    """Medians of the one-hot flags of labelled columns, from one count per label."""
    if not any(labels.values()):
        return {}
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("label")) for c in labels]))
    counts = df.select(pairs).groupBy("column", "label").count().toArrow()
    counted = dict(zip(zip(counts["column"].to_pylist(), counts["label"].to_pylist()), counts["count"].to_pylist()))
    n = sum(v for (c, _), v in counted.items() if c == next(iter(labels)))
    twice = {f"{c}_{v}": 2 * counted.get((c, v), 0) for c, values in labels.items() for v in values[1:]}
    return {name: 1.0 if k > n else 0.5 if k == n and n else 0.0 for name, k in twice.items()}


def impute(df: DataFrame, fill: dict[str, float]) -> DataFrame:
    """Nulls and NaN replaced by the training median."""
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(v)) for c, v in fill.items()})


def top_features(
    df: DataFrame, candidates: list[str], target: str, k: int = TOP_FEATURES, always: list[str] = ALWAYS_KEPT
) -> list[str]:
    """Always-kept columns first, then the ``k`` most informative ones."""
    filled = impute(df, medians(df, candidates))
    best = mutual_information(filled, candidates, target).orderBy(F.desc("mi"), "feature").limit(k).collect()
    kept = [c for c in always if c in candidates] + [r["feature"] for r in best]
    return list(dict.fromkeys(kept))


@dataclass
class Bundle:
    """What scoring needs, small enough for a one-row table."""

    model: CoxModel
    labels: dict[str, list[str]]
    kept: list[str]
    columns: list[str]
    fill: dict[str, float]
    metrics: dict = field(default_factory=dict)


def design_columns(df: DataFrame, bundle_labels: dict[str, list[str]], kept: list[str]) -> DataFrame:
    """Kept columns with categories one-hot encoded by the training labels; absent ones are null."""
    present = set(df.columns)
    for c in kept:
        if c not in present:
            kind = "string" if c in bundle_labels else "double"
            df = df.withColumn(c, F.lit(None).cast(kind))
    dictionary = {c: bundle_labels[c] for c in kept if c in bundle_labels}
    return one_hot(df, dictionary)


def hot_names(labels: dict[str, list[str]], kept: list[str]) -> list[str]:
    plain = [c for c in kept if c not in labels]
    return plain + [f"{c}_{v}" for c in kept if c in labels for v in labels[c][1:]]


def wide_category(labels: dict[str, list[str]], kept: list[str]) -> str | None:
    """The kept category of the most labels, if those are too many for columns."""
    found = max((c for c in kept if c in labels), key=lambda c: len(labels[c]), default=None)
    return found if found is not None and len(labels[found]) > WIDE_LABELS else None


def add_risk(df: DataFrame, bundle: Bundle) -> DataFrame:
    """Design columns, filled, and ``risque``. Flags of a wide category are no columns: their part is one joined value."""
    model, wide = bundle.model, wide_category(bundle.labels, bundle.kept)
    if wide is None:
        filled = impute(design_columns(df, bundle.labels, bundle.kept), bundle.fill)
        return filled.withColumn("risque", risk_score(model))
    label_of = {f"{wide}_{v}": v for v in bundle.labels[wide][1:]}
    weights = dict(zip(model.features, zip(model.coefficients, model.means)))
    if wide not in df.columns:
        df = df.withColumn(wide, F.lit(None).cast("string"))
    df = with_label_value(df, wide, {v: weights[c][0] for c, v in label_of.items()}, "_flag", "double")
    at_mean = sum(weights[c][0] * weights[c][1] for c in label_of)
    df = design_columns(df, {c: v for c, v in bundle.labels.items() if c != wide}, [c for c in bundle.kept if c != wide])
    filled = impute(df.drop(wide), {c: v for c, v in bundle.fill.items() if c not in label_of})
    columns = [c for c in model.features if c not in label_of]
    rest = replace(model, features=columns, coefficients=[weights[c][0] for c in columns], means=[weights[c][1] for c in columns])
    return filled.withColumn("risque", risk_score(rest) + F.coalesce("_flag", F.lit(0.0)) - at_mean).drop("_flag")


def evaluate(
    train: DataFrame, scored: DataFrame, rows: int | None = None, key: str = "timestamp"
) -> dict:
    """c-index and AUC per horizon of rows with their ``risque``. ``rows`` draws a fixed random subset, as a sampling
    operator; None scores the whole test set, which the exact rank counts allow."""
    if rows is not None:
        draw = F.xxhash64(F.lit(42), F.col(key).cast("string"), F.col("machine_row").cast("string"))
        scored = scored.orderBy(draw).limit(rows)
    # Written once: the rank counts below start from three columns, not from the plan of all design columns.
    checkpoint_dir(scored.sparkSession)
    slim = scored.select("time_index", "event_observe", "risque").checkpoint()
    c = concordance(slim, "time_index", "event_observe", "risque").first()
    horizons = [round(h / GRID_DAYS) for h in HORIZON_DAYS]
    auc = dynamic_auc(train.select("time_index", "event_observe"), slim, "time_index", "event_observe", "risque", horizons)
    per = {r["horizon"] * GRID_DAYS: r["auc"] for r in auc.collect()}
    mean = mean_auc(auc, slim, "time_index", "event_observe").first()["auc_moyen"]
    return {"c_index": c["c_index"], "auc_par_horizon": {str(round(k, 1)): v for k, v in sorted(per.items())}, "auc_moyen": mean, "n_lignes_score": slim.count()}


def train(
    features: DataFrame,
    top_k: int = TOP_FEATURES,
    recent_days: float = RECENT_DAYS,
    alpha: float = 0.1,
    scored_rows: int | None = None,
    categorical: list[str] = CATEGORICAL,
    always: list[str] = ALWAYS_KEPT,
) -> Bundle:
    """Encode, split, keep recent rows, choose features, impute, fit and evaluate.

    The assembled rows are written once to the checkpoint folder: the passes below then
    start from files, not from the whole feature chain, also after a lost executor.
    """
    spark = features.sparkSession
    checkpoint_dir(spark)
    categorical = [c for c in categorical if c in features.columns]
    rows = survival_rows(features).withColumn("machine_row", F.col("machine_id")).checkpoint()
    labels = category_labels(features, categorical)
    encoded = encode_categories(rows, labels)
    train_rows, _ = time_split(encoded)
    train_rows = recent(train_rows)
    numeric = [
        f.name
        for f in encoded.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in (*NOT_FEATURES, "time_index", "machine_row")
    ]
    known = train_rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in numeric]).first()
    candidates = [c for c in numeric if known[c]]  # a column never known has no median
    if not candidates:
        raise ValueError("the training set is empty: no row has a known target")
    kept = top_features(train_rows, candidates, "RUL_jours", top_k, always)

    plain_train, plain_test = time_split(rows)
    plain_train = recent(plain_train)
    used = {c: labels[c] for c in kept if c in labels}
    many = wide_category(used, kept)
    if any(len(v) > MAX_CATEGORIES for c, v in used.items() if c != many):
        raise ValueError(f"more than {MAX_CATEGORIES} labels per column cannot be one-hot encoded")
    columns = hot_names(used, kept)
    plain = medians(plain_train, [c for c in columns if c in kept])
    # A flag is never unknown; its median follows from the label's count.
    fill = {**plain, **flag_medians(plain_train, used)}
    flags = None
    if many is not None:
        flags = ("_flag", [f"{many}_{v}" for v in used[many][1:]])
        plain_train = with_label_value(plain_train, many, {v: i for i, v in enumerate(used[many][1:])}, "_flag", "int")
    train_x = design_columns(plain_train, {c: v for c, v in used.items() if c != many}, [c for c in kept if c != many])
    train_x = impute(train_x, plain).checkpoint()
    model = fit_cox(train_x, columns, "time_index", "event_observe", alpha, wide=flags)
    bundle = Bundle(model, used, kept, columns, fill)
    bundle.metrics = evaluate(train_x, add_risk(plain_test, bundle), scored_rows)
    return bundle


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> None:
    """Adds a version to the Parquet table at ``path``; nothing is deleted, so readers see the old or the new one."""
    text = json.dumps(asdict(bundle), ensure_ascii=False)
    spark.range(1).select(F.lit(text).alias("bundle"), F.current_timestamp().alias("saved_at")).write.mode("append").parquet(path)


def load_bundle(spark: SparkSession, path: str) -> Bundle | None:
    """The newest stored bundle, or None when there is none yet."""
    if not exists(spark, path):
        return None
    data = json.loads(spark.read.parquet(path).agg(F.max_by("bundle", "saved_at").alias("bundle")).first()["bundle"])
    model = CoxModel(**data.pop("model"))
    return Bundle(model=model, **data)


def promote_if_better(spark: SparkSession, candidate: Bundle, path: str) -> bool:
    """Stores the candidate when nothing is in production or its c-index is strictly higher."""
    current = load_bundle(spark, path)
    if current is not None and not (candidate.metrics["c_index"] or 0.0) > (current.metrics["c_index"] or 0.0):
        return False
    save_bundle(spark, candidate, path)
    return True
