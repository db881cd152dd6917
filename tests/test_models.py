"""Survival curves, ranks, fit and the gate against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickforge.plans import survival as S, training as T
from tickforge.plans.scoring import NO_MODEL, derived_features, predict
from tickforge.plans.survival import CoxModel
from tickforge.plans.training import (
    Bundle,
    category_labels,
    encode_categories,
    impute,
    load_bundle,
    promote_if_better,
    survival_rows,
    train,
)


@pytest.fixture(scope="module")
def lives():
    rng = np.random.default_rng(11)
    n = 300
    x = rng.normal(size=(n, 3))
    time = rng.exponential(20 * np.exp(-x @ np.array([0.8, -0.5, 0.0]))).astype(int)
    return pd.DataFrame({"t": time, "d": rng.random(n) < 0.7, "a": x[:, 0], "b": x[:, 1], "c.d": x[:, 2], "risk": np.round(x[:, 0], 1)})


def brute_concordance(t, d, r):
    pairs = concordant = tied = 0
    for i in range(len(t)):
        for j in range(len(t)):
            if d[i] and (t[i] < t[j] or (t[i] == t[j] and not d[j])):
                pairs += 1
                concordant += r[i] > r[j]
                tied += r[i] == r[j]
    return pairs, concordant, tied


@pytest.mark.parametrize("block", [None, 50])
def test_concordance_is_exact(spark, lives, block):
    got = S.concordance(spark.createDataFrame(lives), "t", "d", "risk", block).first()
    pairs, concordant, tied = brute_concordance(lives.t.values, lives.d.values, lives.risk.values)
    assert (got.comparable, got.concordant, got.tied) == (pairs, concordant, tied)
    assert got.c_index == pytest.approx((concordant + 0.5 * tied) / pairs)


def brute_curve(t, d, censoring):
    out, s = {}, 1.0
    for u in np.unique(t):
        at_risk, deaths, gone = (t >= u).sum(), ((t == u) & d).sum(), ((t == u) & ~d).sum()
        if censoring:
            s *= 1 - (gone / (at_risk - deaths) if at_risk > deaths else 0)
        else:
            s *= 1 - deaths / at_risk
        out[int(u)] = s
    return out


def test_curves(spark, lives):
    df = spark.createDataFrame(lives)
    for censoring in (False, True):
        got = {r.time: r.survival for r in S.kaplan_meier(df, "t", "d", censoring).collect()}
        assert got == pytest.approx(brute_curve(lives.t.values, lives.d.values, censoring), abs=1e-9)


def test_dynamic_auc(spark, lives):
    train_rows, test_rows = lives[:200], lives[200:]
    curve = brute_curve(train_rows.t.values, train_rows.d.values, True)
    known = np.array(sorted(curve))

    def stay(t):
        i = np.searchsorted(known, t, side="right") - 1
        return curve[int(known[i])] if i >= 0 else 1.0

    want = {}
    for h in (5, 15, 10_000):
        top = all_pairs = 0.0
        for i in test_rows.itertuples():
            if i.t <= h and i.d and stay(i.t) > 0:
                for j in test_rows.itertuples():
                    if j.t > h:
                        w = 1 / stay(i.t)
                        all_pairs += w
                        top += w * (1.0 if i.risk > j.risk else 0.5 if i.risk == j.risk else 0.0)
        want[h] = top / all_pairs if all_pairs else None
    auc = S.dynamic_auc(spark.createDataFrame(train_rows), spark.createDataFrame(test_rows), "t", "d", "risk", [5, 15, 10_000])
    got = {r.horizon: r.auc for r in auc.collect()}
    assert got[10_000] is None and got[5] == pytest.approx(want[5]) and got[15] == pytest.approx(want[15])
    alive = brute_curve(test_rows.t.values, test_rows.d.values, False)
    s5, s15 = (min([v for u, v in alive.items() if u <= h], default=1.0) for h in (5, 15))
    mean = S.mean_auc(auc.filter("horizon < 100"), spark.createDataFrame(test_rows), "t", "d").first()[0]
    assert mean == pytest.approx((want[5] * (1 - s5) + want[15] * (s5 - s15)) / (1 - s15))


def test_cox_weights_may_be_far_apart(spark):
    """A feature that nearly tells the time: risks lie hundreds apart, beyond what weights can hold."""
    rng = np.random.default_rng(5)
    value = rng.exponential(400, size=1500)
    t, d, x = value.astype(int), rng.random(1500) < 0.5, 2 * value + rng.integers(0, 3, 1500)
    df = spark.createDataFrame(pd.DataFrame({"t": t, "d": d, "a": x, "b": rng.normal(size=1500)})).repartition(3)
    model = S.fit_cox(df, ["a", "b"], "t", "d", alpha=1e-4)
    assert model.converged
    both = df.toPandas()
    x, t, d = both[["a", "b"]].to_numpy() - np.array(model.means), both.t.to_numpy(), both.d.to_numpy()

    def objective(beta):
        eta = x @ beta
        value = eta[d].sum() - 0.5e-4 * beta @ beta
        return value - sum(np.logaddexp.reduce(eta[t >= u]) for u in t[d])

    beta = np.array(model.coefficients)
    best = objective(beta)
    assert model.log_likelihood == pytest.approx(best, abs=1e-6) and np.ptp(x @ beta) > 709
    for step in ([1e-3, 0], [-1e-3, 0], [0, 1e-2], [0, -1e-2]):
        assert objective(beta + np.array(step)) <= best + 1e-6
    risk = df.select("t", S.risk_score(model).alias("r")).withColumn("life", S.median_life(model, F.col("r"))).toPandas()
    place = np.array([np.flatnonzero(np.array(model.log_hazard) + r >= np.log(np.log(2.0))) for r in risk.r], dtype=object)
    assert risk.life.tolist() == [model.times[p[0]] if len(p) else model.times[-1] for p in place]


def test_cox_gradient_is_zero(spark, lives):
    names = ["a", "b", "c.d"]
    df = spark.createDataFrame(lives).withColumn("constant", F.lit(3.0))
    model = S.fit_cox(df, [*names, "constant"], "t", "d", alpha=0.1)
    beta = np.array(model.coefficients)
    assert model.converged and not S.fit_cox(df, names, "t", "d", alpha=0.1, max_steps=1).converged
    assert beta[3] == 0.0 and beta[0] > 0.2 and beta[1] < -0.1
    x, t, d = lives[names].to_numpy(), lives.t.to_numpy(), lives.d.to_numpy()

    def objective(b):
        value = 0.0
        for u in np.unique(t[d]):
            dead = (t == u) & d
            value += (x[dead] @ b).sum() - dead.sum() * np.log(np.exp(x[t >= u] @ b).sum())
        return (value - 0.05 * b @ b) / len(t)

    for k in range(3):
        step = np.zeros(3)
        step[k] = 1e-5
        assert (objective(beta[:3] + step) - objective(beta[:3] - step)) / 2e-5 == pytest.approx(0.0, abs=1e-5)
    scored = df.withColumn("r", S.risk_score(model)).withColumn("m", S.median_life(model, F.col("r"))).toPandas()
    for row in scored.head(20).itertuples():
        below = [u for u, h in zip(model.times, model.hazard) if np.exp(-h * np.exp(row.r)) <= 0.5]
        assert row.m == pytest.approx(below[0] if below else model.times[-1])


def test_fit_needs_rows_and_events(spark, lives):
    df = spark.createDataFrame(lives)
    with pytest.raises(ValueError, match="empty"):
        S.fit_cox(df.limit(0), ["a"], "t", "d")
    with pytest.raises(ValueError, match="event"):
        S.fit_cox(df.withColumn("d", F.lit(False)), ["a"], "t", "d")


def test_information_ranks_the_related_feature_first(spark):
    df = spark.range(4000).select(
        (F.col("id") % 97).cast("double").alias("y"), F.rand(1).alias("noise"), ((F.col("id") % 97) * 2.0).alias("same")
    )
    mi = {r.feature: r.mi for r in S.mutual_information(df, ["noise", "same"], "y").collect()}
    assert mi["same"] > 2 and mi["noise"] < 0.1


def test_categories_and_imputation(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", None), (None, float("nan")), ("b", 4.0)], "c string, v double")
    labels = category_labels(df, ["c"])
    assert labels == {"c": ["a", "b"]}
    assert [r.c for r in encode_categories(df, labels).collect()] == [1, 0, -1, 1]
    assert [r.v for r in impute(df, {"v": 9.0}).collect()] == [1.0, 9.0, 9.0, 4.0]


def bundle(c):
    model = CoxModel(["x", "k_two"], [1.0, 2.0], [0.0, 0.0], [0.1, 0.5, 0.9], [0.1, 1.0, 5.0], -1.0, 3)
    return Bundle(model, {"k": ["one", "two"]}, ["x", "k"], ["x", "k_two"], {"x": 0.0, "k_two": 0.0}, {"c_index": c})


def test_gate_is_strict(spark, folder):
    path = f"{folder}/model"
    assert load_bundle(spark, path) is None
    assert promote_if_better(spark, bundle(0.6), path)
    assert not promote_if_better(spark, bundle(0.6), path)
    assert promote_if_better(spark, bundle(0.61), path)
    stored = load_bundle(spark, path)
    assert stored.metrics["c_index"] == 0.61 and stored.model.features == ["x", "k_two"]


def test_prediction_and_placeholder(spark):
    df = spark.createDataFrame([(0.0, "one"), (0.0, "two"), (None, "never seen")], "x double, k string")
    none = predict(df, None).first()
    assert (none.rul_jours_estime, none.risque) == NO_MODEL
    got = [(r.k, r.risque, r.rul_jours_estime) for r in predict(df, bundle(0.5)).collect()]
    assert got == [("one", 0.0, 0.5), ("two", 2.0, 0.1), ("never seen", 0.0, 0.5)]


def test_type_needs_a_label(spark):
    df = spark.createDataFrame([("Alerte_P4",), (None,)], "label_gmao string")
    assert [r.type_censure for r in derived_features(df).collect()] == ["Correctif", None]


def test_train_end_to_end(spark):
    rng = np.random.default_rng(2)
    n = 600
    wear = rng.random(n)
    start = pd.Timestamp("2024-01-01")
    data = pd.DataFrame(
        {
            "timestamp": [start + pd.Timedelta(minutes=7 * i) for i in range(n)],
            "machine_id": [f"M{i % 3}" for i in range(n)],
            "iot_statut_machine": ["Production"] * (n - 5) + ["Panne"] * 5,
            "iot_temperature": 40 + 30 * wear + rng.normal(size=n),
            "empty": [None] * n,
            "age_jours": rng.random(n) * 100,
            "RUL_jours": 3 * (1 - wear) + 0.05 * rng.random(n),
            "type_censure_futur_audit": np.where(rng.random(n) < 0.8, "Correctif", "Sain"),
        }
    )
    df = spark.createDataFrame(data, "timestamp timestamp_ntz, machine_id string, iot_statut_machine string, iot_temperature double, empty double, age_jours double, RUL_jours double, type_censure_futur_audit string")
    assert survival_rows(df).count() == n - 5
    made = train(df, top_k=3, scored_rows=200)
    assert "empty" not in made.kept and made.kept[:2] == ["machine_id", "age_jours"]
    assert made.metrics["n_lignes_score"] == 119 and made.metrics["c_index"] > 0.85
    with pytest.raises(ValueError, match="empty"):
        train(df.withColumn("RUL_jours", F.lit(None).cast("double")).limit(0))


def test_flag_medians_and_risk_of_many_columns(spark):
    """Medians of one-hot flags from counts, and a linear predictor of more columns than a nested sum takes."""
    labels = {"a": ["x", "y", "z"], "b": ["1", "2"]}
    for values in ([("y", "2"), ("y", "1"), ("x", None)], [("y", "2"), ("z", "2")], [(None, "1"), ("y", "2"), ("x", "2"), ("q", "2")]):
        df = spark.createDataFrame(values, "a string, b string")
        hot = T.one_hot(df, labels)
        assert T.flag_medians(df, labels) == T.medians(hot, hot.columns)
    names = [f"n{i}" for i in range(2500)]
    wide = spark.range(3).select(*[(F.col("id") * i).cast("double").alias(c) for i, c in enumerate(names)])
    model = CoxModel(names, [1e-3] * 2500, [1.0] * 2500, [1.0], [1.0], 0.0, 1)
    got = wide.select(S.risk_score(model).alias("r")).collect()
    assert sorted(r.r for r in got) == pytest.approx([sum(1e-3 * (k * i - 1) for i in range(2500)) for k in range(3)])
    unknown = wide.withColumn("n7", F.lit(None).cast("double"))
    assert unknown.select(S.risk_score(model).alias("r")).first().r is None


def test_wide_category_gives_the_one_hot_fit(spark, monkeypatch):
    """A category of many labels is fitted and scored without a column a label, with the same model and risks."""
    rng = np.random.default_rng(11)
    n = 3000
    data = pd.DataFrame(
        {
            "timestamp": [pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=5 * i) for i in range(n)],
            "machine_id": [None if i % 50 == 0 else f"M{k}" for i, k in enumerate(rng.integers(0, 90, n))],
            "iot_statut_machine": rng.choice(["Production", "Pause"], n),
            "iot_temperature": 40 + rng.normal(size=n),
            "age_jours": rng.random(n) * 100,
            "RUL_jours": 3 * rng.random(n),
            "type_censure_futur_audit": np.where(rng.random(n) < 0.6, "Correctif", "Sain"),
        }
    )
    df = spark.createDataFrame(data, "timestamp timestamp_ntz, machine_id string, iot_statut_machine string, iot_temperature double, age_jours double, RUL_jours double, type_censure_futur_audit string")
    monkeypatch.setattr(T, "WIDE_LABELS", 1000)
    plain = T.train(df, top_k=4)
    monkeypatch.setattr(T, "WIDE_LABELS", 64)
    hot = T.one_hot
    monkeypatch.setattr(T, "one_hot", lambda rows, labels: hot(rows, {c: v for c, v in labels.items() if len(v) <= 64 or 1 / 0}))
    wide = T.train(df, top_k=4)
    assert wide.columns == plain.columns == wide.model.features and len(wide.columns) > 89 and wide.model.converged
    assert wide.fill == plain.fill and wide.model.steps == plain.model.steps
    for name in ("coefficients", "means", "log_hazard"):
        assert getattr(wide.model, name) == pytest.approx(getattr(plain.model, name), abs=1e-7)
    assert wide.model.log_likelihood == pytest.approx(plain.model.log_likelihood, rel=1e-9)
    assert wide.metrics["c_index"] == pytest.approx(plain.metrics["c_index"], abs=1e-6)
    some = df.limit(200).union(df.limit(3).withColumn("machine_id", F.lit("never seen")))
    new = predict(some, wide).toPandas().sort_values(["timestamp", "machine_id"])
    monkeypatch.undo()
    monkeypatch.setattr(T, "WIDE_LABELS", 1000)
    old = predict(some, plain).toPandas().sort_values(["timestamp", "machine_id"])
    assert new.risque.tolist() == pytest.approx(old.risque.tolist(), abs=1e-6)
    assert new.rul_jours_estime.tolist() == old.rul_jours_estime.tolist()
