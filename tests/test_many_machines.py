"""More machines than may become one-hot columns: fitted by panels of flags, with the same model whatever the panels."""

import numpy as np
import pandas as pd
import pytest

from tickforge.plans import survival as S, training as T


def test_machines_above_the_one_hot_limit_are_fitted_by_panels(spark, monkeypatch):
    rng = np.random.default_rng(4)
    n = 1500
    data = pd.DataFrame(
        {
            "timestamp": [pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=5 * i) for i in range(n)],
            "machine_id": [f"M{k}" for k in rng.integers(0, 100, n)],
            "iot_statut_machine": rng.choice(["Production", "Pause"], n),
            "iot_temperature": 40 + rng.normal(size=n),
            "age_jours": rng.random(n) * 100,
            "RUL_jours": 3 * rng.random(n),
            "type_censure_futur_audit": np.where(rng.random(n) < 0.6, "Correctif", "Sain"),
        }
    )
    df = spark.createDataFrame(data, "timestamp timestamp_ntz, machine_id string, iot_statut_machine string, iot_temperature double, age_jours double, RUL_jours double, type_censure_futur_audit string")
    whole = T.train(df, top_k=3)
    monkeypatch.setattr(T, "MAX_CATEGORIES", 40)
    monkeypatch.setattr(S, "_FLAG_PANEL", 16)
    monkeypatch.setattr(S, "_HELD", 50)
    parts = T.train(df, top_k=3)
    assert parts.columns == whole.columns and len(parts.columns) >= 99 and parts.model.converged
    assert parts.model.coefficients == pytest.approx(whole.model.coefficients, abs=1e-8)
    assert parts.metrics["c_index"] == pytest.approx(whole.metrics["c_index"], abs=1e-9)
