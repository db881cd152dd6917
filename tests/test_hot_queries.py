"""Registered queries give the same rows when every key is cut into small blocks."""

import pytest

from tests.conftest import rows
from tickforge import catalog
from tickforge.operators import ordering, reference, timeline

catalog.load_all()


NAMES = [
    "since_last_stop",
    "spike_mad",
    "asof_forward_next_start",
    "c_index",
    "train_test_split",
    "mutual_information_rank",
    "gap_interpolation",
    "episodes_by_type",
    "median_impute",
]


@pytest.mark.parametrize("name", NAMES)
def test_cut_equals_whole(spark, sf_dir, name, monkeypatch):
    whole = rows(catalog.QUERIES[name](spark, sf_dir))
    monkeypatch.setattr(timeline, "BLOCK_ROWS", 15)
    monkeypatch.setattr(ordering, "SMALL_ROWS", 0)
    monkeypatch.setattr(reference, "SMALL_ROWS", 0)
    for module in (timeline, ordering, reference):
        monkeypatch.setattr(module, "surely_small", lambda df, n: False)
    assert rows(catalog.QUERIES[name](spark, sf_dir)) == whole
