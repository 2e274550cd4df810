"""Classifiers and runs are fitted on all rows, also beyond the 50,000 that were once the bound."""

from __future__ import annotations

import pytest

from trafficlens.operators import classifiers
from trafficlens.plans import jobs

ROWS = 70_000


def counted(model) -> int:
    """Draws of a bootstrap that its only tree was grown on: as many as there were rows, give or take some hundred."""
    forest = next(s for s in model.stages if hasattr(s, "treeWeights"))
    return int(forest._java_obj.trees()[0].rootNode().impurityStats().count())


@pytest.fixture
def rows(spark):
    return spark.range(ROWS).selectExpr(
        "id", "cast(id % 97 as double) a", "cast(id % 2 as int) label", "case when id % 3 = 0 then 'x' else 'y' end kind", "cast('2024-01-01' as timestamp) + make_interval(0, 0, 0, 0, 0, 0, id) log_time")


def test_forest_is_fitted_on_all_rows(rows):
    for balanced in (False, True):
        assert abs(counted(classifiers.fit_random_forest(rows, ["a"], trees=1, max_depth=2, balanced=balanced)) - ROWS) < 1500
    assert abs(counted(classifiers.fit_random_forest(rows, ["a"], trees=1, max_depth=2, fit_rows=20_000)) - 20_000) < 1500


def test_batch_run_fits_on_its_whole_train_side(rows):
    _, held_out, model = jobs.classify_sessions(rows.select("id", "a", "label"), ["a"], trees=1, max_depth=2)
    assert abs(counted(model) - (ROWS - held_out.count())) < 1500


def test_mode_run_fits_on_its_whole_train_side(rows, tmp_path, spark):
    jobs.run_mode(spark, rows.select("id", "a", "label", "log_time"), str(tmp_path / "out"), "supervised", trees=1, max_depth=2)
    model = classifiers.load_model(str(tmp_path / "out" / "models" / "classifier"))
    assert counted(model) > 0.77 * ROWS


def test_traffic_types_are_fitted_on_all_rows(rows):
    model = classifiers.fit_traffic_types(rows, "kind", ["a"], None, trees=1, max_depth=2)
    assert abs(counted(model) - ROWS) < 1500
    assert abs(counted(classifiers.fit_traffic_types(rows, "kind", ["a"], None, trees=1, max_depth=2, fit_rows=20_000)) - 20_000) < 1500
