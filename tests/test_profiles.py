"""Numbers and sketches of what runs wrote."""

import pytest

from larder.operators import history as runs
from larder.plans.recipes import ingest_recipes, recipe_profiles
from larder.sources.history_table import HistoryTable
from larder.sources.profiles import merged_profiles
from tests.test_loads import put
from tests.test_reconcile import job_in


def profile(spark, job, before):
    rows = merged_profiles(recipe_profiles(spark, job).stored(job.etl_name, before)).collect()
    return {r.column: tuple(r)[1:] for r in rows}


def test_profiles_add_up(spark, tmp_path):
    job = job_in(spark, tmp_path, ledger_path=str(tmp_path / "ledger"), profiles_path=str(tmp_path / "profiles"))
    assert profile(spark, job, 9) == {}
    put(tmp_path / "in", "a.json", *((f"n{i % 50}", "2013-03-28", f"PT{i}M") for i in range(100)))
    ingest_recipes(spark, job)
    put(tmp_path / "in", "b.json", *((f"n{i % 60}", "?", None) for i in range(100)))
    ingest_recipes(spark, job)
    first, both = profile(spark, job, 2), profile(spark, job, 3)
    assert first["recipeName"] == (1, 100, 0, 50, None) and both["recipeName"] == (2, 200, 0, 60, None)
    assert both["datePublished"] == (2, 200, 100, 1, None)
    assert both["cookTimeMinutes"][:4] == (2, 200, 100, None) and first["cookTimeMinutes"][4] == both["cookTimeMinutes"][4]
    assert all(abs(q - x) <= 1 for q, x in zip(both["cookTimeMinutes"][4], (25, 50, 75), strict=True))
    # A full load starts anew; runs without rows, and columns without values, have a profile as well.
    HistoryTable(spark, job.history_path).append(runs.seed(spark, job.etl_name, run_id=4))
    (tmp_path / "in" / "a.json").write_text("")
    ingest_recipes(spark, job)
    assert profile(spark, job, 5)["cookTimeMinutes"] == (1, 100, 100, None, None)
    assert profile(spark, job, 5)["datePublished"] == (1, 100, 100, 0, None)


@pytest.mark.parametrize("changes", [{"merge_keys": ("image",)}, {"reconcile": True}])
def test_profiles_of_other_loads(spark, tmp_path, changes):
    job = job_in(spark, tmp_path, profiles_path=str(tmp_path / "profiles"), **changes)
    put(tmp_path / "in", "a.json", ("a", "2013-03-28", "PT1M"))
    ingest_recipes(spark, job)
    put(tmp_path / "in", "b.json", ("b", "2013-04-28", "PT3M"))
    done = ingest_recipes(spark, job)
    assert done.watermark == "2013-04-28" and profile(spark, job, 3)["recipeName"] == (2, 2, 0, 2, None)
    ingest_recipes(spark, job)
    assert profile(spark, job, 4)["recipeName"][1:3] == (2, 0)
