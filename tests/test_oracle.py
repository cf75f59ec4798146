"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from compare import differences, oracle_connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.QUERIES, entry.ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"table_health", "ml_train"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toArrow()
    assert differences(got, con.sql(ORACLE[name]).to_arrow_table()) is None


def test_table_health_sees_every_table(spark):
    rows = {r["table_name"]: r for r in QUERIES["table_health"](spark, SF_DIR).collect()}
    assert rows["orders"]["files_count"] == 1
    assert rows["orders"]["total_size_mb"] == os.path.getsize(f"{SF_DIR}/orders.parquet") / 1024 / 1024
    assert rows["orders"]["issues"] == "small_files"


def test_training_repeats(spark):
    first, again = (QUERIES["ml_train"](spark, SF_DIR).first() for _ in range(2))
    assert first == again and first["n"] > 0 and 0 <= first["accuracy"] <= 1


def test_entry(spark):
    assert entry.entry(spark).count() == 50


def test_results_do_not_need_a_shared_folder(spark, con, monkeypatch):
    """A session on one machine without a checkpoint folder keeps its intermediate tables in a folder of its own."""
    from lavoura.sources import staging

    monkeypatch.setattr(staging, "checkpoint_root", lambda spark: None)
    for name in ("gold_location", "assemble_features", "ml_impute", "ks_drift"):
        got = QUERIES[name](spark, SF_DIR).toArrow()
        assert differences(got, con.sql(ORACLE[name]).to_arrow_table()) is None
