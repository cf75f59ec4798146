"""What the plans of the registered queries must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lavoura.functions.columns import instant
from lavoura.operators import silver
from lavoura.plans import jobs
from lavoura.sources import staging
from lavoura.sources.applications import bronze_applications

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()


@pytest.fixture()
def whole_plans(spark, monkeypatch):
    """Plans in one piece, joined as if no side were small."""
    monkeypatch.setattr(staging, "_written", lambda df, path: df)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Streams, training and whole jobs run their plans before they return.
RUN_AT_ONCE = {"ml_train", "dated_partitions", "gold_after_load", "gold_after_stream", "gold_between"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in RUN_AT_ONCE and not n.startswith("stream_")))
def test_no_cross_join_and_no_python(spark, whole_plans, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "MapInPandas"):
        assert unwanted not in plan, unwanted
    # Only the drift test and the split broadcast: one line per watched feature, one per class.
    assert ("BroadcastHashJoin" in plan) == (name in ("ks_drift", "ml_split", "model_gate"))


def test_scan_reads_only_what_a_load_needs(spark, folder):
    for name in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    lake = jobs.Lakehouse(spark, f"{folder}/lake")
    jobs.append_bronze(lake, bronze_applications(spark, SF_DIR))
    arrived = spark.table(jobs.BRONZE_TABLE).where(
        (F.col("mes_ingestao") >= "2001-05") & (F.col("ingestion_timestamp") > instant("2001-05-03 00:00:00"))
    )
    plan = physical(silver.build_silver(arrived, "2001-09-01 00:00:00").select("proponente_id", "localizacao_uf"))
    assert "PartitionFilters: [isnotnull(mes_ingestao" in plan
    assert "GreaterThan(ingestion_timestamp" in plan
    assert "localizacao_propriedade:struct<uf:string>" in plan
    assert "Exchange" not in plan
    spark.sql("DROP DATABASE bronze CASCADE")


def test_aggregates_combine_before_the_shuffle(spark, whole_plans):
    plan = physical(QUERIES["gold_proponente"](spark, SF_DIR))
    assert "partial_mode" in plan and "partial_sum(valor_solicitado_credito" in plan
    assert "Expand" not in plan
