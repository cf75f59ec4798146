"""The declared checks on our own outputs and on broken rows."""

import json
from collections import Counter

from pyspark.sql import functions as F

from lavoura.operators import gold, quality, silver, stats
from rows import MS, bronze

AS_OF = "2024-02-01 00:00:00"


def by_check(report):
    return {(r["check_name"], r["column_name"]): (r["failures"], r["status"]) for r in report.collect()}


def test_clean_tables_pass_everything(spark):
    rows = silver.build_silver(bronze(spark, {}, {"proponente_id": "B", "serasa_score": None}), AS_OF)
    assert {s for _, s in by_check(quality.silver_report(rows, AS_OF)).values()} == {"pass"}
    for name, (build, keys) in gold.MODELS.items():
        assert {s for _, s in by_check(quality.gold_report(name, build(rows, AS_OF), keys, AS_OF)).values()} == {"pass"}


def test_every_broken_row_is_reported(spark):
    rows = silver.build_silver(
        bronze(
            spark,
            {"tipo_pessoa": "OUTRA"},
            {"tipo_pessoa": None},
            {"finalidade_credito": "REFORMA_INSTALACOES", "data_solicitacao": MS + 1},
            {"cultura_principal": "PECUARIA", "data_solicitacao": MS + 2},
            {"latitude": 91.0, "longitude": None, "data_solicitacao": MS + 3},
            {"valor_solicitado_credito": -1},
            {"valor_solicitado_credito": 1000001, "renda_bruta_anual_declarada": 100000},
            {"renda_bruta_anual_declarada": 0, "data_solicitacao": MS + 4},
        ),
        AS_OF,
    )
    got = by_check(quality.silver_report(rows, AS_OF))
    assert got["not_null", "tipo_pessoa"] == (1, "error")
    assert got["accepted_values", "tipo_pessoa"] == (1, "error")
    assert got["accepted_values", "finalidade_credito"] == (1, "error")
    assert got["accepted_values", "cultura_principal"] == (1, "error")
    assert got["accepted_values", "registro_valido"] == (1, "error")
    assert got["expression_is_true", "localizacao_latitude"] == (1, "error")
    assert got["expression_is_true", "localizacao_longitude"] == (0, "pass")
    assert got["expression_is_true", "valor_solicitado_credito"] == (1, "error")
    assert got["ratio_outliers", "razao_credito_renda"] == (1, "warn")
    assert got["unique_combination_of_columns", "proponente_id,data_solicitacao,valor_solicitado_credito"] == (1, "error")
    unexpected = quality.unexpected_values(rows, {"cultura_principal": ["SOJA"], "registro_valido": [True]})
    assert {tuple(r) for r in unexpected.collect()} == {("cultura_principal", "PECUARIA", 1), ("registro_valido", "false", 1)}
    # The stored failures are what the report counts, line by line.
    lines = quality.silver_failures(rows, AS_OF).collect()
    counted = Counter((r["check_name"], r["column_name"]) for r in lines)
    assert counted == {key: n for key, (n, _) in got.items() if n}
    broken = [json.loads(r["detail"]) for r in lines if (r["check_name"], r["column_name"]) == ("accepted_values", "tipo_pessoa")]
    assert [(d["tipo_pessoa"], "proponente_id" in d) for d in broken] == [("OUTRA", True)]


def test_recency_limit_and_empty_table(spark):
    rows = silver.build_silver(bronze(spark, {}), AS_OF)

    def failures(df, now):
        return quality.count_failures(df, [quality.recency("processed_at", now, 24)]).first()["failures"]

    assert failures(rows, "2024-02-02 00:00:00") == 0
    assert failures(rows, "2024-02-02 00:00:01") == 1
    assert failures(rows.limit(0), AS_OF) == 1


def test_ratio_limit_is_strict(spark):
    rows = silver.build_silver(
        bronze(
            spark,
            {"valor_solicitado_credito": 1000, "renda_bruta_anual_declarada": 100},
            {"valor_solicitado_credito": 1000.01, "renda_bruta_anual_declarada": 100},
        ),
        AS_OF,
    )
    assert quality.ratio_outliers(rows, AS_OF).count() == 1
    assert quality.ratio_outliers(rows, "2024-02-03 00:00:00").count() == 0


def test_statistics_and_small_partitions(spark):
    rows = silver.build_silver(bronze(spark, {}, {"uf": "SP", "data_solicitacao": MS + 1}, {"proponente_id": "B", "uf": None}), AS_OF)
    assert stats.table_stats(rows).select("total_rows", "unique_proponentes", "unique_states").first() == (3, 2, 2)
    sizes = spark.range(2500).select(F.when(F.col("id") < 2000, "big").otherwise("small").alias("p"))
    assert [tuple(r) for r in stats.small_partitions(sizes, ["p"]).collect()] == [("small", 500)]
    assert [tuple(r) for r in stats.small_partitions(sizes, ["p"], 5000).collect()] == [("small", 500), ("big", 2000)]
