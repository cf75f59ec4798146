"""Boundaries, NULLs, ties and one-row groups of silver and gold."""

import pytest
from pyspark.sql import functions as F

from lavoura.functions import classify
from lavoura.operators import gold, incremental, silver
from lavoura.schemas import SILVER_KEY
from rows import MS, bronze

AS_OF = "2024-02-01 00:00:00"
DAY = 86_400_000


def values(spark, pairs, schema, expression):
    return [r[0] for r in spark.createDataFrame(pairs, schema).select(expression).collect()]


def test_property_class_limits(spark):
    areas = [(49.99,), (50.0,), (199.99,), (200.0,), (1000.0,), (None,)]
    assert values(spark, areas, "a double", classify.property_class(F.col("a"))) == [
        "MINIFUNDIO", "PEQUENA", "PEQUENA", "MEDIA", "GRANDE", "GRANDE",
    ]


def test_risk_band_limits(spark):
    scores = [(299,), (300,), (499,), (500,), (699,), (700,), (None,)]
    assert values(spark, scores, "s int", classify.risk_band(F.col("s"))) == [
        "MUITO_ALTO", "ALTO", "ALTO", "MEDIO", "MEDIO", "BAIXO", "SEM_SCORE",
    ]


def test_rates_are_strict_at_the_limit(spark):
    rates = [(0.7,), (0.71,), (0.3,), (0.31,)]
    assert values(spark, rates, "r double", classify.person_profile(F.col("r"))) == [
        "MISTA", "PREDOMINANTEMENTE_JURIDICA", "PREDOMINANTEMENTE_FISICA", "MISTA",
    ]
    assert values(spark, [(0.5,), (0.2,), (0.0,), (0.51,)], "r double", classify.environmental_risk(F.col("r"))) == [0.8, 0.6, 0.3, 1.0]
    shares = [(0.6, 0.0, 0.0), (0.61, 0.9, 0.9), (0.0, 0.4, 0.0), (0.0, 0.41, 0.9), (0.0, 0.0, 0.3), (0.0, 0.0, 0.31)]
    assert values(spark, shares, "a double, b double, c double", classify.purpose_profile(F.col("a"), F.col("b"), F.col("c"))) == [
        "DIVERSIFICADO", "FOCO_CUSTEIO", "DIVERSIFICADO", "FOCO_INVESTIMENTO", "DIVERSIFICADO", "FOCO_EXPANSAO",
    ]


def test_adjusted_risk_multiplies_the_three_factors(spark):
    cases = [("BAIXO", "SOJA", 0.31), ("SEM_SCORE", "TRIGO", 0.1), ("MUITO_ALTO", "ARROZ", 0.11), (None, None, None)]
    got = values(spark, cases, "b string, c string, r double", classify.adjusted_risk(F.col("b"), F.col("c"), F.col("r")))
    assert got == [0.1 * 0.9 * 1.2, 0.5 * 1.1 * 1.0, 0.9 * 1.0 * 1.1, 0.5]


def test_no_mean_latitude_is_south(spark):
    assert values(spark, [(None,), (-10.0,), (-9.99,)], "l double", classify.region(F.col("l"))) == ["SUL", "NORDESTE", "NORTE"]


def test_validity_is_never_null(spark):
    rows = silver.build_silver(
        bronze(
            spark,
            {},
            {"cpf_cnpj": None},
            {"area_total_hectares": None},
            {"area_total_hectares": 0},
            {"uf": None},
            {"valor_solicitado_credito": None},
        ),
        AS_OF,
    )
    assert [r[0] for r in rows.select("registro_valido").collect()] == [True] + [False] * 5


def test_unidentified_rows_are_left_out_and_structs_may_be_missing(spark):
    rows = bronze(spark, {"proponente_id": None}, {}).withColumn("fontes_dados_adicionais", F.expr("CAST(NULL AS STRUCT<serasa_score: INT, ibama_autuacoes_ativas: BOOLEAN, numero_matricula_imovel: STRING>)"))
    got = silver.build_silver(rows, AS_OF).collect()
    assert len(got) == 1 and got[0]["serasa_score"] is None and got[0]["faixa_risco_credito"] == "SEM_SCORE"


def test_times_are_converted_once(spark):
    row = silver.flatten(bronze(spark, {"data_solicitacao": 1704682800000})).select(F.date_format("data_solicitacao", "yyyy-MM-dd HH:mm")).first()
    assert row[0] == "2024-01-08 03:00"


def test_group_of_one_and_constant_values(spark):
    rows = silver.build_silver(
        bronze(
            spark,
            {"proponente_id": "ONE"},
            {"proponente_id": "FLAT"},
            {"proponente_id": "FLAT", "data_solicitacao": MS + DAY - 1},
            {"proponente_id": "WIDE", "valor_solicitado_credito": 10},
            {"proponente_id": "WIDE", "valor_solicitado_credito": 1000, "data_solicitacao": MS + DAY},
        ),
        AS_OF,
    )
    got = {r["proponente_id"]: r for r in gold.gold_proponente(rows, AS_OF).collect()}
    assert got["ONE"]["valor_desvio_padrao"] is None and got["ONE"]["perfil_volatilidade"] == "CONSISTENTE"
    assert got["FLAT"]["valor_desvio_padrao"] == 0 and got["FLAT"]["perfil_volatilidade"] == "CONSISTENTE"
    assert got["FLAT"]["dias_entre_primeira_ultima"] == 0
    assert got["WIDE"]["perfil_volatilidade"] == "VOLATIL" and got["WIDE"]["dias_entre_primeira_ultima"] == 1
    place = gold.gold_location(rows, AS_OF).first()
    assert place["total_proponentes"] == 5 and place["proponentes_unicos"] == 3 and place["taxa_recorrencia"] == 0.6
    assert place["valor_mediano_solicitado"] == 50000.0


def test_blank_keys_are_skipped(spark):
    rows = silver.build_silver(bronze(spark, {"proponente_id": "  "}, {"municipio": " ", "proponente_id": "A"}, {"cultura_principal": ""}), AS_OF)
    assert {r[0] for r in gold.gold_proponente(rows, AS_OF).select("proponente_id").collect()} == {"A", "PROP_00001"}
    assert gold.gold_location(rows, AS_OF).first()["total_proponentes"] == 2
    assert gold.gold_risk(rows, AS_OF).first()["total_solicitacoes"] == 2


def test_mode_takes_the_most_frequent_then_the_smallest(spark):
    crops = ["SOJA", "MILHO", "MILHO", "SOJA", "CAFE", None]
    rows = silver.build_silver(
        bronze(spark, *[{"cultura_principal": c, "data_solicitacao": MS + i} for i, c in enumerate(crops)]), AS_OF
    )
    got = gold.gold_proponente(rows, AS_OF).first()
    assert got["cultura_mais_comum"] == "MILHO" and got["diversidade_culturas"] == 3


def test_group_without_any_category_counts_zero(spark):
    rows = silver.build_silver(bronze(spark, {"finalidade_credito": None, "cultura_principal": None}), AS_OF)
    got = gold.gold_proponente(rows, AS_OF).first()
    assert got["diversidade_culturas"] == 0 and got["cultura_mais_comum"] is None
    assert got["perfil_diversificacao"] == "FOCADO"


def increments(spark, parts=4):
    changes = []
    for i in range(60):
        changes.append(
            {
                "proponente_id": f"P{i % 7}" if i % 3 else "HOT",
                "data_solicitacao": MS + i * DAY,
                "valor_solicitado_credito": 1000 + 37 * i,
                "cultura_principal": ["SOJA", "MILHO", "CAFE"][i * i % 3],
                "finalidade_credito": ["CUSTEIO_SAFRA", "OUTROS"][i % 2],
            }
        )
    # Slices by arrival, with late requests in each.
    return [[c for i, c in enumerate(changes) if (i * 5) % parts == p] for p in range(parts)]


@pytest.mark.parametrize("model", ["proponente", "location", "risk"])
def test_incremental_gold_equals_a_full_build(spark, model):
    build, keys = gold.MODELS[model]
    stamps = [f"2024-03-0{n} 00:00:00" for n in range(1, 5)]
    whole, table = None, None
    for stamp, part in zip(stamps, increments(spark)):
        part = silver.build_silver(bronze(spark, *part), stamp)
        if table is None:
            whole, since = part, stamp
            table = build(whole, stamp)
        else:
            whole = whole.unionByName(part)
            table = gold.refresh(model, whole, table, since, stamp)
            since = stamp

    def rows(df):
        # A standard deviation depends in its last bits on the order rows are merged in.
        rounded = {c: F.round(c, 6) for c in df.columns if "desvio_padrao" in c}
        return sorted(map(str, df.withColumns(rounded).drop("feature_timestamp").collect()))

    assert rows(table) == rows(build(whole, stamps[-1]))


@pytest.mark.parametrize("model", ["proponente", "location", "risk"])
def test_corrections_and_invalid_rows_leave_no_old_groups(spark, model):
    """A corrected group key, a row that turns invalid and a group that empties."""
    build, keys = gold.MODELS[model]
    first = silver.build_silver(bronze(spark, {"cultura_principal": "SOJA"}, {"proponente_id": "P2", "cultura_principal": "CAFE"}), "2024-03-01 00:00:00")
    table = build(first, "2024-03-01 00:00:00")
    final = silver.build_silver(
        bronze(spark, {"cultura_principal": "TRIGO"}, {"proponente_id": "P2", "cultura_principal": "CAFE"}), "2024-03-02 00:00:00"
    ).withColumn("registro_valido", F.col("proponente_id") != "P2")
    refreshed = gold.refresh(model, final, table, "2024-03-01 00:00:00", "2024-03-02 00:00:00", changed=first.unionByName(final))
    plain = lambda df: sorted(map(str, df.drop("feature_timestamp").collect()))
    assert plain(refreshed) == plain(build(final, "2024-03-02 00:00:00")) and refreshed.count() == 1


def test_percentiles_of_a_large_group_are_exact(spark):
    rows = silver.build_silver(bronze(spark, {}), "2024-03-01 00:00:00").select(*gold.SILVER_INPUTS)
    many = rows.drop("valor_solicitado_credito", "proponente_id").join(
        spark.range(200_000).select(F.col("id").cast("decimal(18,2)").alias("valor_solicitado_credito"), F.col("id").cast("string").alias("proponente_id"))
    )
    found = gold.gold_risk(many, "2024-03-02 00:00:00").first()
    assert (found["valor_p25"], found["valor_mediano"], found["valor_p90"]) == (49999.0, 99999.0, 179999.0)


def test_an_older_copy_undoes_nothing(spark):
    noon = silver.build_silver(bronze(spark, {"area_total_hectares": 111}), AS_OF)
    older = silver.build_silver(bronze(spark, {"area_total_hectares": 5}), AS_OF).withColumn(
        "ingestion_timestamp", F.col("ingestion_timestamp") - F.expr("INTERVAL 3 HOURS")
    )
    got = incremental.upsert(noon, older, SILVER_KEY, ["ingestion_timestamp"]).collect()
    assert [float(r["area_total_hectares"]) for r in got] == [111.0]


def test_increment_scope_replaces_with_the_new_rows_alone(spark):
    first = silver.build_silver(bronze(spark, {}, {"data_solicitacao": MS + 1}), "2024-03-01 00:00:00")
    second = silver.build_silver(bronze(spark, {"data_solicitacao": MS + 2}), "2024-03-02 00:00:00")
    table = gold.gold_proponente(first, "2024-03-01 00:00:00")
    both = first.unionByName(second)
    args = ("proponente", both, table, "2024-03-01 00:00:00", "2024-03-02 00:00:00")
    assert gold.refresh(*args).first()["total_solicitacoes"] == 3
    assert gold.refresh(*args, scope="increment").first()["total_solicitacoes"] == 1


def test_upsert_is_repeatable_even_with_null_keys(spark):
    target = silver.build_silver(bronze(spark, {}, {"valor_solicitado_credito": None}), AS_OF)
    source = silver.build_silver(
        bronze(spark, {"area_total_hectares": 7}, {"valor_solicitado_credito": None, "area_total_hectares": 9}, {"proponente_id": "NEW"}), AS_OF
    )
    once = incremental.upsert(target, source, SILVER_KEY, ["ingestion_timestamp"])
    twice = incremental.upsert(once, source, SILVER_KEY, ["ingestion_timestamp"])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert sorted(float(r[0]) for r in once.select("area_total_hectares").collect()) == [7.0, 9.0, 100.0]


def test_newest_copy_wins_inside_an_increment(spark):
    rows = bronze(spark, *[{"nome_razao_social": n} for n in ("A", "C", "B")])
    flat = silver.build_silver(rows, AS_OF)
    best = incremental.latest_per_key(flat, SILVER_KEY, ["ingestion_timestamp"]).collect()
    assert len(best) == 1 and best[0]["nome_razao_social"] == "C" and best[0].__fields__ == flat.columns


def test_high_water_mark_of_an_empty_target_is_the_epoch(spark):
    rows = bronze(spark, {}, {"data_solicitacao": MS + 1})
    empty = silver.build_silver(rows.limit(0), AS_OF)
    assert silver.silver_increment(rows, empty, AS_OF).count() == 2
    assert silver.silver_increment(rows, silver.build_silver(rows, AS_OF), AS_OF).count() == 0
