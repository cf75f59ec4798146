"""Golden decisions and rule boundaries."""

import pytest
from pyspark.sql import functions as F

from lavoura.operators import enrichment, gold, scoring, serving, silver
from rows import bronze

# name, income, requested, years, area, bureau, fine, score, level, limit, decision
GOLDEN = [
    ("approve", 800000, 150000, 25, 1200, 850, False, 1.0, "LOW", 150000.0, "APPROVE"),
    ("review", 120000, 80000, 8, 50, 620, False, 0.65, "MEDIUM", 29700.0, "APPROVE"),
    ("deny", 45000, 200000, 0, 15, 380, True, 0.0, "HIGH", 6750.0, "DENY"),
    ("smoke", 150000, 50000, 15, 100, 750, False, 0.8, "LOW", 40500.0, "APPROVE"),
]


def request(name, income, requested, years, area, bureau, fine, *_):
    return {
        "proponente_id": name,
        "renda_bruta_anual_declarada": income,
        "valor_solicitado_credito": requested,
        "anos_experiencia": years,
        "area_total_hectares": area,
        "serasa_score": bureau,
        "ibama_autuacoes_ativas": fine,
    }


def test_golden_requests(spark):
    rows = silver.flatten(bronze(spark, *[request(*g) for g in GOLDEN]))
    got = {r["proponente_id"]: r for r in scoring.decide(rows).collect()}
    for name, *_, score, level, limit, decision in GOLDEN:
        r = got[name]
        assert r["score"] == pytest.approx(score) and r["credit_limit"] == pytest.approx(limit)
        assert (r["risk_level"], r["recommendation"]) == (level, decision)


def score(spark, **changes):
    base = request("x", 200000, 100000, 3, 80, None, False)
    return scoring.decide(silver.flatten(bronze(spark, {**base, **changes}))).first()


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, 0.5),
        ({"renda_bruta_anual_declarada": 100000}, 0.5),
        ({"renda_bruta_anual_declarada": 99999}, 0.2),
        ({"renda_bruta_anual_declarada": 300000}, 0.5),
        ({"renda_bruta_anual_declarada": 300001}, 0.6),
        ({"renda_bruta_anual_declarada": 500000}, 0.6),
        ({"renda_bruta_anual_declarada": 500001}, 0.7),
        ({"valor_solicitado_credito": 0}, 0.5),
        ({"anos_experiencia": 0}, 0.3),
        ({"anos_experiencia": 5}, 0.5),
        ({"anos_experiencia": 6}, 0.55),
        ({"anos_experiencia": 10}, 0.55),
        ({"anos_experiencia": 11}, 0.6),
        ({"area_total_hectares": 100}, 0.5),
        ({"area_total_hectares": 100.01}, 0.55),
        ({"area_total_hectares": 500}, 0.55),
        ({"area_total_hectares": None}, 0.5),
        ({"serasa_score": 0}, 0.5),
        ({"serasa_score": 500}, 0.4),
        ({"serasa_score": 501}, 0.6),
        ({"serasa_score": 701}, 0.7),
        ({"ibama_autuacoes_ativas": True}, 0.35),
        ({"ibama_autuacoes_ativas": None}, 0.5),
    ],
)
def test_points(spark, changes, expected):
    assert score(spark, **changes)["score"] == pytest.approx(expected)


def test_boundary_of_ui_and_recommendation_differ(spark):
    row = score(spark, renda_bruta_anual_declarada=300001)
    assert row["score"] == 0.6 and row["approved_in_ui"] and row["recommendation"] == "MANUAL_REVIEW"


def test_model_score_falls_back_to_the_rules(spark):
    rows = silver.flatten(bronze(spark, {})).crossJoin(
        spark.createDataFrame([(0.25,), (None,), (float("nan"),), (1.5,)], "p double")
    )
    got = [r[0] for r in rows.select(scoring.model_or_rules(F.col("p"))).collect()]
    rules = rows.select(scoring.rule_score()).first()[0]
    assert got == [0.75, rules, rules, rules]


def test_request_features_and_vector(spark):
    rows = silver.flatten(bronze(spark, {"serasa_score": 0, "ibama_autuacoes_ativas": None, "possui_experiencia_atividade": None}))
    got = scoring.with_request_features(rows, ["proponente_id"]).first()
    assert (got["serasa_score"], got["ibama_autuacoes_ativas"], got["possui_experiencia_atividade"]) == (500, 0, 0)
    assert (got["tipo_pessoa_fisica"], got["cultura_principal_soja"], got["finalidade_custeio"]) == (1, 1, 1)
    vector = scoring.feature_vector(spark.createDataFrame([("a", None, 3)], "id string, serasa_score_medio double, diversidade_culturas int"), ["id"]).first()
    assert len(vector) == 12 and vector["serasa_score_medio"] == 0.0 and vector["diversidade_culturas"] == 3.0


def test_requests_are_looked_up_then_predicted_then_decided(spark):
    """A known applicant, a known place only, nothing known; a model that has nothing to say on some."""
    rows = silver.build_silver(bronze(spark, {"proponente_id": "KNOWN"}), "2024-02-01 00:00:00")
    served = {name: build(rows, "2024-02-01 00:00:00") for name, (build, _) in gold.MODELS.items()}
    asked = [
        {"proponente_id": "KNOWN", "municipio": "Longe", "cultura_principal": "CAFE"},
        {"proponente_id": "PLACE", "cultura_principal": "CAFE"},
        {"proponente_id": "NEW", "municipio": "Longe", "cultura_principal": "CAFE"},
        {"proponente_id": "NONE", "municipio": None, "uf": None, "cultura_principal": None, "serasa_score": None},
    ]
    requests = silver.flatten(bronze(spark, *asked))
    inputs = {r["proponente_id"]: r for r in serving.model_inputs(requests, served).collect()}
    assert {k: r["features_found"] for k, r in inputs.items()} == {"KNOWN": True, "PLACE": True, "NEW": False, "NONE": False}
    assert inputs["KNOWN"]["total_solicitacoes"] == 1.0 and inputs["NEW"]["total_solicitacoes"] == 0.0
    assert inputs["PLACE"]["valor_medio_solicitado"] == 50000.0 and inputs["PLACE"]["total_solicitacoes"] == 0.0

    def predict(seen):
        assert seen.count() == 4  # the requests alone
        mean = F.col("valor_medio_solicitado")
        return seen.withColumn("probability_default", F.when(mean == 0, F.lit(float("nan"))).otherwise(mean / 200000))

    got = {r["proponente_id"]: r for r in serving.decisions(requests, served, predict).collect()}
    rules = {r["proponente_id"]: r["score"] for r in scoring.decide(requests).collect()}
    assert {k: r["decided_by"] for k, r in got.items()} == {"KNOWN": "model", "PLACE": "model", "NEW": "rules", "NONE": "rules"}
    assert got["KNOWN"]["score"] == 0.75 and got["NEW"]["score"] == rules["NEW"] and got["NONE"]["score"] == rules["NONE"]
    without = {r["proponente_id"]: (r["decided_by"], r["score"]) for r in serving.decisions(requests, served).collect()}
    assert without == {k: ("rules", v) for k, v in rules.items()}


def test_validation_reasons(spark):
    rows = silver.flatten(
        bronze(
            spark,
            {"cpf_cnpj": "12.345.678/0001-90"},
            {"cpf_cnpj": "111.222.333-44"},
            {"cpf_cnpj": "123"},
            {"cpf_cnpj": None},
            {"nome_razao_social": ""},
            {"municipio": None},
            {"numero_matricula_imovel": ""},
            {"proponente_id": ""},
        )
    )
    got = [r["reason"] for r in scoring.validate_requests(rows).collect()]
    assert got == [
        None, None, "invalid_cpf_cnpj", "invalid_cpf_cnpj", "missing_nome_razao_social", "missing_municipio",
        "missing_numero_matricula", "missing_proponente_id",
    ]


def test_simple_score_and_stand_in_features(spark):
    cases = [(100000.0, 0, 0), (None, None, None), (10**12 * 1.0, 0, 0), (0.0, 20, 0), (12345.0, 1, 1)]
    df = spark.createDataFrame(cases, "i double, p int, q int")
    got = [r[0] for r in df.select(enrichment.simple_credit_score(F.col("i"), F.col("p"), F.col("q"))).collect()]
    assert got == [610, 600, 850, 300, 571]
    rows = bronze(spark, {}, {"latitude": None}, {"longitude": 0.0})
    first, *rest = enrichment.event_features(rows, "2024-02-01 00:00:00").collect()
    assert 0.1 <= first["avg_ndvi_90d"] <= 0.9 and 30 <= first["idade_cultura_predominante_dias"] < 210
    assert first["distancia_porto_km"] == pytest.approx(round(abs(-20 + 23.9875) * 100 + abs(-50 + 46.3039) * 100, 2))
    assert all(r["avg_ndvi_90d"] == 0.5 and r["distancia_porto_km"] == 500.0 for r in rest)
    again = enrichment.event_features(rows, "2024-02-01 00:00:00").first()
    assert again == first
