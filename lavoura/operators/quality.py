"""Declared data checks: each yields the number of failures, and the failing rows on demand."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import instant, ratio, whole_minutes
from ..schemas import CROPS, PERSON_TYPES, PROPERTY_CLASSES, PURPOSES, RISK_BANDS, SILVER_KEY


@dataclass(frozen=True)
class Check:
    """A check made while rows stream by.

    Rows for which ``failing`` is true are failures; a check on the whole table gives
    its number of failures as the aggregate ``measure`` instead.
    """

    kind: str
    column: str
    failing: Column | None = None
    severity: str = "error"
    measure: Column | None = None

    @property
    def failures(self) -> Column:
        return F.count_if(self.failing) if self.measure is None else self.measure


def not_null(column: str, **kw) -> Check:
    return Check("not_null", column, F.col(column).isNull(), **kw)


def accepted_values(column: str, values: Sequence, **kw) -> Check:
    """NULL is not a failure; ``not_null`` covers it."""
    return Check("accepted_values", column, ~F.col(column).isin(*values), **kw)


def expression_is_true(column: str, holds: Column, where: Column | None = None, **kw) -> Check:
    """Rows meeting ``where`` must satisfy ``holds``; an unknown result is not a failure."""
    failing = ~holds if where is None else where & ~holds
    return Check("expression_is_true", column, failing, **kw)


def silver_checks() -> list[Check]:
    """The checks declared for the silver table."""
    c = F.col
    return [
        *[
            not_null(name)
            for name in (
                "proponente_id", "cpf_cnpj", "data_solicitacao", "tipo_pessoa", "valor_solicitado_credito",
                "finalidade_credito", "localizacao_uf", "area_total_hectares", "cultura_principal",
                "classificacao_propriedade", "faixa_risco_credito", "registro_valido", "processed_at", "row_hash",
            )
        ],
        accepted_values("tipo_pessoa", PERSON_TYPES),
        accepted_values("finalidade_credito", PURPOSES),
        accepted_values("cultura_principal", CROPS),
        accepted_values("classificacao_propriedade", PROPERTY_CLASSES),
        accepted_values("faixa_risco_credito", RISK_BANDS),
        accepted_values("registro_valido", [True]),
        expression_is_true("valor_solicitado_credito", c("valor_solicitado_credito") > 0),
        expression_is_true("area_total_hectares", c("area_total_hectares") > 0),
        expression_is_true(
            "localizacao_latitude", c("localizacao_latitude").between(-90, 90), c("localizacao_latitude").isNotNull()
        ),
        expression_is_true(
            "localizacao_longitude", c("localizacao_longitude").between(-180, 180), c("localizacao_longitude").isNotNull()
        ),
    ]


def _at_least_one(column: str) -> Check:
    return expression_is_true(column, F.col(column) >= 1)


def _unit_range(column: str, low: float = 0, high: float = 1) -> Check:
    return expression_is_true(column, F.col(column).between(low, high))


def gold_checks(model: str) -> list[Check]:
    """The checks declared for one gold table."""
    c = F.col
    if model == "proponente":
        filled = [
            "proponente_id", "total_solicitacoes", "valor_total_solicitado", "valor_medio_solicitado", "perfil_frequencia",
            "perfil_volatilidade", "perfil_diversificacao", "indicador_risco_score", "indicador_risco_ambiental",
            "feature_timestamp",
        ]
        specific = [
            _at_least_one("total_solicitacoes"),
            expression_is_true("valor_total_solicitado", c("valor_total_solicitado") > 0),
            expression_is_true("valor_medio_solicitado", c("valor_medio_solicitado") > 0),
            expression_is_true(
                "serasa_score_medio", c("serasa_score_medio").between(0, 1000), c("serasa_score_medio").isNotNull()
            ),
            accepted_values("perfil_frequencia", ["NOVO", "RECORRENTE", "FREQUENTE", "MUITO_FREQUENTE"]),
            accepted_values("perfil_volatilidade", ["CONSISTENTE", "ESTAVEL", "MODERADO", "VOLATIL"]),
            accepted_values("perfil_diversificacao", ["ESPECIALIZADO", "FOCADO", "DIVERSIFICADO"]),
            _unit_range("indicador_risco_score"),
            _unit_range("indicador_risco_ambiental"),
        ]
    elif model == "location":
        filled = [
            "localizacao_uf", "localizacao_municipio", "total_proponentes", "densidade_proponentes", "homogeneidade_credito",
            "perfil_diversificacao_culturas", "regiao_geografica", "taxa_risco_elevado", "feature_timestamp",
        ]
        specific = [
            _at_least_one("total_proponentes"),
            accepted_values("densidade_proponentes", ["BAIXA", "MEDIA", "ALTA", "MUITO_ALTA"]),
            accepted_values("homogeneidade_credito", ["HOMOGENEA", "ESTAVEL", "MODERADA", "HETEROGENEA"]),
            accepted_values(
                "perfil_diversificacao_culturas",
                ["MONOCULTURA", "POUCO_DIVERSIFICADA", "MODERADAMENTE_DIVERSIFICADA", "ALTAMENTE_DIVERSIFICADA"],
            ),
            accepted_values("regiao_geografica", ["NORTE", "NORDESTE", "CENTRO_OESTE_SUDESTE", "SUL"]),
            _unit_range("taxa_risco_elevado"),
        ]
    elif model == "risk":
        filled = [
            "faixa_risco_credito", "cultura_principal", "total_solicitacoes", "volume_solicitacoes", "volatilidade_credito",
            "perfil_tipo_pessoa", "perfil_finalidade", "peso_risco_base", "fator_risco_cultura", "score_risco_ajustado",
            "feature_timestamp",
        ]
        specific = [
            accepted_values("faixa_risco_credito", RISK_BANDS),
            accepted_values("cultura_principal", CROPS),
            _at_least_one("total_solicitacoes"),
            accepted_values("volume_solicitacoes", ["BAIXO_VOLUME", "MEDIO_VOLUME", "ALTO_VOLUME", "MUITO_ALTO_VOLUME"]),
            accepted_values("volatilidade_credito", ["HOMOGENEO", "ESTAVEL", "MODERADO", "VOLATIL"]),
            accepted_values("perfil_tipo_pessoa", ["PREDOMINANTEMENTE_JURIDICA", "MISTA", "PREDOMINANTEMENTE_FISICA"]),
            accepted_values("perfil_finalidade", ["FOCO_CUSTEIO", "FOCO_INVESTIMENTO", "FOCO_EXPANSAO", "DIVERSIFICADO"]),
            _unit_range("peso_risco_base"),
            _unit_range("fator_risco_cultura", 0.5, 1.5),
            _unit_range("score_risco_ajustado", 0, 1.5),
        ]
    else:
        raise ValueError(f"unknown gold model: {model}")
    return [*[not_null(name) for name in filled], *specific]


def count_failures(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check, all counted in a single pass over the data."""
    counted = df.agg(*[check.failures.alias(f"f{i}") for i, check in enumerate(checks)])
    described = [
        F.struct(
            F.lit(check.kind).alias("check_name"),
            F.lit(check.column).alias("column_name"),
            F.lit(check.severity).alias("severity"),
            F.col(f"f{i}").alias("failures"),
        )
        for i, check in enumerate(checks)
    ]
    return counted.select(F.explode(F.array(*described)).alias("r")).select("r.*")


def unexpected_values(df: DataFrame, accepted: dict[str, Sequence]) -> DataFrame:
    """Rows per value outside its column's accepted list; only offending rows are spread out."""
    offending = [
        F.when(~F.col(c).isin(*values), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
        for c, values in accepted.items()
    ]
    found = df.select(F.explode(F.filter(F.array(*offending), lambda o: o.isNotNull())).alias("o")).select("o.*")
    return found.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unique(df: DataFrame, keys: Sequence[str], severity: str = "error") -> DataFrame:
    """Number of key combinations that are not unique."""
    kind = "unique" if len(keys) == 1 else "unique_combination_of_columns"
    return count_failures(duplicate_keys(df, keys), [Check(kind, ",".join(keys), severity=severity, measure=F.count(F.lit(1)))])


def recency(column: str, as_of: datetime | str | Column, hours: int, **kw) -> Check:
    """Fails once when the newest stamp is older than the limit, or when there is none."""
    fresh = F.max(column) >= F.first(instant(as_of)) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return Check("recency", column, measure=F.when(fresh, 0).otherwise(1).cast("long"), **kw)


def recent_rows(df: DataFrame, column: str, as_of: datetime | str | Column, hours: int) -> DataFrame:
    return df.where(F.col(column) >= instant(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS"))


def credit_to_income() -> Column:
    return ratio(F.col("valor_solicitado_credito"), F.col("renda_bruta_anual_declarada"))


def ratio_outliers(silver: DataFrame, as_of: datetime | str | Column, limit: float = 10, hours: int = 24) -> DataFrame:
    """Recently processed applications asking for more than ``limit`` times the yearly income."""
    return (
        recent_rows(silver, "processed_at", as_of, hours)
        .withColumn("razao_credito_renda", credit_to_income())
        .where(F.col("razao_credito_renda") > limit)
        .select(
            "proponente_id", "valor_solicitado_credito", "renda_bruta_anual_declarada", "razao_credito_renda", "processed_at"
        )
    )


def ratio_check(as_of: datetime | str | Column, limit: float = 10, hours: int = 24) -> Check:
    """``ratio_outliers`` as a warning counted with the other checks."""
    recent = F.col("processed_at") >= instant(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return Check("ratio_outliers", "razao_credito_renda", recent & (credit_to_income() > limit), severity="warn")


def load_gaps(df: DataFrame, at: str, minutes: int = 5) -> DataFrame:
    """Consecutive stamps more than ``minutes`` whole minutes apart.

    Two stamps within one slot of that many minutes can never be a gap, so rows are
    first reduced to the first and last stamp per slot: what is ordered afterwards
    grows with the time covered, not with the rows. Slots are then compared within
    a day, and days with each other.
    """
    micros, width = F.unix_micros(at), F.lit(minutes * 60 * 1_000_000)
    slots = (
        df.where(F.col(at).isNotNull())
        .groupBy((micros - F.pmod(micros, width)).alias("slot"))
        .agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"))
        .withColumn("day", F.to_date("first_at"))
    )
    days = slots.groupBy("day").agg(F.max("last_at").alias("day_last"))
    # One row per calendar day: small enough to order in one place.
    carried = days.select("day", F.lag("day_last").over(Window.orderBy("day")).alias("carried_at"))
    within = Window.partitionBy("day").orderBy("slot")
    steps = slots.withColumn("previous_in_day", F.lag("last_at").over(within)).join(carried, "day")
    previous = F.coalesce("previous_in_day", "carried_at")
    return (
        steps.select(F.col("first_at").alias(at), previous.alias("prev_timestamp"))
        .withColumn("minutes_diff", whole_minutes(F.col("prev_timestamp"), F.col(at)))
        .where(F.col("minutes_diff") > minutes)
    )


def recent_gaps(silver: DataFrame, as_of: datetime | str | Column, minutes: int = 5, hours: int = 1) -> DataFrame:
    """Gaps between the arrivals of the rows processed in the last ``hours``."""
    return load_gaps(recent_rows(silver, "processed_at", as_of, hours), "ingestion_timestamp", minutes)


def gap_check(silver: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """The number of ``recent_gaps`` as a check of the table."""
    return count_failures(recent_gaps(silver, as_of), [Check("load_gap", "ingestion_timestamp", measure=F.count(F.lit(1)))])


def _detail(check: Check, columns: Sequence[str]) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("detail"),
    )


def audit_rows(df: DataFrame, checks: Sequence[Check], keys: Sequence[str]) -> DataFrame:
    """(check_name, column_name, severity, detail) for each row and check that it fails, in one scan.

    ``detail`` is a JSON object of the row's ``keys`` and the columns that have row checks. Checks
    on the whole table are left to ``audit_tables``.
    """
    by_row = [c for c in checks if c.measure is None]
    shown = list(dict.fromkeys([*keys, *[c.column for c in by_row if c.column in df.columns]]))
    # Only failing rows are spread out.
    failed = F.filter(F.array(*[F.when(c.failing, _detail(c, shown)) for c in by_row]), lambda x: x.isNotNull())
    return df.select(F.explode(failed).alias("f")).select("f.*")


def audit_table(found: DataFrame, kind: str, column: str, severity: str = "error") -> DataFrame:
    """The failures of a whole-table check, one line each, in the shape of ``audit_rows``."""
    return found.select(_detail(Check(kind, column, severity=severity), found.columns).alias("f")).select("f.*")


def _stale(df: DataFrame, column: str, as_of: datetime | str | Column, hours: int) -> DataFrame:
    """The newest stamp, if it is older than the limit or missing."""
    fresh = F.col("newest") >= instant(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return df.agg(F.max(column).alias("newest")).where(~F.coalesce(fresh, F.lit(False)))


def silver_failures(silver: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """What ``silver_report`` counts, line by line."""
    rows = audit_rows(silver, [*silver_checks(), ratio_check(as_of)], [*SILVER_KEY, "processed_at"])
    lines = [
        rows,
        audit_table(_stale(silver, "processed_at", as_of, 24), "recency", "processed_at"),
        audit_table(duplicate_keys(silver, SILVER_KEY), "unique_combination_of_columns", ",".join(SILVER_KEY)),
        audit_table(recent_gaps(silver, as_of), "load_gap", "ingestion_timestamp"),
    ]
    return reduce(DataFrame.unionByName, lines).select(F.lit("silver").alias("table_name"), "*")


def gold_failures(model: str, gold: DataFrame, keys: Sequence[str], as_of: datetime | str | Column) -> DataFrame:
    """What ``gold_report`` counts, line by line."""
    lines = [
        audit_rows(gold, gold_checks(model), keys),
        audit_table(_stale(gold, "feature_timestamp", as_of, 24), "recency", "feature_timestamp"),
        audit_table(duplicate_keys(gold, keys), "unique" if len(keys) == 1 else "unique_combination_of_columns", ",".join(keys)),
    ]
    return reduce(DataFrame.unionByName, lines).select(F.lit(f"gold_{model}").alias("table_name"), "*")


def bronze_report(bronze: DataFrame) -> DataFrame:
    """The check declared for bronze as a source."""
    return report("bronze", [count_failures(bronze, [not_null("proponente_id")])])


def report(table: str, results: Sequence[DataFrame]) -> DataFrame:
    """All results of one table with a pass, warn or error status."""
    combined = results[0]
    for more in results[1:]:
        combined = combined.unionByName(more)
    status = F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity"))
    return combined.select(F.lit(table).alias("table_name"), "*", status.alias("status"))


def silver_report(silver: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Every check declared for silver: one pass, plus one grouping each for the key and the gap check."""
    checks = [*silver_checks(), recency("processed_at", as_of, 24), ratio_check(as_of)]
    return report("silver", [count_failures(silver, checks), unique(silver, SILVER_KEY), gap_check(silver, as_of)])


def gold_report(model: str, gold: DataFrame, keys: Sequence[str], as_of: datetime | str | Column) -> DataFrame:
    """Every check declared for one gold table."""
    checks = [*gold_checks(model), recency("feature_timestamp", as_of, 24)]
    return report(f"gold_{model}", [count_failures(gold, checks), unique(gold, keys)])
