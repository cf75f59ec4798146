"""Gold tables from mergeable partial states, one per silver partition and group.

What a gold row needs of its rows is kept per partition: counts, exact sums, extremes and second
moments in one table, and in another how often each combination of categories, identifiers and amounts
occurs; a group may have several lines in a partition.
States of any partitions can be merged, so a refresh computes anew only those of the partitions that
merges touched, and merges the states of the groups that changed. The rows of other partitions are
not read.

Every touched partition gets a line without a group, so that a partition whose last group went is
overwritten, too.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import COORDINATE, ratio
from ..schemas import SILVER_PARTITIONS as PARTITIONS
from ..sources.staging import path_exists
from .gold import FINISH, MODELS, usable_rows
from .quantiles import exact_percentiles

AMOUNT = "valor_solicitado_credito"
#: Rows of one partition that a task takes, and the column that deals them.
TASK_ROWS, DEAL = 500_000, "_deal"
#: Tables whose groups hardly repeat inside a partition: combining rows before a shuffle saves nothing.
SCATTERED = ("proponente",)


@dataclass(frozen=True)
class Measure:
    """One measure of a gold table: how it comes from the state of ``column``."""

    name: str
    kind: str
    column: str = ""
    of: object = None


def _m(kind: str, column: str, *names: str) -> list[Measure]:
    return [Measure(n, kind, column) for n in names]


def _shares(column: str, **names: str) -> list[Measure]:
    return [Measure(n, "share", column, value) for n, value in names.items()]


_SPAN = [*_m("max", "data_solicitacao", "ultima_solicitacao"), *_m("min", "data_solicitacao", "primeira_solicitacao")]
_FINED = _shares("ibama_autuacoes_ativas", taxa_autuacoes_ibama=True)
_NEWEST = _m("max", "processed_at", "ultima_atualizacao")

MEASURES: dict[str, list[Measure]] = {
    "proponente": [
        *_m("rows", "", "total_solicitacoes"),
        *_m("sum", AMOUNT, "valor_total_solicitado"),
        *_m("mean", AMOUNT, "valor_medio_solicitado"),
        *_m("max", AMOUNT, "valor_maximo_solicitado"),
        *_m("min", AMOUNT, "valor_minimo_solicitado"),
        *_m("spread", AMOUNT, "valor_desvio_padrao"),
        *_SPAN,
        *_m("mean", "serasa_score", "serasa_score_medio"),
        *_m("max", "serasa_score", "serasa_score_maximo"),
        *_m("min", "serasa_score", "serasa_score_minimo"),
        *_m("mean", "localizacao_latitude", "latitude_media"),
        *_m("mean", "localizacao_longitude", "longitude_media"),
        *_m("mean", "area_total_hectares", "area_media_hectares"),
        *_m("mean", "anos_experiencia", "anos_experiencia_medio"),
        *_m("max", "anos_experiencia", "anos_experiencia_maximo"),
        *_FINED,
        *_m("mode", "finalidade_credito", "finalidade_mais_comum"),
        *_m("mode", "cultura_principal", "cultura_mais_comum"),
        *_m("mode", "classificacao_propriedade", "classificacao_mais_comum"),
        *_m("mode", "faixa_risco_credito", "faixa_risco_mais_comum"),
        *_m("kinds", "finalidade_credito", "diversidade_finalidades"),
        *_m("kinds", "cultura_principal", "diversidade_culturas"),
        *_m("kinds", "localizacao_uf", "diversidade_ufs"),
        *_NEWEST,
    ],
    "location": [
        *_m("rows", "", "total_proponentes"),
        *_m("sum", AMOUNT, "valor_total_solicitado"),
        *_m("mean", AMOUNT, "valor_medio_solicitado"),
        Measure("valor_desvio_padrao", "spread", AMOUNT, 0.0),
        Measure("valor_mediano_solicitado", "percentile", AMOUNT, 0.5),
        *_m("sum", "area_total_hectares", "area_total_hectares"),
        *_m("mean", "area_total_hectares", "area_media_hectares"),
        Measure("area_desvio_padrao", "spread", "area_total_hectares", 0.0),
        *_m("mean", "localizacao_latitude", "latitude_media"),
        *_m("mean", "localizacao_longitude", "longitude_media"),
        Measure("latitude_desvio_padrao", "spread", "localizacao_latitude", 0.0),
        Measure("longitude_desvio_padrao", "spread", "localizacao_longitude", 0.0),
        Measure("serasa_score_medio", "mean", "serasa_score", 0.0),
        Measure("serasa_score_desvio_padrao", "spread", "serasa_score", 0.0),
        *_m("mean", "anos_experiencia", "anos_experiencia_medio"),
        *_FINED,
        *_SPAN,
        *_shares("faixa_risco_credito", taxa_risco_baixo="BAIXO", taxa_risco_medio="MEDIO", taxa_risco_alto="ALTO", taxa_risco_muito_alto="MUITO_ALTO"),
        *_shares("tipo_pessoa", taxa_pessoa_juridica="JURIDICA"),
        *_m("mode", "cultura_principal", "cultura_dominante"),
        *_m("mode", "finalidade_credito", "finalidade_dominante"),
        *_m("mode", "classificacao_propriedade", "classificacao_dominante"),
        *_m("kinds", "cultura_principal", "diversidade_culturas"),
        *_m("kinds", "finalidade_credito", "diversidade_finalidades"),
        *_m("kinds", "classificacao_propriedade", "diversidade_classificacoes"),
        *_m("kinds", "proponente_id", "proponentes_unicos"),
        *_NEWEST,
    ],
    "risk": [
        *_m("rows", "", "total_solicitacoes"),
        *_m("sum", AMOUNT, "valor_total_solicitado"),
        *_m("mean", AMOUNT, "valor_medio_solicitado"),
        *_m("spread", AMOUNT, "valor_desvio_padrao"),
        *[Measure(n, "percentile", AMOUNT, p) for n, p in (("valor_p25", 0.25), ("valor_mediano", 0.5), ("valor_p75", 0.75), ("valor_p90", 0.9))],
        *_m("sum", "area_total_hectares", "area_total_hectares"),
        *_m("mean", "area_total_hectares", "area_media_hectares"),
        *_m("spread", "area_total_hectares", "area_desvio_padrao"),
        *_m("mean", "serasa_score", "serasa_score_medio"),
        *_m("spread", "serasa_score", "serasa_score_desvio_padrao"),
        *_m("min", "serasa_score", "serasa_score_minimo"),
        *_m("max", "serasa_score", "serasa_score_maximo"),
        *_m("mean", "anos_experiencia", "anos_experiencia_medio"),
        *_m("spread", "anos_experiencia", "anos_experiencia_desvio_padrao"),
        *_shares("tipo_pessoa", taxa_pessoa_juridica="JURIDICA"),
        *_shares("classificacao_propriedade", taxa_minifundio="MINIFUNDIO", taxa_pequena="PEQUENA", taxa_media="MEDIA", taxa_grande="GRANDE"),
        *_shares(
            "finalidade_credito",
            taxa_custeio_safra="CUSTEIO_SAFRA",
            taxa_investimento_maquinario="INVESTIMENTO_MAQUINARIO",
            taxa_ampliacao_area="AMPLIACAO_AREA",
        ),
        *_FINED,
        *_SPAN,
        *_m("kinds", "localizacao_uf", "diversidade_ufs"),
        *_m("kinds", "proponente_id", "proponentes_unicos"),
        *_m("kinds", "localizacao_municipio", "diversidade_municipios"),
        *_NEWEST,
    ],
}
_SUMMED = ("sum", "mean", "spread")
_VALUED = ("mode", "kinds", "percentile")


def _columns(model: str, *of_kinds: str) -> list[str]:
    return list(dict.fromkeys(m.column for m in MEASURES[model] if m.kind in of_kinds))


def _exact(column: str) -> Column:
    """The column in a type that sums exactly."""
    return F.col(column).cast(COORDINATE) if column in ("localizacao_latitude", "localizacao_longitude") else F.col(column)


def _conditions(model: str) -> list[tuple[str, Column]]:
    return [(m.name, F.col(m.column) == F.lit(m.of)) for m in MEASURES[model] if m.kind == "share"]


def partial_sums(rows: DataFrame, model: str) -> DataFrame:
    """(partition, group, n, and sums, counts, moments, extremes and matches of columns) of usable rows."""
    _, keys = MODELS[model]
    states = [F.count(F.lit(1)).alias("n")]
    for c in _columns(model, *_SUMMED):
        states += [F.sum(_exact(c)).alias(f"{c}__sum"), F.count(c).alias(f"{c}__n")]
    for c in _columns(model, "spread"):
        # Squared distances from the partition's own mean.
        states.append((F.var_pop(F.col(c).cast("double")) * F.count(c)).alias(f"{c}__m2"))
    states += [F.max(c).alias(f"{c}__max") for c in _columns(model, "max")]
    states += [F.min(c).alias(f"{c}__min") for c in _columns(model, "min")]
    states += [F.count_if(test).alias(f"{name}__k") for name, test in _conditions(model)]
    return rows.groupBy(*_within(rows), *keys).agg(*states).drop(DEAL)


def partial_counters(rows: DataFrame, model: str) -> DataFrame:
    """(partition, group, values of columns, n): how often each combination occurs among usable rows."""
    _, keys = MODELS[model]
    # A key column may be counted, too.
    values = [F.col(c).alias(f"{c}__v") for c in _columns(model, *_VALUED)]
    return rows.groupBy(*_within(rows), *keys, *values).agg(F.count(F.lit(1)).alias("n")).drop(DEAL)


def _within(rows: DataFrame) -> list[str]:
    return [*PARTITIONS, *[c for c in rows.columns if c == DEAL]]


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """Rows by partition and ``parts``-th parts of it, whatever their group, so that a state written
    by partition takes one shuffle and a hot group many tasks."""
    deal = F.pmod(F.xxhash64("data_solicitacao", AMOUNT), F.lit(parts))
    return rows.withColumn(DEAL, deal).repartition(*PARTITIONS, DEAL)


def _merged_sums(states: DataFrame, model: str) -> DataFrame:
    """The measures that come from sums and extremes, for all groups in ``states``."""
    _, keys = MODELS[model]
    spreads, group = _columns(model, "spread"), Window.partitionBy(*keys)
    # Moments about the group's mean, from those about each line's mean and the distance between.
    # A group has few lines, at most those of a task for each partition.
    means = {f"{c}__mean": ratio(F.sum(f"{c}__sum").over(group), F.sum(f"{c}__n").over(group)) for c in spreads}
    states = states.withColumns(means)
    totals = [F.sum("n").alias("n")]
    for c in spreads:
        own = ratio(F.col(f"{c}__sum"), F.col(f"{c}__n"))
        totals.append(F.sum(F.col(f"{c}__m2") + F.col(f"{c}__n") * F.pow(own - F.col(f"{c}__mean"), F.lit(2))).alias(f"{c}__m2"))
    for c in _columns(model, *_SUMMED):
        totals += [F.sum(f"{c}__sum").alias(f"{c}__sum"), F.sum(f"{c}__n").alias(f"{c}__n")]
    totals += [F.max(f"{c}__max").alias(f"{c}__max") for c in _columns(model, "max")]
    totals += [F.min(f"{c}__min").alias(f"{c}__min") for c in _columns(model, "min")]
    totals += [F.sum(f"{name}__k").alias(f"{name}__k") for name, _ in _conditions(model)]
    merged = states.groupBy(*keys).agg(*totals)

    def measure(m: Measure) -> Column:
        total, count = F.col(f"{m.column}__sum"), F.col(f"{m.column}__n")
        if m.kind == "rows":
            return F.col("n")
        if m.kind == "sum":
            return total.cast("double")
        if m.kind == "mean":
            value = ratio(total, count)
        elif m.kind == "spread":
            value = F.when(count > 1, F.sqrt(F.col(f"{m.column}__m2") / (count - 1)))
        elif m.kind == "share":
            return F.col(f"{m.name}__k").cast("double") / F.col("n").cast("double")
        else:
            value = F.col(f"{m.column}__{m.kind}")
            if isinstance(states.schema[f"{m.column}__{m.kind}"].dataType, T.DecimalType):
                value = value.cast("double")
        return value if m.of is None else F.coalesce(value, F.lit(m.of))

    return merged.select(*keys, *[measure(m).alias(m.name) for m in MEASURES[model] if m.kind not in _VALUED])


def _merged_counters(counters: DataFrame, model: str) -> DataFrame:
    """The measures that come from values, for all groups in ``counters``."""
    _, keys = MODELS[model]
    columns = _columns(model, "mode", "kinds")
    if model in SCATTERED:
        # Few lines a group, as its values are categories: they meet once.
        counters = counters.repartition(*keys)
    # Values are text. An array, as rows stay where they are when it is exploded.
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__v").cast("string").alias("value")) for c in columns]))
    long = counters.select(*keys, "n", each).where(F.col("value").isNotNull())
    values = long.groupBy(*keys, "column", "value").agg(F.sum("n").alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("less"), "value"))["value"]
    per_column = values.groupBy(*keys, "column").agg(F.count(F.lit(1)).alias("kinds"), top.alias("mode"))
    wanted = [m for m in MEASURES[model] if m.kind in ("mode", "kinds")]
    picked = [F.max(F.when(F.col("column") == m.column, F.col(m.kind))).alias(m.name) for m in wanted]
    out = per_column.groupBy(*keys).agg(*picked)
    levels = {m.name: m.of for m in MEASURES[model] if m.kind == "percentile"}
    if levels:
        amounts = counters.groupBy(*keys, F.col(f"{AMOUNT}__v").alias("value")).agg(F.sum("n").alias("n"))
        found = exact_percentiles(amounts, keys, "value", levels, "n")
        out = out.join(found.select(*keys, *[F.col(n).cast("double").alias(n) for n in levels]), keys, "left")
    return out


def measures(sums: DataFrame, counters: DataFrame, model: str) -> DataFrame:
    """All measures of the groups in the given states."""
    _, keys = MODELS[model]
    merged = _merged_sums(sums, model).join(_merged_counters(counters, model), keys, "left")
    return merged.fillna(0, subset=[m.name for m in MEASURES[model] if m.kind == "kinds"])


def in_partitions(silver: DataFrame, partitions: Iterable[Sequence]) -> DataFrame:
    """The silver rows of the given partitions (year, month), by partition pruning."""
    tests = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(PARTITIONS, p, strict=True)]) for p in partitions]
    return silver.where(reduce(lambda a, b: a | b, tests, F.lit(False)))


@dataclass(frozen=True)
class GoldStates:
    """The stored states of one gold table."""

    spark: SparkSession
    path: str
    model: str

    def exist(self) -> bool:
        """Whether the states of all partitions have been written once."""
        return path_exists(self.spark, f"{self.path}/complete")

    def update(self, silver: DataFrame, partitions: Sequence[Sequence] | None = None) -> None:
        """Compute the states of the given silver partitions anew; of all of them if none are given."""
        if partitions is not None and not partitions:
            return
        _, keys = MODELS[self.model]
        inputs = list(dict.fromkeys([*PARTITIONS, *keys, "registro_valido", *[m.column for m in MEASURES[self.model] if m.column]]))
        rows = (silver if partitions is None else in_partitions(silver, partitions)).select(*inputs)
        largest = rows.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if partitions is None:
            touched = rows.select(*PARTITIONS).distinct()
        else:
            kinds = ", ".join(f"{c} {silver.schema[c].dataType.simpleString()}" for c in PARTITIONS)
            touched = self.spark.createDataFrame([tuple(p) for p in partitions], kinds)
        usable = usable_rows(rows, keys)
        spread = dealt(usable.unionByName(touched, allowMissingColumns=True), max(1, math.ceil(largest / TASK_ROWS)))
        if self.model in SCATTERED:
            sums = partial_sums(spread, self.model)
        else:
            sums = partial_sums(usable, self.model).unionByName(touched, allowMissingColumns=True).hint("rebalance", *PARTITIONS)
        for name, lines in (("sums", sums), ("counters", partial_counters(spread, self.model))):
            (
                lines.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", "zstd")
                .partitionBy(*PARTITIONS)
                .parquet(f"{self.path}/{name}")
            )
        if partitions is None:
            self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/complete")

    def features(self, as_of: datetime | str | Column, groups: DataFrame | None = None) -> DataFrame:
        """Gold rows of all groups, or of those in ``groups``, from the stored states."""
        _, keys = MODELS[self.model]
        found = []
        for name in ("sums", "counters"):
            states = self.spark.read.parquet(f"{self.path}/{name}").where(F.col(keys[0]).isNotNull())
            found.append(states if groups is None else states.join(groups, keys, "left_semi"))
        return FINISH[self.model](measures(*found, self.model), as_of)
