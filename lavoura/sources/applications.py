"""Credit applications derived from the order tables, in the bronze shape.

One application per order: the customer is the applicant, the order total the
credit requested, the quantity ordered the farm area. Gaps (missing document,
state, area, score) and late arrivals are spread by order key so that every
class, boundary and NULL path of the later layers occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ladder, zero_padded
from ..schemas import CROPS, MONEY, PURPOSES

DAY_MS = 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of files.

    A stream takes a plain path for a folder; as a pattern it may also be a single file.
    """
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def flat_applications(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Applications with every field at the top level (times in epoch ms).

    ``orders`` may be a stream; the other tables are then looked up in each micro-batch.
    """
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    quantity = (
        table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
    )
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(quantity, orders.o_orderkey == quantity.l_orderkey, "left")
    )

    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    company = F.col("c_mktsegment").isin("FURNITURE", "MACHINERY")
    requested_ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    late = F.when(order % 50 == 0, 3 * DAY_MS).otherwise(0)
    return joined.select(
        F.concat(F.lit("PROP_"), zero_padded(cust, 5)).alias("proponente_id"),
        requested_ms.alias("data_solicitacao"),
        F.when(order % 53 != 0, F.when(company, zero_padded(cust, 14)).otherwise(zero_padded(cust, 11))).alias("cpf_cnpj"),
        F.concat(F.lit("Produtor "), "c_name").alias("nome_razao_social"),
        F.when(company, "JURIDICA").otherwise("FISICA").alias("tipo_pessoa"),
        (20000 + (F.col("c_acctbal") + 1000) * 60).cast(MONEY).alias("renda_bruta_anual_declarada"),
        F.col("o_totalprice").cast(MONEY).alias("valor_solicitado_credito"),
        ladder(
            F.col("o_orderpriority"),
            lambda value, limit: value == limit,
            list(zip(["1-URGENT", "2-HIGH", "3-MEDIUM"], PURPOSES)),
            PURPOSES[-1],
        ).alias("finalidade_credito"),
        (F.lit(-34.0) + ((order * 7919) % 39000) / F.lit(1000.0)).alias("latitude"),
        (F.lit(-74.0) + ((order * 104729) % 40000) / F.lit(1000.0)).alias("longitude"),
        F.concat(F.lit("Municipio "), (cust % 20 + 1).cast("string")).alias("municipio"),
        F.when(order % 101 != 0, F.col("n_name")).alias("uf"),
        F.when(order % 89 == 0, F.lit(0).cast(MONEY)).otherwise((F.col("qty") * 10).cast(MONEY)).alias(
            "area_total_hectares"
        ),
        F.element_at(F.array(*[F.lit(c) for c in CROPS]), (order % 10 + 1).cast("int")).alias("cultura_principal"),
        (order % 41 > 0).alias("possui_experiencia_atividade"),
        (order % 41).cast("int").alias("anos_experiencia"),
        F.when(order % 7 != 0, (200 + (cust * 37 + order) % 701).cast("int")).alias("serasa_score"),
        F.when(order % 3 == 0, True).when(order % 3 == 1, False).alias("ibama_autuacoes_ativas"),
        F.concat(F.lit("MAT-"), zero_padded(order % 1000000, 6)).alias("numero_matricula_imovel"),
        F.lit("1.0.0").alias("versao_schema"),
        F.lit("fixture").alias("origem_dados"),
        requested_ms.alias("timestamp_geracao_evento"),
        F.timestamp_millis(requested_ms + (order % 86400) * 1000 + late).alias("ingestion_timestamp"),
    )


def bronze_applications(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Applications as nested bronze rows."""
    return nest(flat_applications(spark, sf_dir, orders))


def nest(flat: DataFrame) -> DataFrame:
    """Pack the flat fields into the three structs of the event record."""
    return flat.select(
        "proponente_id",
        "data_solicitacao",
        "cpf_cnpj",
        "nome_razao_social",
        "tipo_pessoa",
        "renda_bruta_anual_declarada",
        "valor_solicitado_credito",
        "finalidade_credito",
        F.struct("latitude", "longitude", "municipio", "uf").alias("localizacao_propriedade"),
        "area_total_hectares",
        "cultura_principal",
        "possui_experiencia_atividade",
        "anos_experiencia",
        F.struct("serasa_score", "ibama_autuacoes_ativas", "numero_matricula_imovel").alias("fontes_dados_adicionais"),
        F.struct("versao_schema", "origem_dados", "timestamp_geracao_evento").alias("metadata_evento"),
        "ingestion_timestamp",
    )
