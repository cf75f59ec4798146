"""The registered queries of this package: thin calls of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavoura.llm.collocations import collocations
from lavoura.llm.common import ship
from lavoura.llm.hnsw import near_vectors
from lavoura.llm.mixing import mixed
from lavoura.llm.near_text import near_duplicates
from lavoura.llm.oracle import ORACLE_SQL  # noqa: F401
from lavoura.llm.passages import without_repeats
from lavoura.llm.pieces import segmented
from lavoura.llm.private import personal_data
from lavoura.llm.projections import nearest
from lavoura.llm.quality import graded
from lavoura.llm.spelling import variants
from lavoura.llm.suffixes import without_repeated_bytes
from lavoura.llm.token_files import encoded
from lavoura.llm.winnowing import contaminated


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 4 best segmentations of every text of ``documents`` into pieces, and the text decoded from each."""
    return segmented(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), n=4, with_ids=True)


def op2_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of ``documents`` written as Re-Pair shards and read back."""
    return encoded(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op3_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of ``embeddings`` linked at cosine 0.95."""
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.95)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, grade) from the labels: 0 toxic, 1 poor, 2 good."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and chances of the best and worst grade of all ``documents``."""
    return graded(table(spark, sf_dir, "documents"), ratings(spark, sf_dir))


def op5_near_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``documents`` on 2-word shingles at similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` covered by a 20-word window that starts earlier, removed."""
    return without_repeats(table(spark, sf_dir, "documents"), width=20)


def label_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, weight): labelled good documents weigh 2, poor ones a half, toxic ones a tenth."""
    weight = F.when(F.col("toxic") == 1, 0.1).when(F.col("quality") == 1, 2.0).otherwise(0.5)
    return table(spark, sf_dir, "labels").select("doc_id", weight.alias("weight"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` mixed to 150% of their size, sources weighing 3, 1, 2 in turn."""
    return mixed(table(spark, sf_dir, "documents"), label_weights(spark, sf_dir))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` covered by a 400-byte string that also starts elsewhere, removed."""
    return without_repeated_bytes(table(spark, sf_dir, "documents"), length=400)


def op9_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``."""
    return personal_data(table(spark, sf_dir, "documents"))


def op10_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest rows of ``embeddings`` for every row whose vec_id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` in windows of 10 words that ``benchmark`` has, too."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents``, their near words and the forms they vary."""
    return variants(table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of 2 and 3 words of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pieces": op1_pieces,
    "op2_repair": op2_repair,
    "op3_hnsw": op3_hnsw,
    "op4_quality": op4_quality,
    "op5_near_text": op5_near_text,
    "op6_passages": op6_passages,
    "op7_mix": op7_mix,
    "op8_suffixes": op8_suffixes,
    "op9_private": op9_private,
    "op10_projections": op10_projections,
    "op11_winnowing": op11_winnowing,
    "op12_spelling": op12_spelling,
    "op13_phrases": op13_phrases,
}
