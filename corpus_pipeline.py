"""From raw documents to piece ids: quality, near duplicates, personal data, mixing, pieces.

Each stage takes (session, documents, folder of the tables) and works on all rows it is given.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavoura.llm.common import staged
from lavoura.llm.mixing import mixed
from lavoura.llm.near_text import near_duplicates
from lavoura.llm.pieces import segmented
from lavoura.llm.private import without_personal_data
from lavoura.llm.quality import graded
from lavoura.llm.queries import label_weights, ratings, tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the best grade is a half at least."""
    return graded(docs, ratings(spark, sf_dir), with_row=True).where("kept").select("row.*")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80% of their 5-word shingles: that of smallest id.

    Rows that repeat id and text are one document and leave one row; rows that share an id only are
    documents of their own. Rows without id all stay.
    """
    found = near_duplicates(docs, width=5, percent=80, with_hash=True).where("kept and doc_id is not null")
    kept = found.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct()
    same = (docs.doc_id == kept.kept_id) & (F.xxhash64(docs.text) == kept.kept_hash)
    one = docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return one.unionByName(docs.where("doc_id is null"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return without_personal_data(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weigh 3, 1, 2 in turn, 150% in all."""
    taken = mixed(docs, label_weights(spark, sf_dir), with_row=True).where("times > 0")
    copies = taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"))
    return copies.select("row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The 4 best segmentations of each text, and the text decoded from each."""
    return segmented(docs, tokenizer_file("piece_bpe_32k.model"), n=4, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicate_groups),
    ("PII", personal_data),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", pieces),
]

#: No stage can be told in SQL as a whole; tests compare with versions in plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + "".join(c if c.isalnum() else "-" for c in name))
    return STAGES[-1][1](spark, docs, sf_dir)
