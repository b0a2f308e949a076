"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame; ``run`` writes each result as Parquet below the shared checkpoint
folder and reads it again for the next stage. A stage imports its operator when it runs,
so that the driver holds no more than the stages that have run.

Defined cases: a null text is empty; quality drops documents of fewer than 50 words, and
so empty ones; rows with null or repeated ids stay apart in near-duplicates as its
docstring says; an empty table stays empty through all stages; further columns are kept
up to decontamination.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.session import stage

# Packing ends in token sequences, which SQL cannot express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted rules keep."""
    from helioframe.llm.quality_rules import assess

    return assess(docs).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near-duplicates (5 words, similarity 0.8).

    A row without an id is linked with nothing and stays. Rows that share an id are one
    document and stay or go together.
    """
    from helioframe.llm.tensor_minhash import near_duplicates

    found = near_duplicates(docs).select("id", "component_id").where("id <> component_id").select("id").distinct()
    return docs.join(found, docs["doc_id"] == found["id"], "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the whole characters of repeated runs of 100 bytes; no document goes.

    A character stays unless all its bytes are in one removed run, so texts stay valid.
    """
    from helioframe.llm.run_length_index import remove_repeats

    cut = remove_repeats(docs)
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast(dict(docs.dtypes)["n_chars"])}
    return cut.select(*[F.when(F.size("spans") > 0, new[c]).otherwise(F.col(f"row.{c}")).alias(c) if c in new
                        else F.col(f"row.{c}").alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating share of benchmark windows."""
    from helioframe.llm.decontaminate import contaminated, decontaminate

    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).where(~contaminated()).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens, with their ids."""
    import public_tokenizers

    from helioframe.llm.vector_packing import pack

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
