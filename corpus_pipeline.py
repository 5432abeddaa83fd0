"""From raw documents to packed sequences: quality, copies, near copies, mixing, packing."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import compression_quality, exact_dedup, mixing, near_duplicates, packing
from reviewloom.llm.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely bad go; learned from the labels of four fifths of the documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    score = "_quality"
    while score in docs.columns:
        score += "_"
    scored = compression_quality.quality_scores(docs, compression_quality.fit(docs, labels), name=score)
    return scored.filter(F.col(score) >= 0.3).drop(score)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts stays, that with the largest doc_id."""
    return exact_dedup.exact_duplicates(docs).filter("kept").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, one with the smallest doc_id: sets of five-word shingles, similarity 0.8."""
    return near_duplicates.near_duplicates(docs).filter("first").select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts, some repeated and some cut, so that the sources have their target weights."""
    return mixing.mixed_rows(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 ids, with the ids."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 0, carry=["doc_id"])
    return pieces.select("row.*", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", copies),
    ("near duplicates", near_copies),
    ("mixing", source_mix),
    ("packing", packed),
]
ORACLE_SQL = None  # dictionaries, signatures and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
