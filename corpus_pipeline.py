"""From raw documents to packed training sequences, in stages that are each written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.decontaminate import remove_contaminated
from tarmac.llm.jaccard import keep_one
from tarmac.llm.linededup import remove_repeated_lines
from tarmac.llm.packing import pack_documents
from tarmac.llm.quality import keep_good, train
from tarmac.llm.queries import held_out, table
from tarmac.llm.shared import Stage, bound_batches, ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of quality 0.5 and more; the field learns from labelled rows not held out."""
    bound_batches(spark)
    labels = table(spark, sf_dir, "labels").where(~held_out(3, 1))
    return keep_good(docs, train(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; n_chars follows the text."""
    columns = docs.columns
    kept = remove_repeated_lines(docs)
    if "n_chars" in columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the smallest id."""
    ship(spark)
    bound_batches(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words in benchmark windows."""
    bound_batches(spark)
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their ids, and where they lie in windows of 1024."""
    import public_tokenizers

    ship(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


#: (name, function) of each stage; a function takes (spark, docs, sf_dir).
STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No SQL expresses the trained and the tokenising stages; a test holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on the documents of ``sf_dir``."""
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage.table(name, function(spark, docs, sf_dir))
    return docs
