"""The registered queries of the text operators; each reads whole tables of ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.shared import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, remainder: int):
    """Rows that no model learns from: crc32 of the id as text, by remainder."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.quality import score, train

    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(3, 1))
    scored = score(documents, train(documents, labels), ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(held_out(3, 1), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_lines",
    )


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.linededup import remove_repeated_lines

    kept = remove_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", "longest_run", "text")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.jaccard import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.licenses import scan, summary

    return summary(scan(table(spark, sf_dir, "documents"), ["doc_id"])).select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        "labels",
        "score",
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tarmac.llm.packing import pack_documents

    packed = pack_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        with_ids=False,
    )
    return packed.drop("ids")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.decontaminate import contamination, find_windows

    hits = find_windows(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]
    )
    return contamination(hits).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.toxicity import score, train

    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(4, 2))
    scored = score(documents, train(documents, labels), ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(held_out(4, 2), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "worst_first",
        "worst_bytes",
        "worst_score",
    )


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.htmltext import extract, train

    pages = table(spark, sf_dir, "pages")
    found = extract(pages, train(pages), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.suffixdedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.ranked import search_ranked

    return search_ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tarmac.llm.fillmiddle import fill_in_middle, restored

    made = fill_in_middle(table(spark, sf_dir, "documents"), ["doc_id"])
    whole = restored(F.col("form"), F.col("output"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(whole.cast("binary"), 256).alias("restored_sha256"),
    )


def op13_bytepairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tarmac.llm.bytepairs import decode, encode

    coder = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode(table(spark, sf_dir, "documents"), ["doc_id"], *coder).select(
        "doc_id",
        "n_tokens",
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        "ids",
    )
    decoded = decode(encoded, ["doc_id", "n_tokens", "ids_sha256"], *coder)
    return decoded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_lines": op2_lines,
    "op3_jaccard": op3_jaccard,
    "op4_topk": op4_topk,
    "op5_licenses": op5_licenses,
    "op6_packing": op6_packing,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity": op8_toxicity,
    "op9_html": op9_html,
    "op10_suffix": op10_suffix,
    "op11_ranked": op11_ranked,
    "op12_middle": op12_middle,
    "op13_bytepairs": op13_bytepairs,
}
