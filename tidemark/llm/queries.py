"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages read back from archives with segments of 8 KB, so that many records are reassembled."""
    from .warc import round_trip

    return (round_trip(table(spark, sf_dir, "pages"), segment_bytes=8192)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op2_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    from .pii import find

    return find(table(spark, sf_dir, "documents"))


def op3_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of all documents that state a licence, with its family."""
    from .licenses import find

    return find(table(spark, sf_dir, "documents"))


def op4_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    from .decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of their decoding."""
    from .bpe import digests

    return digests(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    from .language import identify

    return (identify(table(spark, sf_dir, "documents"))
            .select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans")))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and digest in a written token store."""
    from .token_store import store_and_read

    return store_and_read(table(spark, sf_dir, "documents"))


def op8_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document."""
    from .quality import quality

    return quality(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near-duplicates, and how many links used to join the class its text has."""
    from .neardup import near_duplicates

    members, _ = near_duplicates(table(spark, sf_dir, "documents"))
    return members.select("doc_id", "class_id", "class_size", "n_joining_links")


def op10_chat_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, and of one whose texts hold control strings."""
    from .chat import round_trip

    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    cols = own.columns
    return round_trip(table(spark, sf_dir, "conversations").select(*cols).unionByName(own))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's byte-level token ids and of their decoding."""
    from .byte_bpe import digests

    return digests(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with its subtree's totals."""
    from .prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance for the benchmark's distribution, and its rank if it is drawn."""
    from .resample import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_warc_segments, op2_weak_pii, op3_license_notices, op4_contaminated, op5_trie_bpe, op6_language, op7_token_store,
    op8_perplexity_rules, op9_near_duplicates, op10_chat_templates, op11_byte_bpe, op12_prefix_trie,
    op13_importance_resampling)}
