"""Queries p7 to p9 over the corpus tables, each through its operator, over whole tables and texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.leakage import find_leaks, leak_report
from tidemark.llm.textstats import no_prose, no_sentences, outlier_scores, text_statistics
from tidemark.llm.tokenizer import decode_ids, encode_texts


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k, without special tokens."""
    return encode_texts(_table(spark, folder, "documents"), "doc_id", "text")


def p7_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text, decoded from its token ids."""
    return decode_ids(p7_ids(spark, folder), "doc_id", "ids")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold twelve consecutive words of an evaluation item."""
    return find_leaks(_table(spark, folder, "documents"), "doc_id", "text", _table(spark, folder, "eval_items"), "item_id", "text")


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """Leaked evaluation items with the number of documents that hold them."""
    return leak_report(p8_found(spark, folder), "doc_id", "item_id", _table(spark, folder, "eval_items"), ["split", "task"])


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    return text_statistics(_table(spark, folder, "documents"), "doc_id", "text", "lang")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that are a list, a table or junk: outliers of their language without a text of running sentences.

    All documents are ranked; the score is computed for those whose sentences don't already say that they are prose.
    """
    return outlier_scores(_measured(spark, folder), only=no_sentences()).filter(no_prose()).select("doc_id")


def p9_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's statistics, unrounded, and its outlier score."""
    return outlier_scores(_measured(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p7_ids, p7_decoded, p8_found, p8_report, p9_found, p9_statistics)}


def _grams(table: str, key: str) -> str:
    words = rf"regexp_extract_all(strip_accents(lower(text)), '[\p{{L}}\p{{N}}]+')"
    return f"(SELECT DISTINCT {key}, array_to_string(w[i:i + 11], ' ') AS gram FROM (SELECT {key}, w, unnest(range(1, len(w) - 10)) AS i FROM (SELECT {key}, {words} AS w FROM {table} WHERE text IS NOT NULL) WHERE len(w) >= 12))"


def oracle_sql() -> dict[str, str]:
    leaks = f"SELECT DISTINCT d.doc_id, e.item_id FROM {_grams('documents', 'doc_id')} d JOIN {_grams('eval_items', 'item_id')} e ON d.gram = e.gram"
    return {
        "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
        "p8_found": leaks,
        "p8_report": f"SELECT i.item_id, i.split, i.task, count(*) AS documents FROM ({leaks}) l JOIN eval_items i ON i.item_id = l.item_id GROUP BY ALL",
    }
