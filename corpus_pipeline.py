"""From documents to packed sequences: five stages, each written as Parquet and read again by the next one."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstep.llm import jaccard, mixing, packing, quality, secrets
from loomstep.llm.common import discard, kept_folder, materialize, own_folder, table
from loomstep.llm.registry import tokenizer_path
from loomstep.schema import free_names


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; null and empty texts are rejected, repeated rows share a fate, an empty table gives no rows."""
    [q] = free_names(docs, "quality")
    return quality.measure(docs, out=q).where(quality.accepted(q)).drop(q)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """(docs with a number of its own for each row, that column's name), written down so that the numbers stay."""
    [row] = free_names(docs, "row")
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered", compression="zstd"), row


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, the one of the smallest doc_id (null last), and of these of the smallest number.

    Rows are told apart by their numbers, so those without an id, or with one that repeats, are judged by their
    texts like all others; equal rows are one group. Rows without words are alone and stay. Of the texts only those of
    rows that stay are moved. An empty table gives no rows.
    """
    keyed, row = numbered(docs)
    found = jaccard.similar_documents(keyed.select(row, "text"), width=5, threshold=Fraction(4, 5), id_col=row)
    found = found.select(F.col("doc_id").alias(row), F.col("component_id").alias("group"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)
    first = keyed.select(row, "doc_id").join(found, row).groupBy("group").agg(F.min(order).alias("m")).select(F.col("m")[row].alias(row))
    return keyed.join(first, row, "left_semi").select(docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay; each secret becomes a mark, and n_chars follows the text (of a null text it stays as it is)."""
    [before] = free_names(docs, "before")
    clean = secrets.redact(docs.withColumn(before, F.length("text")))
    return clean.withColumn("n_chars", F.col("n_chars") + F.coalesce(F.length("text") - F.col(before), F.lit(0))).select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row stays as often as the mix takes its words, to the nearest whole number (0, 1 or 2), whatever its doc_id.

    The mix knows rows by their numbers, so equal rows are rows of their own. Rows without words aren't taken, ties
    between equal quotients go by source, an empty table gives no rows.
    """
    keyed, row = numbered(docs)
    times = F.round(F.col("taken") / F.nullif(F.col("size"), F.lit(0))).cast("int")
    [n] = free_names(keyed, "times")
    taken = mixing.mix(keyed.select(row, "source", "text"), id_col=row).select(F.col("doc_id").alias(row), times.alias(n)).where(F.col(n) > 0)
    return keyed.join(taken, row).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; a document that the mix repeats is packed as often.

    A null text is the end mark alone; equal pieces lie in the order of (doc_id, piece, ids_crc32); no rows give none.
    """
    return packing.pack(packing.tokenize_pieces(docs, tokenizer_path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]
#: Suffix arrays, similarity components, trained models and byte-pair tokens are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's frame; a stage's intermediate tables and its docs go once the next one's docs are written."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        with own_folder(spark):
            made = stage(spark, docs, sf_dir)
            with kept_folder():
                after = materialize(made, name)
        if i:
            discard(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
