"""Columns of the caller that are named like temporary ones pass through operators and stages unchanged."""

from pyspark.sql import functions as F

import corpus_pipeline
from loomstep.llm import pii, quality, secrets

NAMES = ["_t", "_rule", "_url", "_text", "_base", "_token", "_quality", "_secrets", "_row", "_before", "_sum", "_times", "__row"]


def frame(spark):
    words = " ".join(f"w{i}x q{i * i}" for i in range(60))
    rows = [(1, f"{words} password = abcdefgh12345 end"), (2, f"{words} other mail a@b.example {words[::-1]}"), (3, None)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in NAMES))


def test_columns_named_like_temporary_ones_stay(spark):
    df = frame(spark)
    for made in (
        secrets.secret_spans(df), secrets.redact(df), pii.pii_spans(df), quality.measure(df),
        *(stage(spark, df, "") for _, stage in corpus_pipeline.STAGES[:4]),
    ):
        assert set(df.columns) <= set(made.columns)
        rows = made.collect()
        assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in NAMES)
