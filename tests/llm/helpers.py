"""Small fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, schema: str = "doc_id long, text string"):
    rows = texts if texts and isinstance(texts[0], tuple) else list(enumerate(texts))
    return spark.createDataFrame(rows, schema)


def prose(seed: int, words: int, vocabulary: int = 300) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(words)]


def crowded(df):
    """The table with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    names = ["id", "n", "text_", "_text", "spans", "score", "host", "rule", "token", "digest", "label", "segment", "unit", "rank", "path"]
    return df.select("*", *(F.lit(k).alias(n) for k, n in enumerate(names) if n not in df.columns))
