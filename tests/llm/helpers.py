"""Small tables for the corpus operators, written and read as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, block string, `__row` int, size int"


def docs(spark: SparkSession, path, texts: list[tuple], parts: int = 2) -> DataFrame:
    """Documents (id, text, lang) with extra columns whose names the operators use themselves."""
    rows = [(i, t, lang, None if k % 3 == 0 else f"src{k % 2}", None if t is None else len(t), f"r{k}", "b", k, 1)
            for k, (i, t, lang) in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).repartition(parts).write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


def prose(seed: int, words: int) -> str:
    """Words of a fixed stream."""
    out, x = [], seed * 7919 + 1
    for _ in range(words):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append("".join("abcdefghijklmnoprstuvz"[(x >> (8 + 5 * k)) % 22] for k in range(2 + (x >> 60) % 5)))
    return " ".join(out)
