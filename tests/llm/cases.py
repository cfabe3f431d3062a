"""Small tables with what operators must stand: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_row string, size long, _text string, shard int, _md5 string, target double"
)


def words(rnd: random.Random, n: int) -> str:
    return " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def edge_rows() -> list[tuple]:
    rnd = random.Random(4)
    base = [words(rnd, 120) for _ in range(4)]
    near = base[0].split(" ")
    near[7] = "changed"
    texts = [
        base[0], base[1], " ".join(near), base[0], "", None, " \t\n ", "one", "one two three", "日本 é\x85ü\xa0z",
        base[2] + "\n" + base[2], "to " * 400, "!! ## " * 30, words(rnd, 6000), base[3] + " tail", "x" * 5000, None, base[1],
    ]
    rows = [
        (None if i == 9 else i // 2 * 2 if i > 15 else i, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "é"][i % 4], None, "r", 1, "t", 2, "m", 0.5)
        for i, t in enumerate(texts)
    ]
    return [*rows, rows[1], rows[1]]  # rows that agree in everything


def edge_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def labels(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(
        rows or [(0, 1, 0, 9), (1, 0, 0, 9), (1, 1, 0, 9), (None, 1, None, 9), (3, None, 0, 9)],
        "doc_id long, quality int, toxic int, stratum int",
    )
