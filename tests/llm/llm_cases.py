"""Rows that every operator has to take: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import DataFrame, SparkSession

CLASHING = ("uid", "size", "row", "key", "label", "score", "bucket", "rank", "part", "path", "n", "order", "range", "base", "y")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"{c} string" for c in CLASHING)
LABELS = "doc_id long, quality int, toxic int"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def texts() -> list[tuple]:
    rng = random.Random(7)
    plain = [sentence(rng, n) for n in (1, 3, 30, 60, 120, 400)]
    long = sentence(rng, 30_000)
    near = plain[4].split()
    near[50] = "changed"
    rows = [(i, t) for i, t in enumerate(plain)]
    rows += [(10, None), (11, ""), (12, " \t\n "), (None, plain[3]), (None, None), (13, long), (14, "x" * 50_000)]
    rows += [(20, plain[4]), (21, " ".join(near)), (22, plain[5]), (22, plain[5]), (22, plain[2]), (23, "ä ö ü ß é ñ 中文 \U0001f600")]
    rows += [(30 + i, sentence(rng, 40) + "\n" + sentence(rng, 40) + "\n" + sentence(rng, 40)) for i in range(30)]
    return rows


def edge_docs(spark: SparkSession) -> DataFrame:
    sources = ["a", "b", None, "é", "B"]
    rows = [(i, t, None if k % 7 == 0 else "en", sources[k % 5], None if t is None else len(t), *["7"] * len(CLASHING)) for k, (i, t) in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def labels(spark: SparkSession, rows: list[tuple] = ()) -> DataFrame:
    return spark.createDataFrame(list(rows), LABELS)
