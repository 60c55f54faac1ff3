"""Rows that every corpus operator must cope with."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the cat sat on the mat and looked at the quiet harbour while rain fell over town".split()


def prose(seed: int, count: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] + str((seed + i) % 10) for i in range(count))


ROWS = [
    (1, "Hello World, this is one text", "en", "a", 29),
    (2, "Hello  World,\tthis is one text\n", "en", "a", 31),
    (3, "HelloWorld,thisisonetext", "en", "b", 24),
    (4, None, "en", "a", None),
    (5, "", None, "a", 0),
    (6, " \t\r\n\x0b\x0c", "de", None, 6),
    (7, " ", "de", "a", 1),
    (8, "x", "de", "a", 1),
    (8, "x", "de", "a", 1),
    (8, "y z", "fr", "c", 3),
    (None, "orphan text without an id", None, None, 25),
    (None, "orphan text without an id", None, None, 25),
    (9, "emoji \U0001f600 and éè accents 日本語", "fr", "c", 30),
    (10, prose(3, 30_000), "en", "b", None),
    (11, prose(3, 30_000) + " end", "en", "b", None),
    (12, "a" * 20_000, "en", "b", None),
    (13, "12345 --- 67890", "es", "b", 15),
    *[(100 + i, prose(5, 60) + f" tail{i % 3}", "en", "hot", None) for i in range(30)],
    *[(200 + i, prose(i, 40), "es", "hot", None) for i in range(20)],
]


def docs(spark: SparkSession, rows=ROWS) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def listed(df: DataFrame) -> list[tuple]:
    """Rows in a fixed order, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def order(rows) -> list[tuple]:
    return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v) for v in r])
