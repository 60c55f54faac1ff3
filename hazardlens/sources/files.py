"""Readers for review tables, id lists, query maps and landed responses."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens import schemas
from hazardlens.functions.text import category_of_file, review_key

# Text keeps its quotes, line ends and edge spaces. A file is read by one task,
# as quoted line ends forbid splitting; land many files, and keep Parquet inside.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_reviews_csv(
    spark: SparkSession, path: str, schema: str = schemas.RAW_REVIEWS, pattern: str | None = None
) -> DataFrame:
    """Review CSV files under the fixed schema, with the name of their file.

    Empty strings come back from CSV as NULL; text columns get them back.
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    df = reader.csv(path)
    text = [F.coalesce(c, F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]
    return df.select(*text, F.col("_metadata.file_name").alias("file_name"))


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_optional(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, or an empty one with the schema where there is none."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).format(fmt)
    return (reader.options(**CSV_OPTIONS) if fmt == "csv" else reader).load(path)


def read_required(spark: SparkSession, path: str, pattern: str, fmt: str, **options) -> DataFrame:
    """All files below ``path`` that match ``pattern``; none, or none with a row, is an error."""
    df = spark.read.format(fmt).options(pathGlobFilter=pattern, **options).load(path)
    if df.isEmpty():
        raise FileNotFoundError(f"no file matching {pattern!r} in {path}")
    return df


def read_landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed response pages, one JSON object per line, body as text; compressed files too."""
    return spark.read.schema(schema).json(path)


def read_review_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_landed(spark, path, schemas.REVIEW_PAGES)


def read_search_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_landed(spark, path, schemas.SEARCH_PAGES)


def read_category_tabs(spark: SparkSession, path: str) -> DataFrame:
    return read_landed(spark, path, schemas.CATEGORY_TABS)


def id_entries(json: Column) -> Column:
    """Entries of an id list that holds objects, bare ids or both.

    The list is a JSON array, or JSON lines with one entry each. An entry may say its own
    ``ordinal``; its place in the list counts else.
    """
    lines = F.concat(F.lit("["), F.regexp_replace(F.trim(json, F.lit(" \r\n\t")), r"\r?\n", ","), F.lit("]"))
    array = F.when(F.rlike(json, F.lit(r"\A\s*\[")), json).otherwise(lines)
    entries = F.from_json(array, "array<variant>")

    def typed(v: Column) -> Column:
        is_object = F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))
        from_object = F.try_variant_get(v, "$.id", "string")
        bare = F.try_variant_get(v, "$", "string")
        subcategory = F.coalesce(F.try_variant_get(v, "$.subcategory", "string"), F.lit(""))
        return F.struct(
            F.when(is_object, from_object).otherwise(bare).alias("id"),
            F.when(is_object, subcategory).otherwise("").alias("subcategory"),
            F.when(is_object, F.try_variant_get(v, "$.ordinal", "bigint")).alias("ordinal"),
        )

    return F.transform(entries, typed)


def explode_id_lists(lists: DataFrame, json: str = "value") -> DataFrame:
    """One row per id with its position in the list."""
    others = [c for c in lists.columns if c != json]
    ordinal = F.coalesce("_entry.ordinal", F.col("_pos").cast("bigint")).alias("ordinal")
    return (
        lists.select(*others, id_entries(F.col(json)).alias("_entries"))
        .select(*others, F.posexplode("_entries").alias("_pos", "_entry"))
        .select(*others, ordinal, "_entry.id", "_entry.subcategory")
    )


def read_id_lists(
    spark: SparkSession, path: str, pattern: str = "*.json", prefix: str = "", suffix: str = "_ids"
) -> DataFrame:
    """Id list files: ``category``, ``ordinal``, ``id``, ``subcategory``, ``file_name``.

    A file is a JSON array, or JSON lines as ``write_id_lists`` leaves them in one folder per
    category. The category is that of the folder ``slug=...``, else what the file name holds
    between ``prefix`` and ``suffix``. At least one file must match.
    """
    files = read_required(spark, path, pattern, "text", wholetext="true")
    name = F.col("_metadata.file_name")
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    of_file = category_of_file(stem, prefix, suffix)
    category = F.col("slug").cast("string") if "slug" in files.columns else of_file
    return explode_id_lists(files.select("value", category.alias("category"), name.alias("file_name"))).select(
        "category", "ordinal", "id", "subcategory", "file_name"
    )


def keyed_reviews(reviews: DataFrame, prefix: str = "", suffix: str = "_reviews_raw") -> DataFrame:
    """Reviews read from files named after their category, with ``category``, ``arrival`` and
    ``review_key``, as label passes need them.

    ``arrival`` is the name of the file, then the row's place in it: a file with quoted line ends
    is read by one task from its first row on, so numbers grow with the place, however files are
    dealt out to tasks.
    """
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    placed = reviews.withColumn("category", category_of_file(stem, prefix, suffix)).withColumn(
        "arrival", F.struct("file_name", F.monotonically_increasing_id().alias("place"))
    )
    key = review_key(F.col("category"), F.col("product_id"), F.col("review_text"))
    return placed.withColumn("review_key", key)


def explode_query_map(maps: DataFrame, json: str = "value") -> DataFrame:
    """One row per category and subcategory with its query, numbered in map order from 1."""
    others = [c for c in maps.columns if c != json]
    parsed = maps.select(*others, F.from_json(json, schemas.QUERY_MAP).alias("_map"))
    categories = parsed.select(*others, F.explode("_map").alias("category", "_value"))
    entries = F.map_entries("_value.subcategories")
    return categories.select(
        *others, "category", F.posexplode(entries).alias("_pos", "_entry")
    ).select(
        *others,
        "category",
        (F.col("_pos") + 1).alias("ordinal"),
        F.col("_entry.key").alias("subcategory"),
        F.col("_entry.value").alias("query"),
    )


def read_query_map(spark: SparkSession, path: str) -> DataFrame:
    return explode_query_map(spark.read.text(path, wholetext=True))


def read_with_file_name(spark: SparkSession, path: str, pattern: str, fmt: str, schema: str):
    """Files that match the pattern, each row with the name of its file."""
    reader = spark.read.schema(schema).option("pathGlobFilter", pattern)
    df = (reader.options(**CSV_OPTIONS) if fmt == "csv" else reader).format(fmt).load(path)
    return df.select("*", F.col("_metadata.file_name").alias("file_name"))


def list_files(df: DataFrame, name: Column | None = None) -> DataFrame:
    """Names of the files behind a scan, sorted; ``name`` may tell another one from the metadata."""
    shown = F.col("_metadata.file_name") if name is None else name
    return df.select(shown.alias("file_name")).distinct().orderBy("file_name")
