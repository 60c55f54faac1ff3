"""Registration of queries with their SQL, and the roles the test tables play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.functions.text import review_key

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- documents as raw reviews ------------------------------------------------

REVIEWS_SQL = """
select doc_id, lang as category, regexp_extract(source, '[0-9]+') as product_id,
       source as subcategory, text as review_text, doc_id as arrival
from documents"""


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("lang").alias("category"),
        F.regexp_extract("source", "[0-9]+", 0).alias("product_id"),
        F.col("source").alias("subcategory"),
        F.col("text").alias("review_text"),
        F.col("doc_id").alias("arrival"),
    )


def keyed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = review_key(F.col("category"), F.col("product_id"), F.col("review_text"))
    return reviews(spark, sf_dir).withColumn("review_key", key)


REVIEW_KEY_SQL = "md5(category || '&' || product_id || '&' || review_text)"

# --- labels as the two label passes ------------------------------------------


def pass_labels(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """One pass as a label table keyed by ``doc_id``."""
    return table(spark, sf_dir, "labels").select(
        "doc_id",
        F.col(column).alias("label"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("labelled_at"),
    )


# --- conversations as landed review pages ------------------------------------
# The length of the text decides what is wrong with a page: an error code, blank
# reviews, a control character in the second review, or an expired token before
# the good answer.

PAGES_SQL = """
select cast(conv_id as varchar) as product_id, cast(1 + conv_id % 5 as varchar) as star,
       cast(turn + 1 as int) as page, cast(3 + conv_id % 5 as int) as total_pages, text, role,
       length(text) % 7 = 0 as failed, length(text) % 5 = 0 as blank,
       length(text) % 11 = 0 as dirty, length(text) % 3 = 0 as retried
from conversations"""


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    second = F.concat(
        F.col("role"), F.lit(": "), F.when(n % 11 == 0, F.lit("\x0b")).otherwise(""), F.col("text")
    )
    blank = F.lit(" \xa0 ")
    first_review = F.struct(
        F.lit("").alias("reviewContent"),
        F.when(n % 5 == 0, blank)
        .otherwise(F.concat(F.lit("\x1c "), F.col("text"), F.lit(" \u3000")))
        .alias("content"),
    )
    second_review = F.struct(
        F.when(n % 5 == 0, blank).otherwise(second).alias("reviewContent"),
        F.lit("later").alias("content"),
    )
    code = F.when(n % 7 == 0, F.lit("FAIL_SYS::error")).otherwise("SUCCESS::ok")
    data = F.struct(
        F.lit(0).alias("totalPage"),
        (3 + F.col("conv_id") % 5).alias("maxPage"),
        F.array().cast("array<string>").alias("reviewList"),
        F.array(first_review, second_review).alias("reviews"),
    )
    good = F.to_json(F.struct(F.array(code).alias("ret"), data.alias("data")))
    expired = F.lit('{"ret":["FAIL_SYS_TOKEN_EXOIRED::token"]}')
    bodies = F.when(n % 3 == 0, F.array(expired, good)).otherwise(F.array(good))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("product_id"),
        (1 + F.col("conv_id") % 5).cast("string").alias("star"),
        (F.col("turn") + 1).cast("int").alias("page"),
        F.posexplode(bodies).alias("attempt", "json"),
    ).select(
        "product_id",
        "star",
        "page",
        (F.col("attempt") + 1).alias("attempt"),
        F.concat(F.lit("mtopjsonp1("), F.col("json"), F.lit(")")).alias("body"),
    )


# --- lineitem as landed search pages and as id sightings ---------------------
# Orders are subcategories, line numbers pages; a line number that comes again is
# another attempt. Three categories, so each holds a third of the rows.

SEARCH_SQL = """
select 'C' || (l_orderkey % 3) as category, cast(l_orderkey as varchar) as subcategory,
       cast(l_orderkey as bigint) as sub_ord, l_linenumber as page,
       l_partkey * 100000 + l_suppkey as attempt, l_partkey, l_suppkey,
       case l_suppkey % 13 when 0 then 'BLOCKED' when 1 then 'BLOCKED' when 2 then 'AUTH'
            else 'DATA' end as status,
       case when l_partkey % 10 = 0 then 0 else 2 end as n_ids
from lineitem"""


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    kind = supp % 13
    code = (
        F.when(kind == 0, "FAIL::RGV587").when(kind == 2, "FAIL_AUTH::x").otherwise("whatever")
    )
    flag = F.when(kind == 1, '"x5step":1,').otherwise("")
    items = F.concat(
        F.lit('{"productId":'), part.cast("string"), F.lit('},{"productId":0},{"productId":"'),
        (supp + 1_000_000).cast("string"), F.lit('"}'),
    )
    content = F.when(part % 10 == 0, '{"productId":0}').otherwise(items)
    stream = F.when(part % 2 == 0, F.concat(F.lit("s"), part.cast("string"))).otherwise("")
    body = F.concat(
        F.lit('{"ret":["'), code, F.lit('"],'), flag,
        F.lit('"data":{"result":{"mods":{"itemList":{"content":['), content,
        F.lit(']}},"pageInfo":{"streamId":"'), stream,
        F.lit('"},"streamId":"fallback"}}}'),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("C"), (F.col("l_orderkey") % 3).cast("string")).alias("category"),
        F.col("l_orderkey").cast("string").alias("subcategory"),
        F.col("l_orderkey").alias("sub_ord"),
        F.col("l_linenumber").alias("page"),
        (part * 100_000 + supp).alias("attempt"),
        body.alias("body"),
    )


SIGHTINGS_SQL = """
select l_returnflag as category, cast(l_partkey as varchar) as id, l_suppkey as sub_ord,
       cast(l_suppkey as varchar) as subcategory, l_orderkey as page, l_linenumber as pos
from lineitem"""


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("category"),
        F.col("l_partkey").cast("string").alias("id"),
        F.col("l_suppkey").alias("sub_ord"),
        F.col("l_suppkey").cast("string").alias("subcategory"),
        F.col("l_orderkey").alias("page"),
        F.col("l_linenumber").alias("pos"),
    )


EXISTING_IDS_SQL = """
select case p_partkey % 4 when 0 then 'A' when 1 then 'N' else 'R' end as category,
       cast(p_partkey as varchar) as id, p_type as subcategory
from part"""


def existing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_partkey") % 4
    return table(spark, sf_dir, "part").select(
        F.when(kind == 0, "A").when(kind == 1, "N").otherwise("R").alias("category"),
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_type").alias("subcategory"),
    )


# --- customer as product list -------------------------------------------------

PRODUCT_LIST_SQL = """
select 'N' || c_nationkey as category, cast(c_custkey as bigint) as ordinal,
       cast(c_custkey % 150 as varchar) as id, c_mktsegment as subcategory
from customer"""


def product_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("category"),
        F.col("c_custkey").alias("ordinal"),
        (F.col("c_custkey") % 150).cast("string").alias("id"),
        F.col("c_mktsegment").alias("subcategory"),
    )
