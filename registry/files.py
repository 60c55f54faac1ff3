"""Sources, sinks and streams: written to the working folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlens import schemas
from hazardlens.functions.text import review_key
from hazardlens.operators import envelopes
from hazardlens.operators.batching import unlabelled
from hazardlens.operators.ordering import ordinal
from hazardlens.session import work_dir
from hazardlens.sources import files, writers
from hazardlens.streaming.dedup import stream_distinct_ids
from hazardlens.streaming.ingest import stream_merge
from hazardlens.streaming.paging import stream_review_pages
from registry.base import (
    EXISTING_IDS_SQL,
    PAGES_SQL,
    REVIEWS_SQL,
    existing_ids,
    pass_labels,
    query,
    review_pages,
    reviews,
    search_pages,
    sightings,
    table,
)
from registry.collect import _PAGE_REVIEWS_SQL, _READ_PAGES_SQL, _tab_responses
from registry.labels import _merged, _merged_sql

# --- sources -----------------------------------------------------------------------


@query("scan_reviews_csv", f"select product_id, subcategory, review_text from ({REVIEWS_SQL})")
def scan_reviews_csv(spark, sf_dir):
    path = work_dir(spark, "reviews_csv")
    writers.write_reviews_csv(
        reviews(spark, sf_dir).select("product_id", "subcategory", "review_text"), path
    )
    return files.read_reviews_csv(spark, path).drop("file_name")


@query(
    "scan_optional",
    """select 'absent' as what, doc_id from documents union all
       select 'present', doc_id from documents where doc_id not in (select doc_id from labels)""",
)
def scan_optional(spark, sf_dir):
    """Reviews left over by a label table that is not there yet, and by one that is."""
    absent, present = work_dir(spark, "absent"), work_dir(spark, "present")
    schema = "doc_id bigint, label int, labelled_at timestamp"
    writers.append_labels(pass_labels(spark, sf_dir, "quality"), present)
    rows = reviews(spark, sf_dir)

    def left_over(what, path):
        labels = files.read_optional(spark, path, schema)
        return unlabelled(rows, labels, "doc_id").select(F.lit(what).alias("what"), "doc_id")

    return left_over("absent", absent).unionByName(left_over("present", present))


@query(
    "scan_files_with_name",
    """select doc_id, lang as category, 'lang=' || lang as folder from documents""",
)
def scan_files_with_name(spark, sf_dir):
    path = work_dir(spark, "per_category")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    docs.write.partitionBy("lang").parquet(path)
    read = files.read_with_file_name(spark, path, "*.parquet", "parquet", "doc_id bigint, lang string")
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return read.where(F.endswith("file_name", F.lit(".parquet"))).select(
        "doc_id", F.col("lang").alias("category"), folder.alias("folder")
    )


@query(
    "list_files",
    """select 'shop_' || lang || '.json' as file_name,
              row_number() over (order by 'shop_' || lang || '.json') as place
       from (select distinct lang from documents)""",
)
def list_files(spark, sf_dir):
    """Names of files, sorted: what a folder of one file per category lists."""
    path = work_dir(spark, "listing")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    docs.repartition("lang").write.partitionBy("lang").json(path)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    read = spark.read.schema("doc_id bigint").json(path)
    named = F.concat(F.lit("shop_"), F.regexp_replace(folder, "^lang=", ""), F.lit(".json"))
    listed = files.list_files(read, named)
    return ordinal(listed.withColumn("folder", F.lit("")), ["folder"], ["file_name"], "place").drop("folder")


@query(
    "scan_id_files",
    f"""select category, id, subcategory,
               row_number() over (partition by category order by id) - 1 as ordinal
        from ({EXISTING_IDS_SQL})""",
)
def scan_id_files(spark, sf_dir):
    """Written lists read back with their order."""
    path = work_dir(spark, "id_files")
    writers.write_id_lists(existing_ids(spark, sf_dir), path)
    lists = files.read_id_lists(spark, path)
    return lists.select(F.upper("category").alias("category"), "id", "subcategory", "ordinal")


@query(
    "land_review_pages",
    f"""with p as (select * from ({PAGES_SQL}) where not failed) {_PAGE_REVIEWS_SQL}""",
)
def land_review_pages(spark, sf_dir):
    path = work_dir(spark, "review_pages")
    pages = review_pages(spark, sf_dir).withColumn(
        "ingest_ts", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    pages.write.json(path)
    parsed = envelopes.read_review_envelopes(files.read_review_pages(spark, path))
    rows = envelopes.explode_reviews(parsed.where(F.col("status") == "OK"))
    return rows.select("product_id", "star", "page", "total_pages", "pos", "review_text")


@query(
    "land_search_pages",
    """select cast(l_orderkey as varchar) as subcategory, l_linenumber as page,
              case when l_partkey % 10 = 0 then ''
                   else l_partkey || ',' || (l_suppkey + 1000000) end as ids
       from lineitem where l_suppkey % 13 > 2""",
)
def land_search_pages(spark, sf_dir):
    path = work_dir(spark, "search_pages")
    writers.write_landed(search_pages(spark, sf_dir), path)
    parsed = envelopes.read_search_envelopes(files.read_search_pages(spark, path))
    return parsed.where(F.col("status") == "DATA").select(
        "subcategory", "page", F.array_join("ids", ",").alias("ids")
    )


@query(
    "land_category_tabs",
    """select cast(c_custkey as int) as tab_pos, cast(c_custkey as varchar) as tab_id,
              case when c_custkey % 9 = 0 then 'TOKEN_EXPIRED' else 'OK' end as status
       from customer""",
)
def land_category_tabs(spark, sf_dir):
    path = work_dir(spark, "category_tabs")
    _tab_responses(spark, sf_dir).write.json(path)
    parsed = envelopes.read_tab_envelopes(files.read_category_tabs(spark, path))
    return parsed.select("tab_pos", "tab_id", "status")


# --- sinks -------------------------------------------------------------------------


@query(
    "append_labels",
    """select doc_id, quality as label from labels union all
       select doc_id, case when toxic = 1 then 1 else -1 end from labels""",
)
def append_labels(spark, sf_dir):
    path = work_dir(spark, "labels")
    second = pass_labels(spark, sf_dir, "toxic")
    only_hits = second.withColumn("label", F.when(F.col("label") == 1, 1))
    for labels in (pass_labels(spark, sf_dir, "quality"), only_hits):
        writers.append_labels(labels, path)
    return spark.read.parquet(path).select(
        "doc_id", F.coalesce("label", F.lit(-1)).alias("label")
    )


@query("compact_labels", "select doc_id, quality as label from labels")
def compact_labels(spark, sf_dir):
    path, target = work_dir(spark, "labels"), work_dir(spark, "compacted")
    first = pass_labels(spark, sf_dir, "quality")
    again = pass_labels(spark, sf_dir, "toxic").withColumn(
        "labelled_at", F.col("labelled_at") + F.expr("interval 1 hour")
    )
    for labels in (first, again):
        writers.append_labels(labels, path)
    writers.compact_labels(spark, path, target, "doc_id")
    return spark.read.parquet(target).select("doc_id", "label")


@query(
    "write_merged_reviews",
    f"""with r as (
          select *, case when doc_id % 3 = 0 then 1 else 0 end as source_rank
          from ({REVIEWS_SQL}))
        select category, product_id, subcategory, review_text,
               row_number() over (partition by category order by cast(product_id as bigint),
                                  source_rank, arrival) as place, count(*) over () as written
        from (select *, row_number() over (partition by category, product_id, review_text
                                           order by source_rank, arrival) as n from r)
        where n = 1""",
)
def write_merged_reviews(spark, sf_dir):
    existing, target = work_dir(spark, "raw"), work_dir(spark, "raw")
    rows = reviews(spark, sf_dir)
    rows.where(F.col("doc_id") % 3 != 0).write.parquet(existing)
    batch = rows.where(F.col("doc_id") % 3 == 0)
    written = writers.write_merged_reviews(spark.read.parquet(existing), batch, target)
    placed = ordinal(spark.read.parquet(target), ["category"], ["ordinal"], "place")
    return placed.drop("ordinal").withColumn("written", F.lit(written).cast("bigint"))


@query(
    "write_hazards_csv",
    """select regexp_extract(source, '[0-9]+') as product_id, source as subcategory,
              text as review_text, quality as hazard_label_classified
       from documents join labels using (doc_id) where quality = 1""",
)
def write_hazards_csv(spark, sf_dir):
    path = work_dir(spark, "hazards")
    labels = pass_labels(spark, sf_dir, "quality").select(
        "doc_id", F.col("label").alias("hazard_label_classified")
    )
    hazards = reviews(spark, sf_dir).join(labels.where("hazard_label_classified = 1"), "doc_id")
    writers.write_hazards_csv(hazards, path)
    schema = schemas.RAW_REVIEWS + ", hazard_label_classified int"
    return files.read_reviews_csv(spark, path, schema).drop("file_name")


@query(
    "export_ids",
    f"""select lower(category) as slug, id, subcategory,
               row_number() over (partition by category order by id) - 1 as ordinal
        from ({EXISTING_IDS_SQL})""",
)
def export_ids(spark, sf_dir):
    path = work_dir(spark, "ids")
    writers.write_id_lists(existing_ids(spark, sf_dir), path)
    schema = "id string, subcategory string, ordinal bigint, slug string"
    return spark.read.schema(schema).json(path).select("slug", "id", "subcategory", "ordinal")


@query(
    "export_category_tree",
    """select 'T' || c_nationkey as category,
              array_to_string(arg_max(list_sort([c_name, c_mktsegment]), c_custkey), '|') as names
       from customer
       where c_custkey % 9 <> 0 and c_custkey % 4 <> 0 and c_custkey % 5 <> 0
       group by all""",
)
def export_category_tree(spark, sf_dir):
    path = work_dir(spark, "tree")
    tabs = _tab_responses(spark, sf_dir)
    listed = envelopes.tab_list(tabs).select("tab_id", "tab_title")
    writers.write_category_tree(envelopes.category_tree(tabs.join(listed, "tab_id")), path)
    tree = spark.read.text(path).select(
        F.explode(F.from_json("value", "map<string,array<string>>")).alias("category", "names")
    )
    return tree.select("category", F.array_join("names", "|").alias("names"))


@query(
    "final_export",
    f"""select product_id, subcategory, review_text, hazard_label_classified,
               hazard_label_validated, hazard_final
        from ({_merged_sql("quality = 1 or toxic = 1")})""",
)
def final_export(spark, sf_dir):
    path = work_dir(spark, "final")
    merged = _merged(spark, sf_dir, "union").withColumn("arrival", F.col("doc_id"))
    writers.write_final(merged, path)
    schema = schemas.LABELLED_REVIEWS + ", hazard_final int"
    return files.read_reviews_csv(spark, path, schema).drop("file_name")


@query(
    "merge_versions",
    """with d as (select lang as category, regexp_extract(source, '[0-9]+') as product_id, text as review_text from documents)
       select distinct category, product_id, review_text from d""",
)
def merge_versions(spark, sf_dir):
    """Two batches are merged into one table, the second into what the first left there."""
    path, every = work_dir(spark, "versions"), reviews(spark, sf_dir)
    for part in range(2):
        writers.merge_into(spark, path, every.where(F.col("doc_id") % 2 == part).drop("doc_id"))
    return writers.read_merged(spark, path).select("category", "product_id", "review_text")


# --- streams ------------------------------------------------------------------------


def _land_documents(docs, path):
    docs.write.mode("append").partitionBy("lang").parquet(path)


def _as_reviews(docs):
    product = F.regexp_extract("source", "[0-9]+", 0)
    return docs.select(
        F.col("lang").alias("category"),
        product.alias("product_id"),
        F.col("source").alias("subcategory"),
        F.col("text").alias("review_text"),
        F.col("doc_id").alias("arrival"),
        review_key(F.col("lang"), product, F.col("text")).alias("review_key"),
    )


@query(
    "stream_merge",
    f"""select distinct category, product_id, review_text from ({REVIEWS_SQL})""",
)
def stream_merge_query(spark, sf_dir):
    """Documents land in two portions; the second run of the stream takes the new files only."""
    source, target = work_dir(spark, "landed"), work_dir(spark, "merged")
    checkpoint = work_dir(spark, "checkpoint")
    schema = "doc_id bigint, text string, source string, n_chars bigint, lang string"
    docs = table(spark, sf_dir, "documents")
    for portion in (docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")):
        _land_documents(portion, source)
        merged = stream_merge(spark, source, schema, target, checkpoint, _as_reviews)
    return merged.select("category", "product_id", "review_text")


@query("stream_dedup", "select distinct l_returnflag as category, cast(l_partkey as varchar) as id from lineitem")
def stream_dedup(spark, sf_dir):
    source, target = work_dir(spark, "sightings"), work_dir(spark, "distinct")
    checkpoint = work_dir(spark, "checkpoint")
    found = sightings(spark, sf_dir).select("category", "id")
    first = F.crc32("id") % 2 == 0
    for portion in (found.where(first), found):
        portion.write.mode("append").parquet(source)
        ids = stream_distinct_ids(spark, source, "category string, id string", target, checkpoint)
    return ids.select("category", "id")


# Hour and users of each portion: some come again within the delay of twelve hours, some long after it.
_PORTIONS = ((0, "user_id % 3 = 0"), (6, "user_id % 3 < 2"), (40, "user_id % 3 = 2"), (60, "user_id % 5 = 0"), (80, "true"))


@query(
    "stream_dedup_bounded",
    """with u as (select distinct user_id from events),
            s as (select user_id as id, 0 as hour from u where user_id % 3 = 0
                  union all select user_id, 6 from u where user_id % 3 = 1
                  union all select user_id, 40 from u where user_id % 3 = 2
                  union all select user_id, 80 from u where user_id % 3 < 2
                  union all select -1 - user_id, 60 from u where user_id % 5 = 0)
       select cast(id as varchar) as id, cast(hour as int) as hour from s""",
)
def stream_dedup_bounded(spark, sf_dir):
    """A stream that restarts for each portion and remembers a user for twelve hours.

    Rows that come later than the delay, in the last portion, are left out.
    """
    source, target = work_dir(spark, "sightings"), work_dir(spark, "distinct")
    checkpoint = work_dir(spark, "checkpoint")
    events, start = table(spark, sf_dir, "events"), F.lit("2024-01-01").cast("timestamp")

    def at(hour):
        seconds = F.lit(hour * 3600) + F.col("event_id") % 3600
        return F.timestamp_add("SECOND", seconds, start).alias("seen")

    for hour, users in _PORTIONS:
        user = F.col("user_id") if hour != 60 else -1 - F.col("user_id")
        portion = events.where(users).select(user.cast("string").alias("id"), at(hour))
        if hour == 80:
            late = F.concat(F.lit("late "), F.col("user_id").cast("string")).alias("id")
            portion = portion.unionAll(events.select(late, at(1)))
        portion.write.mode("append").parquet(source)
        found = stream_distinct_ids(
            spark, source, "id string, seen timestamp", target, checkpoint, ["id"], event_time="seen", delay="12 hours"
        )
    return found.select("id", F.floor(F.timestamp_diff("SECOND", start, F.col("seen")) / 3600).cast("int").alias("hour"))


@query(
    "stream_pagination",
    f"""with {_READ_PAGES_SQL}
        select product_id, star, page, cast(case when blank then 0 when dirty then 1 else 2 end as int) as n_valid
        from kept""",
)
def stream_pagination(spark, sf_dir):
    """Landed pages come in three portions in no order; each run reads as far as it can."""
    source, target = work_dir(spark, "landed_pages"), work_dir(spark, "pages_read")
    checkpoint = work_dir(spark, "checkpoint")
    pages = review_pages(spark, sf_dir).withColumn("part", F.crc32(F.concat_ws(",", "product_id", "page", "attempt")) % 3)
    for part in range(3):
        pages.where(F.col("part") == part).drop("part").write.mode("append").json(source)
        kept = stream_review_pages(spark, source, target, checkpoint)
    return kept.select("product_id", "star", "page", "n_valid")
