"""Envelopes, pagination, ids, work lists and the category tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlens.functions.text import category_of_file, slug
from hazardlens.operators import dedup, envelopes, ordering, paging, reports, worklist
from hazardlens.plans.collect import (
    collect_ids,
    collect_reviews,
    collect_tree,
    usable_review_pages,
    usable_search_pages,
)
from hazardlens.session import materialize
from hazardlens.sources.files import explode_id_lists, explode_query_map
from registry.base import (
    EXISTING_IDS_SQL,
    PAGES_SQL,
    PRODUCT_LIST_SQL,
    REVIEWS_SQL,
    SEARCH_SQL,
    SIGHTINGS_SQL,
    existing_ids,
    product_list,
    query,
    review_pages,
    reviews,
    search_pages,
    sightings,
    table,
)

# --- review pages ---------------------------------------------------------------

_PAGE_REVIEWS_SQL = """
select product_id, star, page, total_pages, cast(0 as int) as pos, text as review_text
from p where not blank
union all
select product_id, star, page, total_pages, cast(1 as int), role || ': ' || text
from p where not blank and not dirty"""


@query(
    "status_review",
    f"""with p as ({PAGES_SQL}), last as (
          select product_id, page, case when retried then 2 else 1 end as attempt,
                 case when failed then 'ERROR' else 'OK' end as status from p)
        select product_id, page, attempt, status from last
        union all
        select product_id, page, 1, 'TOKEN_EXPIRED' from p where retried""",
)
def status_review(spark, sf_dir):
    parsed = envelopes.read_review_envelopes(review_pages(spark, sf_dir))
    return parsed.select("product_id", "page", "attempt", "status")


@query(
    "parse_reviews",
    f"""with p as (select * from ({PAGES_SQL}) where not failed) {_PAGE_REVIEWS_SQL}""",
)
def parse_reviews(spark, sf_dir):
    parsed = envelopes.read_review_envelopes(review_pages(spark, sf_dir))
    rows = envelopes.explode_reviews(parsed.where(F.col("status") == "OK"))
    return rows.select("product_id", "star", "page", "total_pages", "pos", "review_text")


@query(
    "filter_star",
    f"""select product_id, page, cast(attempt as int) as attempt
        from ({PAGES_SQL}), (values (1), (2)) a(attempt)
        where star in ('1', '2') and (attempt = 1 or retried)""",
)
def filter_star(spark, sf_dir):
    pages = review_pages(spark, sf_dir)
    return worklist.negative_only(pages).select("product_id", "page", "attempt")


_READ_PAGES_SQL = f"""
p as (select * from ({PAGES_SQL}) where not failed),
n as (select *, row_number() over w as n,
             coalesce(max(case when page >= total_pages or blank then 1 else 0 end) over (
               partition by product_id, star order by page
               rows between unbounded preceding and 1 preceding), 0) as stopped
      from p window w as (partition by product_id, star order by page)),
kept as (select * from n where n = page and stopped = 0)"""


@query(
    "pagination_takewhile",
    f"""with {_READ_PAGES_SQL}
        select product_id, star, page,
               cast(case when blank then 0 when dirty then 1 else 2 end as int) as n_valid
        from kept""",
)
def pagination_takewhile(spark, sf_dir):
    kept = paging.review_pages_read(usable_review_pages(review_pages(spark, sf_dir)))
    return kept.select("product_id", "star", "page", "n_valid")


@query(
    "first_usable_attempt",
    """with a as (select user_id, cast(json_extract_string(props, '$.k') as int) // 10 + 1 as page,
                         event_id, ts, event_type from events),
            r as (select *, row_number() over (partition by user_id, page order by ts, event_id) as n
                  from a where event_type <> 'error')
       select user_id, page, event_id from r where n = 1""",
)
def first_usable_attempt(spark, sf_dir):
    number = F.get_json_object("props", "$.k").cast("int")
    attempts = table(spark, sf_dir, "events").withColumn(
        "page", (F.floor(number / 10) + 1).cast("int")
    )
    usable = F.col("event_type") != "error"
    first = paging.first_usable_attempt(attempts, ["user_id", "page"], ["ts", "event_id"], usable)
    return first.select("user_id", "page", "event_id")


@query(
    "enrich_subcategory",
    f"""with ids as (
          select *, row_number() over (partition by category, id order by ordinal) as n
          from ({PRODUCT_LIST_SQL})),
        pages as (select cast(conv_id as varchar) as product_id, turn + 1 as page
                  from conversations)
        select product_id, page, coalesce(category, '') as category,
               coalesce(subcategory, '') as subcategory
        from pages left join (select * from ids where n = 1) on product_id = id""",
)
def enrich_subcategory(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("product_id"), (F.col("turn") + 1).alias("page")
    )
    listed = worklist.enrich_subcategory(pages, product_list(spark, sf_dir))
    return listed.select("product_id", "page", "category", "subcategory")


@query(
    "collect_reviews",
    f"""with {_READ_PAGES_SQL},
        texts as (
          select product_id, star, page, 0 as pos, text as review_text
          from kept where not blank
          union all
          select product_id, star, page, 1, role || ': ' || text
          from kept where not blank and not dirty),
        ids as (select *, row_number() over (partition by category, id order by ordinal) as n
                from ({PRODUCT_LIST_SQL})),
        raw as (
          select category, product_id, subcategory, review_text,
                 row_number() over (partition by category, product_id, review_text
                                    order by star, page, pos) as n
          from texts join (select category, id, subcategory from ids where n = 1) i
               on product_id = i.id
          where star in ('1', '2'))
        select category, product_id, subcategory, review_text from raw where n = 1""",
)
def collect_reviews_query(spark, sf_dir):
    raw = collect_reviews(review_pages(spark, sf_dir), product_list(spark, sf_dir))
    return raw.select("category", "product_id", "subcategory", "review_text")


# --- search pages ------------------------------------------------------------------


@query(
    "status_search",
    f"select subcategory, page, cast(attempt as bigint) as attempt, status from ({SEARCH_SQL})",
)
def status_search(spark, sf_dir):
    parsed = envelopes.read_search_envelopes(search_pages(spark, sf_dir))
    return parsed.select("subcategory", "page", "attempt", "status")


@query(
    "extract_ids",
    f"""with s as (select * from ({SEARCH_SQL}) where status = 'DATA' and n_ids > 0),
        e as (select *, 0 as pos, cast(l_partkey as varchar) as id from s
              union all select *, 1, cast(l_suppkey + 1000000 as varchar) from s)
        select category, subcategory, page, cast(attempt as bigint) as attempt,
               cast(pos as int) as pos, id,
               case when l_partkey % 2 = 0 then 's' || l_partkey else 'fallback' end as next_stream
        from e""",
)
def extract_ids(spark, sf_dir):
    parsed = envelopes.read_search_envelopes(search_pages(spark, sf_dir))
    rows = envelopes.explode_ids(parsed.where(F.col("status") == "DATA"))
    return rows.select("category", "subcategory", "page", "attempt", "pos", "id", "next_stream")


_SEARCH_READ_SQL = f"""
a as (select *, row_number() over (partition by category, subcategory, page order by attempt) as r
      from ({SEARCH_SQL}) where status = 'DATA'),
p as (select * from a where r = 1),
n as (select *, row_number() over (partition by category, subcategory order by page) as n,
             max(case when n_ids = 0 then 1 else 0 end) over (
               partition by category, subcategory order by page
               rows between unbounded preceding and current row) as stopped
      from p),
kept as (select * from n where n = page and stopped = 0)"""


@query(
    "search_takewhile",
    f"""with {_SEARCH_READ_SQL}
        select category, subcategory, page, cast(n_ids as int) as n_ids from kept""",
)
def search_takewhile(spark, sf_dir):
    kept = paging.search_pages_read(usable_search_pages(search_pages(spark, sf_dir)))
    return kept.select("category", "subcategory", "page", "n_ids")


@query(
    "collect_ids",
    f"""with {_SEARCH_READ_SQL},
        found as (select category, subcategory, sub_ord, page, 0 as pos,
                         cast(l_partkey as varchar) as id from kept
                  union all
                  select category, subcategory, sub_ord, page, 1,
                         cast(l_suppkey + 1000000 as varchar) from kept),
        existing as (select 'C' || (p_partkey % 5) as category, cast(p_partkey as varchar) as id,
                            p_type as subcategory from part),
        first as (select *, row_number() over (partition by category, id
                                               order by sub_ord, page, pos) as r
                  from found f
                  where not exists (select 1 from existing e
                                    where e.category = f.category and e.id = f.id))
        select category, id, subcategory, cast(0 as int) as source_rank,
               cast(-1 as bigint) as ordinal from existing
        union all
        select category, id, subcategory, 1,
               row_number() over (partition by category order by sub_ord, page, pos, id) - 1
        from first where r = 1""",
)
def collect_ids_query(spark, sf_dir):
    existing = table(spark, sf_dir, "part").select(
        F.concat(F.lit("C"), (F.col("p_partkey") % 5).cast("string")).alias("category"),
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_type").alias("subcategory"),
    )
    merged = collect_ids(search_pages(spark, sf_dir), existing)
    return merged.fillna(-1, ["ordinal"])


# --- ids ----------------------------------------------------------------------------

_FIRST_SEEN_SQL = f"""
first as (select * from (
  select *, row_number() over (partition by category, id order by sub_ord, page, pos) as r
  from ({SIGHTINGS_SQL})) where r = 1)"""


@query(
    "first_seen_ids",
    f"with {_FIRST_SEEN_SQL} select category, id, sub_ord, page, pos from first",
)
def first_seen_ids(spark, sf_dir):
    first = dedup.first_seen_ids(sightings(spark, sf_dir))
    return first.select("category", "id", "sub_ord", "page", "pos")


@query(
    "new_ids",
    f"""with {_FIRST_SEEN_SQL}, existing as ({EXISTING_IDS_SQL})
        select category, id, subcategory from first f
        where not exists (select 1 from existing e where e.category = f.category and e.id = f.id)""",
)
def new_ids(spark, sf_dir):
    fresh = dedup.new_ids(sightings(spark, sf_dir), existing_ids(spark, sf_dir))
    return fresh.select("category", "id", "subcategory")


@query(
    "merge_ids",
    f"""with {_FIRST_SEEN_SQL}, existing as ({EXISTING_IDS_SQL})
        select category, id, subcategory, cast(0 as int) as source_rank,
               cast(-1 as bigint) as ordinal from existing
        union all
        select category, id, subcategory, 1,
               row_number() over (partition by category order by sub_ord, page, pos, id) - 1 from first f
        where not exists (select 1 from existing e where e.category = f.category and e.id = f.id)""",
)
def merge_ids(spark, sf_dir):
    merged = dedup.merge_ids(sightings(spark, sf_dir), existing_ids(spark, sf_dir))
    return merged.fillna(-1, ["ordinal"])


@query(
    "running_new_ids",
    f"""with {_FIRST_SEEN_SQL},
        seen as (select category, subcategory, page, count(*) as ids_seen
                 from ({SIGHTINGS_SQL}) group by all),
        fresh as (select category, subcategory, page, count(*) as c from first group by all),
        both_ as (select s.*, coalesce(c, 0) as new_ids
                  from seen s left join fresh using (category, subcategory, page))
        select category, subcategory, page, ids_seen, new_ids,
               cast(sum(new_ids) over (partition by category, subcategory order by page
                    rows between unbounded preceding and current row) as bigint) as new_so_far
        from both_""",
)
def running_new_ids(spark, sf_dir):
    found = sightings(spark, sf_dir)
    return paging.running_new_ids(found, dedup.first_seen_ids(found))


@query(
    "scan_ids_mixed",
    """select p_partkey as list_id, cast(0 as bigint) as ordinal,
              cast(p_partkey as varchar) as id, '' as subcategory from part
       union all
       select p_partkey, 1, cast(p_size as varchar), p_type from part
       union all
       select p_partkey, 2, p_brand, '' from part""",
)
def scan_ids_mixed(spark, sf_dir):
    entry = F.to_json(F.struct(F.col("p_size").alias("id"), F.col("p_type").alias("subcategory")))
    no_subcategory = F.to_json(F.struct(F.col("p_brand").alias("id")))
    bare = F.concat(F.lit('"'), F.col("p_partkey").cast("string"), F.lit('"'))
    body = F.concat(F.lit("["), F.concat_ws(", ", bare, entry, no_subcategory), F.lit("]"))
    lists = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("list_id"), body.alias("value")
    )
    return explode_id_lists(lists)


# --- work lists ----------------------------------------------------------------------


@query(
    "query_map_flatten",
    """select p_partkey as map_id, p_brand as category, cast(1 as int) as ordinal,
              p_type as subcategory, lower(p_type) as query from part
       union all
       select p_partkey, p_brand, 2, p_name, 'buy ' || p_name from part""",
)
def query_map_flatten(spark, sf_dir):
    subcategories = F.create_map(
        "p_type", F.lower("p_type"), "p_name", F.concat(F.lit("buy "), "p_name")
    )
    body = F.to_json(
        F.create_map("p_brand", F.struct(subcategories.alias("subcategories")))
    )
    maps = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("map_id"), body.alias("value")
    )
    return explode_query_map(maps)


@query(
    "query_lookup",
    """select s_suppkey, r_name as category, n_name as subcategory,
              lower(n_name) || ' in ' || lower(r_name) as query
       from supplier join nation on s_nationkey = n_nationkey
            join region on n_regionkey = r_regionkey""",
)
def query_lookup(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    names = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("category"), F.col("n_name").alias("subcategory")
    )
    work = table(spark, sf_dir, "supplier").join(names, F.col("s_nationkey") == F.col("n_nationkey"))
    query_map = names.withColumn(
        "query", F.concat(F.lower("subcategory"), F.lit(" in "), F.lower("category"))
    )
    found = worklist.query_lookup(
        work.select("s_suppkey", "category", "subcategory"), query_map
    )
    return found.select("s_suppkey", "category", "subcategory", "query")


@query(
    "work_list",
    """select p_partkey, star from part, (values ('1'), ('2')) s(star)""",
)
def work_list(spark, sf_dir):
    return worklist.work_list(table(spark, sf_dir, "part").select("p_partkey"))


@query(
    "product_batches",
    f"""select category, ordinal, id,
               cast((row_number() over (partition by category order by ordinal) - 1) // 3000
                    as bigint) as batch_id
        from ({PRODUCT_LIST_SQL})""",
)
def product_batches(spark, sf_dir):
    batched = worklist.product_batches(product_list(spark, sf_dir))
    return batched.select("category", "ordinal", "id", "batch_id")


@query(
    "start_from",
    f"""with l as ({PRODUCT_LIST_SQL}),
        s as (select category, min(ordinal) as start from l
              where subcategory = 'FURNITURE' group by category)
        select category, ordinal, id, subcategory from l left join s using (category)
        where ordinal >= coalesce(start, 0)""",
)
def start_from(spark, sf_dir):
    return worklist.start_from(product_list(spark, sf_dir), "FURNITURE")


@query(
    "select_categories",
    f"select doc_id, category from ({REVIEWS_SQL}) where category in ('fr', 'de')",
)
def select_categories(spark, sf_dir):
    known = ["en", "fr", "de", "es"]
    chosen = worklist.select_numbered(reviews(spark, sf_dir), "2 3", known)
    return chosen.select("doc_id", "category")


@query(
    "derive_category",
    """select p_partkey, replace(p_name, ' ', '_') as category,
              'shop_us_' || replace(p_name, ' ', '_') || '_reviews_labeled' as labelled_name
       from part""",
)
def derive_category(spark, sf_dir):
    stem = F.concat(F.lit("shop_us_"), slug(F.col("p_name")), F.lit("_ids"))
    category = category_of_file(stem, "shop_us_", "_ids")
    raw_name = F.concat(F.lit("shop_us_"), category, F.lit("_reviews_raw"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        category.alias("category"),
        F.replace(raw_name, F.lit("_raw"), F.lit("_labeled")).alias("labelled_name"),
    )


# --- order ------------------------------------------------------------------------------


@query(
    "sort_numeric_id",
    f"""select doc_id, category, product_id,
               row_number() over (partition by category
                                  order by cast(product_id as bigint), arrival) as position
        from ({REVIEWS_SQL})""",
)
def sort_numeric_id(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn("number", F.col("product_id").try_cast("bigint"))
    numbered = ordering.ordinal(rows, ["category"], ["number", "arrival"], "position")
    return ordering.sort_by_numeric_id(numbered).select(
        "doc_id", "category", "product_id", "position"
    )


@query(
    "limit_per_category",
    f"""select doc_id, category from (
          select *, row_number() over (partition by category order by arrival) as n
          from ({REVIEWS_SQL})) where n <= 25""",
)
def limit_per_category(spark, sf_dir):
    first = ordering.first_per_group(reviews(spark, sf_dir), ["category"], "arrival", 25)
    return first.select("doc_id", "category")


@query(
    "offset_rows",
    f"""select doc_id, category from (
          select *, row_number() over (partition by category order by arrival) as n
          from ({REVIEWS_SQL})) where n > 40""",
)
def offset_rows(spark, sf_dir):
    rest = ordering.skip_per_group(reviews(spark, sf_dir), ["category"], "arrival", 40)
    return rest.select("doc_id", "category")


# --- category tree ------------------------------------------------------------------------
# Every customer is one tab response; customers of a nation share their title.

_TABS_SQL = """
select c_custkey as tab_pos, 'T' || c_nationkey as category, c_custkey % 9 = 0 as failed,
       c_custkey % 4 = 0 as empty, c_custkey % 5 = 0 as unmarked, c_name, c_mktsegment
from customer"""


def _tab_responses(spark, sf_dir):
    key = F.col("c_custkey")

    def module(*items):
        entries = [F.struct(i.alias("id"), t.alias("title")) for i, t in items]
        return F.struct(F.struct(F.array(*entries).alias("items")).alias("data"))

    title = F.when(key % 4 != 0, F.col("c_name")).otherwise("")
    segment = F.when(key % 4 != 0, F.col("c_mktsegment")).otherwise("")
    mark = F.when(key % 5 == 0, "b").otherwise("b#1")
    modules = F.array(
        module((F.lit("a"), F.lit("banner"))),
        module((mark, title), (F.lit("c"), segment), (F.lit("d"), F.lit(""))),
        module((F.when(key % 5 != 0, "e#1").otherwise("e"), F.lit("too late"))),
    )
    tab = F.struct(
        key.cast("string").alias("id"),
        F.concat(F.lit("T"), F.col("c_nationkey").cast("string")).alias("title"),
    )
    no_id = F.struct(F.lit("").alias("id"), F.lit("nameless").alias("title"))
    untitled = F.struct(
        F.concat(F.lit("u"), key.cast("string")).alias("id"),
        F.lit(None).cast("string").alias("title"),
    )
    data = F.struct(
        F.struct(F.array(tab, no_id, untitled).alias("items")).alias("categoryTabs"),
        modules.alias("modules"),
    )
    code = F.when(key % 9 == 0, "FAIL_SYS_TOKEN_ILLEGAL::x").otherwise("SUCCESS::ok")
    body = F.to_json(
        F.struct(F.array(code).alias("ret"), F.struct(data.alias("data")).alias("data"))
    )
    return table(spark, sf_dir, "customer").select(
        key.alias("tab_pos"), key.cast("string").alias("tab_id"), body.alias("body")
    )


@query(
    "status_category",
    f"""select tab_pos, case when failed then 'TOKEN_EXPIRED' else 'OK' end as status
        from ({_TABS_SQL})""",
)
def status_category(spark, sf_dir):
    parsed = envelopes.read_tab_envelopes(_tab_responses(spark, sf_dir))
    return parsed.select("tab_pos", "status")


@query(
    "tab_list",
    f"""select tab_pos, tab_id, tab_title from (
          select 0 as tab_pos, cast(tab_pos as varchar) as tab_id, category as tab_title
          from ({_TABS_SQL}) where not failed
          union all
          select 2, 'u' || tab_pos, 'u' || tab_pos from ({_TABS_SQL}) where not failed)""",
)
def tab_list(spark, sf_dir):
    return envelopes.tab_list(_tab_responses(spark, sf_dir))


@query(
    "category_tree",
    f"""with t as (select category, tab_pos, list_sort([c_name, c_mktsegment]) as subs
                   from ({_TABS_SQL}) where not failed and not empty and not unmarked)
        select category, array_to_string(arg_max(subs, tab_pos), '|') as subcategories
        from t group by category""",
)
def category_tree(spark, sf_dir):
    tabs = _tab_responses(spark, sf_dir)
    listed = envelopes.tab_list(tabs).select("tab_id", "tab_title")
    titled = tabs.join(listed, "tab_id")
    tree = envelopes.category_tree(titled)
    return tree.select("category", F.array_join("subcategories", "|").alias("subcategories"))


@query(
    "collect_tree",
    f"""with t as (select category, tab_pos, list_sort([c_name, c_mktsegment]) as subs
                   from ({_TABS_SQL}) where not failed and not empty and not unmarked)
        select category, array_to_string(arg_max(subs, tab_pos), '|') as subcategories
        from t group by category""",
)
def collect_tree_query(spark, sf_dir):
    tabs = _tab_responses(spark, sf_dir)
    tree = materialize(collect_tree(tabs, tabs), "tree")
    return tree.select("category", F.array_join("subcategories", "|").alias("subcategories"))


@query(
    "tree_volume",
    f"""with t as (select category, tab_pos, [c_name, c_mktsegment] as subs
                   from ({_TABS_SQL}) where not failed and not empty and not unmarked)
        select category, cast(len(arg_max(subs, tab_pos)) as int) as subcategories
        from t group by category""",
)
def tree_volume(spark, sf_dir):
    tabs = _tab_responses(spark, sf_dir)
    return reports.tree_volume(materialize(collect_tree(tabs, tabs), "tree"))
