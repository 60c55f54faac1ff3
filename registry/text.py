"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlens.functions import answers, text
from hazardlens.operators.envelopes import parse_envelope, part
from registry.base import REVIEW_KEY_SQL, REVIEWS_SQL, query, reviews, table

FENCE = "`" * 3


@query("fn_strip", "select doc_id, text as stripped from documents")
def fn_strip(spark, sf_dir):
    padded = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("\x1c "), "text", F.lit("\xa0")))
        .when(F.col("doc_id") % 4 == 1, F.concat(F.lit("\u3000\t"), "text", F.lit("\n")))
        .when(F.col("doc_id") % 4 == 2, F.concat(F.lit("\u2028"), "text", F.lit("\x85\u1680")))
        .otherwise(F.col("text"))
    )
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.strip(padded).alias("stripped"))


_CHAIN = {
    "a": "case doc_id % 3 when 0 then '' when 1 then null else text end",
    "b": "case when doc_id % 2 = 0 then source else '' end",
    "c": "case when doc_id % 5 = 0 then '' else lang end",
}


@query(
    "fn_text_chain",
    f"""with t as (select doc_id, {_CHAIN["a"]} as a, {_CHAIN["b"]} as b, {_CHAIN["c"]} as c
                   from documents)
        select doc_id, case when a <> '' then a when b <> '' then b when c <> '' then c
                            else '' end as chosen from t""",
)
def fn_text_chain(spark, sf_dir):
    fields = [F.expr(sql) for sql in _CHAIN.values()]
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.first_text(*fields).alias("chosen"))


@query(
    "fn_list_chain",
    """select doc_id, case when doc_id % 3 = 1 then lang || '|' || source
                           when doc_id % 2 = 0 then text else '' end as chosen
       from documents""",
)
def fn_list_chain(spark, sf_dir):
    empty = F.array().cast("array<string>")
    first = F.when(F.col("doc_id") % 3 == 1, F.array("lang", "source")).when(
        F.col("doc_id") % 3 == 0, empty
    )
    second = F.when(F.col("doc_id") % 2 == 0, F.array("text")).otherwise(empty)
    chosen = F.coalesce(text.first_list(first, second), empty)
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.array_join(chosen, "|").alias("chosen"))


@query(
    "fn_total_pages",
    """select doc_id, cast(case when doc_id % 4 = 3 then n_chars
                                when doc_id % 3 <> 0 then doc_id % 3 else 1 end as int) as total
       from documents""",
)
def fn_total_pages(spark, sf_dir):
    kind = F.col("doc_id") % 4
    first = (
        F.when(kind == 0, "0").when(kind == 2, "junk").when(kind == 3, F.col("n_chars").cast("string"))
    )
    second = (F.col("doc_id") % 3).cast("string")
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.total_pages(first, second).alias("total"))


@query(
    "fn_unwrap",
    """select page_id, case when page_id % 4 = 0 then ''
                            else replace(html, chr(10), chr(8232)) end as payload
       from pages""",
)
def fn_unwrap(spark, sf_dir):
    end = F.when(F.col("page_id") % 4 == 0, ");").when(F.col("page_id") % 4 == 1, ")\n").otherwise(")")
    one_line = F.replace(F.col("html"), F.lit("\n"), F.lit("\u2028"))
    body = F.concat(F.lit("mtopjsonp"), F.col("page_id").cast("string"), F.lit("("), one_line, end)
    payload = F.coalesce(text.unwrap_callback(body), F.lit(""))
    return table(spark, sf_dir, "pages").select("page_id", payload.alias("payload"))


@query(
    "fn_parse_json",
    """select doc_id, case when doc_id % 6 = 0 then '' else lang end as code,
              case when doc_id % 6 = 0 then '' else cast(n_chars as varchar) end as total,
              case when doc_id % 6 = 0 then '' else text end as review,
              doc_id % 6 = 0 as broken
       from documents""",
)
def fn_parse_json(spark, sf_dir):
    whole = F.to_json(
        F.struct(
            F.array("lang").alias("ret"),
            F.struct(
                F.col("n_chars").alias("totalPage"),
                F.array(F.struct(F.col("text").alias("content"))).alias("reviews"),
            ).alias("data"),
        )
    )
    json = F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit("{"), whole)).otherwise(whole)
    docs = table(spark, sf_dir, "documents").select("doc_id", json.alias("json"))
    parsed = docs.select("doc_id", parse_envelope(F.col("json")).alias("e"))
    envelope, empty = F.col("e"), F.lit("")
    broken = envelope.isNull()

    def text_at(path):
        return F.when(broken, empty).otherwise(part(envelope, path, "string"))

    return parsed.select(
        "doc_id",
        text_at("ret[0]").alias("code"),
        text_at("data.totalPage").alias("total"),
        text_at("data.reviews[0].content").alias("review"),
        broken.alias("broken"),
    )


@query(
    "fn_json_path",
    """select event_id, coalesce(json_extract_string(props, '$.k'), '0') as k,
              'none' as missing
       from events""",
)
def fn_json_path(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.json_path(F.col("props"), "$.k", "0").alias("k"),
        text.json_path(F.col("props"), "$.data.result.k", "none").alias("missing"),
    )


@query(
    "fn_slug",
    """select p_partkey, replace(lower(p_name), ' ', '_') || '_' || replace(lower(p_brand), '#', '_')
              || '_' || lower(p_type) as slug
       from part""",
)
def fn_slug(spark, sf_dir):
    name = F.concat(F.lit("- "), "p_name", F.lit(" & "), "p_brand", F.lit(" ("), "p_type", F.lit(")!"))
    return table(spark, sf_dir, "part").select("p_partkey", text.slug(name).alias("slug"))


@query("fn_truncate", "select doc_id, substring(text, 1, 300) as short from documents")
def fn_truncate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.truncate(F.col("text")).alias("short"))


@query("fn_strip_fence", "select doc_id, text as answer from documents")
def fn_strip_fence(spark, sf_dir):
    kind = F.col("doc_id") % 3
    fenced = (
        F.when(kind == 0, F.concat(F.lit(f"\n{FENCE}json\n"), "text", F.lit(f"\n{FENCE} ")))
        .when(kind == 1, F.concat(F.lit(FENCE), "text", F.lit(FENCE)))
        .otherwise(F.col("text"))
    )
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", answers.strip_fence(fenced).alias("answer"))


@query(
    "fn_format_elapsed",
    """select o_orderkey, case when o_orderkey * 7 >= 3600
              then cast(o_orderkey * 7 // 3600 as varchar) || 'h ' else '' end
              || cast(o_orderkey * 7 % 3600 // 60 as varchar) || 'm '
              || cast(o_orderkey * 7 % 60 as varchar) || 's' as elapsed
       from orders""",
)
def fn_format_elapsed(spark, sf_dir):
    elapsed = text.format_elapsed(F.col("o_orderkey") * 7)
    return table(spark, sf_dir, "orders").select("o_orderkey", elapsed.alias("elapsed"))


@query(
    "fn_casts",
    """select c_custkey, cast(c_custkey as varchar) as id_text, c_custkey as id_number,
              cast(-1 as bigint) as not_a_number
       from customer""",
)
def fn_casts(spark, sf_dir):
    as_text = text.id_text(F.col("c_custkey"))
    padded = F.lpad(as_text, 12, "0")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        as_text.alias("id_text"),
        text.id_number(padded).alias("id_number"),
        F.coalesce(text.id_number(F.col("c_mktsegment")), F.lit(-1).cast("bigint")).alias(
            "not_a_number"
        ),
    )


@query("fn_review_key", f"select doc_id, {REVIEW_KEY_SQL} as review_key from ({REVIEWS_SQL})")
def fn_review_key(spark, sf_dir):
    key = text.review_key(F.col("category"), F.col("product_id"), F.col("review_text"))
    return reviews(spark, sf_dir).select("doc_id", key.alias("review_key"))


@query(
    "fn_kv_map",
    """select p_partkey, cast(p_size as varchar) as a, p_type || '=x' as b, 2 as n_keys
       from part""",
)
def fn_kv_map(spark, sf_dir):
    raw = F.concat(
        F.lit("a="), "p_brand", F.lit("; b = "), "p_type", F.lit("=x ; junk;a= "),
        F.col("p_size").cast("string"),
    )
    parsed = table(spark, sf_dir, "part").select("p_partkey", text.attribute_map(raw).alias("m"))
    return parsed.select(
        "p_partkey",
        F.col("m")["a"].alias("a"),
        F.col("m")["b"].alias("b"),
        F.size("m").alias("n_keys"),
    )


@query(
    "fn_prefix",
    """select c_custkey, 'Customer' as before_mark, c_mktsegment as without_mark from customer""",
)
def fn_prefix(spark, sf_dir):
    marked = F.replace(F.col("c_name"), F.lit("#"), F.lit("_"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.prefix_before(marked).alias("before_mark"),
        text.prefix_before(F.col("c_mktsegment")).alias("without_mark"),
    )


@query("fn_epoch_millis", "select event_id, epoch_us(ts) // 1000 as millis from events")
def fn_epoch_millis(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", text.epoch_millis(F.col("ts")).alias("millis")
    )


@query(
    "fn_to_json",
    """select doc_id, '{"appId":"' || source || '","params":"{\\"lang\\":\\"' || lang
              || '\\",\\"n\\":' || n_chars || '}"}' as json
       from documents""",
)
def fn_to_json(spark, sf_dir):
    inner = text.compact_json(
        lang=F.col("lang"), n=F.col("n_chars"), absent=F.lit(None).cast("string")
    )
    outer = text.compact_json(appId=F.col("source"), params=inner)
    return table(spark, sf_dir, "documents").select("doc_id", outer.alias("json"))


@query(
    "parse_labels",
    """select doc_id, cast(case when doc_id % 5 < 2 then 2 else -1 end as int) as n,
              cast(case when doc_id % 5 < 2 then quality else -1 end as int) as first,
              cast(case when doc_id % 5 < 2 then toxic else -1 end as int) as second
       from labels""",
)
def parse_labels(spark, sf_dir):
    pair = F.concat(
        F.lit("["), F.col("quality").cast("string"), F.lit(", "), F.col("toxic").cast("string")
    )
    kind = F.col("doc_id") % 5
    answer = (
        F.when(kind == 0, F.concat(pair, F.lit("]")))
        .when(kind == 1, F.concat(F.lit(f"{FENCE}json\n"), pair, F.lit(f"]\n{FENCE}")))
        .when(kind == 2, pair)
        .when(kind == 3, F.lit('{"a": 1}'))
    )
    parsed = table(spark, sf_dir, "labels").select(
        "doc_id", answers.parse_labels(answer).alias("labels")
    )
    missing = F.lit(-1)
    return parsed.select(
        "doc_id",
        F.coalesce(F.size("labels"), missing).alias("n"),
        F.coalesce(F.col("labels")[0], missing).alias("first"),
        F.coalesce(F.col("labels")[1], missing).alias("second"),
    )
