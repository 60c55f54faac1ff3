"""Pages, urls, the source mix and the pipeline."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hazardlens.llm import mixing, templates, urls
from tests.llm.cases import ROWS, docs, empty, listed, prose
from tests.llm.test_dedup import components_by_hand
from tests.llm.test_near import shingles_by_hand, similar

# --- main text -----------------------------------------------------------------


def page(number, host, article, extra=""):
    menu = "".join(f"<li><a href='/{number}{i}'>menu {number} {i}</a></li>" for i in range(3))
    return (
        f"<!DOCTYPE html><html><head><title>T {number}</title><script>var a='<p>no</p>';</script></head>"
        f"<body><header>Site head</header><nav><ul>{menu}</ul></nav><div class='ad'>Buy {number}</div>"
        f"<article><h1>Head {number}</h1>{article}{extra}</article>"
        f"<div class='comments'><p>a reader says {number}</p></div><form>Search <input></form>"
        f"<footer>&copy; {host}</footer></body></html>"
    )


def pages_table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_main_text_of_pages_of_a_host(spark):
    rows = []
    for i in range(12):
        body = f"<p>{prose(i, 40)}<p>second&nbsp;&amp; <b>bo</b>ld {i}<br>line {i}"
        rows.append((i, f"http://big.example.com/{i}", page(i, "big", body, "<p>Share this article</p>")))
    rows += [(20, "https://one.example.org/x", page(20, "one", "<p>alone   on\n its host</p>"))]
    rows += [(21, "https://one.example.org/x", page(20, "one", "<p>alone   on\n its host</p>"))]
    rows += [(22, None, None), (23, "no scheme", ""), (None, "http://a/", "<p>bare text</p>"), (24, "http://a/", "<div" * 5000)]
    found = templates.extract(pages_table(spark, rows).withColumn("TEXT", F.lit("clash")).withColumn("region", F.lit(1)))
    text = {r.page_id: (r.text, r.n_chars) for r in found.collect()}
    for i in range(12):
        # the line that all pages share is template, the rest of the slot is not
        want = f"Head {i} {prose(i, 40)} second & bold {i} line {i}"
        assert text[i] == (want, len(want))
    assert text[20] == text[21] == ("Head 20 alone on its host", 25)
    assert text[22] == text[23] == ("", 0)
    assert text[None][0] == "bare text"
    none = pages_table(spark, [])
    assert templates.extract(none).count() == 0


def test_copies_of_a_page_are_no_template(spark):
    rows = [(i, "http://copies.example.com/", page(1, "c", f"<p>{prose(2, 50)}</p>")) for i in range(30)]
    rows += [(100 + i, f"http://h{i}.example.com/", page(i, "h", f"<p>{prose(i, 50)}</p>")) for i in range(10)]
    text = {r.page_id: r.text for r in templates.extract(pages_table(spark, rows)).collect()}
    assert all(text[i] == f"Head 1 {prose(2, 50)}" for i in range(30))
    assert text[103] == f"Head 3 {prose(3, 50)}"


def registered_by_hand(host):
    labels = host.split(".")
    return ".".join(labels[-3:] if len(labels) > 2 and labels[-2] in urls.SECOND_LEVEL and len(labels[-1]) == 2 else labels[-2:])


def templates_by_hand(pages):
    """Regions and template texts of hosts, domains and all pages, token by token."""
    once = {}
    for host, html in pages:
        read = templates._tokens(html)
        once[host, read["page"]] = read
    levels = {}
    for (host, _), read in once.items():
        for key in (f"h:{host}", f"d:{registered_by_hand(host)}", templates.GENERAL):
            levels.setdefault(key, []).append((host, read))
    regions = {}
    for key, own in levels.items():
        if len(own) < templates.SLOT_PAGES:
            continue
        seen = {}
        for host, read in own:
            for e in read["elements"]:
                seen.setdefault(e["id"], []).append((host, read["page"], e))
        frequent = {i: es for i, es in seen.items() if len(es) >= templates.ELEMENTS_ON * len(own)}
        classes = {}
        for i, es in frequent.items():
            classes.setdefault(tuple(sorted((p, e["n"]) for _, p, e in es)), []).append(i)
        slots, most = [], 0
        for ids in classes.values():
            if len(ids) < templates.CLASS_SIZE:
                continue
            most = max([most, *(sum(e["chars"] for *_, e in frequent[i]) for i in ids)])
            single = [i for i in ids if all(e["n"] == 1 for *_, e in frequent[i])]
            orders = set()
            for host, read in own:
                place = {e["id"]: e["place"] for e in read["elements"]}
                if single and single[0] in place:
                    orders.add(tuple(sorted(single, key=place.get)))
            slots += [i for i in single if len(orders) == 1]
        good = [
            (-frequent[i][0][2]["depth"], i) for i in slots
            if any(e["box"] for *_, e in frequent[i]) and sum(e["chars"] for *_, e in frequent[i]) >= templates.MAIN_SHARE * most
        ]
        if good:
            regions[key] = min(good)[1]
    on = {key: Counter(t for _, read in own for t in set(read["texts"])) for key, own in levels.items()}
    fixed = {}
    for (host, _), read in once.items():
        for t in read["texts"]:
            share, keys = 0.0, (templates.GENERAL, f"d:{registered_by_hand(host)}", f"h:{host}")
            for key, inner in zip(keys, (*keys[1:], None)):
                others = on[key][t] - (on[inner][t] if inner else 0)
                pages_there = len(levels[key]) - (len(levels[inner]) if inner else 0)
                share = (others + templates.PRIOR_PAGES * share) / (pages_there + templates.PRIOR_PAGES)
            if share >= templates.TEXTS_ON - 1e-9:
                fixed.setdefault(f"h:{host}", set()).add(t)
    return regions, fixed


def strange_pages(seed):
    rng, out = random.Random(seed), []
    for n in range(90):
        host = rng.choice(["big.a.com", "big.a.com", "two.a.com", "x.b.co.uk", "y.b.co.uk", f"one{n}.c.org"])
        parts = ["<nav>menu</nav>", "<div class='promo'>buy</div>", "<p>Shared line</p>", f"<div id=more><p>{prose(n, 5)}</p></div>"]
        rng.shuffle(parts)
        parts = parts[: rng.randrange(len(parts) + 1)]
        box = rng.choice(["article", "div class=post", "main"])
        parts.insert(rng.randrange(len(parts) + 1), f"<{box}><h1>T{n % 40}</h1><p>{prose(n % 40, 30)}</p><p>Read more</p></{box.split()[0]}>")
        out.append((host, f"<html><body><div id=page>{''.join(parts)}<p>Terms apply</p></div></body></html>"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_against_every_token(spark, seed):
    pages = strange_pages(seed)
    table = spark.createDataFrame(pages, "host string, html string").repartition(3)
    found = {r.key: (r.region, set(r.texts)) for r in templates.templates(table).collect()}
    regions, fixed = templates_by_hand(pages)
    assert {k: r for k, (r, _) in found.items() if r is not None} == regions and regions
    assert {k: t for k, (_, t) in found.items() if t} == fixed and fixed


def test_names_never_mark_what_holds_the_article(spark):
    opened = {
        "<body class='single no-sidebar'>": "</body>", "<body><article class='post comment-status-open'>": "</article>",
        "<body><main id='share-story'>": "</main>", "<body><div class='widget Blog'><article>": "</article></div>",
        "<body class=widget><div class='sidebar'>": "</div>",
    }
    aside = "<div class='ad'>Buy now</div><div class='comments'><article class='comment'>a reader's word</article></div>"
    rows = [(i, f"http://h{i}.example.com/", f"<html>{a}<p>{prose(i, 30)}</p>{b}{aside}") for i, (a, b) in enumerate(opened.items())]
    rows += [(10 * i + j, f"http://g{i}.example.org/{j}", rows[i][2].replace(prose(i, 30), prose(j, 30))) for i in range(4) for j in range(10, 16)]
    text = {r.page_id: r.text for r in templates.extract(pages_table(spark, rows)).collect()}
    for i, _, html in rows:
        want = re.search(r"<p>(.*?)</p>", html)[1]
        assert text[i] == want or (i == 4 and text[i] == f"{want} Buy now")


@pytest.mark.parametrize("count", [1, 2, 3, 4])
def test_small_hosts_learn_from_their_domain(spark, count):
    def of(host, n, line):
        body = f"<div class=post><p>{prose(n, 30)}</p><p>{line}</p></div>"
        return f"http://{host}/{n}", f"<html><body><div id=top>{body}</div></body></html>"

    rows = [of("small.shop.com", n, "Rate this story") for n in range(count)]
    rows += [of(f"h{n % 5}.shop.com", 100 + n, "Rate this story") for n in range(20)]
    rows += [of("alone.org", 200 + n, "All rights") for n in range(count)]
    rows += [of(f"o{n}.net", 300 + n, f"end {n}") for n in range(15)]
    table = pages_table(spark, [(i, *r) for i, r in enumerate(rows)])
    text = [r.text for r in templates.extract(table).orderBy("page_id").collect()]
    assert text[:count] == [prose(n, 30) for n in range(count)]
    alone = [prose(200 + n, 30) + ("" if count >= 4 else " All rights") for n in range(count)]
    assert text[count + 20 : 2 * count + 20] == alone


def test_long_pages(spark):
    body = "".join(f"<p>{prose(i, 12)} {i}</p>" for i in range(8_000))
    rows = [(i, "http://long.example.com/", page(i, "h", body)) for i in range(2)]
    found = templates.extract(pages_table(spark, rows)).collect()
    assert all(r.n_chars == len(r.text) > 500_000 and r.text.endswith(" 7999") for r in found)


# --- urls ----------------------------------------------------------------------

URLS = {
    "https://WWW.Example.com/en/a?x#y": ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
    "https://blog.example.com/en/1": ("blog.example.com", "/en/1", "example.com/en/", "block"),
    "http://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://other.com/x": ("other.com", "/x", "com/", "allow"),
    "http://other.com": ("other.com", "", None, "allow"),
    "http://x.net/fr/?a": ("x.net", "/fr/", "net/fr/", "block"),
    "http://x.net/de/": ("x.net", "/de/", None, "allow"),
    "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "a://b?c/d": ("b", "", None, "allow"),
    "x#://y/z": ("y", "/z", None, "allow"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_rules_and_parts(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://x.net/fr/"), (3, "http://other.com/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("clash"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = urls.judge(pages, labels).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert by_id[None] == URLS["http://x.net/fr/?a"]
    assert [by_id[i] for i in range(len(URLS))] == list(URLS.values())
    assert urls.judge(pages.limit(0), labels).count() == 0


def test_registered_domains(spark):
    hosts = {
        "shop.example.co.za": ("example.co.za", "co.za"), "a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"),
        "www.example.com:8080": ("example.com", "com"), "user@example.com": ("example.com", "com"), "10.0.0.1": ("10.0.0.1", "address"),
        "192.168.0.1:80": ("192.168.0.1", "address"), "[2001:db8::1]": ("[2001:db8::1]", "address"), "co.uk": ("co.uk", "co.uk"),
        "localhost": ("localhost", "localhost"), "": ("", ""), "me.github.io": ("me.github.io", "github.io"),
    }
    table = spark.createDataFrame([(h,) for h in hosts], "host string")
    own = table.select("host", *[f(F.col("host"), ["github.io"]).alias(n) for f, n in ((urls.registered, "d"), (urls.suffix_of, "s"))])
    assert {r.host: (r.d, r.s) for r in own.collect()} == hosts


def test_bounds_stay_between_zero_and_the_rate(spark):
    lines = [(f"h{i}.com", i % 7 == 0) for i in range(70) for _ in range(1 + i % 4)] + [("all.com", True)] * 400
    found = urls.reputation(spark.createDataFrame(lines, "host string, bad boolean")).collect()
    assert all(0 < r.bad_bound < r.bad_rate < 1 for r in found)
    assert max(found, key=lambda r: r.bad_bound).host == "all.com"


def test_hosts_with_a_bad_record_are_blocked(spark):
    pages, labels = [], []
    for i in range(300):
        host = "bad" if i % 3 == 0 else f"good{i % 20}"
        pages.append((i, f"http://{host}.example.org/{i}"))
        labels.append((i, 0 if i % 3 == 0 else 1, 0))
    pages += [(1000, "http://new.example.org/"), (1001, "http://bad.example.org/late")]
    labels += [(None, 1, 1), (5, None, None), (7, None, 0), (9999, 0, 0)]
    table = spark.createDataFrame(pages, "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert got[0].verdict == got[1001].verdict == "block"
    assert got[1].verdict == got[1000].verdict == "allow"
    assert got[1].bad_rate < got[1000].bad_rate < got[0].bad_rate


# --- source mix ----------------------------------------------------------------


def targets_by_hand(raw, dim, targets, wanted):
    """Targets of a margin in tokens, none above what its value has."""
    weight = {v: n ** targets.powers[dim] * targets.factors.get(dim, {}).get(v, 1) for v, n in raw.items()}
    full = set()
    while True:
        left = wanted - sum(raw[v] for v in full)
        rest = sum(w for v, w in weight.items() if v not in full)
        more = {v for v in weight if v not in full and weight[v] * left / rest >= raw[v]}
        if not more:
            return {v: raw[v] if v in full else weight[v] * left / rest for v in weight}
        full |= more


def test_what_is_drawn_fits_the_targets(spark):
    rng, budget = random.Random(4), 0.4
    rows = []
    for i in range(900):
        source = "big" if i % 3 else f"s{i % 5}"
        rows.append((i, prose(i, 20 + i % 7) + (" this is stupid" if i % 11 == 0 else ""), rng.choice(["en", "en", "de", None]), source, 0))
    targets = mixing.Targets(budget=budget)
    own = mixing.described(docs(spark, rows))
    found = mixing.rates(own, targets).collect()
    tokens = {}
    for r in own.collect():
        tokens[(r._source, r._lang, r._topic)] = tokens.get((r._source, r._lang, r._topic), 0) + r._n
    assert set(tokens) == {(r.source, r.lang, r.topic) for r in found}
    wanted = budget * sum(tokens.values())
    for k, dim in enumerate(mixing.DIMS):
        raw = {}
        for cell, n in tokens.items():
            raw[cell[k]] = raw.get(cell[k], 0) + n
        for value, tokens_wanted in targets_by_hand(raw, dim, targets, wanted).items():
            got = sum(r.p * tokens[(r.source, r.lang, r.topic)] for r in found if r[dim] == value)
            assert got == pytest.approx(tokens_wanted, rel=0.01)
    assert sum(r.p * tokens[(r.source, r.lang, r.topic)] for r in found) == pytest.approx(wanted, rel=1e-6)
    assert all(0 < r.p <= 1 for r in found)
    kept = mixing.keep_sampled(docs(spark, rows), targets)
    drawn = kept.select(F.sum(mixing.n_tokens(F.col("text")))).first()[0]
    assert abs(drawn / sum(tokens.values()) - budget) < 0.1


def test_mix_of_odd_rows(spark):
    df = docs(spark).withColumn("P", F.lit(1)).withColumn("topic", F.lit("mine"))
    kept = mixing.keep_sampled(df)
    assert kept.columns == df.columns
    report = {(r.source, r.lang, r.topic): r.p for r in mixing.report(docs(spark)).collect()}
    assert mixing.report(docs(spark)).count() == len(ROWS)
    assert report[("a", "unknown", "general")] == 0
    assert 0 < kept.count() < len(ROWS)
    assert mixing.report(empty(spark)).count() == 0


# --- pipeline ------------------------------------------------------------------


def test_pipeline_against_hand_made_stages(spark, tmp_path):
    rows = [r for r in ROWS if len(r[1] or "") < 25_000]
    rows += [(1000 + i, prose(i, 80), "en", f"s{i % 4}", 0) for i in range(60)]
    table = docs(spark, rows).withColumn("score", F.lit(7)).withColumn("row", F.lit("x"))
    kept = {name: None for name, _ in corpus_pipeline.STAGES}
    now = table
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, now, "").write.parquet(path)
        now = spark.read.parquet(path)
        kept[name] = now
        if name != "bpe":
            assert now.columns == table.columns
            assert {(r.score, r.row) for r in now.select("score", "row").distinct().collect()} == {(7, "x")}
    text_of = lambda name: [r.text for r in kept[name].select("text").collect()]
    lettered = [r[1] for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]
    assert sorted(text_of("language")) == sorted(lettered)
    assert len(text_of("exact_dedup")) == len({re.sub("[ \t-\r]", "", t) for t in lettered})
    sets = {shingles_by_hand(t) for t in text_of("exact_dedup")}
    assert len(text_of("near_dedup")) == len(set(components_by_hand(sets, similar).values()))
    assert set(text_of("source_mix")) <= set(text_of("near_dedup"))
    assert all(r.round_trip for r in kept["bpe"].collect())
    assert kept["bpe"].count() == kept["source_mix"].count()


def test_pipeline_of_nothing(spark):
    now = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, "")
    assert listed(now) == []
