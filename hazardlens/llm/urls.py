"""URL filter: allow and block rules first, the reputation of the host for the rest.

Labelled pages of a host are good or bad. The rate of bad ones is shrunk by beta-binomial
priors from the corpus to the suffix, from there to the registered domain and to the host;
how strongly a level is shrunk is estimated from how much its members differ. A host is
blocked if the lower posterior bound of its bad rate is above a limit.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.session import materialize


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]
#: Names are registered under the last label, or under two labels if a country has one of these.
SECOND_LEVEL = "ac co com edu go gob gouv gov ltd mil ne net nom or org plc sch".split()
LIMIT = 0.3
#: One-sided 95 % bound of a normal distribution of the logarithm of the odds.
Z = 1.645


def host_of(url: Column) -> Column:
    """What follows the first ``://``, A-Z lower-cased; empty without one or for null."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_for(host: Column, path: Column, rules: Sequence[Rule], what: str) -> Column:
    """``rule`` (host and path) or ``verdict`` of the longest rule that fits, else null."""
    longest = sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path))
    out = F.lit(None).cast("string")
    for rule in reversed(longest):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        value = rule.host + rule.path if what == "rule" else rule.verdict
        out = F.when(fits & F.startswith(path, F.lit(rule.path)), value).otherwise(out)
    return out


_ADDRESS = r"^([0-9]+(\.[0-9]+){3}|\[.*\])$"
_TWO_LABELS = rf"^([^.]+\.)*({'|'.join(SECOND_LEVEL)})\.[a-z]{{2}}$"


def name_of(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def _labels(host: Column, own: int, suffixes: Sequence[str]) -> Column:
    """The suffix of the host's name and ``own`` labels more; an address is as it is."""
    name = name_of(host)
    two = F.rlike(name, F.lit(_TWO_LABELS))
    out = F.when(two, F.substring_index(name, ".", -2 - own)).otherwise(F.substring_index(name, ".", -1 - own))
    for suffix in sorted(suffixes, key=lambda s: s.count(".")):
        listed = (name == suffix) | F.endswith(name, F.lit(f".{suffix}"))
        out = F.when(listed, F.substring_index(name, ".", -1 - suffix.count(".") - own)).otherwise(out)
    return F.when(F.rlike(name, F.lit(_ADDRESS)), name if own else F.lit("address")).otherwise(out)


def suffix_of(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """What names are registered under: by the rule of ``SECOND_LEVEL`` and a list of further ones."""
    return _labels(host, 0, suffixes)


def registered(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """The registered domain of a host; an address is its own."""
    return _labels(host, 1, suffixes)


def _strength(members: DataFrame) -> tuple[float, float]:
    """Overall bad rate of a level and the weight, in pages, of the prior of its members.

    The weight follows from the variance between members beyond that of binomial draws.
    """
    n, k, count, n2, between = members.where("n > 0").agg(
        F.sum("n"),
        F.sum("k"),
        F.count("*"),
        F.sum(F.col("n").cast("double") * F.col("n")),
        F.sum(F.col("k").cast("double") * F.col("k") / F.col("n")),
    ).first()
    if not n:
        return 0.0, 1.0
    rate = k / n
    alike = 1.0
    if count > 1 and 0 < rate < 1:
        size = (n - n2 / n) / (count - 1)
        spread = (between - k * k / n) / (count - 1)
        if size > 1:
            alike = (spread / (rate * (1 - rate)) - 1) / (size - 1)
    alike = min(max(alike, 0.001), 0.5)
    return rate, 1 / alike - 1


def _posterior(n: Column, k: Column, mean: Column, weight: float) -> Column:
    return (mean * weight + k) / (n + weight)


def reputation(
    outcomes: DataFrame, limit: float = LIMIT, z: float = Z, suffixes: Sequence[str] = ()
) -> DataFrame:
    """One row per ``host`` of ``outcomes`` (host, bad): ``bad_rate``, ``bad_bound``, ``verdict``.

    User and port belong to the host, but not to its domain and suffix.

    ``bad`` is a boolean, null for pages without a label; these only make their host known.
    A null host counts as empty. Without any label every rate is zero and all are allowed.
    """
    own = outcomes.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(
        F.count("bad").alias("n"), F.count_if(F.col("bad")).alias("k")
    )
    hosts = own.select("*", registered(F.col("host"), suffixes).alias("domain"))
    hosts = materialize(hosts.select("*", suffix_of(F.col("host"), suffixes).alias("suffix")), "hosts")
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums)
    overall, suffix_weight = _strength(suffixes)
    domain_weight, host_weight = _strength(domains)[1], _strength(hosts)[1]
    n, k = F.col("n"), F.col("k")
    top = suffixes.select(
        "suffix", _posterior(n, k, F.lit(overall), suffix_weight).alias("suffix_rate")
    )
    middle = domains.join(top, "suffix").select(
        "domain", "suffix", _posterior(n, k, F.col("suffix_rate"), domain_weight).alias("domain_rate")
    )
    rate = _posterior(n, k, F.col("domain_rate"), host_weight)
    # The posterior is a beta distribution of a bad and b good pages; the logarithm of its odds is
    # close to normal with variance 1 / a + 1 / b. Half a good page more keeps the bound low where b
    # is next to none, and above zero and below the rate everywhere.
    weight = n + host_weight
    a, b = rate * weight, (1 - rate) * weight + 0.5
    odds = a / b * F.exp(-z * F.sqrt(1 / a + 1 / b))
    bound = F.when(rate > 0, odds / (1 + odds)).otherwise(0.0)
    rated = hosts.join(middle, ["domain", "suffix"]).select("host", rate.alias("bad_rate"), bound.alias("bad_bound"))
    verdict = F.when(F.col("bad_bound") > limit, "block").otherwise("allow")
    return rated.withColumn("verdict", verdict)


def judge(
    pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, limit: float = LIMIT
) -> DataFrame:
    """Verdict on the url of every row of ``pages`` (page_id, url).

    ``labels`` (doc_id, quality, toxic) holds outcomes of pages by id: bad if toxic is 1 or
    quality 0; a page with several labels is bad if any says so; labels without a known
    value or page are left out. Rows stay as they are, repeated ones and those with a null
    id too. An empty table gives no rows. Further columns are not read.
    """
    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.fillna("", ["host", "path"])
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    known = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    outcomes = parsed.select("page_id", "host").join(known, "page_id", "left")
    rated = reputation(outcomes, limit)
    path, host = F.col("path"), F.col("host")
    return parsed.join(rated.withColumnRenamed("verdict", "_own"), "host").select(
        "page_id",
        "host",
        "path",
        rule_for(host, path, rules, "rule").alias("rule"),
        F.coalesce(rule_for(host, path, rules, "verdict"), "_own").alias("verdict"),
        F.round("bad_rate", 6).alias("bad_rate"),
        F.round("bad_bound", 6).alias("bad_bound"),
    )


def _rule_sql(rules: Sequence[Rule], what: str) -> str:
    longest = sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path))
    cases = " ".join(
        f"when (host = '{r.host}' or host like '%.{r.host}') and path like '{r.path}%' "
        f"then '{r.host + r.path if what == 'rule' else r.verdict}'"
        for r in longest
    )
    return f"case {cases} end"


def _level_sql(members: str) -> str:
    return f"""select p, 1 / greatest(0.001, least(0.5, coalesce(case when g > 1 and p > 0 and p < 1
        and (nn - n2 / nn) / (g - 1) > 1
      then ((b - kk * kk / nn) / (g - 1) / (p * (1 - p)) - 1) / ((nn - n2 / nn) / (g - 1) - 1)
      end, 1))) - 1 as w
    from (select sum(n)::double nn, sum(k)::double kk, count(*) g, sum(n::double * n) n2,
                 sum(k::double * k / n) b, sum(k)::double / sum(n) p
          from {members} where n > 0)"""


SQL = f"""
with parsed as (
  select page_id,
    lower(regexp_extract(case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end,
          '^[^/?#]*')) as host,
    regexp_extract(case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end,
          '^[^/?#]*([^?#]*)', 1) as path
  from pages),
known as (select doc_id, bool_or(toxic = 1 or quality = 0) as bad from labels group by 1),
own as (select host, count(bad) as n, coalesce(sum(bad::int), 0) as k
        from parsed left join known on page_id = doc_id group by 1),
names as (select *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as name from own),
hosts as (
  select *, string_split(name, '.') as l, regexp_matches(name, '{_TWO_LABELS}') as two,
    regexp_matches(name, '{_ADDRESS}') as address
  from names),
placed as (
  select host, n, k,
    case when address then name else array_to_string(case when two then l[-3:] else l[-2:] end, '.') end as domain,
    case when address then 'address' else array_to_string(case when two then l[-2:] else l[-1:] end, '.') end as suffix
  from hosts),
domains as (select domain, suffix, sum(n) n, sum(k) k from placed group by all),
suffixes as (select suffix, sum(n) n, sum(k) k from placed group by all),
ws as ({_level_sql("suffixes")}), wd as ({_level_sql("domains")}), wh as ({_level_sql("placed")}),
top as (select suffix, (coalesce(p, 0) * w + k) / (n + w) as r from suffixes, ws),
middle as (select domain, suffix, (r * w + k) / (n + w) as r from domains join top using (suffix), wd),
rated as (select host, (r * w + k) / (n + w) as r, n + w as weight
          from placed join middle using (domain, suffix), wh),
odds as (select host, r, r * weight as x, (1 - r) * weight + 0.5 as y from rated),
bounds as (select host, r, case when r > 0
    then x / y * exp(-{Z} * sqrt(1 / x + 1 / y)) / (1 + x / y * exp(-{Z} * sqrt(1 / x + 1 / y))) else 0.0 end as b from odds)
select page_id, host, path, {_rule_sql(RULES, "rule")} as rule,
  coalesce({_rule_sql(RULES, "verdict")}, case when b > {LIMIT} then 'block' else 'allow' end) as verdict,
  round(r, 6) as bad_rate, round(b, 6) as bad_bound
from parsed join bounds using (host)"""
