"""Main text of web pages by equivalence classes of template tokens.

The tokens of a page are its elements, told apart by their path, and its text blocks with
their path. Tokens that occur equally often on every page of a host have equal occurrence
vectors and form a class; a class is valid if its tokens come in one order on all pages (that they
nest follows from their paths). Valid classes that are on most pages make up the host's
template. The slot that holds most of the running text is the article; it is extracted
without template text and without elements that are marked as something else.

What a host has too few pages to tell is taken from its registered domain and from all pages:
the share of pages that a text is on is shrunk from all pages to the domain and to the host.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from hazardlens.llm.common import add_columns, without
from hazardlens.llm.urls import host_of, registered
from hazardlens.session import materialize

#: Share of a host's pages that elements and text blocks of its template are on.
ELEMENTS_ON, TEXTS_ON = 0.5, 0.8
#: How many pages the share among the other pages of the level above counts as.
PRIOR_PAGES = 1
#: Different pages that a host or domain needs to have a slot of its own.
SLOT_PAGES = 2
#: Tokens of a class at least, and share of the running text that the main slot holds.
CLASS_SIZE, MAIN_SHARE = 2, 0.5

# Elements without content, those that end a paragraph, boxes that can hold an
# article, and elements and names that say what is not one.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul br".split()
)
BOXES = set("article body div main section td".split())
NOT_TEXT = set(
    "head title script style noscript template iframe object svg canvas nav header footer aside "
    "form button select textarea menu dialog".split()
)
MARKS = set(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments "
    "cookie cookies disqus footer header menu modal nav navbar navigation newsletter notice notices "
    "popup promo related reply replies share sharing sidebar social sponsor sponsored subscribe widget".split()
)
#: Elements that names never mark, and names that no article inside takes back.
MAIN = {"html", "body", "main", "article"}
READERS = {"comment", "comments", "reply", "replies", "disqus"}
CLOSES = {"li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"},
          "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}


def _id(*parts) -> int:
    digest = xxhash.xxh64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return digest - (1 << 64 if digest >> 63 else 0)


class _Open:
    """An open element. ``names`` are the elements around it, itself included, that a name marks."""

    __slots__ = ("tag", "id", "marked", "linked", "inside", "chars", "names", "kind", "taken_back")

    def __init__(self, tag, id, marked, linked, inside, names=(), kind=frozenset()):
        self.tag, self.id, self.marked, self.linked = tag, id, marked, linked
        self.inside, self.chars, self.kind, self.taken_back = inside, 0, kind, False
        self.names = (*names, self) if kind else names

    def named(self, around=()) -> bool:
        """Whether a name marks it, apart from those of elements ``around`` the main slot."""
        return any(not n.taken_back and n not in around for n in self.names)


class Page(HTMLParser):
    """Tokens and text blocks of a page; ``regions`` are element ids to look out for.

    ``elements`` has for each id how often it occurs, the characters of running text inside, its
    depth, whether it can be a slot, and its place among the first occurrences.
    """

    def __init__(self, html: str, regions: tuple[int | None, ...] = ()) -> None:
        super().__init__(convert_charrefs=True)
        self.regions = regions
        self.open = [_Open("", 0, False, False, (False,) * len(regions))]
        self.elements: dict[int, list] = {}
        self.blocks: list[tuple[int, str, tuple[bool, ...], _Open]] = []
        self.found: list[tuple | None] = [None] * len(regions)
        self.buffer: list[str] = []
        self.feed(html)
        self.close()
        self._flush()
        while len(self.open) > 1:
            self._pop()

    def _flush(self) -> None:
        if self.buffer:
            top, text = self.open[-1], " ".join("".join(self.buffer).split())
            self.buffer = []
            if text:
                self.blocks.append((top.id, text, top.inside, top))
                if not top.linked and not top.named():
                    top.chars += len(text)

    def _pop(self) -> None:
        if self.open[-1].tag in BLOCKS:
            self._flush()
        top = self.open.pop()
        self.elements[top.id][1] += top.chars
        self.open[-1].chars += top.chars

    def _pop_to(self, tags: set[str], stop: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i].tag in stop:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._flush()
            if tag != "br":
                self._pop_to({"p"}, BOXES | {"li", "td", "th", "table", "blockquote"})
        if tag in CLOSES:
            self._pop_to(CLOSES[tag], {"ul", "ol", "table", "dl", "select"})
        if tag in VOID:
            return
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower()
        words = [w for w in re.split(r"[^a-z]+", names) if w]
        up = self.open[-1]
        own = _id(up.id, tag, *words)
        # Whole names only: "no-sidebar" and "comment-status-open" mark nothing.
        kind = frozenset() if tag in MAIN else frozenset(names.split()) & MARKS
        marked = up.marked or tag in NOT_TEXT
        inside = up.inside
        here = _Open(tag, own, marked, up.linked or tag == "a", inside, up.names, kind)
        if tag in ("main", "article") and not marked:
            for element in up.names:
                # What holds the article is no advert or notice, whatever its name.
                element.taken_back |= element.kind.isdisjoint(READERS)
        for i, region in enumerate(self.regions):
            if own == region:
                here.inside = (*here.inside[:i], True, *here.inside[i + 1 :])
                self.found[i] = here.names
        slot = tag in BOXES and not marked and not here.named()
        self.open.append(here)
        seen = self.elements.setdefault(own, [0, 0, len(self.open) - 1, slot, len(self.elements)])
        seen[0] += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        self._pop_to({tag}, set() if tag in BLOCKS else BOXES | {"p", "li", "td", "th"})

    def handle_data(self, data: str) -> None:
        if not self.open[-1].marked:
            self.buffer.append(data)


_TOKENS = StructType(
    [
        StructField("page", LongType()),
        StructField(
            "elements",
            ArrayType(
                StructType(
                    [
                        StructField("id", LongType()),
                        StructField("n", IntegerType()),
                        StructField("chars", LongType()),
                        StructField("depth", IntegerType()),
                        StructField("box", BooleanType()),
                        StructField("place", IntegerType()),
                    ]
                )
            ),
        ),
        StructField("texts", ArrayType(LongType())),
    ]
)


def _tokens(html: str | None) -> dict:
    page = Page(html or "")
    texts = [_id(i, text) for i, text, _, at in page.blocks if not at.named()]
    elements = [
        {"id": i, "n": n, "chars": chars, "depth": depth, "box": box, "place": place}
        for i, (n, chars, depth, box, place) in page.elements.items()
    ]
    return {"page": _id(*texts), "elements": elements, "texts": texts}


#: Key of the template of all pages; hosts and domains have keys of their own.
GENERAL = "*"


def _key(kind: str, name: str) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.col(name))


def templates(pages: DataFrame) -> DataFrame:
    """``key`` of a host, a domain or all pages, ``region`` (id of the main slot's element, null if
    none) and, for hosts, ``texts`` (ids of template text blocks).

    Pages of a host with the same texts count once, so copies are no template.
    """
    read = add_columns(pages.select("host", "html"), ["html"], [StructField("t", _TOKENS)], lambda: lambda h: (_tokens(h),))
    once = read.select("host", "t.*").dropDuplicates(["host", "page"])
    once = materialize(once.withColumn("domain", registered(F.col("host"))), "tokens")
    elements = once.select("host", "domain", "page", F.inline("elements"))
    vector = F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("vector")
    by_host = elements.groupBy("host", "domain", "id").agg(
        F.count("*").alias("on"), vector, F.max("n").alias("most"), F.sum("chars").alias("chars"),
        F.max("depth").alias("depth"), F.max("box").alias("box"),
    )
    by_host = materialize(by_host, "elements")
    host, domain, every = _key("h", "host"), _key("d", "domain"), F.lit(GENERAL)
    pages_of = materialize(once.groupBy("host", "domain").agg(F.count("*").alias("pages")), "pages")
    slots = [
        _slots(by_host.select(key.alias("key"), "*"), elements.select(key.alias("key"), "*"), pages_of.select(key.alias("key"), "pages"))
        for key in (host, domain, every)
    ]
    regions = slots[0].unionByName(slots[1]).unionByName(slots[2])
    fixed = _fixed(once, pages_of)
    none = F.array().cast("array<bigint>")
    return regions.join(fixed, "key", "full").select("key", "region", F.coalesce("texts", none).alias("texts"))


def _slots(by_host: DataFrame, elements: DataFrame, pages_of: DataFrame) -> DataFrame:
    """``key`` and ``region``: classes of tokens, those in one order, and the main slot among them.

    A slot's element is on each page once at most, and so are those it is nested in; of those that
    hold enough text the deepest is taken.
    """
    counted = pages_of.groupBy("key").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= SLOT_PAGES)
    tokens = by_host.groupBy("key", "id").agg(
        F.sum("on").alias("on"), F.sum("vector").alias("vector"), F.max("most").alias("most"),
        F.sum("chars").alias("chars"), F.max("depth").alias("depth"), F.max("box").alias("box"),
    )
    frequent = tokens.join(counted, "key").where(F.col("on") >= ELEMENTS_ON * F.col("pages"))
    sizes = frequent.groupBy("key", "vector").agg(F.count("*").alias("size")).where(F.col("size") >= CLASS_SIZE)
    large = materialize(frequent.join(sizes, ["key", "vector"]).drop("pages", "on", "size"), "classes")
    # The order of each class's tokens on each page: one hash per page, and whether all are alike.
    single = large.where("most = 1").select("key", "id", "vector")
    placed = elements.select("key", "page", "host", "id", "place").join(single, ["key", "id"])
    line = placed.groupBy("key", "vector", "host", "page").agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("line"))
    order = F.xxhash64(F.transform("line", lambda t: t["id"]))
    valid = line.groupBy("key", "vector").agg(F.min(order).alias("a"), F.max(order).alias("b")).where("a = b")
    whole = large.groupBy("key").agg(F.max("chars").alias("all_chars"))
    main = large.where("most = 1 and box").join(valid.select("key", "vector"), ["key", "vector"]).join(whole, "key")
    main = main.where(F.col("chars") >= F.col("all_chars") * MAIN_SHARE)
    return main.groupBy("key").agg(F.min(F.struct(-F.col("depth"), "id")).alias("slot")).select("key", F.col("slot.id").alias("region"))


def _fixed(once: DataFrame, pages_of: DataFrame) -> DataFrame:
    """``key`` of hosts and ``texts``, the ids of their template text.

    The share of pages that a text is on counts like ``PRIOR_PAGES`` pages one level below, where it
    is that of the other hosts of the domain, and for these that of other domains. Texts of one
    page alone cannot reach the limit and are left out first.
    """
    texts = once.select("host", "domain", "page", F.explode(F.array_distinct("texts")).alias("id"))
    texts = materialize(texts.groupBy("host", "domain", "id").agg(F.count("*").alias("on")), "texts")
    often = texts.groupBy("id").agg(F.sum("on").alias("on_all")).where("on_all > 1")
    total = pages_of.agg(F.sum("pages")).first()[0] or 0
    own = materialize(texts.join(often, "id"), "shared")
    by_domain = pages_of.groupBy("domain").agg(F.sum("pages").alias("domain_pages"))
    domains = own.groupBy("domain", "id").agg(F.sum("on").alias("on_domain")).join(by_domain, "domain")
    hosts = own.join(domains, ["domain", "id"]).join(pages_of.select("host", "pages"), "host")
    general = (F.col("on_all") - F.col("on_domain")) / (total - F.col("domain_pages") + PRIOR_PAGES)
    domain = (F.col("on_domain") - F.col("on") + PRIOR_PAGES * general) / (F.col("domain_pages") - F.col("pages") + PRIOR_PAGES)
    found = hosts.where((F.col("on") + PRIOR_PAGES * domain) / (F.col("pages") + PRIOR_PAGES) >= TEXTS_ON - 1e-9)
    return found.groupBy(_key("h", "host").alias("key")).agg(F.collect_list("id").alias("texts"))


def main_text(html: str | None, regions: tuple[int | None, ...], texts: list | None) -> str:
    """Blocks of the first of the ``regions`` that the page has, else of the page, joined by a space.

    Template ``texts`` and what names mark are left out, but no name around the region marks what
    is in it. A page that has text in marked elements only keeps it, reader comments aside.
    """
    page = Page(html or "", regions)
    use = next((i for i, names in enumerate(page.found) if names is not None), None)
    around = () if use is None else page.found[use]
    known = set(texts or ())
    own = [b for b in page.blocks if use is None or b[2][use]]
    kept = [text for i, text, _, at in own if not at.named(around) and not (known and _id(i, text) in known)]
    if not kept and use is None:
        kept = [text for i, text, _, at in own if all(n.kind.isdisjoint(READERS) for n in at.names) and not _id(i, text) in known]
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``text`` and ``n_chars``, its code points.

    Null pages count as empty and give an empty text. White space inside a block becomes one
    space; character references are decoded. Rows stay as they are, repeated ones and those
    without an id too; input columns named like the results are replaced. Pages without a host
    are taken together as one host. An empty table gives no rows.
    """
    own = without(pages, ["text", "n_chars", "_host", "_slot", "_texts", "_domain"])
    named = own.withColumn("_host", F.coalesce(host_of(F.col("url")), F.lit("")))
    found = materialize(templates(named.select(F.col("_host").alias("host"), "html")), "templates")
    row = found.where(F.col("key") == GENERAL).first()
    general = row.region if row else None

    def keyed(kind: str, name: str, **columns: str) -> DataFrame:
        level = found.where(F.startswith("key", F.lit(f"{kind}:")))
        return level.select(F.substring("key", 3, 1 << 30).alias(name), *[F.col(c).alias(n) for n, c in columns.items()])

    domains = keyed("d", "_domain", _domain_slot="region")
    placed = named.withColumn("_domain", registered(F.col("_host")))
    joined = placed.join(keyed("h", "_host", _slot="region", _texts="texts"), "_host", "left").join(domains, "_domain", "left")

    def make():
        def row(html, slot, domain_slot, own):
            text = main_text(html, (slot, domain_slot, general), own)
            return text, len(text)

        return row

    fields = [StructField("text", StringType(), False), StructField("n_chars", LongType(), False)]
    read = joined.drop("_host", "_domain")
    return add_columns(read, ["html", "_slot", "_domain_slot", "_texts"], fields, make).drop("_slot", "_domain_slot", "_texts")
