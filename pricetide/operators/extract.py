"""Extraction over stored pages (X1-X22), as Spark jobs over a pages table.

Input: ``pages(page_id, store_key, category, page_no, url, html)``; ``page_no`` orders the
pages of a (store, category).  Each store's pages follow that store's own rules
(``constants.STORE_RULES``).  Fetching is not part of the engine: pages arrive as a table.  HTML is read with regular expressions from the
subset Java regex and RE2 share (no look-around); every rule list is ordered
and the first rule that yields something wins, expressed with ``coalesce`` /
``when(size(...) > 0)`` so the whole extraction is one projection per page
(no Python, no DOM).  The supported shapes are the ones the patterns in
``DEFAULT_RULES`` describe; other layouts need their own rule list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide import constants as K
from pricetide.functions import absolutize_url, by_store, contains_any, has_mark, join_price_parts, listing_name, parse_price

# extraction rules for the stored page layout
DEFAULT_RULES = {
    "cards": [r"(?s)<li>(.*?)</li>", r"(?s)<p>(.*?)</p>"],
    "name": [r"(?s)<a [^>]*>(.*?)</a>", r"(?s)<b>(.*?)</b>"],
    "href": r'href="([^"]*)"',
    "title": r"(?s)<title>(.*?)</title>",
    "price": r"(?:US\$|MX\$|\$|€|¥)\s?([0-9][0-9.,]*)",
    "links": r'<a href="([^"]*)"',
    "price_int": r'(?s)<span class="fraction">(.*?)</span>',
    "price_cents": r'(?s)<span class="cents">(.*?)</span>',
}


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]*>", " ")


def first_nonempty(cands: list[Column]) -> Column:
    return F.coalesce(*[F.when(F.length(F.trim(c)) > 0, F.trim(c)) for c in cands])


# ----------------------------------------------------------------------------
# X1 crawl frontier
# ----------------------------------------------------------------------------


def frontier(spark, categories: DataFrame, stores=K.FRONTIER, queries=K.SEARCH_QUERIES) -> DataFrame:
    """One search url per store x category x page.  Search text comes from
    the (store, category) table, falling back to lower(category); spaces
    become '-'; offset = (page - 1) * 48 + 1."""
    st = spark.createDataFrame([(k, t, per, mp) for k, t, per, mp in stores],
                               "store_key string, template string, per_page int, max_pages int")
    q = spark.createDataFrame([(s, c, t) for s, m in queries.items() for c, t in m.items()],
                              "store_key string, category string, query string")
    grid = (categories.select(F.col("name").alias("category")).distinct()
            .crossJoin(F.broadcast(st))                      # stores: fixed 3 rows
            .join(F.broadcast(q), ["store_key", "category"], "left")
            .withColumn("page", F.explode(F.sequence(F.lit(1), F.col("max_pages")))))
    text = F.replace(F.coalesce(F.col("query"), F.lower(F.col("category"))), F.lit(" "), F.lit("-"))
    offset = ((F.col("page") - 1) * K.FRONTIER_OFFSET_STEP + 1).cast("string")
    url = F.replace(F.replace(F.replace(F.col("template"), F.lit("{query}"), text),
                              F.lit("{page}"), F.col("page").cast("string")), F.lit("{offset}"), offset)
    return grid.select("store_key", "category", "page", url.alias("url"))


# ----------------------------------------------------------------------------
# X2-X4 cards and listings
# ----------------------------------------------------------------------------


def cards(pages: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """Page -> ordered cards; the first pattern that finds any card wins."""
    pats = patterns or DEFAULT_RULES["cards"]
    found = F.lit(None).cast("array<string>")
    for p in reversed(pats):
        a = F.regexp_extract_all(F.col("html"), F.lit(p), 1)
        found = F.when(F.size(a) > 0, a).otherwise(found)
    key = [c for c in ("page_id", "store_key", "category", "page_no", "url") if c in pages.columns]
    return (pages.select(*key, F.posexplode(F.coalesce(found, F.array().cast("array<string>"))))
            .select(*key, (F.col("pos") + 1).alias("card_no"), F.col("col").alias("card")))


def card_fields(cards_df: DataFrame, rules: dict | None = None) -> DataFrame:
    """Fields of a card with ordered fallback: name = first non-empty
    of the name patterns, else the card text; href; price text."""
    r = rules or DEFAULT_RULES
    card = F.col("card")
    names = [strip_tags(F.regexp_extract(card, p, 1)) for p in r["name"]] + [strip_tags(card)]
    return cards_df.select("*", first_nonempty(names).alias("raw_name"),
                           F.nullif(F.regexp_extract(card, r["href"], 1), F.lit("")).alias("href"),
                           F.nullif(F.regexp_extract(card, r["price"], 1), F.lit("")).alias("price_text"))


def listings(fields: DataFrame) -> DataFrame:
    """X4 (+X6, X7, X10): listing rows: name required, missing price -> 0.0,
    availability = price > 0, url absolutised, '' when absent."""
    price = F.coalesce(parse_price(F.col("price_text")), F.lit(0.0))
    url = F.coalesce(absolutize_url(F.col("href"), host_of(F.col("url"))), F.lit(""))
    key = [c for c in ("store_key", "category", "page_no") if c in fields.columns]
    return (fields.filter(F.col("raw_name").isNotNull())
            .select("page_id", *key, F.col("url").alias("page_url"), "card_no", listing_name(F.col("raw_name")).alias("name"),
                    price.alias("price"),
                    (price > 0).alias("availability"), url.alias("url")))


# ----------------------------------------------------------------------------
# X5, X6 price text
# ----------------------------------------------------------------------------


def price_from_parts(int_text: Column, cents_text: Column) -> Column:
    """X5 + X6: '<int>.<cents>' when both parts exist, parsed as a price."""
    return parse_price(join_price_parts(int_text, cents_text))


# ----------------------------------------------------------------------------
# X8 brand
# ----------------------------------------------------------------------------


def infer_brand(name: Column, category_id: Column, brands=K.BRANDS, categories=K.CATEGORIES) -> Column:
    """First brand of the category's ordered list whose upper-case form
    occurs in upper(name); NULL when none."""
    by_id = {int(i): brands.get(n, []) for i, n, *_ in categories}
    m = F.create_map(*[x for i, bl in by_id.items()
                       for x in (F.lit(i), F.array(*[F.lit(b) for b in bl]).cast("array<string>"))])
    lst = F.coalesce(F.try_element_at(m, category_id), F.array().cast("array<string>"))
    hits = F.filter(lst, lambda b: F.instr(F.upper(name), F.upper(b)) > 0)
    return F.try_element_at(hits, F.lit(1))


# ----------------------------------------------------------------------------
# X12-X15 page classifiers, X16 cut-off
# ----------------------------------------------------------------------------


def page_text(pages: DataFrame, rules: dict | None = None) -> DataFrame:
    r = rules or DEFAULT_RULES
    return pages.select("*", F.lower(F.regexp_extract(F.col("html"), r["title"], 1)).alias("title_lc"),
                        F.lower(strip_tags(F.regexp_replace(F.col("html"), r["title"], " "))).alias("body_lc"))


def classify_pages(pages: DataFrame, rules: dict | None = None) -> DataFrame:
    """X12-X15 by the rules of each page's store: captcha (an element mark, a title keyword,
    or a phrase in title and body both), challenge page (mark, title keyword or body phrase),
    blocked (body phrase), no results (mark or body phrase)."""
    t = page_text(pages)
    title, body, html = F.col("title_lc"), F.col("body_lc"), F.col("html")
    flags = {
        "is_captcha": lambda r: (has_mark(html, r["captcha_marks"]) | contains_any(title, r["captcha_title"])
                                 | (contains_any(title, r["captcha_both"]) & contains_any(body, r["captcha_both"]))),
        "is_challenge": lambda r: (has_mark(html, r["challenge_marks"]) | contains_any(title, r["challenge_title"])
                                   | contains_any(body, r["challenge_body"])),
        "is_blocked": lambda r: contains_any(body, r["blocked_body"]),
        "is_no_results": lambda r: has_mark(html, r["no_results_marks"]) | contains_any(body, r["no_results_body"]),
    }
    key = [c for c in ("page_id", "store_key", "category", "page_no", "url") if c in pages.columns]
    return t.select(*key, *[F.coalesce(by_store(F.col("store_key"), rule, rules), F.lit(False)).alias(name) for name, rule in flags.items()])


def cut_after_block(pages: DataFrame, group: Column, order: str, flag: str) -> DataFrame:
    """Within a group, the first flagged page and every later page are
    dropped.  The first flagged position per group is a partial aggregate
    joined back, so a large group never becomes one window partition."""
    g = pages.withColumn("__g", group)
    first = g.filter(F.col(flag)).groupBy("__g").agg(F.min(order).alias("__first_block"))
    return (g.join(first, "__g", "left")
             .filter(F.col("__first_block").isNull() | (F.col(order) < F.col("__first_block")))
             .drop("__g", "__first_block"))


# ----------------------------------------------------------------------------
# X17 fallback links, X18 caps
# ----------------------------------------------------------------------------


def fallback_links(pages: DataFrame, card_counts: DataFrame, rules: dict | None = None, layout: dict | None = None) -> DataFrame:
    """For pages without cards, the store's product links in page order, up to the
    store's number of them, each url once (the number is the feature; a page is one row)."""
    pattern = (layout or DEFAULT_RULES)["links"]
    empty = pages.join(card_counts.filter(F.col("n_cards") > 0).select("page_id"), "page_id", "left_anti")
    every = F.regexp_extract_all(F.col("html"), F.lit(pattern), 1)

    def first(r: dict) -> Column:
        links = F.filter(every, lambda h: h.rlike(r["link"]))
        return F.array_distinct(links if r["link_cap"] is None else F.slice(links, 1, r["link_cap"]))
    links = F.coalesce(by_store(F.col("store_key"), first, rules), F.array().cast("array<string>"))
    return (empty.select("page_id", "store_key", "url", F.posexplode(links))
            .select("page_id", "store_key", "url", F.col("col").alias("href"), (F.col("pos") + 1).alias("link_no")))


def running_before(rows: DataFrame, keys: list[str], order: str, value: str, width: int = 1024) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over the group's earlier rows
    (``order`` is unique in a group).  Sums per segment of ``width`` order values are
    added up first, so a group of any length is no single window partition."""
    seg = rows.withColumn("__seg", F.floor(F.col(order) / F.lit(width)))
    upto = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    base = (seg.groupBy(*keys, "__seg").agg(F.sum(value).alias("__n"))
            .withColumn("__base", F.coalesce(F.sum("__n").over(upto), F.lit(0))).drop("__n"))
    inside = Window.partitionBy(*keys, "__seg").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (seg.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(base, [*keys, "__seg"])
            .withColumn("before", F.col("__base") + F.col("__in")).drop("__seg", "__base", "__in"))


def stop_pages(listings_df: DataFrame, pages: DataFrame, max_pages: int, rules: dict | None = None) -> DataFrame:
    """The listings of the pages that are fetched.  Before each page the store's limit
    (pages times listings per page) is held against the listings so far; a page that is
    fetched is kept whole, and a store without a limit never stops."""
    key = ["store_key", "category"]
    n = listings_df.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    per_page = pages.select("page_id", *key, "page_no").join(n, "page_id", "left").fillna(0, ["n"])
    cap = by_store(F.col("store_key"), lambda r: F.lit(None if r["per_page"] is None else r["per_page"] * max_pages).cast("long"), rules)
    fetched = running_before(per_page, key, "page_no", "n").where(cap.isNull() | (F.col("before") < cap))
    return listings_df.join(fetched.select("page_id"), "page_id", "left_semi")


# ----------------------------------------------------------------------------
# X19-X21
# ----------------------------------------------------------------------------


def detail_prices(pages: DataFrame, layout: dict | None = None, rules: dict | None = None) -> DataFrame:
    """Url -> price of a detail page (integer and cents parts joined where the page has
    them, else the first price text), the store's currency always, availability (false
    without a price)."""
    r = layout or DEFAULT_RULES
    part = lambda name: F.nullif(F.trim(F.regexp_extract(F.col("html"), r[name], 1)), F.lit(""))
    price = parse_price(F.coalesce(join_price_parts(part("price_int"), part("price_cents")), part("price")))
    currency = by_store(F.col("store_key"), lambda s: F.lit(s["currency"]), rules)
    return pages.select("page_id", "url", price.alias("price"), currency.alias("currency"), price.isNotNull().alias("availability"))


def drift(pages: DataFrame, key: Column, order: str, threshold: float = K.DRIFT_THRESHOLD, width: int = 100_000) -> DataFrame:
    """Relative html length change against the previous snapshot of the
    same key above ``threshold``; no previous snapshot -> false.  ``width`` order values
    make a segment (``segmented_lag``)."""
    from pricetide.operators.changes import segmented_lag
    d = pages.select("page_id", "url", key.alias("page_key"), F.col(order).alias("__o"),
                     F.length("html").alias("html_len"))
    d = segmented_lag(d, ["page_key"], ["__o"], "html_len", F.floor(F.col("__o") / F.lit(width)), out="prev_len")
    rel = F.abs(F.col("html_len") - F.col("prev_len")) / F.nullif(F.col("prev_len"), F.lit(0))
    return d.select("page_id", "page_key", "html_len", "prev_len",
                    F.coalesce(rel > F.lit(threshold), F.lit(False)).alias("changed")).drop("__o")


def extraction_counters(lst: DataFrame, classes: DataFrame) -> DataFrame:
    """Per store: pages, captcha and blocked pages, listings found, saved (priced) and
    failed (no price), and the categories that were blocked, in order."""
    a = lst.groupBy("store_key").agg(
        F.count(F.lit(1)).alias("found"), F.count_if(F.col("price") > 0).alias("saved"),
        F.count_if(~(F.col("price") > 0)).alias("failed"))
    stop = F.col("is_captcha") | F.col("is_blocked") | F.col("is_challenge")
    b = classes.groupBy("store_key").agg(
        F.count_if("is_captcha").alias("captcha_pages"), F.count_if("is_blocked").alias("blocked_pages"),
        F.count(F.lit(1)).alias("pages"),
        F.array_join(F.array_sort(F.collect_set(F.when(stop, F.col("category")))), ",").alias("blocked_categories"))   # a few categories
    return b.join(a, "store_key", "left").fillna(0, ["found", "saved", "failed"])
