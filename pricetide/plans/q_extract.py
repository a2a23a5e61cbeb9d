"""Registered extraction queries X1-X22 over the driver's ``pages`` table (and
the retail listings / part table where the rule needs prices or categories)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricetide import constants as K
from pricetide.functions import WS_CLASS, canonical_url, extract_sku, listing_name, mark_pattern, parse_price
from pricetide.operators import cleaning as CL
from pricetide.operators import extract as X
from pricetide.plans.catalog import query
from pricetide.plans.q_cleaning import OK_SQL, STAGES_CTE, strip_sql
from pricetide.sources.adapters import retail_star
from pricetide.sources.raw import RETAIL_LISTINGS_SQL, retail_listings
from pricetide.sources.pages import store_pages, store_pages_cte
from pricetide.sources.tables import read_table

R = X.DEFAULT_RULES
# FIXED VALUES of the registered instances (parameters, not engine rules)
WORDS = ["que", "the end", "wh"]          # words that occur in the pages
PRODUCT_CARD = [r'(?s)<div class="product-card">(.*?)</div>']   # card layout of some store pages
SP = store_pages_cte()
MAX_PAGES = 2
# the classifier with words that occur in all pages, for every store
WORD_RULES = {k: {**r, "captcha_marks": [], "captcha_title": WORDS[:1], "captcha_both": WORDS[1:2], "challenge_marks": [],
                  "challenge_title": WORDS[2:], "challenge_body": WORDS[:1], "blocked_body": WORDS[1:], "no_results_marks": [],
                  "no_results_body": WORDS[:2]} for k, r in K.STORE_RULES.items()}


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_sql(col: str, phrases: list[str]) -> str:
    if not phrases:
        return "FALSE"
    return "(" + " OR ".join(f"instr({col}, {_sq(p)}) > 0" for p in phrases) + ")"


def listing_name_sql(c: str) -> str:
    s = f"regexp_replace({strip_sql(c)}, '{WS_CLASS}+', ' ', 'g')"
    s = f"regexp_replace({s}, '[\\x{{0}}-\\x{{1F}}]', '', 'g')"
    # Python / Java upper-case 'ß' as 'SS'; DuckDB gives the capital sharp s, so spell it out
    s = f"(CASE WHEN substring({s}, 1, 1) = 'ß' THEN 'SS' ELSE upper(substring({s}, 1, 1)) END || substring({s}, 2))"
    return f"(CASE WHEN length({s}) > 300 THEN substring({s}, 1, 297) || '...' ELSE {s} END)"


def parse_price_sql(c: str) -> str:
    s = c
    for m in K.PRICE_MARKERS:
        s = f"replace({s}, {_sq(m)}, '')"
    s = strip_sql(s)
    rev = f"reverse({s})"
    norm = (f"(CASE WHEN instr({s}, ',') > 0 AND instr({s}, '.') > 0 THEN "
            f"(CASE WHEN instr({rev}, ',') < instr({rev}, '.') THEN replace(replace({s}, '.', ''), ',', '.') "
            f"ELSE replace({s}, ',', '') END) "
            f"WHEN instr({s}, ',') > 0 THEN "
            f"(CASE WHEN length({s}) - length(replace({s}, ',', '')) = 1 AND length(reverse(split_part({rev}, ',', 1))) <= 2 "
            f"THEN replace({s}, ',', '.') ELSE replace({s}, ',', '') END) ELSE {s} END)")
    val = f"(CASE WHEN regexp_matches({norm}, '^[+-]?[0-9]+(\\.[0-9]*)?$|^[+-]?\\.[0-9]+$') THEN CAST({norm} AS DOUBLE) END)"
    return f"(CASE WHEN {val} > 0 THEN {val} END)"


def by_store_sql(rule, rules=None) -> str:
    whens = " ".join(f"WHEN {_sq(k)} THEN {rule(r)}" for k, r in (rules or K.STORE_RULES).items())
    return f"(CASE store_key {whens} END)"


def _canonical_one(c: str, r: dict) -> str:
    nf = f"split_part({c}, '#', 1)"
    base = f"split_part({nf}, '?', 1)"
    if r["tracking"] is None:
        return f"(CASE WHEN instr({c}, {_sq(r['keep_query'])}) > 0 THEN {c} ELSE {base} END)"
    q = f"(CASE WHEN instr({nf}, '?') > 0 THEN substring({nf}, instr({nf}, '?') + 1) END)"
    cond = " OR ".join(f"starts_with(p, {_sq(k + '=')})" for k in r["tracking"])
    keep = f"list_filter(string_split({q}, '&'), lambda p: NOT ({cond}))"
    item = f"regexp_extract({nf}, {_sq(r['item_url'])}, 1)"
    return (f"(CASE WHEN {item} <> '' THEN {item} WHEN {q} IS NULL THEN {nf} "
            f"WHEN len({keep}) > 0 THEN {base} || '?' || array_to_string({keep}, '&') ELSE {base} END)")


def _sku_one(c: str, r: dict) -> str:
    out = "CAST(NULL AS VARCHAR)"
    for pat, prefix in reversed(r["sku"]):
        g = f"regexp_extract({c}, {_sq(pat)}, 1)"
        out = f"(CASE WHEN {g} <> '' THEN {_sq(prefix)} || {g} ELSE {out} END)"
    return out


def canonical_sql(c: str) -> str:
    return by_store_sql(lambda r: _canonical_one(c, r))


def sku_sql(c: str) -> str:
    return by_store_sql(lambda r: _sku_one(c, r))


def marks_sql(c: str, marks: list[str]) -> str:
    return "FALSE" if not marks else f"regexp_matches({c}, {_sq('|'.join(mark_pattern(m) for m in marks))})"


def strip_tags_sql(c: str) -> str:
    return f"regexp_replace({c}, '<[^>]*>', ' ', 'g')"


def cards_sql(pats: list[str]) -> str:
    arr = "CAST([] AS VARCHAR[])"
    for p in reversed(pats):
        a = f"regexp_extract_all(html, {_sq(p)}, 1)"
        arr = f"(CASE WHEN len({a}) > 0 THEN {a} ELSE {arr} END)"
    return (f"cards AS (SELECT page_id, store_key, category, page_no, url, CAST(generate_subscripts(a, 1) AS INTEGER) AS card_no, unnest(a) AS card "
            f"FROM (SELECT page_id, store_key, category, page_no, url, {arr} AS a FROM sp) x)")


_NAME_CANDS = [f"trim({strip_tags_sql(f'regexp_extract(card, {_sq(p)}, 1)')})" for p in R["name"]] + \
              [f"trim({strip_tags_sql('card')})"]
_FIELDS = (f"fields AS (SELECT *, coalesce({', '.join(f'CASE WHEN length({c}) > 0 THEN {c} END' for c in _NAME_CANDS)}) AS raw_name, "
           f"nullif(regexp_extract(card, {_sq(R['href'])}, 1), '') AS href, "
           f"nullif(regexp_extract(card, {_sq(R['price'])}, 1), '') AS price_text FROM cards)")
_HOST = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
_LISTINGS = (f"listings AS (SELECT page_id, store_key, category, page_no, url AS page_url, card_no, {listing_name_sql('raw_name')} AS name, "
             f"coalesce({parse_price_sql('price_text')}, 0.0) AS price, "
             f"coalesce({parse_price_sql('price_text')}, 0.0) > 0 AS availability, "
             f"coalesce(CASE WHEN starts_with(href, '/') THEN {_HOST} || href ELSE href END, '') AS url "
             f"FROM fields WHERE raw_name IS NOT NULL)")


def _pages(spark, d):
    return store_pages(spark, d)


@query("x01_frontier_r", f"""WITH st AS (SELECT * FROM (VALUES {", ".join(f"({_sq(k)}, {_sq(t)}, {mp})" for k, t, _, mp in K.FRONTIER)}) AS t(store_key, template, max_pages)),
q AS (SELECT * FROM (VALUES {", ".join(f"({_sq(s)}, {_sq(c)}, {_sq(t)})" for s, m in K.SEARCH_QUERIES.items() for c, t in m.items())}) AS t(store_key, category, query)),
g AS (SELECT c.category, st.store_key, st.template, unnest(range(1, st.max_pages + 1)) AS page
      FROM (SELECT DISTINCT p_type AS category FROM part) c CROSS JOIN st)
SELECT g.store_key, g.category, CAST(g.page AS INTEGER) AS page,
       replace(replace(replace(g.template, '{{query}}', replace(coalesce(q.query, lower(g.category)), ' ', '-')),
               '{{page}}', CAST(g.page AS VARCHAR)), '{{offset}}', CAST((g.page - 1) * {K.FRONTIER_OFFSET_STEP} + 1 AS VARCHAR)) AS url
FROM g LEFT JOIN q ON q.store_key = g.store_key AND q.category = g.category""")
def x01(spark, d):
    return X.frontier(spark, retail_star(spark, d).categories)


@query("x02_cards_pages", f"WITH {SP},\n{cards_sql(R['cards'])}\nSELECT page_id, url, card_no, card FROM cards")
def x02(spark, d):
    return X.cards(_pages(spark, d)).select("page_id", "url", "card_no", "card")


@query("x03_fields_pages", f"WITH {SP},\n{cards_sql(R['cards'])},\n{_FIELDS}\n"
                           "SELECT page_id, card_no, raw_name, href, price_text FROM fields")
def x03(spark, d):
    return X.card_fields(X.cards(_pages(spark, d))).select("page_id", "card_no", "raw_name", "href", "price_text")


@query("x04_listings_pages", f"WITH {SP},\n{cards_sql(R['cards'])},\n{_FIELDS},\n{_LISTINGS}\n"
                             "SELECT page_id, card_no, name, price, availability, url FROM listings")
def x04(spark, d):
    return X.listings(X.card_fields(X.cards(_pages(spark, d)))).select("page_id", "card_no", "name", "price", "availability", "url")


_PARTS = """SELECT p_partkey, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS int_text,
       CASE WHEN p_partkey % 3 = 0 THEN NULL
            ELSE lpad(CAST(CAST(round((p_retailprice - floor(p_retailprice)) * 100) AS INTEGER) AS VARCHAR), 2, '0') END AS cents_text
FROM part"""


@query("x05_price_parts_part", f"""WITH t AS ({_PARTS})
SELECT p_partkey, int_text, cents_text,
       {parse_price_sql("CASE WHEN cents_text IS NOT NULL AND cents_text <> '' AND int_text IS NOT NULL THEN int_text || '.' || cents_text ELSE int_text END")} AS price
FROM t""")
def x05(spark, d):
    p = read_table(spark, d, "part")
    x = F.col("p_retailprice")
    t = p.select("p_partkey", F.floor(x).cast("bigint").cast("string").alias("int_text"),
                 F.when(F.col("p_partkey") % 3 == 0, F.lit(None).cast("string"))
                  .otherwise(F.lpad(F.round((x - F.floor(x)) * 100).cast("int").cast("string"), 2, "0"))
                  .alias("cents_text"))
    return t.withColumn("price", X.price_from_parts(F.col("int_text"), F.col("cents_text")))


_TEXT_SQL = """CASE p_partkey % 5
  WHEN 0 THEN '$' || format('{:,.2f}', p_retailprice)
  WHEN 1 THEN '€' || translate(format('{:,.2f}', p_retailprice), ',.', '.,')
  WHEN 2 THEN 'US$ ' || printf('%.2f', p_retailprice)
  WHEN 3 THEN replace(printf('%.2f', p_retailprice), '.', ',')
  ELSE 'MXN ' || format('{:,}', CAST(floor(p_retailprice) AS BIGINT)) END"""


@query("x06_price_text_part", f"""WITH t AS (SELECT p_partkey, {_TEXT_SQL} AS price_text FROM part)
SELECT p_partkey, price_text, {parse_price_sql('price_text')} AS price FROM t""")
def x06(spark, d):
    p = read_table(spark, d, "part")
    x = F.col("p_retailprice")
    k = F.col("p_partkey") % 5
    text = (F.when(k == 0, F.concat(F.lit("$"), F.format_number(x, 2)))
             .when(k == 1, F.concat(F.lit("€"), F.translate(F.format_number(x, 2), ",.", ".,")))
             .when(k == 2, F.concat(F.lit("US$ "), F.format_string("%.2f", x)))
             .when(k == 3, F.replace(F.format_string("%.2f", x), F.lit("."), F.lit(",")))
             .otherwise(F.concat(F.lit("MXN "), F.format_number(F.floor(x), 0))))
    return p.select("p_partkey", text.alias("price_text")).withColumn("price", parse_price(F.col("price_text")))


@query("x07_title_names_pages", f"""WITH {SP}
SELECT page_id, {listing_name_sql(f"regexp_extract(html, {_sq(R['title'])}, 1)")} AS name FROM sp""")
def x07(spark, d):
    return _pages(spark, d).select("page_id", listing_name(F.regexp_extract("html", R["title"], 1)).alias("name"))


def _brand_case():
    parts = []
    for i, n, *_ in K.CATEGORIES:
        lst = "[" + ", ".join(_sq(b) for b in K.BRANDS.get(n, [])) + "]"
        parts.append(f"WHEN {i} THEN {lst}")
    return "CASE category_id " + " ".join(parts) + " ELSE CAST([] AS VARCHAR[]) END"


BRAND_WORDS = ["kingston", "AMD", "samsung", "msi", "hp", "lg", "wd", "asus", "no brand"]     # one is put behind each name


@query("x08_brand_inference_r", f"""WITH {STAGES_CTE},
branded AS (SELECT name || ' ' || ([{", ".join(_sq(b) for b in BRAND_WORDS)}])[length(name) % {len(BRAND_WORDS)} + 1] AS name, store_id, category_id
          FROM d2 WHERE {OK_SQL})
SELECT name, store_id, category_id,
       list_filter({_brand_case()}, lambda b: instr(upper(name), upper(b)) > 0)[1] AS brand_inferred
FROM branded""")
def x08(spark, d):
    c = CL.clean_all(retail_listings(spark, d)).data
    word = F.get(F.array(*map(F.lit, BRAND_WORDS)), F.length("name") % len(BRAND_WORDS))
    c = c.withColumn("name", F.concat("name", F.lit(" "), word))
    return c.select("name", "store_id", "category_id",
                    X.infer_brand(F.col("name"), F.col("category_id")).alias("brand_inferred"))


_KEYS = list(K.STORE_RULES)


@query("x09_sku_r", f"""WITH raw AS ({RETAIL_LISTINGS_SQL}),
keyed AS (SELECT *, ([{", ".join(map(_sq, _KEYS))}])[l_linenumber % 3 + 1] AS store_key FROM raw)
SELECT l_orderkey, l_linenumber, url, {sku_sql('url')} AS sku_extracted FROM keyed""")
def x09(spark, d):
    key = F.get(F.array(*map(F.lit, _KEYS)), F.col("l_linenumber") % 3)
    return retail_listings(spark, d).select("l_orderkey", "l_linenumber", "url", extract_sku(F.col("url"), key).alias("sku_extracted"))


@query("x09_sku_pages", f"WITH {SP}\nSELECT page_id, url, {sku_sql('url')} AS sku_extracted FROM sp")
def x09p(spark, d):
    return _pages(spark, d).select("page_id", "url", extract_sku(F.col("url"), F.col("store_key")).alias("sku_extracted"))


@query("x10_absolute_links_pages", f"""WITH {SP}, l AS (
  SELECT page_id, url, unnest(a) AS href, CAST(generate_subscripts(a, 1) AS INTEGER) AS link_no
  FROM (SELECT page_id, url, regexp_extract_all(html, {_sq(R['links'])}, 1) AS a FROM sp) x)
SELECT page_id, link_no, href, CASE WHEN starts_with(href, '/') THEN {_HOST} || href ELSE href END AS abs_url FROM l""")
def x10(spark, d):
    p = _pages(spark, d)
    l = p.select("page_id", "url", F.posexplode(F.regexp_extract_all(F.col("html"), F.lit(R["links"]), 1)))
    return l.select("page_id", (F.col("pos") + 1).alias("link_no"), F.col("col").alias("href"),
                    X.absolutize_url(F.col("col"), X.host_of(F.col("url"))).alias("abs_url"))


@query("x11_canonical_urls_pages", f"WITH {SP}\nSELECT page_id, url, {canonical_sql('url')} AS canonical FROM sp")
def x11(spark, d):
    return _pages(spark, d).select("page_id", "url", canonical_url(F.col("url"), F.col("store_key")).alias("canonical"))


def classes_cte(rules=None) -> str:
    """CTE ``classes``: the page classifiers by store."""
    pick = lambda rule: by_store_sql(rule, rules)
    title, body = lambda ws: any_sql("title_lc", ws), lambda ws: any_sql("body_lc", ws)
    captcha = pick(lambda r: f"({marks_sql('html', r['captcha_marks'])} OR {title(r['captcha_title'])} OR ({title(r['captcha_both'])} AND {body(r['captcha_both'])}))")
    challenge = pick(lambda r: f"({marks_sql('html', r['challenge_marks'])} OR {title(r['challenge_title'])} OR {body(r['challenge_body'])})")
    text = strip_tags_sql("regexp_replace(html, " + _sq(R["title"]) + ", ' ', 'g')")
    return f"""tx AS (SELECT *, lower(regexp_extract(html, {_sq(R['title'])}, 1)) AS title_lc, lower({text}) AS body_lc FROM sp),
classes AS (SELECT page_id, store_key, category, page_no, url, {captcha} AS is_captcha, {challenge} AS is_challenge,
  {pick(lambda r: body(r['blocked_body']))} AS is_blocked,
  {pick(lambda r: f"({marks_sql('html', r['no_results_marks'])} OR {body(r['no_results_body'])})")} AS is_no_results FROM tx)"""


_CLASS_COLS = ["page_id", "url", "is_captcha", "is_challenge", "is_blocked", "is_no_results"]


@query("x12_page_classes_pages", f"WITH {SP},\n{classes_cte()}\nSELECT {', '.join(_CLASS_COLS)} FROM classes")
def x12(spark, d):
    return X.classify_pages(_pages(spark, d)).select(*_CLASS_COLS)


@query("x13_page_classes_words_pages", f"WITH {SP},\n{classes_cte(WORD_RULES)}\nSELECT {', '.join(_CLASS_COLS)} FROM classes")
def x13(spark, d):
    return X.classify_pages(_pages(spark, d), WORD_RULES).select(*_CLASS_COLS)


@query("x16_block_cutoff_pages", f"""WITH {SP},\n{classes_cte()},
stop AS (SELECT store_key, category, min(page_no) AS first_stop FROM classes WHERE is_captcha OR is_blocked OR is_challenge GROUP BY ALL)
SELECT c.page_id, c.url FROM classes c LEFT JOIN stop s ON c.store_key = s.store_key AND c.category = s.category
WHERE s.first_stop IS NULL OR c.page_no < s.first_stop""")
def x16(spark, d):
    c = X.classify_pages(_pages(spark, d)).withColumn("stop", F.col("is_captcha") | F.col("is_blocked") | F.col("is_challenge"))
    return X.cut_after_block(c, F.struct("store_key", "category"), "page_no", "stop").select("page_id", "url")


_LINKS = f"list_filter(regexp_extract_all(html, {_sq(R['links'])}, 1), lambda h: regexp_matches(h, %s))"


def _first_links(r: dict) -> str:
    links = _LINKS % _sq(r["link"])
    return links if r["link_cap"] is None else f"list_slice({links}, 1, {r['link_cap']})"


@query("x17_fallback_links_pages", f"""WITH {SP},
{cards_sql(PRODUCT_CARD)},
e AS (SELECT * FROM sp p WHERE NOT EXISTS (SELECT 1 FROM cards c WHERE c.page_id = p.page_id)),
l AS (SELECT page_id, store_key, url, unnest(a) AS href, generate_subscripts(a, 1) AS pos
      FROM (SELECT page_id, store_key, url, {by_store_sql(_first_links)} AS a FROM e) x),
u AS (SELECT page_id, store_key, url, href, min(pos) AS pos FROM l GROUP BY ALL)
SELECT page_id, store_key, url, href, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) AS INTEGER) AS link_no FROM u""")
def x17(spark, d):
    p = _pages(spark, d)
    cc = X.cards(p, PRODUCT_CARD).groupBy("page_id").agg(F.count(F.lit(1)).alias("n_cards"))
    return X.fallback_links(p, cc)


@query("x18_listing_cap_pages", f"""WITH {SP},
{cards_sql(R['cards'])},\n{_FIELDS},\n{_LISTINGS},
n AS (SELECT page_id, count(*) AS n FROM listings GROUP BY page_id),
b AS (SELECT sp.page_id, store_key, coalesce(sum(coalesce(n, 0)) OVER (PARTITION BY store_key, category ORDER BY page_no
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sp LEFT JOIN n ON n.page_id = sp.page_id),
f AS (SELECT page_id FROM b WHERE coalesce(before < {by_store_sql(lambda r: 'CAST(NULL AS BIGINT)' if r['per_page'] is None else str(r['per_page'] * MAX_PAGES))}, TRUE))
SELECT l.page_id, l.card_no, l.name FROM listings l JOIN f ON f.page_id = l.page_id""")
def x18(spark, d):
    p = _pages(spark, d)
    lst = X.listings(X.card_fields(X.cards(p)))
    return X.stop_pages(lst, p, MAX_PAGES).select("page_id", "card_no", "name")


def _part(name: str) -> str:
    return f"nullif(trim(regexp_extract(html, {_sq(R[name])}, 1)), '')"


@query("x19_detail_prices_pages", f"""WITH {SP}, t AS (
  SELECT page_id, url, store_key, coalesce(CASE WHEN {_part('price_cents')} IS NOT NULL AND {_part('price_int')} IS NOT NULL
           THEN {_part('price_int')} || '.' || {_part('price_cents')} ELSE {_part('price_int')} END, {_part('price')}) AS txt FROM sp),
u AS (SELECT page_id, url, store_key, {parse_price_sql('txt')} AS price FROM t)
SELECT page_id, url, price, {by_store_sql(lambda r: _sq(r['currency']))} AS currency, price IS NOT NULL AS availability FROM u""")
def x19(spark, d):
    return X.detail_prices(_pages(spark, d))


@query("x20_drift_pages", f"""WITH {SP}, t AS (SELECT page_id, {_HOST} AS page_key, length(html) AS html_len FROM sp),
u AS (SELECT *, lag(html_len) OVER (PARTITION BY page_key ORDER BY page_id) AS prev_len FROM t)
SELECT page_id, page_key, html_len, CAST(prev_len AS DOUBLE) AS prev_len,
       coalesce(abs(html_len - prev_len) / nullif(prev_len, 0) > {K.DRIFT_THRESHOLD}, FALSE) AS changed FROM u""")
def x20(spark, d):
    # a host's pages in order stand for the snapshots of one page; a missing previous
    # length is NULL, reported as DOUBLE so every client maps the column the same way
    return X.drift(_pages(spark, d), X.host_of(F.col("url")), "page_id", width=64).withColumn("prev_len", F.col("prev_len").cast("double"))


@query("x21_counters_pages", f"""WITH {SP},
{cards_sql(R['cards'])},\n{_FIELDS},\n{_LISTINGS},\n{classes_cte()},
a AS (SELECT store_key, count(*) AS found, count(*) FILTER (WHERE price > 0) AS saved, count(*) FILTER (WHERE NOT (price > 0)) AS failed
      FROM listings GROUP BY 1),
b AS (SELECT store_key, count(*) FILTER (WHERE is_captcha) AS captcha_pages, count(*) FILTER (WHERE is_blocked) AS blocked_pages, count(*) AS pages,
        coalesce(string_agg(DISTINCT category, ',' ORDER BY category) FILTER (WHERE is_captcha OR is_blocked OR is_challenge), '') AS blocked_categories
      FROM classes GROUP BY 1)
SELECT b.*, coalesce(a.found, 0) AS found, coalesce(a.saved, 0) AS saved, coalesce(a.failed, 0) AS failed
FROM b LEFT JOIN a ON a.store_key = b.store_key""")
def x21(spark, d):
    p = _pages(spark, d)
    return X.extraction_counters(X.listings(X.card_fields(X.cards(p))), X.classify_pages(p))


@query("x22_category_counts_r", f"""WITH {STAGES_CTE},
cl AS (SELECT * FROM d2 WHERE {OK_SQL}),
grid AS (SELECT s.id AS store_id, c.id AS category_id FROM
         (SELECT * FROM (VALUES {", ".join(f"(CAST({i} AS BIGINT))" for i, *_ in K.STORES)}) AS t(id)) s CROSS JOIN
         (SELECT * FROM (VALUES {", ".join(f"(CAST({i} AS BIGINT))" for i, *_ in K.CATEGORIES)}) AS t(id)) c)
SELECT g.store_id, g.category_id, count(cl.name) AS products
FROM grid g LEFT JOIN cl ON cl.store_id = g.store_id AND cl.category_id = g.category_id
GROUP BY g.store_id, g.category_id""")
def x22(spark, d):
    c = CL.clean_all(retail_listings(spark, d)).data
    stores = spark.createDataFrame([(int(i),) for i, *_ in K.STORES], "store_id bigint")
    cats = spark.createDataFrame([(int(i),) for i, *_ in K.CATEGORIES], "category_id bigint")
    grid = stores.crossJoin(cats)          # fixed 3 x 7 frontier of (store, category)
    got = c.groupBy("store_id", "category_id").agg(F.count(F.lit(1)).alias("products"))
    return grid.join(got, ["store_id", "category_id"], "left").fillna(0, ["products"])
