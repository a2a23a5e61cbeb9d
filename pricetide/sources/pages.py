"""Store pages (S2): the driver's ``pages`` with store, category, place and store content.

The stored pages are plain web pages.  As the raw listings are derived from lineitems
(``sources/raw.py``), store pages are derived from them: store and category follow the
url, and by the page's number some pages get what the extraction rules look for (element
marks, phrases, product cards with prices, product links, item urls), so that every rule
meets pages that fire it and pages that do not.  The text below is valid in Spark SQL and
in DuckDB; the oracle reads it as a relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricetide.sources.tables import read_table, spread

_ID = "CAST(page_id AS STRING)"
_HOST = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
_STORE = "CASE WHEN url LIKE '%.example.com%' THEN 'mercadolibre' WHEN url LIKE '%.example.org%' THEN 'aliexpress' ELSE 'temu' END"
_CATEGORY = "CASE WHEN url LIKE '%/fr/%' THEN 'GPUs' WHEN url LIKE '%/de/%' THEN 'RAM' WHEN url LIKE '%/es/%' THEN 'SSD' ELSE 'CPUs' END"

_URL = f"""CASE
  WHEN page_id % 4 = 1 AND store_key = 'mercadolibre' THEN {_HOST} || '/MLM-' || {_ID} || '-x?ref=1#f'
  WHEN page_id % 4 = 1 AND store_key = 'aliexpress' THEN {_HOST} || '/item/' || {_ID} || '.html?spm=1'
  WHEN page_id % 4 = 1 THEN {_HOST} || '/thing-g-' || {_ID} || '.html?src=a'
  WHEN page_id % 4 = 2 THEN split_part(split_part(url, '#', 1), '?', 1) || '?spm=1&src=2&search_key=k&page=3#top'
  WHEN page_id % 4 = 3 AND store_key = 'mercadolibre' THEN {_HOST} || '/p/MLM' || {_ID} || '?x=1'
  WHEN page_id % 4 = 3 AND store_key = 'temu' THEN {_HOST} || '/' || CAST(10000000 + page_id AS STRING) || '.html'
  ELSE url END"""

_TITLE = """CASE WHEN page_id % 13 = 1 THEN replace(html, '<title>', '<title>Captcha: ')
  WHEN page_id % 13 = 4 THEN replace(html, '<title>', '<title>Just a moment ') ELSE html END"""

_EXTRA = f"""CASE page_id % 13
  WHEN 0 THEN '<div class="box captcha">x</div><div id="nc_1_wrapper"></div><iframe src="/captcha/1"></iframe>'
  WHEN 1 THEN CASE WHEN page_id % 2 = 0 THEN '<p>Slide to verify</p>' ELSE '' END
  WHEN 2 THEN '<form id="challenge-form"></form>'
  WHEN 3 THEN '<p>Ray ID 7</p>'
  WHEN 5 THEN '<p>Access denied</p>'
  WHEN 6 THEN '<div class="ui-search-message">-</div><div class="no-result">-</div><p>No items found</p>'
  ELSE '' END ||
  CASE WHEN page_id % 13 >= 7 THEN
    '<ul><li><a href="/item/' || {_ID} || '.html">kingston  drive ' || {_ID} || '</a> $1,' || CAST(100 + page_id % 900 AS STRING) || '.50</li>'
    || '<li><a href="/MLM-' || {_ID} || '">msi board</a> US$ ' || CAST(page_id % 97 AS STRING) || '</li><li><b></b></li></ul>' ELSE '' END ||
  CASE WHEN page_id % 13 >= 10 THEN '<div class="product-card"><b>card</b></div>' ELSE '' END ||
  CASE WHEN page_id % 5 = 0 THEN '<span class="fraction">' || CAST(page_id AS STRING) || '</span><span class="cents">25</span>' ELSE '' END ||
  CASE WHEN page_id % 3 = 0 THEN repeat('<a href="/item/7.html">x</a>', 58) || '<a href="/item/8.html">x</a><a href="/item/9.html">x</a><a href="/item/10.html">x</a>'
    || repeat('<a href="/a-g-7.html">x</a>', 38) || '<a href="/a-g-8.html">x</a><a href="/a-g-9.html">x</a><a href="/a-g-10.html">x</a>'
    || '<a href="/MLM-1">x</a><a href="/MLM-2">x</a><a href="/MLM-1">x</a>' ELSE '' END"""

STORE_PAGES_SQL = f"""SELECT page_id, store_key, category, page_id AS page_no, {_URL} AS url, {_TITLE} || {_EXTRA} AS html
FROM (SELECT page_id, url, html, {_STORE} AS store_key, {_CATEGORY} AS category FROM {{pages}}) raw"""


def store_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, store_key, category, page_no, url, html: one row per stored page."""
    return spark.sql(STORE_PAGES_SQL, pages=spread(read_table(spark, sf_dir, "pages")))


def store_pages_cte(name: str = "sp") -> str:
    return f"{name} AS ({STORE_PAGES_SQL.format(pages='pages')})"
