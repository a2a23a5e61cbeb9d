"""SQL versions of the questions (Q1-Q8), run with ``spark.sql`` on temp views.

They differ from the DataFrame versions as the standalone SQL they stand for does: no
look-back window, population standard deviation, distinct product counts and LIKE.

All but the two history questions read one relation, ``shelf``: the newest observation of
every product with the names of its store and category.  The newest rows are a table of
the stored star; a star without it has them found by the latest time of each product
(a partial aggregate, so a hot product sends one row per task) and a join on (product,
time), which is unique.

User values are bound as parameters (``:name`` markers, ``spark.sql(args=...)``), never
spliced into the text.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from pricetide.plans.sqltext import r2
from pricetide.sources.adapters import Star

TABLES = ("stores", "categories", "products", "price_history")

# the newest row of each product, for engines and stars that do not keep it
NEWEST = """
newest AS (
  SELECT h.* FROM price_history h
  INNER JOIN (SELECT product_id, MAX(scraped_at) AS scraped_at FROM price_history GROUP BY product_id) top
          ON top.product_id = h.product_id AND top.scraped_at = h.scraped_at)"""

SHELF = """
shelf AS (
  SELECT item.id AS product_id, item.name AS product_name, shop.name AS store_name, kind.name AS category_name,
         seen.price, seen.price_change, seen.price_change_pct, seen.scraped_at
  FROM newest seen
  INNER JOIN products item ON item.id = seen.product_id
  INNER JOIN stores shop ON shop.id = item.store_id
  INNER JOIN categories kind ON kind.id = item.category_id)"""


@dataclass(frozen=True)
class Question:
    """A query text over the star's views (and ``shelf``), with its bound values."""

    body: str
    values: dict[str, Any] = field(default_factory=dict)
    shelf: bool = True

    def ctes(self, kept: bool = False) -> str:
        """Relations of the body; with ``kept`` there is a table ``newest`` already."""
        return (SHELF if kept else f"{NEWEST},{SHELF}") if self.shelf else ""

    def literal(self) -> str:
        """The body with the values as literals, for engines without these markers."""
        out = self.body
        for name, value in self.values.items():
            text = str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"
            out = out.replace(f":{name}", text)
        return out


def price_facts(prefix: str, of: str = "price") -> str:
    """Rounded average, lowest and highest of a column, named after ``prefix``."""
    return ", ".join(f"{r2(f'{fn}({of})')} AS {word}_{prefix}" for word, fn in (("avg", "AVG"), ("min", "MIN"), ("max", "MAX")))


def kpis() -> Question:
    """Q1: sizes of the star, price facts of all observations, products whose newest
    change is down or up."""
    return Question(f"""
SELECT (SELECT COUNT(*) FROM products) AS total_products, (SELECT COUNT(*) FROM stores) AS total_stores,
       (SELECT COUNT(*) FROM categories) AS total_categories,
       COALESCE(avg_price_mxn, 0.0) AS avg_price_mxn, COALESCE(min_price_mxn, 0.0) AS min_price_mxn,
       COALESCE(max_price_mxn, 0.0) AS max_price_mxn,
       (SELECT COUNT(CASE WHEN price_change_pct < 0 THEN 1 END) FROM shelf) AS products_with_discount,
       (SELECT COUNT(CASE WHEN price_change_pct > 0 THEN 1 END) FROM shelf) AS products_price_up,
       last_update, total_price_records
FROM (SELECT {price_facts('price_mxn')}, MAX(scraped_at) AS last_update, COUNT(*) AS total_price_records FROM price_history) facts""")


def category_summary() -> Question:
    """Q2: newest prices by category."""
    return Question(f"""
SELECT category_name, COUNT(DISTINCT product_id) AS product_count, {price_facts('price')},
       {r2('AVG(price_change_pct)')} AS avg_discount_pct
FROM shelf GROUP BY category_name ORDER BY category_name""")


def top_discounts(n: int = 10) -> Question:
    """Q3: the ``n`` products whose newest price fell the most, in percent, not rounded."""
    return Question("""
SELECT product_name, store_name, category_name, price AS current_price, price - price_change AS previous_price,
       ABS(price_change) AS discount_amount, ABS(price_change_pct) AS discount_pct, scraped_at
FROM shelf WHERE price_change_pct < 0
ORDER BY price_change_pct, product_id LIMIT :n""", {"n": int(n)})


def volatility() -> Question:
    """Q4: population spread of all percent changes by category."""
    return Question(f"""
SELECT kind.name AS category_name, {r2('STDDEV_POP(moves.price_change_pct)')} AS volatility,
       {r2('AVG(moves.price_change_pct)')} AS avg_change_pct, COUNT(moves.id) AS price_records,
       COUNT(DISTINCT moves.product_id) AS products_count
FROM (SELECT h.id, h.product_id, h.price_change_pct, item.category_id
      FROM price_history h INNER JOIN products item ON item.id = h.product_id
      WHERE h.price_change_pct IS NOT NULL) moves
INNER JOIN categories kind ON kind.id = moves.category_id
GROUP BY kind.name ORDER BY volatility DESC NULLS LAST, category_name""", shelf=False)


def store_ranking() -> Question:
    """Q5: stores by their rounded average newest price, cheapest first."""
    return Question(f"""
SELECT store_name, avg_price, min_price, max_price, product_count,
       CAST(ROW_NUMBER() OVER (ORDER BY avg_price, store_name) AS INT) AS rank
FROM (SELECT store_name, {price_facts('price')}, COUNT(DISTINCT product_id) AS product_count
      FROM shelf GROUP BY store_name) by_store
ORDER BY rank""")


def price_evolution(product_name: str) -> Question:
    """Q6: all observations of products whose name holds a text (LIKE)."""
    return Question("""
SELECT CAST(h.scraped_at AS DATE) AS date, h.price, h.price_change, h.price_change_pct, found.product_name, found.store_name
FROM (SELECT item.id, item.name AS product_name, shop.name AS store_name
      FROM products item INNER JOIN stores shop ON shop.id = item.store_id WHERE item.name LIKE :pattern) found
INNER JOIN price_history h ON h.product_id = found.id
ORDER BY h.scraped_at, h.product_id""", {"pattern": f"%{product_name}%"}, shelf=False)


def products_by_category(category_name: str) -> Question:
    """Q7: newest prices of one category's products, cheapest first."""
    return Question("""
SELECT product_name, store_name, price AS current_price, price_change_pct, scraped_at AS last_updated
FROM shelf WHERE category_name = :category ORDER BY price, product_id""", {"category": category_name})


def product_names() -> Question:
    """Q8: the distinct product names in order."""
    return Question("SELECT DISTINCT name AS product_name FROM products ORDER BY product_name", shelf=False)


def run(spark: SparkSession, star: Star, question: Question) -> DataFrame:
    """Runs a question through Spark SQL; the star's tables are views for this query only
    (keyword arguments of ``spark.sql``), so no names are left behind."""
    frames = {t: getattr(star, t) for t in TABLES}
    if question.shelf and star.latest is not None:
        frames["newest"] = star.latest
    ctes = ", ".join(f"{t} AS (SELECT * FROM {{{t}}})" for t in frames) + (f",{question.ctes('newest' in frames)}" if question.shelf else "")
    return spark.sql(f"WITH {ctes}\n{question.body}", args=question.values or None, **frames)
