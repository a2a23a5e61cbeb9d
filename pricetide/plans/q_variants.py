"""Registered SQL variants Q1-Q8."""

from __future__ import annotations

from pricetide.operators import variants as V
from pricetide.plans.catalog import query
from pricetide.plans.sqltext import STAR_CTE
from pricetide.sources.adapters import events_star, retail_star

ADAPTERS = {"e": events_star, "r": retail_star}


def _reg(key: str, adapter: str, question: V.Question):
    oracle = f"WITH {STAR_CTE[adapter]}{',' + question.ctes() if question.shelf else ''}\n{question.literal()}"

    @query(key, oracle)
    def _run(spark, d):
        return V.run(spark, ADAPTERS[adapter](spark, d), question)
    return _run


_reg("q01_kpis_e", "e", V.kpis())
_reg("q02_category_summary_e", "e", V.category_summary())
_reg("q02_category_summary_r", "r", V.category_summary())
_reg("q03_top_discounts_e", "e", V.top_discounts(n=10))
_reg("q04_volatility_pop_e", "e", V.volatility())
_reg("q04_volatility_pop_r", "r", V.volatility())
_reg("q05_store_ranking_e", "e", V.store_ranking())
_reg("q05_store_ranking_r", "r", V.store_ranking())
_reg("q06_price_evolution_like_e", "e", V.price_evolution("view #1"))
_reg("q07_products_by_category_e", "e", V.products_by_category("purchase"))
_reg("q08_product_names_e", "e", V.product_names())
_reg("q08_product_names_r", "r", V.product_names())
