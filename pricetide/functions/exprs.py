"""Scalar Column expressions shared by every operator.

Rounding rule of the engine: half-up on the binary value,
``round2(x) = floor(x * 100 + 0.5) / 100``.  It gives the same answer in
Spark and in the DuckDB oracle, unlike the engines' own ``round``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricetide import constants as K

__all__ = [
    "by_store", "has_mark", "mark_pattern",
    "round2", "round4", "round_n", "price_change", "price_change_pct", "iso_weekday",
    "weekday_name", "WS_CLASS", "strip_ws", "clean_name", "listing_name", "KEEP_CLASS",
    "parse_price", "join_price_parts", "absolutize_url", "canonical_url", "extract_sku",
    "clamp", "in_range", "parse_scraped_at", "null_if_blank", "contains_any", "with_computed", "with_clean_name",
]

# Python's notion of whitespace (str.isspace), written as a regex class both
# Java regex and RE2 understand.
WS_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# characters a product name may keep (see constants.NAME_KEEP_RANGES)
KEEP_CLASS = "".join(r"\x{%X}-\x{%X}" % (lo, hi) for lo, hi in K.NAME_KEEP_RANGES)
# all others; Java searches a class of ranges several times as fast as a negated one
DROP_CLASS = "".join(r"\x{%X}-\x{%X}" % (hi + 1, lo - 1) for (_, hi), (lo, _) in zip(
    [(0, -1), *K.NAME_KEEP_RANGES], [*K.NAME_KEEP_RANGES, (0x110000, 0)]) if hi + 1 < lo)
# printable ASCII words with one space between them: nothing to strip, collapse or drop
PLAIN_TEXT = r"^[!-~]++(?: [!-~]++)*+\z"


def round_n(c: Column, digits: int) -> Column:
    scale = 10 ** digits
    return F.floor(c * F.lit(float(scale)) + F.lit(0.5)) / F.lit(float(scale))


def round2(c: Column) -> Column:
    return round_n(c, 2)


def round4(c: Column) -> Column:
    return round_n(c, 4)


def price_change(cur: Column, prev: Column) -> Column:
    """Absolute change; NULL when there is no previous price."""
    return round2(cur - prev)


def price_change_pct(cur: Column, prev: Column) -> Column:
    """Percent change; NULL when there is no previous price or it is 0."""
    return round2((cur - prev) / F.nullif(prev, F.lit(0.0)) * F.lit(100.0))


def iso_weekday(ts: Column) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return (F.weekday(ts) + F.lit(1)).cast("int")


def weekday_name(day_no: Column, names: dict[int, str] | None = None) -> Column:
    names = names or K.WEEKDAY_NAMES
    m = F.create_map(*[x for k, v in sorted(names.items()) for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, day_no)


# the same whitespace as literal characters (for TRIM, which needs no regex)
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing whitespace (Python's definition)."""
    return F.trim(c, F.lit(WS_CHARS))


def _capital_first(cleaned: Column, finish) -> Column:
    """``finish`` of a cleaned text with its first character in upper case.  The text is
    bound to a lambda variable, so that the chain of expressions that cleans it runs once
    a row though it is used twice."""
    return F.transform(F.array(cleaned), lambda s: finish(F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))))[0]


def _kept_text(c: Column) -> Column:
    """strip -> collapse whitespace -> drop code points < 32 -> drop characters outside the
    kept ranges (which hold all printable ASCII, so a plain text stays as it is)."""
    text = c.cast("string")
    s = F.regexp_replace(strip_ws(text), f"{WS_CLASS}+", " ")
    # code points < 32 lie outside the kept ranges, so the control-character
    # step and the kept-ranges step are one deletion pass
    return F.when(text.rlike(PLAIN_TEXT), text).otherwise(F.regexp_replace(s, f"[{DROP_CLASS}]", ""))


def clean_name(c: Column, max_chars: int = K.NAME_MAX_CHARS) -> Column:
    """Cleaning-side name normaliser; returns '' for names that must be dropped.

    strip -> collapse whitespace -> drop code points < 32 -> drop characters outside
    the kept ranges -> upper-case the first character only -> first ``max_chars``.
    Over a table's rows use ``with_clean_name``.
    """
    return _capital_first(_kept_text(c), lambda x: F.substring(x, 1, max_chars))


def listing_name(c: Column, max_chars: int = K.LISTING_NAME_MAX) -> Column:
    """Extraction-side name normaliser: trim, one space between words, no
    control characters, first character upper-cased, long names cut to
    ``max_chars - 3`` characters plus '...'."""
    s = F.regexp_replace(F.regexp_replace(strip_ws(c), f"{WS_CLASS}+", " "), r"[\x{0}-\x{1F}]", "")
    cut = lambda x: F.when(F.length(x) > max_chars, F.concat(F.substring(x, 1, max_chars - 3), F.lit("..."))).otherwise(x)
    return F.transform(F.array(_capital_first(s, lambda x: x)), cut)[0]


_NUMBER_RE = r"^[+-]?[0-9]+(\.[0-9]*)?$|^[+-]?\.[0-9]+$"


def parse_price(c: Column, markers: list[str] | None = None) -> Column:
    """Multi-locale price text -> double, NULL when empty, unparsable or <= 0.

    Both ',' and '.': the later one is the decimal mark.  Only ',': a single
    comma followed by at most two characters is decimal, otherwise thousands.
    Only '.': plain decimal number.
    """
    s = c
    for m in (markers or K.PRICE_MARKERS):
        s = F.replace(s, F.lit(m), F.lit(""))
    s = strip_ws(s)
    has_comma = F.instr(s, ",") > 0
    has_dot = F.instr(s, ".") > 0
    rev = F.reverse(s)
    comma_last = F.instr(rev, ",") < F.instr(rev, ".")
    n_commas = F.length(s) - F.length(F.replace(s, F.lit(","), F.lit("")))
    tail = F.substring_index(s, ",", -1)
    no_comma = F.replace(s, F.lit(","), F.lit(""))
    comma_as_dot = F.replace(s, F.lit(","), F.lit("."))
    normalised = (
        F.when(has_comma & has_dot,
               F.when(comma_last, F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
               .otherwise(no_comma))
        .when(has_comma,
              F.when((n_commas == 1) & (F.length(tail) <= 2), comma_as_dot).otherwise(no_comma))
        .otherwise(s))
    value = F.when(normalised.rlike(_NUMBER_RE), normalised.cast("double"))
    return F.when(value > 0, value)


def join_price_parts(int_part: Column, cents: Column) -> Column:
    """Integer and cents text joined as '<int>.<cents>' when both are present."""
    return F.when(cents.isNotNull() & (cents != "") & int_part.isNotNull(),
                  F.concat_ws(".", int_part, cents)).otherwise(int_part)


def absolutize_url(url: Column, base: Column) -> Column:
    return F.when(url.startswith("/"), F.concat(base, url)).otherwise(url)


def by_store(store_key: Column, rule, rules: dict | None = None) -> Column:
    """``rule(rules of the store)`` of each row's own store; NULL for an unknown store."""
    out = F.lit(None)
    for key, r in (rules or K.STORE_RULES).items():
        out = F.when(store_key == key, rule(r)).otherwise(out)
    return out


def _canonical(url: Column, r: dict) -> Column:
    no_frag = F.substring_index(url, "#", 1)
    base = F.substring_index(no_frag, "?", 1)
    if r["tracking"] is None:
        return F.when(F.instr(url, r["keep_query"]) > 0, url).otherwise(base)
    query = F.when(F.instr(no_frag, "?") > 0, F.substring(no_frag, F.instr(no_frag, "?") + 1, 1 << 30))
    keys = F.array(*[F.lit(k + "=") for k in r["tracking"]])
    keep = F.filter(F.split(query, "&"), lambda p: ~F.exists(keys, lambda k: p.startswith(k)))
    out = F.when(query.isNull(), no_frag).when(F.size(keep) > 0, F.concat(base, F.lit("?"), F.array_join(keep, "&"))).otherwise(base)
    item = F.regexp_extract(no_frag, r["item_url"], 1)
    return F.when(item != "", item).otherwise(out)


def canonical_url(url: Column, store_key: Column, rules: dict | None = None) -> Column:
    """Each store's own way: the fragment goes; item urls keep their path only; other urls
    lose the query parameters whose key the store lists (exact ``key=`` match), or their
    whole query."""
    return by_store(store_key, lambda r: _canonical(url, r), rules)


def _sku(url: Column, rules: list[tuple[str, str]]) -> Column:
    out = F.lit(None).cast("string")
    for pat, prefix in reversed(rules):
        g = F.regexp_extract(url, pat, 1)
        out = F.when(g != "", F.concat(F.lit(prefix), g)).otherwise(out)
    return out


def extract_sku(url: Column, store_key: Column, rules: dict | None = None) -> Column:
    """The first sku rule of the row's store whose pattern matches: prefix + first group."""
    return by_store(store_key, lambda r: _sku(url, r["sku"]), rules)


def mark_pattern(mark: str) -> str:
    """A regular expression for a page element given as tag.class, tag#id, #id or
    tag[attribute*='text']."""
    import re
    tag, kind, value = re.fullmatch(r"([a-z]*)([.#\[])(.*)", mark).groups()
    open_tag = f"<{tag or '[a-z0-9]+'}[^>]* "
    if kind == ".":
        return f'{open_tag}class="([^"]* )?{re.escape(value)}( [^"]*)?"'
    if kind == "#":
        return f'{open_tag}id="{re.escape(value)}"'
    attribute, text = re.fullmatch(r"([a-z]+)\*='(.*)'\]", value).groups()
    return f'{open_tag}{attribute}="[^"]*{re.escape(text)}'


def has_mark(html: Column, marks: list[str]) -> Column:
    if not marks:
        return F.lit(False)
    return html.rlike("|".join(mark_pattern(m) for m in marks))


def clamp(c: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(lo, F.least(hi, c))


def in_range(price: Column, lo: Column, hi: Column) -> Column:
    """Inclusive range check; an unknown range (NULL bounds) accepts every price."""
    return F.when(lo.isNull() | hi.isNull(), F.lit(True)).otherwise(price.between(lo, hi))


def parse_scraped_at(c: Column, default: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"), default)


def null_if_blank(c: Column) -> Column:
    return F.when(F.length(F.trim(c)) > 0, c)


def contains_any(text: Column, phrases: list[str]) -> Column:
    """True when any phrase occurs in ``text`` (phrases matched literally)."""
    if not phrases:
        return F.lit(False)
    return F.exists(F.array(*[F.lit(p) for p in phrases]), lambda p: F.instr(text, p) > 0)


def with_computed(df, cols: dict):
    """Add expensive computed columns exactly once.

    Catalyst substitutes a projected expression into every later filter that
    mentions it (filter push-down through projections), so a regex chain
    followed by ``filter(length(name) > 0)`` would run twice per row.  A
    one-element ``inline`` (a Generate node) keeps the computation in one place:
    filters on its output cannot be pushed below it.  Returns the columns of
    ``df`` not in ``cols`` followed by the new columns."""
    struct = F.struct(*[c.alias(n) for n, c in cols.items()])
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, F.inline(F.array(struct)))


def with_clean_name(df, col: str, max_chars: int = K.NAME_MAX_CHARS, more: dict | None = None):
    """``with_computed`` of ``clean_name`` and of the columns ``more``.  A lambda function would
    leave the whole step to interpreted expressions, so the first character is raised behind
    the computed column, where using it twice costs no second cleaning."""
    d = with_computed(df, {col: _kept_text(F.col(col)), **(more or {})})
    raised = F.concat(F.upper(F.substring(col, 1, 1)), F.substring(col, 2, 1 << 30))
    return d.withColumn(col, F.substring(raised, 1, max_chars))
