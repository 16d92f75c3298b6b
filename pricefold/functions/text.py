"""Text predicates and projections used by collection, matching and reporting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .cleaning import _col


# ---------------------------------------------------------------- P8 / P9
def strip_title_suffix(title) -> Column:
    """Remove a `` | ...`` suffix from a result title, then trim."""
    return F.trim(F.regexp_replace(_col(title), K.TITLE_SUFFIX_PATTERN, ""))


def domain_filter(title, url, domain: str = K.ORGANIC_DOMAIN) -> Column:
    """Non-empty title and ``domain`` inside the lower-cased URL."""
    return (F.coalesce(F.trim(_col(title)), F.lit("")) != "") & \
        F.lower(F.coalesce(_col(url), F.lit(""))).contains(domain)


# ---------------------------------------------------------------- P11
def availability_from_price(price, otherwise: str = "out_of_stock") -> Column:
    """in_stock when the price is truthy (non-null, non-zero), else ``otherwise``."""
    p = _col(price)
    return F.when(p.isNotNull() & (p != 0), F.lit("in_stock")).otherwise(F.lit(otherwise))


# ---------------------------------------------------------------- P15 / P16
def is_blocked_page(html) -> Column:
    h = F.coalesce(_col(html), F.lit(""))
    return (F.length(h) < K.BLOCKED_PAGE_MAX_LEN) & h.contains(K.BLOCKED_PAGE_MARKER)


def relevance_window(text) -> Column:
    """Slice around the first indicator found, indicators tried in list order.

    Start = max(0, pos - 200) (0-based), length 5000; none found -> head.
    """
    t = F.coalesce(_col(text), F.lit(""))
    out = None
    for ind in K.WINDOW_INDICATORS:
        pos = F.instr(t, ind)  # 1-based, 0 when absent
        start0 = F.greatest(pos - 1 - K.WINDOW_BACKOFF, F.lit(0))
        piece = F.substr(t, start0 + 1, F.lit(K.WINDOW_CHARS))
        branch = F.when(pos > 0, piece)
        out = branch if out is None else F.coalesce(out, branch)
    return F.coalesce(out, F.substr(t, F.lit(1), F.lit(K.WINDOW_CHARS)))


# ---------------------------------------------------------------- P19
def search_url(template, query, name=None) -> Column:
    """Fill ``{query}`` with the form-encoded query (falls back to the name).

    Spark's ``url_encode`` and Python's ``quote_plus`` differ on two
    characters: ``*`` (left by Spark, encoded by Python) and ``~`` (the
    reverse); both are corrected.
    """
    q = F.coalesce(_col(query), _col(name) if name is not None else F.lit(None), F.lit(""))
    enc = F.url_encode(q)
    enc = F.replace(F.replace(enc, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.replace(_col(template), F.lit("{query}"), enc)


# ---------------------------------------------------------------- P20
def is_accessory(text, intended_display_part: bool = False) -> Column:
    t = F.coalesce(_col(text), F.lit(""))
    disp = K.DISPLAY_PART_PATTERN_INTENDED if intended_display_part else K.DISPLAY_PART_PATTERN
    return t.rlike(K.ACCESSORY_PATTERN) | t.rlike(disp)


# ---------------------------------------------------------------- P21
def token_signature(text) -> Column:
    """Distinct ``[a-z0-9]+`` tokens of the lower-cased text."""
    return F.array_distinct(
        F.regexp_extract_all(F.lower(F.coalesce(_col(text), F.lit(""))), F.lit(K.TOKEN_PATTERN), 1))


# ---------------------------------------------------------------- P22
def fuzzy_normalize(text) -> Column:
    """Non letters/digits -> space, trim, lowercase (the fuzzy pre-processor)."""
    s = F.regexp_replace(F.coalesce(_col(text), F.lit("")), r"[^\p{L}\p{N}]", " ")
    return F.lower(F.regexp_replace(s, r"^(?U)\s+|(?U)\s+$", ""))


# ---------------------------------------------------------------- P23 / P24
def dedupe_tokens(text) -> Column:
    """Split on whitespace, keep the first spelling of each token (case-insensitive)."""
    toks = F.filter(F.split(_col(text), r"(?U)\s+"), lambda t: t != "")
    low = F.transform(toks, lambda t: F.lower(t))
    kept = F.filter(toks, lambda t, i: F.array_position(low, F.lower(t)) == i + 1)
    return F.array_join(kept, " ")


def strip_spec_noise(name, category) -> Column:
    """Spec-noise removal before encoding: pattern 1 always, pattern 2 for
    laptop / phone; squeeze, trim, dedupe tokens."""
    n = F.coalesce(_col(name), F.lit(""))
    s = F.regexp_replace(n, K.SPEC_NOISE_PATTERN, " ")
    s = F.when(_col(category).isin(*K.COMPONENT_NOISE_CATEGORIES),
               F.regexp_replace(s, K.COMPONENT_NOISE_PATTERN, " ")).otherwise(s)
    s = F.regexp_replace(s, K.MULTI_SPACE_PATTERN, " ")
    s = F.regexp_replace(s, r"^(?U)\s+|(?U)\s+$", "")
    return dedupe_tokens(s)


def encoder_text(name, category) -> Column:
    """Noise-stripped text, falling back to the name when nothing is left."""
    s = strip_spec_noise(name, category)
    return F.coalesce(F.nullif(s, F.lit("")), F.coalesce(_col(name), F.lit("")))


# ---------------------------------------------------------------- P25
def non_blank(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


# ---------------------------------------------------------------- P26
def sanitize(col_name: str, dtype: T.DataType) -> Column:
    """NaN / +-Inf -> null recursively; timestamps -> ISO text."""
    return _sanitize_expr(F.col(col_name), dtype).alias(col_name)


def _sanitize_expr(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
    if isinstance(dtype, T.TimestampType) or isinstance(dtype, T.TimestampNTZType):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda e: _sanitize_expr(e, dtype.elementType))
    if isinstance(dtype, T.StructType):
        if not dtype.fields:
            return c
        return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*[
            _sanitize_expr(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]))
    return c


def sanitize_frame(df):
    return df.select(*[sanitize(f.name, f.dataType) for f in df.schema.fields])


# ---------------------------------------------------------------- P29 / P30
def run_status(success, error_message, products_found) -> Column:
    err = F.coalesce(_col(error_message), F.lit(""))
    short = F.when(F.char_length(err) > K.STATUS_ERROR_CHARS,
                   F.concat(F.substr(err, F.lit(1), F.lit(K.STATUS_ERROR_CHARS)), F.lit(K.STATUS_ELLIPSIS)))\
             .otherwise(err)
    return F.when(~_col(success), F.concat(F.lit("FAIL "), short))\
            .when(_col(products_found) == 0, F.lit("OK / 0 results"))\
            .otherwise(F.lit("OK"))


def display_name(source_key) -> Column:
    """``_`` -> space, then title case."""
    return F.initcap(F.replace(_col(source_key), F.lit("_"), F.lit(" ")))


# ---------------------------------------------------------------- P33
def coverage_filter(seller, url, site: str) -> Column:
    s = site.lower()
    return F.lower(F.coalesce(_col(seller), F.lit(""))).contains(s) | \
        F.lower(F.coalesce(_col(url), F.lit(""))).contains(s)
