"""Column expressions for the cleaning steps (category, name, price, availability).

All of these are JVM-side expressions (codegen'd), except the NFKC step of the
name normaliser, which has no Spark built-in and runs as an Arrow pandas UDF
on non-ASCII rows only.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


# ---------------------------------------------------------------- P1 / P32
def normalize_category(c, mapping: dict | None = None) -> Column:
    """null -> '', lowercase, mapped through ``mapping``; unknown passes through."""
    low = F.lower(F.coalesce(_col(c), F.lit("")))
    m = map_literal(mapping or K.CATEGORY_MAP)
    return F.coalesce(F.try_element_at(m, low), low)


def category_fallback(df, col: str = "category", fallback: str = "_category"):
    """Use ``_category`` when ``category`` is absent."""
    if col in df.columns:
        return df
    if fallback in df.columns:
        return df.withColumn(col, F.col(fallback))
    return df.withColumn(col, F.lit(None).cast("string"))


# ---------------------------------------------------------------- P2 / P28
@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode NFKC normalisation (no Spark built-in exists)."""
    return s.map(lambda v: unicodedata.normalize("NFKC", v) if isinstance(v, str) else None)


def clean_name(c, use_nfkc: bool = True) -> Column:
    """Name normalisation, same result as the reference order:

    blank -> ''; tags -> space; NFKC; hyphen family -> '-'; characters outside
    word/space/``-.,"/'()`` -> space; lowercase; collapse whitespace; trim.

    Two regex passes instead of five: the hyphen family is a ``translate``;
    dropping and whitespace collapsing are one replace of every run of
    characters outside the keep class (whitespace is outside it too) by one
    space; a blank input ends up empty by the same steps.  Texts without ``<``
    skip the tag pass, ASCII texts (as many bytes as characters) NFKC and ``translate``.
    """
    raw = F.coalesce(_col(c), F.lit(""))
    s = F.when(raw.contains("<"), F.regexp_replace(raw, K.HTML_TAG_PATTERN, " ")).otherwise(raw)
    wide = F.when(F.octet_length(s) != F.char_length(s), s)
    wide = nfkc(wide) if use_nfkc else wide
    s = F.coalesce(F.translate(wide, K.HYPHEN_CHARS, "-" * len(K.HYPHEN_CHARS)), s)
    s = F.regexp_replace(s, K.DROP_RUN_PATTERN, " ")
    return F.trim(F.lower(s))


def blank_to_null(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


# ---------------------------------------------------------------- P3
def _price_text_dialect_a(text: Column) -> Column:
    t = F.replace(text, F.lit(K.NBSP), F.lit(""))
    tok = F.regexp_extract(t, K.PRICE_TOKEN_PATTERN, 0)
    german = tok.rlike(r",[0-9]{2}$")
    normal = F.when(german, F.replace(F.replace(tok, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))\
              .otherwise(F.replace(tok, F.lit(","), F.lit("")))
    v = normal.try_cast("double")
    return F.when((tok != "") & (v >= 0), v)


def price_number(d: Column) -> Column:
    """A numeric price: kept when >= 0, else null (NaN too)."""
    d = d.cast("double")
    return F.when(~F.isnan(d) & (d >= 0), d)


def parse_price_clean(c, dtype: T.DataType | None = None, number=None) -> Column:
    """Cleaning-side price parse.

    Numbers >= 0 are kept (NaN and negatives -> null).  Text, whatever it looks
    like: NBSP removed, first run of ``[0-9.,]``; a trailing ``,dd`` means
    German decimals (dots dropped, comma -> dot), otherwise commas are dropped;
    unparsable -> null.  ``number`` is a column with the price where it was a
    number at its source (a JSON scan reads numbers and text into two columns).
    """
    x = _col(c)
    if dtype is not None and isinstance(dtype, T.NumericType):
        return price_number(x)
    text = _price_text_dialect_a(x.cast("string"))
    if number is None:
        return text
    return F.when(_col(number).isNotNull(), price_number(_col(number))).otherwise(text)


# ---------------------------------------------------------------- P4
def map_availability(c) -> Column:
    """In-stock pattern first, then out-of-stock, then canonical pass-through."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    low = F.lower(text)
    return F.when(text.rlike(K.IN_STOCK_PATTERN), F.lit("in_stock"))\
            .when(text.rlike(K.OUT_OF_STOCK_PATTERN), F.lit("out_of_stock"))\
            .when(low.isin(*K.CANONICAL_AVAILABILITY), low)\
            .otherwise(F.lit("unknown"))


def map_availability_negation_first(c) -> Column:
    """Variant that tests the out-of-stock phrases before the in-stock ones."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    low = F.lower(text)
    return F.when(text.rlike(K.OUT_OF_STOCK_PATTERN), F.lit("out_of_stock"))\
            .when(text.rlike(K.IN_STOCK_PATTERN), F.lit("in_stock"))\
            .when(low.isin(*K.CANONICAL_AVAILABILITY), low)\
            .otherwise(F.lit("unknown"))
