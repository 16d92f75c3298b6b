"""Collection-side price parsing (dialect B) and its helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .cleaning import _col


def _count_char(s: Column, ch: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))


def parse_price_locale(c, on_fail: float | None = None, strip_prefix: bool = False) -> Column:
    """Price text -> double, the collection dialect.

    First run of ``[0-9.,]``.  Both separators: the later one is the decimal
    mark.  Only commas: a single comma followed by exactly three digits is a
    thousands mark, otherwise commas are decimal marks.  Only dots: a single
    dot followed by exactly three digits is a thousands mark.  Failure gives
    ``on_fail`` (null for HTML sources, 0.0 for API / model sources).
    ``strip_prefix`` removes a leading "ab" / "from" first (P6).
    """
    s = F.replace(_col(c).cast("string"), F.lit(K.NBSP), F.lit(" " if on_fail is None else ""))
    s = F.trim(s)
    if strip_prefix:
        s = F.regexp_replace(s, K.PRICE_PREFIX_PATTERN, "")
    tok = F.regexp_extract(s, K.PRICE_TOKEN_PATTERN, 0)
    has_c = F.instr(tok, ",") > 0
    has_d = F.instr(tok, ".") > 0
    # position of the last comma / dot, from the right
    last_c = F.length(tok) - F.instr(F.reverse(tok), ",")
    last_d = F.length(tok) - F.instr(F.reverse(tok), ".")
    n_c = _count_char(tok, ",")
    n_d = _count_char(tok, ".")
    tail3_c = (n_c == 1) & tok.rlike(r",[0-9]{3}$")
    tail3_d = (n_d == 1) & tok.rlike(r"\.[0-9]{3}$")
    drop_dots_comma_dec = F.replace(F.replace(tok, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    drop_commas = F.replace(tok, F.lit(","), F.lit(""))
    norm = (F.when(has_c & has_d,
                   F.when(last_c > last_d, drop_dots_comma_dec).otherwise(drop_commas))
             .when(has_c, F.when(tail3_c, drop_commas).otherwise(F.replace(tok, F.lit(","), F.lit("."))))
             .when(has_d, F.when(tail3_d, F.replace(tok, F.lit("."), F.lit(""))).otherwise(tok))
             .otherwise(tok))
    v = F.when(tok != "", norm.try_cast("double"))
    if on_fail is None:
        return v
    return F.coalesce(v, F.lit(float(on_fail)))


def variant_number(v: Column) -> Column:
    """The value of a JSON number (or boolean), null for anything else."""
    kind = F.schema_of_variant(v)
    number = F.try_variant_get(v, "$", "double")
    return F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), number) \
            .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int").cast("double"))


def variant_text(v: Column) -> Column:
    """A JSON value as text; null for null, objects and arrays."""
    return F.try_variant_get(v, "$", "string")


def parse_price_api(c, dtype: T.DataType | None = None) -> Column:
    """API / model dialect: numbers pass through; of text the prefix is stripped; 0.0 on failure.

    ``dtype`` of the column says what it holds: numbers, text, or (VARIANT) either, as the JSON had it."""
    x = _col(c)
    if isinstance(dtype, T.NumericType):
        return F.coalesce(x.cast("double"), F.lit(0.0))
    if isinstance(dtype, T.VariantType):
        text = parse_price_locale(variant_text(x), on_fail=0.0, strip_prefix=True)
        return F.coalesce(variant_number(x), text)
    return parse_price_locale(x, on_fail=0.0, strip_prefix=True)


def price_given(c, dtype: T.DataType | None = None) -> Column:
    """Whether a price is there at all: not null, not blank text and not zero."""
    x = _col(c)
    if isinstance(dtype, T.VariantType):
        number = variant_number(x)
        return F.when(number.isNotNull(), number != 0).otherwise(F.coalesce(variant_text(x), F.lit("")) != "")
    if isinstance(dtype, T.NumericType):
        return F.coalesce(x != 0, F.lit(False))
    return F.coalesce(x.cast("string"), F.lit("")) != ""


def price_from_snippet(snippet) -> Column:
    """First ``[ab] <number> €|EUR`` in a snippet -> dialect B; none -> 0.0."""
    m = F.regexp_extract(_col(snippet), K.SNIPPET_PRICE_PATTERN, 1)
    return F.when(m != "", parse_price_locale(m, on_fail=0.0, strip_prefix=True)).otherwise(F.lit(0.0))


def token_cost(input_tokens, output_tokens) -> Column:
    """USD cost of a model call."""
    return (_col(input_tokens) * F.lit(K.INPUT_COST_PER_M)
            + _col(output_tokens) * F.lit(K.OUTPUT_COST_PER_M)) / F.lit(1_000_000.0)


def cost_per_product(cost, found) -> Column:
    """cost / found rounded to 6 places; 0 when nothing was found."""
    f = _col(found)
    q = (_col(cost) / f).cast("decimal(38,12)")
    return F.when(f == 0, F.lit(0.0)).otherwise(F.round(q, 6).cast("double"))
