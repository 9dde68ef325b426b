"""Text standardisation as native Column expressions (ST01-ST07).

Each rule turns a messy text column into a typed column with JVM-side string
functions only (regexp_replace / regexp_extract / try_cast), so the rules stay
inside whole-stage codegen and filters on their output can still be pushed
around by Catalyst. ``standardize`` applies a set of rules to a whole table in
one projection and counts rejects (text present, result NULL) with ``observe``.

Semantics follow the reference's per-row parsers:
* text is stripped of Python ``str.strip()`` whitespace, not only the space;
* a number is accepted when Python ``float()`` would accept it (sign, digits
  with single underscores, optional point, exponent, inf/nan); other text is NULL;
* ASCII digits only (the reference also took other Unicode decimal digits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The characters Python's str.isspace() treats as whitespace,
# written as a Java regex character class:
# tab, line feed, vertical tab, form feed, carriage return, the four information
# separators U+001C-U+001F, space, U+0085, no-break space U+00A0, U+1680,
# U+2000-U+200A, line separator U+2028, paragraph separator U+2029, U+202F,
# U+205F, ideographic space U+3000.
WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# The currency sign removed from amounts and the marker that
# flags an all-in rent.
EURO = "€"
UTILITIES_MARK = "utilities incl"

_DIGITS = r"[0-9](?:_?[0-9])*"
# Python float() grammar, ASCII digits only; float() itself ignores surrounding
# whitespace, so the capture group is the number and whitespace may surround it.
FLOAT_TEXT = (
    rf"\A{WS}*([+-]?(?:(?:(?:{_DIGITS})(?:\.(?:{_DIGITS})?)?|\.(?:{_DIGITS}))"
    rf"(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity|nan)))\z"
)
_FLOAT_CAPTURE = FLOAT_TEXT[:-2] + rf"{WS}*\z"


def _present(c: Column) -> Column:
    """Text given (not NULL, not empty): the reference treats both as missing."""
    return c.isNotNull() & (c != F.lit(""))


def _drop(c: Column, chars: str, by: str = "") -> Column:
    """Plain substring replacement (no regex)."""
    return F.replace(c, F.lit(chars), F.lit(by))


def _float_or_null(c: Column) -> Column:
    """Python ``float(text)`` semantics as one regex and a cast; invalid → NULL.

    No match extracts '' and ``try_cast('')`` is NULL, so the input is used
    once: a Filter gets no common-subexpression elimination, and a repeated
    input would re-run the whole chain.
    """
    return _drop(F.regexp_extract(c, _FLOAT_CAPTURE, 1), "_").try_cast("double")


def rent_amount(c: Column) -> Column:
    """ST01: '€ 1.250,-  Utilities incl.' → 1250.0.

    Reference steps: drop the euro sign, strip, cut from ',-' (and the
    whitespace before it) to the end of the line, strip, drop '.' thousands
    marks, float(). float() ignores surrounding whitespace, so the strips and
    the whitespace before ',-' need no pass of their own: one regex cut, two
    plain replacements and the float parse. NULL or empty text gives NULL.
    """
    t = F.regexp_replace(_drop(c.cast("string"), EURO), r",-[^\n]*", "")
    return _float_or_null(_drop(t, "."))


def rent_utilities(c: Column) -> Column:
    """ST02: True when the rent text says utilities are included; never NULL."""
    c = c.cast("string")
    return F.coalesce(F.lower(c).contains(UTILITIES_MARK), F.lit(False))


def postal_pc4(c: Column) -> Column:
    """ST03: leading four digits after whitespace, first digit 1-9; else NULL."""
    c = c.cast("string")
    return F.nullif(F.regexp_extract(c, rf"\A{WS}*([1-9][0-9]{{3}})", 1), F.lit(""))


def area_sqm(c: Column) -> Column:
    """ST04: first number anywhere in the text ('14 m2' → 14.0, '1.250 m2' → 1.25)."""
    c = c.cast("string")
    return F.regexp_extract(c, r"([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")


def capacity(c: Column) -> Column:
    """ST05: first integer in the text; beyond 32 bits → NULL."""
    c = c.cast("string")
    return F.regexp_extract(c, r"([0-9]+)", 1).try_cast("int")


def deposit_amount(c: Column) -> Column:
    """ST06: European decimal comma: '€ 1.250,50' → 1250.5; '€ 500,-' → NULL (kept).

    Reference steps: drop the euro sign, strip, drop '.', turn ',' into '.',
    float(); the strip is implied by float().
    """
    t = _drop(_drop(_drop(c.cast("string"), EURO), "."), ",", ".")
    return _float_or_null(t)


def price_outlier(c: Column, lo: float = 10.0, hi: float = 2000.0) -> Column:
    """ST07: outside [lo, hi] or NULL → True. NaN counts as an outlier."""
    return F.coalesce((c < F.lit(lo)) | (c > F.lit(hi)), F.lit(True))


RULES = {
    "rent_amount": rent_amount,
    "rent_utilities": rent_utilities,
    "postal_pc4": postal_pc4,
    "area_sqm": area_sqm,
    "capacity": capacity,
    "deposit_amount": deposit_amount,
    "price_outlier": price_outlier,
}


def standardize(df: DataFrame, spec: dict[str, tuple[str, str]],
                observation: Observation | None = None) -> DataFrame:
    """Apply rules to whole columns in one projection.

    ``spec`` maps output column → (rule name, input column). When an
    ``Observation`` is given, it records per output column the number of rows
    whose input text was present but did not parse (``rejects_<out>``); the
    counts arrive with the first action on the result, no extra pass.
    """
    cols = {out: RULES[rule](F.col(src)) for out, (rule, src) in spec.items()}
    out = df.withColumns(cols)
    if observation is not None:
        metrics = [
            F.count_if(_present(F.col(src).cast("string")) & F.col(o).isNull()).alias(f"rejects_{o}")
            for o, (rule, src) in spec.items() if rule not in ("rent_utilities", "price_outlier")
        ]
        metrics.append(F.count(F.lit(1)).alias("rows"))
        out = out.observe(observation, *metrics)
    return out
