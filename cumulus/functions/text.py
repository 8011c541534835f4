"""Display strings and text parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import as_col

# Unicode White_Space, spelled out so the same class works in every regex
# engine (Java's \s misses NBSP and friends).
WS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
TRIM_PATTERN = rf"\A{WS}+|{WS}+\z"


def str_trim(c) -> Column:
    """Remove leading and trailing white space (whole string, any length)."""
    return F.regexp_replace(as_col(c), TRIM_PATTERN, "")


def thousands(c) -> Column:
    """Whole number → '3,605,561'."""
    return F.format_number(as_col(c).cast("bigint"), 0)


def parse_thousands(c) -> Column:
    """'  3,605,561' → 3605561; NULL when not a number."""
    return F.regexp_replace(str_trim(c), ",", "").try_cast("bigint")


def display_string(c) -> Column:
    """Number → its plain text, not rounded ('28650', '42857.4'); nine decimals
    at most, which drops the noise of a product of doubles."""
    text = as_col(c).cast("decimal(38,9)").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


def first_match(c, pattern: str) -> Column:
    """First substring matching ``pattern``; NULL when there is none."""
    return F.regexp_substr(as_col(c), F.lit(pattern))


def band_label(c, edges, prefix: str = "Band_", suffix: str = "") -> Column:
    """Numeric value → band name like 'Band_25-39'; last band is open ('75+')."""
    c = as_col(c)
    out = None
    for i, lo in enumerate(edges):
        hi = edges[i + 1] if i + 1 < len(edges) else None
        name = (f"{prefix}{lo:02d}-{hi - 1:02d}{suffix}" if hi is not None
                else f"{prefix}{lo:02d}+{suffix}")
        pred = (c >= lo) & (c < hi) if hi is not None else (c >= lo)
        out = F.when(pred, name) if out is None else out.when(pred, name)
    return out
