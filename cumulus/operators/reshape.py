"""Renames, casts, stamps and panel construction."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, Window, functions as F

from .. import constants as K


def rename_columns(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename by name; new names may hold spaces, '%', '.' (quoted as needed)."""
    return df.withColumnsRenamed(mapping)


def regex_rename(df: DataFrame, pattern: str, columns=None, missing: str = "NA") -> DataFrame:
    """Rename ``columns`` (default: all but the first) to their first match of
    ``pattern``; a name without a match becomes ``missing``."""
    cols = df.columns[1:] if columns is None else list(columns)
    mapping = {}
    for c in cols:
        m = re.search(pattern, c)
        mapping[c] = m.group(0) if m else missing
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


# Letters that Unicode does not take apart into a letter and its mark.
LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l",
           "ı": "i", "Æ": "AE", "Œ": "OE", "Ø": "O", "Đ": "D", "Ð": "D", "Þ": "Th", "Ł": "L"}


def snake_name(name: str) -> str:
    """'Total Doses Delivered' → 'total_doses_delivered'; '% of X' → 'percent_of_x';
    letters with marks lose them, and what has no Latin letter is left out."""
    s = name.replace("%", " percent ").replace("+", " plus ")
    s = unicodedata.normalize("NFKD", "".join(LETTERS.get(c, c) for c in s))
    s = "".join(c for c in s if not unicodedata.combining(c))
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    return s or "x"


def unique_names(names) -> list[str]:
    """Names made different: a name that is taken gets the first free of ``_2``, ``_3`` …

    A name that none clashes with before it stays as it is, also one that ends in ``_2``."""
    taken, out = set(), []
    for name in names:
        new, n = name, 1
        while new in taken:
            n += 1
            new = f"{name}_{n}"
        taken.add(new)
        out.append(new)
    return out


def snake_names(df: DataFrame, names=None) -> DataFrame:
    """Clean every column name, no two alike (or set them positionally from ``names``)."""
    new = list(names) if names is not None else unique_names(snake_name(c) for c in df.columns)
    return df.toDF(*new)


def cast_by_pattern(df: DataFrame, pattern: str, to: str = "double") -> DataFrame:
    """try_cast every column whose name contains ``pattern`` (case-sensitive)."""
    return df.select(*[(F.col(f"`{c}`").try_cast(to).alias(c) if pattern in c
                        else F.col(f"`{c}`")) for c in df.columns])


def stamp_date(df: DataFrame, as_of, col: str = "date") -> DataFrame:
    """Add the run date to every row."""
    v = as_of if not isinstance(as_of, str) else F.lit(as_of).cast("date")
    if hasattr(v, "isoformat"):
        v = F.lit(v)
    return df.withColumn(col, v)


def canonical_value(col: str, mapping: dict):
    """Column with mapped values replaced (``{"New York State": "New York"}``)."""
    out = None
    for old, new in mapping.items():
        out = (F.when(F.col(col) == old, F.lit(new)) if out is None
               else out.when(F.col(col) == old, F.lit(new)))
    return out.otherwise(F.col(col)) if out is not None else F.col(col)


def normalise_snapshot(records: DataFrame, names=K.CANONICAL_NAMES) -> DataFrame:
    """Feed records → snapshot rows: text date → date, canonical names."""
    return (records.withColumn("Date", F.to_date("Date"))
                   .withColumn("LongName", canonical_value("LongName", names)))


def cumulative_panel(daily: DataFrame, keys, date_col: str, measures,
                     densify: bool = True) -> DataFrame:
    """Daily increments → cumulative snapshots, one row per key and date.

    With ``densify`` every key gets a row for each day from its first day to
    the latest day of the whole input (cumulative values carry forward), as a
    snapshot feed reports every jurisdiction every day.  One per-key window
    gives the running sums and the key's next active day; each active row is
    then exploded over the days until that next day (``sequence`` +
    ``explode``: no cross join, no second pass over the input).  A key's window
    holds one row per active day, however skewed the raw rows were.  Rows
    without a date are dropped.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(date_col)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = daily.select(*keys, date_col,
                       *[F.sum(F.coalesce(F.col(m), F.lit(0))).over(run).alias(m)
                         for m in measures],
                       F.lead(date_col).over(w).alias("__next"))
    if not densify:
        return cum.drop("__next")
    last = daily.select(F.max(date_col)).scalar()
    end = F.coalesce(F.date_sub(F.col("__next"), 1), last)
    return cum.select(*keys, F.explode(F.sequence(F.col(date_col), end)).alias(date_col),
                      *measures)
