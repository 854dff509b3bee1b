"""Row-wise column expressions.

Spark 4 runs in ANSI mode by default, where a bad cast or a zero divisor stops
the job; data preparation wants a null instead, hence the ``try_`` forms.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Unit capture of an ISO-8601 duration and the unit's seconds.
DURATION_UNITS = {"([0-9]+)H": 3600, "([0-9]+)M": 60, "([0-9]+)S": 1}
# Fixed value: duration assumed when none is given.
EMPTY_DURATION = "PT0S"


def column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def snake_case(name: str) -> str:
    """``publishedAt`` -> ``published_at``, ``Like %`` -> ``like_percent``."""
    text = name.replace("%", " percent ").replace("#", " number ")
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower() or "x"
    return f"x{text}" if text[0].isdigit() else text


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case all column names; repeated names get ``_2``, ``_3``, ..."""
    taken: set[str] = set()
    names = []
    for base in map(snake_case, df.columns):
        name, ordinal = base, 1
        while name in taken:
            ordinal += 1
            name = f"{base}_{ordinal}"
        taken.add(name)
        names.append(name)
    return df.toDF(*names)


def present(text: Column) -> Column:
    """Null for empty text. A failing ``try_cast`` costs an exception, a null one nothing."""
    return F.when(text != "", text)


def leading_zero(figure: Column) -> Column:
    """Makes an empty capture read as zero and changes no other number."""
    return F.concat(F.lit("0"), figure)


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to the named types; values that do not parse become null.

    ``date`` parses timestamps too and drops the time of day.
    """
    def cast(name: str, kind: str) -> Column:
        value, source = F.col(name), df.schema[name].dataType
        if isinstance(source, StringType) and kind != "string":
            value = present(value)
            return F.try_to_date(value) if kind == "date" else value.try_cast(kind)
        return value if source.simpleString() == kind else value.try_cast(kind)

    return df.withColumns({name: cast(name, kind) for name, kind in types.items()})


def is_missing(value: str | Column, zero_is_missing: bool = False) -> Column:
    """True for null and, on request, for zero; never null itself."""
    value = column(value)
    if zero_is_missing:
        return F.coalesce(value == 0, F.lit(True))
    return value.isNull()


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient, null where the denominator is zero."""
    return F.try_divide(column(numerator), column(denominator))


def percent(part: str | Column, whole: str | Column) -> Column:
    return ratio(100 * column(part), whole)


def log10_positive(value: str | Column) -> Column:
    """Base-10 logarithm; null for values a log axis cannot show, NaN included."""
    value = column(value)
    return F.when((value > 0) & ~F.isnan(value), F.log10(value))


def duration_seconds(value: str | Column, include_days: bool = False) -> Column:
    """Seconds of an ISO-8601 duration text.

    The default reads the first hour, minute and second figure wherever they
    stand, so days are ignored (``P1DT2H`` is 7200) and months count as minutes
    (``P3M`` is 180); missing or empty text is zero. ``include_days`` reads the
    part before and after ``T`` strictly and adds days and weeks.
    """
    text = F.coalesce(column(value), F.lit(EMPTY_DURATION))
    clock = F.regexp_extract(text, "T(.*)$", 1) if include_days else text
    seconds = F.lit(0)
    for pattern, scale in DURATION_UNITS.items():
        figure = leading_zero(F.regexp_extract(clock, pattern, 1)).try_cast("int")
        seconds = seconds + F.coalesce(figure, F.lit(0)) * scale
    if include_days:
        for pattern, scale in (("^P[^T]*?([0-9]+)W", 604800), ("^P[^T]*?([0-9]+)D", 86400)):
            figure = leading_zero(F.regexp_extract(text, pattern, 1)).try_cast("int")
            seconds = seconds + F.coalesce(figure, F.lit(0)) * scale
    return seconds.cast("int")


def recode(value: str | Column, replacements: Mapping[str, str]) -> Column:
    """Replace literal values; others pass through."""
    value = column(value)
    result = value
    for old, new in replacements.items():
        result = F.when(value == old, F.lit(new)).otherwise(result)
    return result


def string_key(*parts: str | Column, sep: str = "", null_text: str = "\\N") -> Column:
    """Concatenate parts into one text key; a null part reads ``null_text``, so it differs from an empty one."""
    texts = [F.coalesce(column(part).cast("string"), F.lit(null_text)) for part in parts]
    return F.concat(*[piece for text in texts for piece in (F.lit(sep), text)][1:])


def shown(df: DataFrame, name: str) -> Column:
    """The column with NaN as null; other types than floating point pass through."""
    floating = df.schema[name].dataType.simpleString() in ("double", "float")
    return F.when(~F.isnan(name), F.col(name)) if floating else F.col(name)


def round_columns(df: DataFrame, columns: Sequence[str], digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


def hash_unit(key: str | Column, seed: str) -> Column:
    """A number in [0, 1) fixed by the key's text and the seed.

    It is the first 32 bits of an md5, so the same row gets the same number under
    any partitioning, on any retry, and in any other engine.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), column(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
