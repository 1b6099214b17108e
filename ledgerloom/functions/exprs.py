"""Column builders: trimming, strict typing, identifiers, dates, money and canonical text.

Every builder takes and returns a ``Column`` and keeps nulls unless it says otherwise.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "__UNKNOWN__"
UNCLASSIFIED = ("__UNCLASSIFIED__", "Sin clasificar", "UNKNOWN")
MONEY = "decimal(38,14)"
TOLERANCE = "0.01"
LOCAL_ZONE = "America/Lima"
# Cells that a raw archive means as missing, and Spanish calendar names.
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
DAYS = ("lunes", "martes", "miércoles", "jueves", "viernes", "sábado", "domingo")


def u_trim(c: Column) -> Column:
    """Trims Unicode white space; ``F.trim`` strips U+0020 alone."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_TOKENS), c)


def any_null(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, (c.isNull() for c in columns), F.lit(False))


def governed(c: Column, token: str = UNKNOWN) -> Column:
    """Blank and null text become the governed token."""
    return F.coalesce(F.nullif(u_trim(c), F.lit("")), F.lit(token))


def strict_decimal(c: Column, precision: int = 38, scale: int = 14) -> Column:
    """Null where the text is no decimal of at most ``scale`` fractional digits; a plain cast would round."""
    value = c.try_cast(f"decimal({precision},{scale})")
    digits = F.length(F.regexp_extract(c, r"\.([0-9]*?)0*(?:[eE][+-]?[0-9]+)?$", 1))
    return F.when(~c.rlike(r"(?i)nan|inf") & (digits <= scale), value)


def strict_integer(c: Column) -> Column:
    """Accepts 2.0 and 1e3; null for fractions and text."""
    value = c.try_cast("decimal(38,6)")
    return F.when(value % 1 == 0, value.try_cast("bigint"))


def strict_boolean(c: Column) -> Column:
    low = F.lower(u_trim(c))
    return F.when(low.isin("true", "1"), True).when(low.isin("false", "0"), False)


def parsed_timestamp(c: Column, formats: Iterable[str] = ("yyyyMMdd", "dd/MM/yyyy")) -> Column:
    """ISO 8601 first, then the listed formats; text without a zone is in the session's (UTC).

    A text such as 01/07/2026 is read day first, as its publisher writes dates.
    """
    return F.coalesce(F.try_to_timestamp(c), *(F.try_to_timestamp(c, F.lit(f)) for f in formats))


STRICT = {"integer": strict_integer, "boolean": strict_boolean, "decimal": strict_decimal, "datetime": parsed_timestamp, "string": lambda c: c}


def ruc_valid(c: Column) -> Column:
    """Eleven ASCII digits after trimming; null is false. The anchors don't let a trailing newline pass."""
    return F.coalesce(F.regexp_like(u_trim(c), F.lit(r"\A[0-9]{11}\z")), F.lit(False))


def ruc_flag(scheme: Column, identifier: Column, applicable: str = "PE-RUC") -> Column:
    """True or false where the scheme applies, else null."""
    return F.when(F.coalesce(F.upper(u_trim(scheme)) == applicable.upper(), F.lit(False)), ruc_valid(identifier))


def role_matches(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def is_zero(c: Column) -> Column:
    return F.coalesce(c == 0, F.lit(False))


def date_key(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """yyyymmdd of a UTC time in the local zone; null is 0."""
    return F.coalesce(F.date_format(F.from_utc_timestamp(ts.cast("timestamp"), zone), "yyyyMMdd").cast("int"), F.lit(0))


def rate_for(currency: Column, rate: Column, home: str = "PEN") -> Column:
    return F.when(currency == home, F.lit(1).cast("decimal(18,14)")).otherwise(rate.cast("decimal(18,14)"))


def converted(amount: Column, rate: Column) -> Column:
    """Product of bounded operands, which keeps scale 14; null if either is null or out of bounds. Rates are never invented."""
    return (amount.try_cast("decimal(24,14)") * rate.try_cast("decimal(18,14)")).cast(MONEY)


def difference(left: Column, right: Column) -> Column:
    """Difference of two amounts that keeps scale 14."""
    return left.cast("decimal(37,14)") - right.cast("decimal(37,14)")


def within(diff: Column, tolerance: str = TOLERANCE) -> Column:
    """Null is false."""
    return F.coalesce(F.abs(diff) <= F.lit(tolerance).cast("decimal(10,4)"), F.lit(False))


def percentage(part: Column, whole: Column) -> Column:
    return F.round(F.when(whole > 0, part.cast("double") / whole * 100).otherwise(F.lit(0.0)), 4)


def joined_set(c: Column, sep: str = ";") -> Column:
    """Distinct values in order, joined."""
    return F.array_join(F.sort_array(F.collect_set(c)), sep)


def calendar_columns(day: Column) -> dict[str, Column]:
    """Attributes of a date; names don't depend on the JVM's locale."""
    weekday = F.weekday(day) + 1
    name = lambda names, i: F.element_at(F.array(*map(F.lit, names)), i)
    return {
        "year_number": F.year(day),
        "semester_number": F.floor((F.month(day) - 1) / 6).cast("int") + 1,
        "quarter_number": F.quarter(day),
        "month_number": F.month(day),
        "month_name": name(MONTHS, F.month(day)),
        "year_month": F.date_format(day, "yyyy-MM"),
        "day_number": F.dayofmonth(day),
        "iso_weekday": weekday,
        "weekday_name": name(DAYS, weekday),
        "is_weekend": weekday >= 6,
    }


def fold_text(value: str | None) -> str:
    """White space collapsed, compatibility decomposition, case folded."""
    return "" if value is None else unicodedata.normalize("NFKD", " ".join(str(value).split())).casefold()


@F.pandas_udf(T.StringType())
def folded(values: pd.Series) -> pd.Series:
    """``fold_text`` over Arrow batches. No collation of Spark gives this order; apply it to distinct values only."""
    return values.map(fold_text)


def snake_name(name: str) -> str:
    """Flattened path to a column name: the first place of a list goes, a capital after a small letter or digit begins a word, other signs separate words."""
    words = re.findall(r"[0-9A-Za-z]+", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.replace("/0/", "/")))
    if not words:
        raise ValueError(f"no name is left of {name!r}")
    return "_".join(words).lower()


def snake_names(names: Iterable[str]) -> dict[str, str]:
    out = {n: snake_name(n) for n in names}
    clashes = sorted({v for v in out.values() if list(out.values()).count(v) > 1})
    if clashes:
        raise ValueError(f"several columns become {clashes}")
    return out
