"""Column expressions that clean one value. All tolerate bad input by returning NULL."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value, compared after upper(trim()).
DEFAULT_SENTINELS = ("NULL", "NA", "?", "NONE", "")
BLANK_SENTINELS = ("NULL", "NA", "")

# Fixed value: what a date looks like after the export cut it down to minutes and seconds.
CORRUPT_DATE = "^[0-9]{2}:[0-9]{2}[.][0-9]+$"
ISO_DAY = "yyyy-MM-dd"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def norm_trim(value: Column | str) -> Column:
    return F.trim(_column(value))


def norm_upper(value: Column | str) -> Column:
    return F.upper(norm_trim(value))


def is_sentinel(value: Column | str, sentinels: Iterable[str] = BLANK_SENTINELS) -> Column:
    """TRUE where the text stands for "missing"; NULL in, NULL out."""
    return norm_upper(value).isin(*sentinels)


def null_if_sentinel(value: Column | str, sentinels: Iterable[str] = DEFAULT_SENTINELS) -> Column:
    """The value as it came, or NULL when it stands for "missing"."""
    return F.when(~is_sentinel(value, sentinels), _column(value))


def coalesce_variants(
    *values: Column | str, sentinels: Iterable[str] = BLANK_SENTINELS, trim: bool = True
) -> Column:
    """First usable value among columns that carry the same attribute under different headers."""
    usable = [null_if_sentinel(v, sentinels) for v in values]
    return F.coalesce(*[F.trim(u) if trim else u for u in usable]) if usable else F.lit(None).cast("string")


def safe_cast(value: Column | str, data_type: str) -> Column:
    return _column(value).try_cast(data_type)


def coalesce_ids(*values: Column | str, data_type: str = "bigint") -> Column:
    """First column that holds a readable id."""
    return F.coalesce(*[safe_cast(v, data_type) for v in values])


def extract_number(value: Column | str, data_type: str, pattern: str = "([0-9.]+)") -> Column:
    """Number in front of a unit, e.g. ``"1248 CC"``. No match gives NULL."""
    return F.regexp_extract(_column(value), pattern, 1).try_cast(data_type)


def _first_true(tests: Iterable[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """One CASE over the tests in order; the optimizer can then reason about its branches."""
    chain = F
    for test, result in tests:
        chain = chain.when(test, result)
    return chain if otherwise is None else chain.otherwise(otherwise)


def extract_unit(value: Column | str, units: Sequence[str]) -> Column:
    """First of ``units`` that the text contains (case-sensitive), else NULL."""
    text = _column(value)
    return _first_true((text.contains(u), F.lit(u)) for u in units)


def matches_corrupt(value: Column | str, pattern: str = CORRUPT_DATE) -> Column:
    return _column(value).rlike(pattern)


def normalise_enum(value: Column | str, allowed: Iterable[str]) -> Column:
    """Upper-cased value if it is one of ``allowed``, else NULL."""
    text = norm_upper(value)
    return F.when(text.isin(*allowed), text)


def safe_date(value: Column | str, fmt: str = ISO_DAY) -> Column:
    """Date in a strict format, else NULL.

    For ISO days the shape is tested first and the plain cast does the rest: a parser that raises
    and recovers on every bad value costs many times more.
    """
    text = _column(value)
    if fmt == ISO_DAY:
        return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))
    return F.try_to_date(text, fmt)


def safe_timestamp(value: Column | str, fmt: str, sentinels: Iterable[str] = BLANK_SENTINELS) -> Column:
    return F.try_to_timestamp(null_if_sentinel(value, sentinels), F.lit(fmt))


def violates_order(start: Column | str, end: Column | str) -> Column:
    """TRUE where both ends are known and the end lies before the start; never NULL."""
    return F.coalesce(_column(end) < _column(start), F.lit(False))


def outlier_flag(value: Column | str, limit: float, null_is: bool | None = None) -> Column:
    """Above a fixed limit. NULL stays NULL unless ``null_is`` says otherwise."""
    flag = _column(value) > F.lit(limit)
    return flag if null_is is None else F.coalesce(flag, F.lit(null_is))


def safe_pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """``100 * num / den`` rounded; NULL when the denominator is zero or NULL."""
    return F.round(F.try_divide(_column(num) * F.lit(100.0), _column(den)), digits) + F.lit(0.0)


def bucketize(value: Column | str, bounds: Sequence[tuple[float, str]], otherwise: str, at_least: bool) -> Column:
    """Label of the first bound that holds: ``value >= bound`` if ``at_least``, else ``value <= bound``."""
    number = _column(value)
    tests = ((number >= F.lit(b) if at_least else number <= F.lit(b), F.lit(label)) for b, label in bounds)
    return _first_true(tests, F.lit(otherwise))


def first_match(rules: Iterable[tuple[str, str]]) -> Column:
    """Label of the first SQL predicate that is TRUE, in the given order; NULL when none fires."""
    return _first_true((F.expr(predicate), F.lit(label)) for label, predicate in rules)
