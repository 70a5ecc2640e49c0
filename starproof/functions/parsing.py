"""Text -> typed value expressions. Anything unreadable becomes NULL, never an error.

All of them are plain Catalyst expressions, so a cleaning ``select`` stays in
one whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from starproof import specs

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
FRENCH_DATE, ISO_DATE = "d/M/yyyy", "yyyy-M-d"


def trimmed(c: Column) -> Column:
    """Strip white space at both ends, no-break space included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def without_missing_tokens(c: Column) -> Column:
    return F.when(~c.isin(*specs.MISSING_TOKENS), c)


def _number(text: Column, dtype) -> Column:
    # the guard keeps out what a cast alone would take: '12d', 'NaN', 'Infinity'
    return F.when(text.rlike(NUMBER), text.try_cast(dtype))


def french_amount(c: Column, dtype=specs.MONEY) -> Column:
    """``'3 000,52'`` (space or no-break space) -> 3000.52; ``'11.73'`` stays 11.73."""
    # three plain replacements: a translation looks every character up
    spaced = F.replace(F.replace(c, F.lit("\u00a0")), F.lit(" "))
    return _number(F.replace(spaced, F.lit(","), F.lit(".")), dtype)


def strict_date(c: Column, patterns: Iterable[str] = (FRENCH_DATE, ISO_DATE)) -> Column:
    """First pattern that reads the whole text wins; impossible dates are NULL."""
    return F.coalesce(*[F.try_to_date(c, p) for p in patterns])


def whole_number(c: Column) -> Column:
    """``'12'`` and ``'12.0'`` -> 12; fractions and text -> NULL."""
    exact = _number(F.trim(c), "decimal(38,9)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def points_to_rate(c: Column) -> Column:
    """Percent points with a decimal dot -> rate (``'6.1'`` -> 0.061)."""
    return (_number(F.trim(c), "decimal(12,6)") * F.lit("0.01").cast("decimal(2,2)")).cast(specs.RATE)  # exact, as / 100 is, and cheaper


def _mapped(key: Column, mapping: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def canonical_category(c: Column, variants: Mapping[str, str] | None = None) -> Column:
    """Known spelling variants -> canonical label; anything else only trimmed."""
    clean = trimmed(c)
    return F.coalesce(_mapped(F.lower(clean), variants or specs.CATEGORY_VARIANTS), clean)


def canonical_segment(c: Column, segments: Iterable[str] = specs.SEGMENTS) -> Column:
    """Case-insensitive match against the segment list; acronyms keep their case."""
    clean = trimmed(c)
    return F.coalesce(_mapped(F.lower(clean), {s.lower(): s for s in segments}), clean)


def period_of_label(year: Column, label: Column, labels: Iterable[str] = specs.BUDGET_LAYOUT.month_labels) -> Column:
    """Month label -> ``yyyy-MM``, the month being the label's position in ``labels``."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), label)
    return F.when(position > 0, F.format_string("%d-%02d", year.cast("int"), position))


def period_year(period: Column) -> Column:
    return F.substring(period, 1, 4).cast("int")


def period_month(period: Column) -> Column:
    return F.substring(period, 6, 2).cast("int")


def year_in_file_name(path: Column) -> Column:
    """First four digits in the file name; fails the job when there are none."""
    name = F.element_at(F.split(path, "/"), -1)
    digits = F.regexp_extract(name, r"(\d{4})", 1)
    return F.when(digits != "", digits.try_cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("no year in budget file name: "), name)).cast("int")
    )


def parse(field: specs.Field, c: Column) -> Column:
    """The expression that brings raw text to the declared kind of ``field``."""
    if field.kind == specs.DATE:
        return strict_date(c)
    if field.kind == specs.AMOUNT:
        return french_amount(c)
    if field.kind == specs.INTEGER:
        return whole_number(c)
    return trimmed(c)
