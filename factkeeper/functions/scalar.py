"""Column expressions (F1-F12, P9, P11, P14), all JVM-side built-ins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line recodes applied before the keys are built.
LINE_RECODES = {
    "UWKH33": "UWON33KH",
    "UWKH29": "UWON29KH",
    "OK188": "OK188SG",
}

# Text date layouts tried in this order (padded or not); first that parses wins.
DATE_LAYOUTS = ["yyyy-M-d", "yyyy/M/d", "d/M/yyyy", "M/d/yyyy"]


def strict_concat(*parts, sep: str = "-") -> Column:
    """``a || sep || b ...`` — NULL if any part is NULL (unlike concat_ws)."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(F.col(p) if isinstance(p, str) else p)
    return F.concat(*cols)


def recode(col: str, mapping: dict) -> Column:
    """Replace exact values per ``mapping``; other values (and NULL) kept."""
    c = F.col(col)
    expr = None
    for old, new in mapping.items():
        expr = (F.when(c == F.lit(old), F.lit(new)) if expr is None
                else expr.when(c == F.lit(old), F.lit(new)))
    return c if expr is None else expr.otherwise(c)


def blank_if_null(col: str) -> Column:
    """``COALESCE(col, '')``."""
    return F.coalesce(F.col(col), F.lit(""))


def as_text(col: str) -> Column:
    """Text form with '' for NULL."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def days_between(later, earlier) -> Column:
    """whole days ``later - earlier`` as INT; NULL if either is NULL."""
    a = F.lit(later) if isinstance(later, date) else (F.col(later) if isinstance(later, str) else later)
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    return F.datediff(a, b).cast("int")


def distinct_from(a: str, b: str) -> Column:
    """``a IS DISTINCT FROM b``."""
    return ~F.col(a).eqNullSafe(F.col(b))


def parse_date_multi(col: str, as_of: date, layouts=DATE_LAYOUTS) -> Column:
    """cut off a time part, try each layout in turn, else ``as_of``."""
    head = F.split_part(F.col(col).cast("string"), F.lit(" "), F.lit(1))
    tries = [F.try_to_date(head, fmt) for fmt in layouts]
    return F.coalesce(*tries, F.lit(as_of))


def thousands(col, decimals: int = 0) -> Column:
    """``1,234`` / ``1,234.56`` text from a number."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_number(c.cast("double"), decimals)


def slash_date(col) -> Column:
    """date as ``yyyy/MM/dd``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy/MM/dd")


def utf8_or_hex(col: str) -> Column:
    """decode bytes as UTF-8; if they are not valid UTF-8 keep a hex text."""
    as_str = F.col(col).cast("string")
    return F.when(F.is_valid_utf8(as_str), as_str).otherwise(F.hex(F.col(col)))
