"""Scalar column expressions (all JVM-side, codegen friendly).

Oracle-isms are made explicit here so every operator agrees on them:
empty text is NULL, ``||`` treats NULL as empty, date minus date is a
duration compared with an interval, and SYSDATE is a fixed run timestamp.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from nightledger.schemas import ONE_SECOND

# Text formats of the inputs.
#   transaction / blacklist time text: yyyy-MM-dd HH:mm:ss, time part optional
#   business date in file names: ddMMyyyy
DT_PATTERN = "yyyy-MM-dd[ HH:mm:ss]"
FILE_DATE_PATTERN = "ddMMyyyy"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: _dt.datetime | str) -> Column:
    """A zone-free timestamp literal (run time, watermark, markers)."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    return F.lit(value).cast("timestamp_ntz")


def blank_to_null(c: Column | str) -> Column:
    """Empty text is NULL in the source database; so is text of blanks once it is trimmed."""
    return F.nullif(_c(c), F.lit(""))


def strip_blanks(c: Column | str) -> Column:
    """Remove every blank (card numbers arrive as '4000 0000 ...'); NULL if nothing is left."""
    return blank_to_null(F.replace(_c(c), F.lit(" "), F.lit("")))


def decimal_comma(c: Column | str) -> Column:
    """'1234,565' -> 1234.57 as decimal(30,2); blank is NULL, bad text is NULL too (see ``rejects``)."""
    return blank_to_null(F.trim(F.replace(_c(c), F.lit(","), F.lit(".")))).try_cast("decimal(30,2)")


def parse_dt(c: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm:ss' or a bare 'yyyy-MM-dd' -> timestamp_ntz; blank and bad text are NULL."""
    text = F.nullif(F.trim(_c(c)), F.lit(""))
    # two whole forms and no others, so that a bad text is NULL and never raises
    good = text.rlike(r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])( ([01]\d|2[0-3]):[0-5]\d:[0-5]\d)?$")
    real = F.when(good, F.substring(text, 1, 10)).try_cast("date").isNotNull()
    return F.to_timestamp_ntz(F.when(good & real, text), F.lit(DT_PATTERN))


def parse_ddmmyyyy(c: Column | str) -> Column:
    return F.to_timestamp_ntz(_c(c), F.lit(FILE_DATE_PATTERN))


def fio(last: Column | str, first: Column | str, middle: Column | str) -> Column:
    """TRIM(last) || ' ' || TRIM(first) || ' ' || TRIM(middle) with NULL as empty."""
    parts = [F.coalesce(F.trim(_c(x)), F.lit("")) for x in (last, first, middle)]
    return F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2])


def closing_time(new_from: Column) -> Column:
    """A version superseded at ``new_from`` ends one second earlier."""
    return new_from - F.expr(ONE_SECOND)


def within(later: Column, earlier: Column, interval: str, inclusive: bool = True) -> Column:
    """``later - earlier <= interval`` (or ``<``) on zone-free timestamps.

    Written as ``later <= earlier + interval`` so it stays a plain
    timestamp comparison; NULL on either side is not within.
    """
    bound = earlier + F.expr(f"INTERVAL {interval}")
    return (later <= bound) if inclusive else (later < bound)
