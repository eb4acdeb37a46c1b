"""Date and time expressions with named format presets."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselog.functions import text as tx

# The accepted formats, tried in this order.
FORMATS = {
    "timeline": ["yyyy/M/d h:m:s a", "yyyy-M-d H:m:s", "yyyy-M-d"],
    "audit": [
        "yyyy-M-d",
        "yyyy/M/d",
        "d/M/yyyy",
        "d-M-yyyy",
        "M/d/yyyy",
        "M-d-yyyy",
        "yyyy-M-d H:m:s",
        "d/M/yyyy H:m:s",
    ],
    "load": ["yyyy/M/d h:m:s a"],
    "column_date": ["yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "yyyy/M/d"],
    "column_timestamp": [
        "yyyy-M-d H:m:s",
        "yyyy-M-d'T'H:m:s",
        "yyyy-M-d H:m",
        "d/M/yyyy H:m:s",
        "M/d/yyyy H:m:s",
    ],
}
NO_DATE = "0000-00-00"
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}){1,2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?)?$"


def _shape(fmt: str) -> str:
    """Pattern of texts worth parsing with the format; a failed parse costs far more than a match."""
    pieces = {"yyyy": r"\d{4}", "'T'": "T", "a": "[AaPp][Mm]"} | {c: r"\d{1,2}" for c in "MdHhms"}
    tokens = re.findall(r"yyyy|'T'|[a-zA-Z]|.", fmt)
    return "^" + "".join(pieces.get(t, re.escape(t)) for t in tokens) + "$"


def parse_first(text: Column, formats: list[str]) -> Column:
    """First format that reads the whole text; null when none does."""
    return F.coalesce(*[F.when(text.rlike(_shape(f)), F.try_to_timestamp(text, F.lit(f))) for f in formats])


def timeline_ts(text: Column) -> Column:
    """Expects squeezed text."""
    return parse_first(text, FORMATS["timeline"])


def audit_date(value: Column, with_clock_format: bool = False) -> Column:
    """Day-first reading of mixed dates, as yyyy-MM-dd text, null when unreadable."""
    text = tx.strip_blank(value.cast("string"))
    formats = FORMATS["audit"] + (FORMATS["load"] if with_clock_format else [])
    iso = F.when(text.rlike(ISO_SHAPE), F.to_date(F.try_to_timestamp(F.substring(text, 1, 10))))
    return F.date_format(F.coalesce(parse_first(text, formats).cast("date"), iso), "yyyy-MM-dd")


def load_ts(value: Column, squeeze_edges: bool = False) -> Column:
    """The loader's clock format. Inner runs of spaces are fine; edges only when asked."""
    text = value.cast("string")
    text = tx.squeeze_strip(text) if squeeze_edges else tx.squeeze(text)
    return parse_first(text, FORMATS["load"])


def weekdays_before(day: Column) -> Column:
    """Monday-to-Friday days between a fixed Monday and the given day, day excluded."""
    since = F.datediff(day, F.lit("1970-01-05").cast("date"))
    weeks = F.floor(since / F.lit(7))
    return weeks * 5 + F.least(F.pmod(since, F.lit(7)), F.lit(5))


def business_days(start: Column, end: Column) -> Column:
    """Working days after start up to and including end, in closed form."""
    return (weekdays_before(F.date_add(end, 1)) - weekdays_before(F.date_add(start, 1))).cast("int")
