"""Column helpers for keys and delimited text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(cols: list[str]) -> Column:
    """One unambiguous text per tuple: ``length:value`` parts, ``-`` for null."""
    parts = []
    for name in cols:
        text = F.col(name).cast("string")
        sized = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.concat_ws("|", *parts)


def quote_pattern(literal: str) -> str:
    """A Java regular expression that matches ``literal`` and nothing else."""
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def truncate_to(unit: str, col: Column | str) -> Column:
    """Start of the calendar unit as ``timestamp_ntz``."""
    return F.date_trunc(unit, col).cast("timestamp_ntz")
