"""Text expressions (M3-M5) and header normalisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def regex_group(col: Column | str, pattern: str, group: int = 1) -> Column:
    """M5: regex group, null when the pattern does not match (Spark gives '')."""
    return F.nullif(F.regexp_extract(_c(col), pattern, group), F.lit(""))


def ends_with_any(col: Column | str, suffixes) -> Column:
    """M4: true when the text ends with any of ``suffixes``."""
    c = _c(col)
    return reduce(lambda a, b: a | b, [c.endswith(s) for s in suffixes])


# Characters that a column name has as an underscore.
HEADER_JOINTS = str.maketrans(dict.fromkeys(" -/.", "_"))


def header_key(name) -> str:
    """A vendor header as a column name. Runs on the schema, never on data."""
    return str(name).strip().translate(HEADER_JOINTS).lower()
