"""``IEV 881-01-23:1983-01``: the concept that an entry replaces, natively."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossweave.functions.text import sanitize

#: Fixed value: how a replaced concept and its version are written.
PATTERN = r"\A(?:IEV\s+)?([0-9]{3}-[0-9]{2}-[0-9]{2})\s*:\s*([-0-9]+)\z"


def superseded(cell: Column, compose: bool = True) -> Column:
    """``ARRAY<STRUCT<type, source, id>>``; null for null, for cells without a word, and for cells of another form."""
    c = sanitize(cell, compose)
    ref = F.struct(F.lit("supersedes").alias("type"), F.lit("IEV").alias("source"), F.regexp_extract(c, PATTERN, 1).alias("id"))
    return F.when(c.rlike(PATTERN), F.array(ref))
