"""What changed between consecutive full snapshots of a table.

Each snapshot row is unpivoted into *signed cells*: one cell per watched field plus a
key-presence marker, counted +1 in the transition that leads to its snapshot and -1 in the
transition that leaves it.  Summed per (transition, key, field, value), cells that two
consecutive snapshots share cancel out; whatever sum is not zero is a difference.  A
presence marker left over means the key was added (+1) or removed (-1).

Cells carry a 64-bit fingerprint of the normalised value, not the text, so long definitions
never travel through a shuffle.

Plan: one shuffle that picks the row that counts of each (snapshot, key), after a map-side
pre-selection (each partition sends one row per key, so a key repeated in a third of all
rows is reduced before it moves); one shuffle on the key alone, whose partitioning serves both
the cell sums and the per-key classification.  No self-join, no window over a snapshot.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.operators.sheet import first_of
from glossweave.session import small_rows

PRESENCE = "#key"

#: Code points that leave no mark in a text.
INVISIBLE_RANGES = [
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180E), (0x200B, 0x200F),
    (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF),
]
INVISIBLE = "".join(chr(cp) for low, high in INVISIBLE_RANGES for cp in range(low, high + 1))
#: White space other than the blank, and quotes by what they become.
BLANKS = "\t\n\x0b\f\r\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
DOUBLE_QUOTES = "“”„‟″‶〝〞＂"
SINGLE_QUOTES = "‘’‚‛′‵‹›`´＇"
MARKUP_TAG = "</?[A-Za-z][^<>]*>"


def _blanks(c: Column) -> Column:
    """Every kind and amount of white space as one blank."""
    return F.regexp_replace(F.translate(c, BLANKS, " " * len(BLANKS)), " {2,}", " ")


def prose(c: Column) -> Column:
    """A text without tags, invisible characters, letter case, quote style or amount of white space; '' is null.

    One translation does all single characters; a pattern with as many would cost ten times that.
    """
    kept = BLANKS + DOUBLE_QUOTES + SINGLE_QUOTES
    c = F.translate(c, kept + INVISIBLE, " " * len(BLANKS) + '"' * len(DOUBLE_QUOTES) + "'" * len(SINGLE_QUOTES))
    c = F.regexp_replace(F.regexp_replace(c, MARKUP_TAG, ""), " {2,}", " ")
    c = F.replace(F.replace(c, F.lit("« "), F.lit("«")), F.lit(" »"), F.lit("»"))
    return F.nullif(F.lower(F.trim(F.translate(c, "«»", '""'))), F.lit(""))


def label(c: Column) -> Column:
    """A short code without letter case and outer blanks; '' is null."""
    return F.nullif(F.lower(F.trim(_blanks(c))), F.lit(""))


def instant(c: Column) -> Column:
    """A date or date-time in any ISO-like spelling as microseconds (no zone: UTC).

    A text that is no date keeps its trimmed form, so it still compares; '' is null.
    """
    c = F.trim(_blanks(c))
    zoned = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(c, F.lit("T00:00:00Z"))).when(
        c.rlike(r"\d{2}:\d{2}(:\d{2}(\.\d+)?)?$") & ~c.rlike(r"[+-]\d{2}:?\d{2}$"), F.concat(c, F.lit("Z"))
    ).otherwise(c)
    at = F.unix_micros(F.try_to_timestamp(zoned))
    return F.coalesce(at.cast("string"), F.nullif(c, F.lit("")))


def snapshot_changes(
    df: DataFrame,
    *,
    snapshot: str,
    keys: Sequence[str],
    fields: Mapping[str, Callable[[Column], Column]],
    version: str,
) -> DataFrame:
    """Rows ``(snapshot, *keys, change_kind, changed_fields)`` for every delivered snapshot but the first.

    * ``fields`` maps each watched column to the function that brings its values to one form.
    * Several rows of one key in a snapshot: the latest ``version`` counts; null versions are
      oldest; equal versions are decided by the greatest fingerprint, so any order of the
      input gives the same result.
    * Rows without snapshot number belong to no delivery and are left out.  Null keys are
      keys like any other.  Null and '' are the same value.
    * ``change_kind`` is ``added``, ``removed`` or ``changed``; ``changed_fields`` lists the
      fields in the given order and is empty unless ``changed``.
    * Other columns of ``df`` are ignored, whatever their names.  An empty table gives no rows.
    """
    names = list(fields)
    prints = {f"_h{i}": F.xxhash64(F.coalesce(fields[n](F.col(n)), F.lit(""))) for i, n in enumerate(names)}
    slim = df.select(snapshot, *keys, F.col(version).alias("_version"), *[v.alias(k) for k, v in prints.items()])
    latest = first_of(slim, [snapshot, *keys], [F.col("_version").desc_nulls_last(), *[F.col(h).desc() for h in prints]])
    placed = _placed(df, latest.drop("_version"), snapshot)
    cells = F.array(
        F.struct(F.lit(PRESENCE).alias("field"), F.lit(0).cast("long").alias("value")),
        *[F.struct(F.lit(n).alias("field"), F.col(f"_h{i}").alias("value")) for i, n in enumerate(names)],
    )
    arrives = F.when(~F.col("_first"), F.struct(F.col(snapshot).alias("at"), F.lit(1).alias("sign")))
    leaves = F.when(F.col("_next").isNotNull(), F.struct(F.col("_next").alias("at"), F.lit(-1).alias("sign")))
    signed = (
        placed.repartition(*keys)
        .select(*keys, F.explode(F.array_compact(F.array(arrives, leaves))).alias("_move"), cells.alias("_cells"))
        .select(*keys, F.col("_move.at").alias("_at"), F.col("_move.sign").alias("_sign"), F.explode("_cells").alias("_cell"))
        .select(*keys, "_at", "_sign", F.col("_cell.field").alias("_field"), F.col("_cell.value").alias("_value"))
    )
    left_over = signed.groupBy(*keys, "_at", "_field", "_value").agg(F.sum("_sign").alias("_sum")).where("_sum <> 0")
    presence = F.max(F.when(F.col("_field") == PRESENCE, F.col("_sum")))
    touched = F.collect_set(F.when(F.col("_field") != PRESENCE, F.col("_field")))
    per_key = left_over.groupBy(*keys, "_at").agg(presence.alias("_presence"), touched.alias("_touched"))
    kind = F.when(F.col("_presence") > 0, "added").when(F.col("_presence") < 0, "removed").otherwise("changed")
    listed = F.filter(F.array(*map(F.lit, names)), lambda n: F.array_contains(F.col("_touched"), n))
    return per_key.select(
        F.col("_at").alias(snapshot),
        *keys,
        kind.alias("change_kind"),
        F.when(F.col("_presence").isNull(), listed).otherwise(F.array().cast("array<string>")).alias("changed_fields"),
    )


def _placed(df: DataFrame, latest: DataFrame, snapshot: str) -> DataFrame:
    """``latest`` with ``_first`` and ``_next``, by a join with the table of deliveries in their order.

    The deliveries are listed from the narrow scan of ``df``.  The join is hinted only while
    that list is known to be small.
    """
    seen = df.select(snapshot).where(F.col(snapshot).isNotNull()).distinct()
    rows = small_rows(seen)
    if rows is None:
        by = Window.orderBy(snapshot)
        order = seen.select(snapshot, F.lead(snapshot).over(by).alias("_next"), F.lag(snapshot).over(by).isNull().alias("_first"))
        return latest.join(order, snapshot)
    numbers = sorted(r[0] for r in rows)
    kind = df.schema[snapshot].dataType
    schema = T.StructType([T.StructField(snapshot, kind), T.StructField("_next", kind), T.StructField("_first", T.BooleanType())])
    order = df.sparkSession.createDataFrame([(x, y, x == numbers[0]) for x, y in zip(numbers, [*numbers[1:], None])], schema)
    return latest.join(F.broadcast(order), snapshot)


def termbase_changes(df: DataFrame) -> DataFrame:
    """Changes in definition, status or amendment date of (code, language) records."""
    return snapshot_changes(
        df,
        snapshot="snapshot_no",
        keys=["code", "language_code"],
        fields={"definition": prose, "entry_status": label, "date_amended": instant},
        version="loaded_at",
    )
