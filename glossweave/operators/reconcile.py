"""Two snapshots of localized concepts reconciled: merged concepts, changes, and reports.

A side is a table ``code, language, _ord, status, designations, definition, notes, examples``,
unique per (code, language).  The sides meet once, in a full outer join on (code, language);
one aggregation per code then holds all that the concept needs (its languages, a few dozen at
most), and merging, diffing and reporting are projections of that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.functions.codes import section_of
from glossweave.functions.labels import termbase_status
from glossweave.functions.text import comparable, nfc, shorten
from glossweave.operators.sheet import first_wins

SIDE = ["code", "language", "_ord", "status", "designations", "definition", "notes", "examples"]
_CONTENT = ["designations", "definition", "notes", "examples"]
#: Languages whose changes make translations stale, and the notice that says so.
SOURCE_LANGUAGES = ("eng", "fra")
STALE_NOTICE = "[Reconciler] Translation may be stale — source language content changed (%s) on %s"


def side(df: DataFrame, *, order: str, code="code", language="language_code", status="entry_status", designation="term", definition="definition", notes=None, examples=None) -> DataFrame:
    """A table of localized concepts as a side; the first row of a (code, language) wins; null lists are empty."""
    empty = F.array().cast("array<string>")
    rows = df.select(
        F.col(code).alias("code"),
        F.col(language).alias("language"),
        F.col(order).alias("_ord"),
        termbase_status(F.trim(status)).alias("status"),
        F.array_compact(F.array(designation)).alias("designations"),
        F.nullif(F.col(definition), F.lit("")).alias("definition"),
        (F.coalesce(F.col(notes), empty) if notes else empty).alias("notes"),
        (F.coalesce(F.col(examples), empty) if examples else empty).alias("examples"),
    )
    return first_wins(rows.where("code is not null and language is not null"), ["code", "language"])


def rejected(df: DataFrame, code: str = "code", language: str = "language_code") -> DataFrame:
    """The rows of ``df`` that no side can hold, as they are, with their ``error``; the others are reconciled all the same."""
    error = F.when(F.col(code).isNull(), "no code").when(F.col(language).isNull(), "no language")
    return df.withColumn("error", error).where("error is not null")


def _met(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per code of either side: which sides have it, its statuses, and its languages with both contents."""

    def packed(df, name):
        # the compared forms are made before the join, so each text is normalised once, on its own side
        more = [comparable(nfc(F.col("definition")), compose=False).alias("definition_form"), comparable(nfc(F.get("designations", F.lit(0))), compose=False).alias("designation_form")]
        body = F.struct("_ord", "status", *_CONTENT, *more)
        return df.select("code", "language", body.alias(name))

    rows = packed(old, "o").join(packed(new, "n"), ["code", "language"], "full_outer")
    at = F.coalesce(F.col("o._ord"), F.col("n._ord"))
    entry = F.struct(F.col("o").isNull().alias("_new"), at.alias("_at"), "language", "o", "n")
    return rows.groupBy("code").agg(
        F.max(F.col("o").isNotNull()).alias("in_old"),
        F.max(F.col("n").isNotNull()).alias("in_new"),
        F.min_by("o.status", F.when(F.col("o").isNotNull(), F.struct("o._ord", "language"))).alias("old_status"),
        F.min_by("n.status", F.when(F.col("n").isNotNull(), F.struct("n._ord", "language"))).alias("new_status"),
        F.array_sort(F.collect_list(entry)).alias("entries"),
    )


_CHANGE = "array<struct<field:string,language:string,old_value:string,new_value:string>>"


def _change(field: str, language: Column, old: Column, new: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), language.alias("language"), old.alias("old_value"), new.alias("new_value"))


def _field_changes(e: Column) -> Column:
    o, n, lang = e["o"], e["n"], e["language"]
    joined = lambda x: F.array_join(x, " | ")
    return F.array_compact(
        F.array(
            F.when(o["designation_form"] != n["designation_form"], _change("designation", lang, F.get(o["designations"], F.lit(0)), F.get(n["designations"], F.lit(0)))),
            F.when(o["definition_form"] != n["definition_form"], _change("definition", lang, o["definition"], n["definition"])),
            F.when(o["notes"] != n["notes"], _change("notes", lang, joined(o["notes"]), joined(n["notes"]))),
            F.when(o["examples"] != n["examples"], _change("examples", lang, joined(o["examples"]), joined(n["examples"]))),
        )
    )


def reconcile(old: DataFrame, new: DataFrame, detected_at: str, dates: DataFrame | None = None) -> DataFrame:
    """``code, origin, status, dates, localized, changes``, one row per code of either side.

    * In both: the old status and dates stay (plus ``amended`` if anything changed); each
      language takes the new definition, notes, examples and designations where they are not
      empty; new languages are appended.  A changed definition or note in a source language
      leaves a notice among the examples of every other language.
    * Only in the old side: status ``retired`` with its date, content kept; the change that
      says so has ``retired`` on both sides (kept for parity: it is read after it is set).
    * Only in the new side: unchanged, no change rows.
    * Languages that the new side lacks are kept and not reported.
    * ``dates`` (``code, dates``) are those that the old side's concepts have already.
    """
    met = _met(old, new)
    both = F.col("in_old") & F.col("in_new")
    null = F.lit(None).cast("string")
    status_change = F.when(~F.col("old_status").eqNullSafe(F.col("new_status")), F.array(_change("status", null, F.col("old_status"), F.col("new_status"))))
    added = F.transform(F.filter("entries", lambda e: e["o"].isNull() & e["n"].isNotNull()), lambda e: _change("language_added", e["language"], null, F.lit("present")))
    edited = F.flatten(F.transform(F.filter("entries", lambda e: e["o"].isNotNull() & e["n"].isNotNull()), _field_changes))
    none = F.array().cast(_CHANGE)
    retired = F.array(_change("status", null, F.lit("retired"), F.lit("retired")))
    changes = F.when(both, F.concat(F.coalesce(status_change, none), added, edited)).when(F.col("in_old"), retired).otherwise(none)
    rows = met.withColumn("changes", changes)

    touched = F.filter("changes", lambda c: c["language"].isin(*SOURCE_LANGUAGES) & c["field"].isin("definition", "notes"))
    fields = F.array_join(F.array_distinct(F.transform(touched, lambda c: F.concat_ws(":", c["language"], c["field"]))), ", ")
    before, after = STALE_NOTICE.split("%s", 1)
    middle, end = after.split("%s")
    notice = F.when(both & (F.size(touched) > 0), F.concat(F.lit(before), fields, F.lit(middle), F.lit(detected_at), F.lit(end)))
    rows = rows.withColumn("_notice", notice)

    def pick(e, name):
        o, n = e["o"][name], e["n"][name]
        filled = n.isNotNull() if name == "definition" else F.size(n) > 0
        return F.when(e["o"].isNull(), n).when(e["n"].isNotNull() & filled, n).otherwise(o)

    def localized(e):
        stale = F.when(F.col("_notice").isNotNull() & ~e["language"].isin(*SOURCE_LANGUAGES), F.concat(pick(e, "examples"), F.array("_notice"))).otherwise(pick(e, "examples"))
        return F.struct(e["language"].alias("language"), *[(stale if c == "examples" else pick(e, c)).alias(c) for c in _CONTENT])

    dated = lambda kind: F.array(F.struct(F.lit(kind).alias("type"), F.lit(detected_at).alias("date")))
    no_dates = F.array().cast("array<struct<type:string,date:string>>")
    if dates is not None:
        earlier = dates.select("code", F.col("dates").alias("_dates")).groupBy("code").agg(F.first("_dates").alias("_dates"))
        rows = rows.join(earlier, "code", "left").withColumn("_dates", F.coalesce("_dates", no_dates))
    else:
        rows = rows.withColumn("_dates", no_dates)
    return rows.select(
        "code",
        F.when(both, "both").when(F.col("in_old"), "termbase_only").otherwise("live_only").alias("origin"),
        F.when(both, F.col("old_status")).when(F.col("in_old"), "retired").otherwise(F.col("new_status")).alias("status"),
        F.concat("_dates", F.when(both & (F.size("changes") > 0), dated("amended")).when(~both & F.col("in_old"), dated("retired")).otherwise(no_dates)).alias("dates"),
        F.transform("entries", localized).alias("localized"),
        "changes",
    )


def change_rows(reconciled: DataFrame, detected_at: str) -> DataFrame:
    """Flat changes: ``code, section, field, language, detected_at, old_value, new_value``."""
    each = reconciled.select("code", F.explode("changes").alias("_c"))
    return each.select("code", section_of(F.col("code")).alias("section"), "_c.field", "_c.language", F.lit(detected_at).alias("detected_at"), "_c.old_value", "_c.new_value")


def change_csv(changes: DataFrame) -> DataFrame:
    """Change rows as the report writes them, long values cut."""
    return changes.withColumns({"old_value": shorten(F.col("old_value")), "new_value": shorten(F.col("new_value"))})


def stats(reconciled: DataFrame) -> DataFrame:
    """One row: total, in_both, termbase_only, live_only, changed."""
    return reconciled.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("origin") == "both").alias("in_both"),
        F.count_if(F.col("origin") == "termbase_only").alias("termbase_only"),
        F.count_if(F.col("origin") == "live_only").alias("live_only"),
        F.count_if(F.size("changes") > 0).alias("changed"),
    )


def tally(changes: DataFrame, by: str) -> DataFrame:
    """Changes per value of a column, most first, ties by value; null is a group."""
    return changes.groupBy(by).agg(F.count(F.lit(1)).alias("n_changes")).orderBy(F.desc("n_changes"), by)


def summary(changes: DataFrame) -> DataFrame:
    """All tallies of the report in one pass: ``tally, value, n_changes``; the total has tally ``total``."""
    sets = changes.groupingSets([[], [F.col("field")], [F.col("language")], [F.col("section")]], "field", "language", "section")
    counted = sets.agg(F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n_changes"))
    name = F.when(F.col("_g") == 3, "field").when(F.col("_g") == 5, "language").when(F.col("_g") == 6, "section").otherwise("total")
    value = F.when(F.col("_g") == 3, F.col("field")).when(F.col("_g") == 5, F.col("language")).when(F.col("_g") == 6, F.col("section"))
    return counted.select(name.alias("tally"), value.alias("value"), "n_changes")


def codes_of_origin(reconciled: DataFrame, origin: str) -> DataFrame:
    """Codes of one origin whose concept has content, in order: retired (``termbase_only``) or new (``live_only``)."""
    return reconciled.where((F.col("origin") == origin) & (F.size("localized") > 0)).select("code").orderBy("code")


def by_field(changes: DataFrame, field: str) -> DataFrame:
    return changes.where(F.col("field") == field)


def by_language(changes: DataFrame, language: str) -> DataFrame:
    return changes.where(F.col("language") == language)
