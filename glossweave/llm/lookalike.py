"""Text that looks the same, stored in different characters.

``skeleton`` maps a text to a form that two texts share exactly if a reader can't tell them
apart: characters without a mark of their own are dropped, wide and narrow forms and spaces
are unified, the rest is decomposed, each character is replaced by its prototype in a
look-alike table, and the result is decomposed again.

The table is not typed in: it is read from the confusables data (Unicode TR 39) of the ICU
library that Spark itself ships, and corrected by rule where that data equates characters
that a reader can tell apart (digits and letters of ASCII among themselves, ``m`` and
``rn``).  Accents, letter case, raised figures, and hyphen against space stay different.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from py4j.java_gateway import JavaPackage
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points read for the table: everything below the private planes that has a category of its own.
TABLE_END = 0x30000
#: Proven bound of the table sent to executors: one entry per code point that has another prototype.
MAX_TABLE = 20_000


def invisible(cp: int) -> bool:
    """Whether a character leaves no mark: format characters and the other default-ignorable ones."""
    return (
        unicodedata.category(chr(cp)) == "Cf"
        or cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0)
        or 0x180B <= cp <= 0x180F
        or 0xFE00 <= cp <= 0xFE0F
        or 0xE0000 <= cp <= 0xE0FFF
    )


def _by_rule() -> dict[int, str]:
    """Dropped characters, spaces, and wide, narrow and presentation forms, from the character database."""
    table = {}
    for cp in [*range(0x80, TABLE_END), *range(0xE0000, 0xE1000)]:
        ch = chr(cp)
        if invisible(cp):
            table[cp] = ""
        elif unicodedata.category(ch) == "Zs":
            table[cp] = " "
        else:
            form = unicodedata.decomposition(ch).partition(">")[0]
            if form in ("<wide", "<narrow", "<initial", "<medial", "<final", "<isolated"):
                table[cp] = unicodedata.normalize("NFKD", ch)
    for cp in (9, 10, 13):
        table[cp] = " "
    return table


def _prototypes(spark: SparkSession) -> dict[int, str]:
    """Each character's prototype after decomposition, where it has another one than itself.

    Without Spark's ICU library there is no table, and no smaller one takes its place.
    """
    cps = [cp for cp in range(0x80, TABLE_END) if unicodedata.category(chr(cp)) not in ("Cn", "Cs", "Co", "Cc")]
    spoof = spark._jvm.com.ibm.icu.text.SpoofChecker
    if isinstance(spoof, JavaPackage):  # what the gateway gives for a class that isn't there
        raise RuntimeError("no ICU library in this session's JVM: look-alikes can't be told")
    got = spoof.Builder().build().getSkeleton("\n".join(map(chr, cps))).split("\n")
    assert len(got) == len(cps)
    table = {}
    for cp, proto in zip(cps, got):
        ch = chr(cp)
        category = unicodedata.category(ch)
        if unicodedata.normalize("NFD", ch) != ch or category in ("Nd", "No"):
            continue  # looked up only after decomposition; figures keep their own kind
        if 0x1100 <= cp <= 0x11FF or 0xA960 <= cp <= 0xA97F or 0xD7B0 <= cp <= 0xD7FF:
            continue  # letters that open and close a syllable share prototypes, but syllables don't look the same
        proto = proto.replace("rn", "m")
        if unicodedata.name(ch, "").startswith("LATIN SMALL LIGATURE"):
            proto = unicodedata.normalize("NFKD", ch)
        elif "l" in proto and (category == "Lu" or ch.lower() != ch):
            proto = proto.replace("l", "I")  # the data has one prototype for 1, I, l and |
        elif "l" in proto and category == "Nl":
            proto = unicodedata.normalize("NFKD", ch)
        if proto != ch:
            table[cp] = proto
    return table


_TABLES: dict[str, tuple[dict, dict]] = {}


def tables(spark: SparkSession) -> tuple[dict[int, str], dict[int, str]]:
    """The two look-alike tables (before and after decomposition), built once a process."""
    if "t" not in _TABLES:
        before, after = _by_rule(), _prototypes(spark)
        assert len(before) + len(after) <= MAX_TABLE, "look-alike table beyond its bound"
        _TABLES["t"] = (before, after)
    return _TABLES["t"]


def skeleton_of(text: str, before: dict[int, str], after: dict[int, str]) -> str:
    s = unicodedata.normalize("NFD", text.translate(before))
    return unicodedata.normalize("NFD", s.translate(after))


def skeleton(spark: SparkSession):
    """A column function: the skeleton of a text; null for null."""
    before, after = tables(spark)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: s if s is None or (s.isascii() and s.isprintable()) else skeleton_of(s, before, after))

    return run


def spellings(rows: DataFrame, group: list[str], text: str) -> DataFrame:
    """``(*group, text, n_rows, skeleton)``: the distinct texts of each group, laid out by (group, skeleton).

    Texts are made distinct before the skeleton is computed, so a text that fills a third of
    the table costs one call and one row of the shuffle per partition.  Whatever reads this
    twice by skeleton shares the one exchange, and with it the one pass of Python.
    """
    distinct = rows.groupBy(*group, text).agg(F.count(F.lit(1)).alias("n_rows"))
    marked = distinct.withColumn("skeleton", F.coalesce(skeleton(rows.sparkSession)(F.col(text)), F.lit("")))  # never null: no null test of it is pushed below the distinct
    return marked.repartition(*group, "skeleton")


def lookalike_pairs(rows: DataFrame, row_id: str, group: list[str], text: str) -> DataFrame:
    """``(*group, id_a, id_b)``: rows of a group whose texts look the same but are not equal.

    Pairs are found between *spellings*, not rows: equal texts never meet, so a group of exact
    copies costs nothing, and rows are attached only to spellings that have a partner.  Rows
    with null text or a null in ``group`` pair with nothing.  Empty texts look like texts of
    invisible characters only.  Repeated ids give each pair once.
    """
    rows = rows.select(row_id, *group, text).where(F.col(text).isNotNull()).dropna(subset=group)
    known = spellings(rows, group, text)
    a = known.select(*group, "skeleton", F.col(text).alias("_text_a"))
    b = known.select(*group, "skeleton", F.col(text).alias("_text_b"))
    pairs = a.join(b, [*group, "skeleton"]).where(F.col("_text_a") < F.col("_text_b")).drop("skeleton")
    left = rows.select(*group, F.col(text).alias("_text_a"), F.col(row_id).alias("_a"))
    right = rows.select(*group, F.col(text).alias("_text_b"), F.col(row_id).alias("_b"))
    met = pairs.join(left, [*group, "_text_a"]).join(right, [*group, "_text_b"]).where("_a <> _b")
    return met.select(*group, F.least("_a", "_b").alias("id_a"), F.greatest("_a", "_b").alias("id_b")).distinct()


def classes(rows: DataFrame, row_id: str, group: list[str], text: str) -> DataFrame:
    """One row per row of the table: ``(row_id, *group, skeleton, n_spellings, n_links, plain)``.

    The form of the pairs that grows with the rows alone: ``skeleton`` names the class within
    the group, ``n_spellings`` counts its different texts, ``n_links`` the rows that look like
    this one and are not equal to it, and ``plain`` says whether one of its texts is the
    skeleton itself.  Null is a group of its own; rows with null text have null, 0, 0, false.
    Repeated ids keep a row each and count as rows.
    """
    marked = rows.select(row_id, *group, F.to_json(F.struct(*group)).alias("_g"), F.col(text).alias("_text"))
    known = spellings(marked.where("_text is not null"), ["_g"], "_text")
    plain = F.max(F.col("_text") == F.col("skeleton")).alias("plain")
    sizes = known.groupBy("_g", "skeleton").agg(F.count(F.lit(1)).alias("n_spellings"), F.sum("n_rows").alias("_all"), plain)
    spelled = known.join(sizes, ["_g", "skeleton"]).select("_g", "_text", "skeleton", "n_spellings", (F.col("_all") - F.col("n_rows")).alias("n_links"), "plain")
    none = F.lit(0).cast("long")
    return marked.join(spelled, ["_g", "_text"], "left").select(
        row_id, *group, "skeleton", F.coalesce("n_spellings", none).alias("n_spellings"), F.coalesce("n_links", none).alias("n_links"), F.coalesce("plain", F.lit(False)).alias("plain")
    )


#: Fixed value: the mark of a missing term.
MISSING = "....."


def both_fields(localized: DataFrame, terms: DataFrame) -> DataFrame:
    """``(id, field_name, language_code, text)`` of the terms of localizations and the designations of terms; the mark of a missing term is null."""
    text = lambda c: F.when(F.trim(c) != MISSING, F.col(c)).alias("text")
    a = localized.select(F.col("l10n_id").alias("id"), F.lit("term").alias("field_name"), "language_code", text("term"))
    b = terms.select(F.col("term_id").alias("id"), F.lit("designation").alias("field_name"), "language_code", text("designation"))
    return a.unionByName(b)


def found(localized: DataFrame, terms: DataFrame) -> DataFrame:
    """``(field_name, id_a, id_b)`` over both fields."""
    pairs = lookalike_pairs(both_fields(localized, terms), "id", ["field_name", "language_code"], "text")
    return pairs.select("field_name", "id_a", "id_b")


def all_classes(localized: DataFrame, terms: DataFrame) -> DataFrame:
    """``(field_name, id, language_code, skeleton, n_spellings, n_links, plain)``: the class of every row of both fields."""
    return classes(both_fields(localized, terms), "id", ["field_name", "language_code"], "text")
