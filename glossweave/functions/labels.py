"""Closed vocabularies of the sheet, the termbase and the pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Status words.
SHEET_STATUS = {"standard": "valid"}
TERMBASE_STATUS = {
    "Standard": "valid",
    "Published": "valid",
    "Effective": "valid",
    "Draft": "draft",
    "Not Valid": "notValid",
    "Superseded": "superseded",
    "Retired": "retired",
}
CLASSIFICATION = {
    "认可的": "admitted",
    "допустимый": "admitted",
    "admitido": "admitted",
    "首选的": "preferred",
    "suositettava": "preferred",
    "suositeltava": "preferred",
    "рекомендуемый": "preferred",
    "preferente": "preferred",
}
DESIGNATION_STATUS = {"obsoleto": "deprecated", "напуштен": "deprecated"}
#: Languages of the pages.
PAGE_LANGUAGES = {
    "en": "eng", "fr": "fra", "ar": "ara", "de": "deu", "es": "spa", "it": "ita", "ko": "kor", "ja": "jpn", "pl": "pol", "pt": "por",
    "sr": "srp", "sv": "swe", "zh": "zho", "nl": "nld", "fi": "fin", "cs": "ces", "no": "nor", "ru": "rus", "sl": "slv", "sk": "slk",
}


def lookup(words: dict[str, str], c: Column) -> Column:
    """The word's meaning; null for null and unknown words."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in words.items() for x in pair]), c)


def sheet_status(c: Column) -> Column:
    return lookup(SHEET_STATUS, F.lower(c))


def termbase_status(c: Column) -> Column:
    """The termbase's status; anything unknown, null included, is valid."""
    return F.coalesce(lookup(TERMBASE_STATUS, c), F.lit("valid"))


def classification(c: Column) -> Column:
    return F.coalesce(lookup(CLASSIFICATION, c), F.lower(F.nullif(c, F.lit(""))))


def designation_status(c: Column) -> Column:
    return F.coalesce(lookup(DESIGNATION_STATUS, c), c)


def page_language(c: Column) -> Column:
    return lookup(PAGE_LANGUAGES, c)


def anchor(label: Column) -> Column:
    """The id under which a reference is listed."""
    return F.lower(F.regexp_replace(F.regexp_replace(label, "[ /:]", "_"), "__+", "_"))


def reference_label(source: Column, ref_id: Column) -> Column:
    return F.trim(F.concat_ws(" ", source, ref_id))


def reference_type(source: Column) -> Column:
    s = F.coalesce(source, F.lit(""))
    return F.when(s.rlike("^(IEV|VIM|JCGM)"), "vocabulary").when(s.rlike("^ITU"), "recommendation").when(s.rlike("^(BIPM|BBIPM)"), "brochure").otherwise("standard")


def language_dimension(spark: SparkSession) -> DataFrame:
    """``alpha2, alpha3, eng, fra, deu``: the two-letter languages of the JVM's ISO 639 data with their terminology codes.

    About 190 rows, made once on the driver from the platform's own table.
    """
    jvm = spark._jvm
    locale = jvm.java.util.Locale
    rows = []
    for code in locale.getISOLanguages():
        if len(code) == 2:
            one = locale(code)
            alpha3 = one.getISO3Language()
            rows.append((code, alpha3, *[one.getDisplayLanguage(x) for x in (locale.ENGLISH, locale.FRENCH, locale.GERMAN)]))
    # the platform keeps three superseded codes beside their successors
    superseded = {"iw", "in", "ji"}
    return spark.createDataFrame([r for r in rows if r[0] not in superseded], "alpha2 string, alpha3 string, eng string, fra string, deu string")


def three_letter(df: DataFrame, column: str, languages: DataFrame, out: str = "language", strict: bool = False, keep: bool = True) -> DataFrame:
    """``df`` with the three-letter code of a language cell.

    A cell longer than two characters is looked up by the text before its first space; the
    three-letter codes of ``languages`` stand for themselves, but not if ``strict``.  A cell
    that is no language stays as it is if ``keep``, else it is null in ``out``, for the
    caller to quarantine; strict keeps none.  The join carries no hint: Spark broadcasts the
    dimension while its measured size allows it.
    """
    key = F.when(F.length(column) > 2, F.split(F.col(column), " ").getItem(0)).otherwise(F.col(column))
    names = languages.select(F.col("alpha2").alias("_name"), F.col("alpha3").alias("_alpha3"))
    if not strict:
        names = names.unionByName(languages.select(F.col("alpha3").alias("_name"), F.col("alpha3").alias("_alpha3"))).distinct()
    joined = df.withColumn("_key", key).join(names, F.col("_key") == F.col("_name"), "left")
    value = F.coalesce("_alpha3", column) if keep and not strict else F.col("_alpha3")
    return joined.withColumn(out, value).drop("_key", "_name", "_alpha3")
