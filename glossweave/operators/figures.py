"""Figures: image macros in converted texts as entities of their own, and mentions in their place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.operators.sheet import first_of as first_of_key

#: How an image macro, and a caption in it, are written.
FOLDER = "/assets/images/parts"
MACRO = r"image::/assets/images/parts/([0-9]+)/([\w.\-]+)\[([^\]]*)\]"
CAPTION = r"(?s)\A(Figure\s+[0-9]+)\s*[–-]\s*(.+)\z"
LABEL = r"\AFigure\s+[0-9]+\z"


def caption_parts(bracket: Column) -> Column:
    """Struct (identifier, caption): ``Figure N`` and the words behind its dash; either may be missing, both are for a blank."""
    c = F.trim(bracket)
    both, only = c.rlike(CAPTION), c.rlike(LABEL)
    identifier = F.when(both, F.regexp_replace(F.regexp_extract(c, CAPTION, 1), r"\s+", " ")).when(only, c)
    words = F.when(both, F.trim(F.regexp_extract(c, CAPTION, 2))).when(~only & (c != ""), c)
    return F.struct(identifier.alias("identifier"), words.alias("caption"))


def figure_id(file: Column) -> Column:
    return F.concat(F.lit("fig-"), F.regexp_replace(file, r"\.[^.]+\z", ""))


def image_format(file: Column) -> Column:
    return F.lower(F.regexp_extract(file, r"[^.]\.([^.]*)\z", 1))


def hits_of(text: Column) -> Column:
    """``ARRAY<STRUCT<area, file, bracket>>`` of a text's macros in order; [] for null."""
    groups = [F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(MACRO), F.lit(i)) for i in (1, 2, 3)]
    return F.arrays_zip(groups[0].alias("area"), groups[1].alias("file"), groups[2].alias("bracket"))


def figure_hits(rows: DataFrame, fields=("definition", "examples", "notes")) -> DataFrame:
    """One row per macro of a localized concept: ``code, language, _ord, _n, figure_id, identifier, caption, src, format``.

    Only three-letter languages count.  ``_n`` is the macro's place within the row.
    """
    texts = F.concat(*[F.array(f) if dict(rows.dtypes)[f] == "string" else F.coalesce(F.col(f), F.array().cast("array<string>")) for f in fields])
    some = rows.where(F.length("language") == 3).select("code", "language", "_ord", F.flatten(F.transform(texts, hits_of)).alias("_hits"))
    each = some.select("code", "language", "_ord", F.posexplode("_hits").alias("_n", "_h"))
    parts = caption_parts(F.col("_h.bracket"))
    return each.select(
        "code", "language", "_ord", "_n", figure_id(F.col("_h.file")).alias("figure_id"), parts["identifier"].alias("identifier"), parts["caption"].alias("caption"),
        F.concat_ws("/", F.lit(FOLDER), F.col("_h.area"), F.col("_h.file")).alias("src"), image_format(F.col("_h.file")).alias("format"),
    )


def figure_entities(hits: DataFrame) -> DataFrame:
    """One row per figure: the first identifier (null if the first macro has none), the first caption per language, images distinct by source.

    The first hits of each (figure, language) and (figure, source) are cut out before the
    shuffle; a figure that every row shows is a few rows by then.
    """
    at = [F.col("_ord").asc(), F.col("_n").asc()]
    captions = (
        first_of_key(hits.where("caption is not null").select("figure_id", "language", "caption", "_ord", "_n"), ["figure_id", "language"], [*at, F.col("caption").asc()])
        .groupBy("figure_id")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "caption")))).alias("caption"))
    )
    image = F.struct("_ord", "_n", "src", "format", "identifier")
    images = (
        first_of_key(hits.select("figure_id", "src", "format", "identifier", "_ord", "_n"), ["figure_id", "src"], [*at, F.col("identifier").asc(), F.col("format").asc()])
        .groupBy("figure_id")
        .agg(F.array_sort(F.collect_list(image)).alias("_images"))
    )
    shown = F.transform("_images", lambda i: F.struct(i["src"].alias("src"), i["format"].alias("format"))).alias("images")
    return images.join(captions, "figure_id", "left").select("figure_id", F.col("_images")[0]["identifier"].alias("identifier"), "caption", shown)


def figure_references(hits: DataFrame) -> DataFrame:
    """``code, figure_id, display``: each figure once per concept, the first macro's identifier shown."""
    first = first_of_key(hits.select("code", "figure_id", "identifier", "_ord", "_n"), ["code", "figure_id"], [F.col(c).asc() for c in ("_ord", "_n", "identifier")])
    return first.select("code", "figure_id", F.col("identifier").alias("display"))


def row_figures(*fields: Column) -> Column:
    """``ARRAY<STRUCT<entity_id, display>>`` of a row's texts (arrays): each figure once, the first macro's identifier shown."""
    found = F.flatten(F.transform(F.concat(*[F.coalesce(f, F.array().cast("array<string>")) for f in fields]), hits_of))
    return first_of(F.transform(found, lambda h: F.struct(figure_id(h["file"]).alias("entity_id"), caption_parts(h["bracket"])["identifier"].alias("display"))), "entity_id")


def first_of(items: Column, key: str) -> Column:
    """An array's structs without those whose ``key`` an earlier one has."""
    return F.filter(items, lambda x, i: F.array_position(F.transform(items, lambda y: y[key]), x[key]) == i + 1)


def with_mentions(text: Column) -> Column:
    """A text with mentions in place of its macros, natively: the text between macros and the mentions are woven together."""
    between = F.split(text, MACRO, -1)
    shown = F.transform(
        hits_of(text),
        lambda h: F.concat(
            F.lit("{{fig:"),
            figure_id(h["file"]),
            F.when(F.trim(h["bracket"]) == "", F.lit("")).otherwise(
                F.concat(F.lit(", "), F.concat_ws(" - ", caption_parts(h["bracket"])["identifier"], caption_parts(h["bracket"])["caption"]))
            ),
            F.lit("}}"),
        ),
    )
    return F.array_join(F.zip_with(between, shown, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
