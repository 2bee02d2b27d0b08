"""Stored snapshots: one big map of codes, a file per concept, or a page per concept."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from glossweave.sources.sqlite import pushdown

RECORD = (
    "_ord long, code string, language string, lang_no int, terms array<struct<type:string,designation:string,normative_status:string,gender:string,plurality:string,usage_info:string>>, "
    "definition string, notes array<string>, examples array<string>, entry_status string, classification string, date_accepted string, date_amended string, review_date string, "
    "review_decision_date string, review_decision_event string"
)
_TERM = ("type", "designation", "normative_status", "gender", "plurality", "usage_info")
_TEXTS = ("entry_status", "classification", "date_accepted", "date_amended", "review_date", "review_decision_date", "review_decision_event")
#: Bytes of a snapshot file that one task reads.
RANGE = 32 << 20


def _text(x) -> str | None:
    return None if x is None else x if isinstance(x, str) else x.isoformat() if hasattr(x, "isoformat") else json.dumps(x, ensure_ascii=False)


def _texts(x) -> list[str]:
    listed = x if isinstance(x, list) else [] if x is None else [x]
    return [_text(i.get("content") if isinstance(i, dict) else i) or "" for i in listed]


def languages_of(order: int, code: str, entry) -> list[tuple]:
    """One row per language of a concept: the values of its map that are maps with terms.

    Several definitions are one text with a blank line between them.
    """
    rows = []
    for lang, v in entry.items() if isinstance(entry, dict) else ():
        if not (isinstance(v, dict) and v.get("terms")):
            continue
        terms = [tuple(_text(t.get(k)) for k in _TERM) for t in v["terms"] if isinstance(t, dict)]
        definitions = [t for t in _texts(v.get("definition")) if t]
        rows.append((order, code, lang, len(rows), terms, "\n\n".join(definitions) if definitions else None, _texts(v.get("notes")), _texts(v.get("examples")), *[_text(v.get(k)) for k in _TEXTS]))
    return rows


def _load(text: str):
    try:
        return json.loads(text)
    except ValueError:
        import yaml

        return yaml.load(text, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))


class _Bytes(InputPartition):
    def __init__(self, path: str, low: int, high: int):
        super().__init__((path, low, high))


_KEY = re.compile(rb"^[^\s#\-][^\n]*:", re.MULTILINE)


class TermbaseReader(DataSourceReader):
    """Byte ranges of a YAML map; a range holds the entries whose key begins in it."""

    def __init__(self, path: str):
        self.path, self.code = path, None

    def partitions(self):
        size = os.path.getsize(self.path)
        return [_Bytes(self.path, a, min(a + RANGE, size)) for a in range(0, max(size, 1), RANGE)]

    def read(self, partition):
        path, low, high = partition.value
        for at, block in _blocks(path, low, high):
            if self.code is not None and self.code.encode() not in block.split(b"\n", 1)[0]:
                continue
            for code, entry in (_load(block.decode()) or {}).items():
                if self.code in (None, str(code)):
                    yield from languages_of(at, str(code), entry)


def _blocks(path: str, low: int, high: int):
    """(place, bytes) of each top-level entry whose key begins in [low, high)."""
    with open(path, "rb") as f:
        f.seek(max(low - 1, 0))
        if low:
            f.readline()  # the line that a range begins in belongs to the range before
        at, start, lines = f.tell(), None, []
        while line := f.readline():
            if _KEY.match(line):
                if lines:
                    yield start, b"".join(lines)
                if at >= high:
                    return
                start, lines = at, [line]
            elif lines:
                lines.append(line)
            at = f.tell()
        if lines:
            yield start, b"".join(lines)


class _ByCode:
    """Takes an equality on the code; Spark refuses a reader that has ``pushFilters`` while its setting is off."""

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("code",):
                self.code = f.value
            else:
                yield f


class PushingTermbaseReader(_ByCode, TermbaseReader):
    pass


class TermbaseSource(DataSource):
    @classmethod
    def name(cls):
        return "termbase_yaml"

    def schema(self):
        return RECORD

    def reader(self, schema):
        return (PushingTermbaseReader if self.options.get("pushdown") == "true" else TermbaseReader)(self.options["path"])


class ConceptFilesReader(DataSourceReader):
    """Files ``concept-CODE.yaml`` of a folder; an equality on the code opens one file only."""

    def __init__(self, folder: str):
        self.folder, self.code = folder, None

    def partitions(self):
        names = [f"concept-{self.code}.yaml"] if self.code is not None else sorted(n for n in os.listdir(self.folder) if re.fullmatch(r"concept-.*\.yaml", n))
        step = max(1, len(names) // 256 + 1)
        return [_Bytes("\n".join(names[i : i + step]), i, i + step) for i in range(0, len(names), step)] or [_Bytes("", 0, 0)]

    def read(self, partition):
        names, low, _ = partition.value
        for n, name in enumerate(filter(None, names.split("\n")), low):
            path = Path(self.folder, name)
            if path.is_file():
                entry = _load(path.read_text(encoding="utf-8"))
                code = name[len("concept-") : -len(".yaml")]
                yield from languages_of(n, code, entry)


class PushingConceptFilesReader(_ByCode, ConceptFilesReader):
    pass


class ConceptFilesSource(DataSource):
    @classmethod
    def name(cls):
        return "concept_files"

    def schema(self):
        return RECORD

    def reader(self, schema):
        return (PushingConceptFilesReader if self.options.get("pushdown") == "true" else ConceptFilesReader)(self.options["path"])


def read_termbase(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(TermbaseSource)
    return spark.read.format("termbase_yaml").option("pushdown", pushdown(spark)).load(path)


def read_concepts(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(ConceptFilesSource)
    return spark.read.format("concept_files").option("pushdown", pushdown(spark)).load(folder)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``code, html`` of a folder's ``CODE.html`` files."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.html")
    return files.select(F.regexp_extract("_metadata.file_name", r"^(.*)\.html$", 1).alias("code"), F.col("value").alias("html"))


def parsed_pages(pages: DataFrame) -> DataFrame:
    """``code, entries, parsed`` of pages; ``parsed`` is false for pages that don't show their code."""
    from glossweave.markup.pages import page_entries

    rows = pages.withColumn("entries", page_entries(F.col("html"), F.col("code")))
    return rows.select("code", "entries", F.col("entries").isNotNull().alias("parsed"))


def merged_terms(rows: DataFrame) -> DataFrame:
    """Termbase rows with markers read from their designations and joined to the stored attributes.

    Stored gender and number come first, then parsed ones, each once; the field of
    application is the stored usage, else the parsed domain.
    """
    from glossweave.parsers.markers import markers

    each = rows.select("code", "language", "_ord", F.posexplode("terms").alias("term_no", "_t")).withColumn("_m", markers(F.col("_t.designation")))
    joined = lambda stored, found: F.array_distinct(F.array_compact(F.concat(F.array(stored), F.coalesce(found, F.array().cast("array<string>")))))
    return each.select(
        "code", "language", "_ord", "term_no", "_m.designation", F.col("_t.normative_status").alias("normative_status"),
        joined(F.col("_t.gender"), F.col("_m.genders")).alias("gender"), joined(F.col("_t.plurality"), F.col("_m.numbers")).alias("number"),
        F.coalesce("_t.usage_info", "_m.domain").alias("field_of_application"), F.col("_m.part_of_speech").alias("part_of_speech"), F.col("_m.is_prefix").alias("is_prefix"),
    )


def concept_dates(rows: DataFrame) -> DataFrame:
    """``code, status, dates`` from each concept's first language; amended only if it differs from accepted."""
    from glossweave.functions.labels import termbase_status

    first = rows.groupBy("code").agg(F.min_by(F.struct("entry_status", "date_accepted", "date_amended"), F.struct("lang_no", "_ord")).alias("_f"))
    a, m = F.col("_f.date_accepted"), F.col("_f.date_amended")
    date = lambda kind, c: F.struct(F.lit(kind).alias("type"), c.alias("date"))
    dates = F.array_compact(F.array(F.when(a.isNotNull(), date("accepted", a)), F.when(m.isNotNull() & ~m.eqNullSafe(a), date("amended", m))))
    return first.select("code", termbase_status(F.col("_f.entry_status")).alias("status"), dates.alias("dates"))
