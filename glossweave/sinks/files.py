"""Documents, reports and database files.

Concept documents are written by the executors, packed or one file each; reports and registers
are one small file, written by the driver from rows whose number is bounded by the caller's data
model (areas, works of a bibliography page, tallies).
"""

from __future__ import annotations

import csv
import json
import os
import re
import sqlite3
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StringType

from glossweave.operators.sheet import COLUMNS, first_wins


def dump(value) -> str:
    """A value as a YAML document; without PyYAML as JSON, which is YAML too."""
    try:
        import yaml

        return yaml.safe_dump(value, allow_unicode=True, sort_keys=False)
    except ImportError:
        return json.dumps(value, ensure_ascii=False) + "\n"


def compact(value):
    """Without null members and empty lists, as documents are stored."""
    if isinstance(value, dict):
        out = {k: compact(v) for k, v in value.items()}
        return {k: v for k, v in out.items() if v not in (None, [], {})}
    if isinstance(value, list):
        return [compact(v) for v in value]
    return value


class _Count(WriterCommitMessage):
    def __init__(self, n: int):
        self.n = n


class DocumentWriter(DataSourceWriter):
    """Rows ``name, body``: each body into the file of its name; a rewritten task writes the same files again."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator):
        Path(self.folder).mkdir(parents=True, exist_ok=True)
        n = 0
        for row in iterator:
            if not re.fullmatch(r"[^/\\\0]+", row.name) or row.name in (".", ".."):
                raise ValueError(f"no file name: {row.name!r}")
            temporary = Path(self.folder, f".{row.name}.{os.getpid()}")
            temporary.write_text(row.body, encoding="utf-8")
            temporary.replace(Path(self.folder, row.name))
            n += 1
        return _Count(n)


class DocumentSink(DataSource):
    @classmethod
    def name(cls):
        return "documents_in_folder"

    def writer(self, schema, overwrite):
        return DocumentWriter(self.options["path"])


def write_documents(rows: DataFrame, name: str, value: str, folder: str, packed: bool = False) -> None:
    """One document per row: ``name`` (a column) with the struct or text of column ``value``.

    ``packed`` writes a dataset ``name, body`` with Spark's own writer, wherever its file
    systems reach; structs become JSON, which is YAML in flow style, without Python.
    Otherwise each document is a YAML file of its name in ``folder``, which all executors
    must share.
    """
    is_text = rows.schema[value].dataType == StringType()
    if packed:
        body = F.col(value) if is_text else F.to_json(F.col(value))
        rows.select(F.col(name).alias("name"), body.alias("body")).write.mode("overwrite").parquet(folder)
        return

    @F.udf(StringType(), useArrow=True)
    def dumped(x):
        return dump(compact(x.asDict(recursive=True)))

    rows.sparkSession.dataSource.register(DocumentSink)
    body = F.col(value) if is_text else dumped(F.col(value))
    rows.select(F.col(name).alias("name"), body.alias("body")).write.format("documents_in_folder").mode("append").save(folder)


def write_concepts(concepts: DataFrame, folder: str, packed: bool = False) -> None:
    """A grouped document per concept under ``concepts/``: the concept, then each of its localizations.

    ``packed`` as in ``write_documents``: one struct of both.
    """
    have = lambda c: F.col(c) if c in concepts.columns else F.lit(None).alias(c)
    data = F.struct(F.col("code").alias("identifier"), "domains", have("tags"), have("figures"), have("references"))
    managed = F.struct(F.col("code").alias("id"), F.lit("3").alias("schema_version"), "status", data.alias("data"), "related")
    each = F.transform("languages", lambda lang: F.struct(F.concat_ws("-", "code", lang).alias("id"), lang.alias("language_code"), F.element_at("localized", lang).alias("data")))

    @F.udf(StringType(), useArrow=True)
    def grouped(concept, localized):
        return "---\n".join(["", *[dump(compact(x.asDict(recursive=True))) for x in (concept, *localized)]])

    body = F.struct(managed.alias("concept"), each.alias("localized")) if packed else grouped(managed, each)
    rows = concepts.select(F.concat(F.lit("concept-"), "code", F.lit(".yaml")).alias("name"), body.alias("body"))
    write_documents(rows, "name", "body", os.path.join(folder, "concepts"), packed)


def write_figures(figures: DataFrame, folder: str, packed: bool = False) -> None:
    rows = figures.select(F.concat("figure_id", F.lit(".yaml")).alias("name"), F.struct(*[F.col(c) for c in figures.columns]).alias("value"))
    write_documents(rows, "name", "value", os.path.join(folder, "figures"), packed)


def write_list(rows: DataFrame, path: str, wrap: dict | None = None, key: str | None = None) -> int:
    """Rows in their order as one YAML list, streamed; nothing is written for no rows.  Returns how many there were."""
    n = 0
    temporary = f"{path}.part"
    with open(temporary, "w", encoding="utf-8") as f:
        if wrap is not None:
            f.write(dump(wrap) + f"{key}:\n")
        for row in rows.toLocalIterator():
            f.write(dump([compact(row.asDict(recursive=True)) if len(row) > 1 else row[0]]))
            n += 1
    if n or wrap is not None:
        os.replace(temporary, path)
    else:
        os.remove(temporary)
    return n


def write_register(register: DataFrame, path: str, **about) -> None:
    """The dataset's description and its tree of areas and sections."""
    write_list(register.select(F.col("area_code").alias("code"), F.col("area_title").alias("title"), "children"), path, wrap={"schema_type": "terminology", "schema_version": "3", **about}, key="sections")


#: Columns of the change report.
CHANGE_COLUMNS = ["code", "section", "field", "language", "detected_at", "old_value", "new_value"]


def write_changes(changes: DataFrame, path: str, single_file: bool = False) -> None:
    """Change rows as CSV: a folder written by the executors, or on request one file streamed in code order."""
    from glossweave.operators.reconcile import change_csv

    rows = change_csv(changes).select(*CHANGE_COLUMNS)
    if not single_file:
        rows.write.mode("overwrite").option("header", True).option("multiLine", True).csv(path)
        return
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(CHANGE_COLUMNS)
        for row in rows.orderBy("code", "language", "field").toLocalIterator():
            out.writerow(["" if x is None else x for x in row])


def write_reports(reconciled: DataFrame, changes: DataFrame, folder: str, single_file: bool = False) -> None:
    """``summary.yaml``, ``changes.csv``, ``retired.yaml`` and ``new.yaml``."""
    from glossweave.operators.reconcile import codes_of_origin, stats, summary

    Path(folder).mkdir(parents=True, exist_ok=True)
    tallies = {"field": {}, "language": {}, "section": {}}
    total = 0
    for r in summary(changes).orderBy("tally", F.desc("n_changes"), "value").toLocalIterator():
        if r.tally == "total":
            total = r.n_changes
        else:
            tallies[r.tally][r.value] = r.n_changes
    numbers = stats(reconciled).first().asDict()
    sources = {k: numbers[k] for k in ("in_both", "termbase_only", "live_only") if numbers[k]}
    text = dump({"total_concepts": numbers["total"], "sources": sources, "changes": {"total": total, **{f"by_{k}": v for k, v in tallies.items()}}})
    Path(folder, "summary.yaml").write_text(text, encoding="utf-8")
    write_changes(changes, os.path.join(folder, "changes.csv"), single_file)
    write_list(codes_of_origin(reconciled, "termbase_only"), os.path.join(folder, "retired.yaml"))
    write_list(codes_of_origin(reconciled, "live_only"), os.path.join(folder, "new.yaml"))


def write_sqlite(sheet: DataFrame, path: str, table: str = "concepts") -> int:
    """A sheet as a table of text columns with the first two as key, first row of a key only, rows in reading order.

    A SQLite file has one writer: rows are streamed to the driver partition by partition.
    """
    rows = first_wins(sheet, ["IEVREF", "LANGUAGE"]).orderBy("_ord").select(*COLUMNS)
    if os.path.exists(path):
        os.remove(path)
    with sqlite3.connect(path) as db:
        db.execute(f"CREATE TABLE {table} ({', '.join(f'{c} TEXT' for c in COLUMNS)}, PRIMARY KEY ({COLUMNS[0]}, {COLUMNS[1]}))")
        for c in COLUMNS[:2]:
            db.execute(f"CREATE INDEX {table}_{c.lower()} ON {table} ({c})")
        n = 0
        for row in rows.toLocalIterator():
            db.execute(f"INSERT INTO {table} VALUES ({', '.join('?' * len(COLUMNS))})", tuple(row))
            n += 1
    return n
