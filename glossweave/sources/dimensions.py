"""Bundled dimensions, loaded from the files that the caller names; each is small and read on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glossweave.session import MAX_DRIVER_ROWS


def _yaml(path: str):
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def _frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    if len(rows) > MAX_DRIVER_ROWS:
        raise ValueError(f"{len(rows)} rows are no dimension; load them as a table")
    return spark.createDataFrame(rows, schema)


def subject_areas(spark: SparkSession, path: str) -> DataFrame:
    """``area_code, area_title, section_code, section_title``; an area without sections has one row with nulls."""
    rows = []
    for a in (_yaml(path) or {}).get("areas") or []:
        for s in a.get("sections") or [{}]:
            rows.append((str(a["code"]), a.get("title"), None if not s else str(s["code"]), s.get("title")))
    return _frame(spark, rows, "area_code string, area_title string, section_code string, section_title string")


def languages(spark: SparkSession, path: str) -> DataFrame:
    """``alpha2, alpha3, eng, fra, deu`` of the entries with a two-letter terminology code."""
    rows = [(v["iso_639_1"], k, *[(v.get(n) or [None])[0] if isinstance(v.get(n), list) else v.get(n) for n in ("eng", "fra", "deu")]) for k, v in _yaml(path).items() if v.get("iso_639_1") and v.get("terminology")]
    return _frame(spark, rows, "alpha2 string, alpha3 string, eng string, fra string, deu string")


def enum_labels(spark: SparkSession, path: str) -> DataFrame:
    """``lang, enum, value, label``."""
    rows = [(lang, enum, str(value), str(label)) for lang, enums in _yaml(path).items() if isinstance(enums, dict) for enum, values in enums.items() if isinstance(values, dict) for value, label in values.items()]
    return _frame(spark, rows, "lang string, enum string, value string, label string")
