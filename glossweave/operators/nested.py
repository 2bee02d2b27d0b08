"""Deeply nested records as related flat tables.

One pass over the stored bodies: a depth-first visitor walks each parsed record and emits,
for every object it meets that belongs to a known table, one *tagged row*
``(tag, pk, parent_pk, record_id, lang, pos, item, payload)``.  ``payload`` is the object
itself as JSON, so that no field is lost; ``write_tables`` writes the rows partitioned by tag
and ``read_flat`` puts the schema of one tag on its payload.

The visitor runs inside one ``mapInArrow``: no shuffle, no second read for a second table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TAGGED = T.StructType(
    [
        T.StructField("tag", T.StringType(), False),
        T.StructField("pk", T.StringType(), False),
        T.StructField("parent_pk", T.StringType(), True),
        T.StructField("record_id", T.LongType(), True),
        T.StructField("lang", T.StringType(), False),
        T.StructField("pos", T.IntegerType(), False),
        T.StructField("item", T.StringType(), False),
        T.StructField("payload", T.StringType(), False),
    ]
)

#: Schema of each tag's payload, applied on read.
PAYLOAD = {
    "record": "id STRING, schema_version STRING, status STRING, tags ARRAY<STRING>",
    "domain": "concept_id STRING, source STRING, ref_type STRING, note STRUCT<since: STRING, by: ARRAY<STRING>>",
    "related": "type STRING, ref STRUCT<source: STRING, id: STRING>",
    "localized": "language_code STRING, entry_status STRING, definition STRING, dates ARRAY<STRUCT<type: STRING, date: STRING>>",
    "term": "type STRING, designation STRING, normative_status STRING, usage_info STRING, grammar_info STRING",
    "note": "content STRING",
    "example": "content STRING",
    "source": "type STRING, status STRING, origin STRUCT<ref: STRUCT<source: STRING, id: STRING>, locality: STRUCT<type: STRING, reference_from: STRING>>",
}


_WS = re.compile(r"[ \t\n\r]*")


def deep_loads(text: str):
    """``json.loads`` for texts nested beyond Python's recursion limit: open containers are on a stack of its own."""
    scalar = json.JSONDecoder().raw_decode
    skip = lambda i: _WS.match(text, i).end()

    def key_at(i: int) -> tuple[str, int]:
        if text[i : i + 1] != '"':
            raise ValueError(f"no key at {i}")
        key, i = scanstring(text, i + 1, True)
        i = skip(i)
        if text[i : i + 1] != ":":
            raise ValueError(f"no colon at {i}")
        return key, skip(i + 1)

    boxes: list[tuple] = []
    i = skip(0)
    while True:
        c = text[i : i + 1]
        if c and c in "{[":
            value, i = {} if c == "{" else [], skip(i + 1)
            if text[i : i + 1] != ("}" if c == "{" else "]"):
                key, i = key_at(i) if c == "{" else (None, i)
                boxes.append((value, key))
                continue
            i += 1
        else:
            value, i = scalar(text, i)
        while True:  # a value is complete: into its container, which may be complete with it
            i = skip(i)
            if not boxes:
                if i != len(text):
                    raise ValueError(f"more text at {i}")
                return value
            box, key = boxes.pop()
            if isinstance(box, list):
                box.append(value)
            else:
                box[key] = value
            c, value, i = text[i : i + 1], box, i + 1
            if c == ",":
                i = skip(i)
                boxes.append((box, None))
                if isinstance(box, dict):
                    key, i = key_at(i)
                    boxes[-1] = box, key
                break
            if c != ("]" if isinstance(box, list) else "}"):
                raise ValueError(f"no end at {i - 1}")


class _Written(str):
    """Text that stands as it is."""


def dumps(x) -> str:
    """A value as JSON, however deep."""
    try:
        return json.dumps(x, ensure_ascii=False)
    except RecursionError:
        pass
    out, todo = [], [x]
    while todo:
        o = todo.pop()
        if isinstance(o, _Written):
            out.append(o)
        elif isinstance(o, (dict, list)):
            parts: list = [_Written("{" if isinstance(o, dict) else "[")]
            for n, k in enumerate(o):
                comma = ", " if n else ""
                parts += [_Written(f"{comma}{json.dumps(k, ensure_ascii=False)}: "), o[k]] if isinstance(o, dict) else [_Written(comma), k]
            todo += reversed([*parts, _Written("}" if isinstance(o, dict) else "]")])
        else:
            out.append(json.dumps(o, ensure_ascii=False))
    return "".join(out)


def parse_body(body: str | None) -> dict | None:
    """The record of a stored body, or None if it is null, empty, cut off or no object.

    Bodies are flow-style YAML that is also JSON; a complete body of another YAML style is
    read by PyYAML where that is installed.
    """
    if body is None or not body.strip():
        return None
    try:
        try:
            got = json.loads(body)
        except RecursionError:
            got = deep_loads(body)
    except ValueError:
        if body.lstrip()[:1] in "{[":  # flow style: what JSON rejects is cut off or broken
            return None
        try:
            import yaml

            got = yaml.safe_load(body)
        except Exception:
            return None
    return got if isinstance(got, dict) else None


def _objects(x) -> list[dict]:
    """An array's objects; a single object is an array of one; anything else is none."""
    return [o for o in (x if isinstance(x, list) else [x]) if isinstance(o, dict)]


def _text(x) -> str:
    return "" if x is None else x if isinstance(x, str) else dumps(x)


def visit(record_id: int, body: str | None, tags: frozenset[str] = frozenset(PAYLOAD), payload: bool = True) -> Iterator[tuple]:
    """Tagged rows of one body, depth first, in written order; none for a body that is not complete.

    Objects of other ``tags`` are walked but not emitted; without ``payload`` it stays empty.
    """
    for row in _visit(record_id, body):
        if row[0] in tags:
            yield *row[:-1], dumps(row[-1]) if payload else ""


def _visit(record_id: int, body: str | None) -> Iterator[tuple]:
    top = parse_body(body)
    if top is None:
        return
    root = f"{record_id}"
    inner = top.get("data") if isinstance(top.get("data"), dict) else {}

    def row(tag, pk, parent, lang, pos, item, o):
        return tag, pk, parent, record_id, lang, pos, item, o

    shallow = {k: v for k, v in {**inner, **top}.items() if k not in ("data", "domains", "localized_concepts", "related")}
    if isinstance(shallow.get("tags"), str):
        shallow["tags"] = [shallow["tags"]]
    yield row("record", root, None, "", 0, _text(top.get("id", inner.get("id"))), shallow)
    # a record may hold its children on both levels: they are numbered through
    both = lambda field: (holder.get(field) for holder in (top, inner))
    for i, o in enumerate((o for x in both("domains") for o in _objects(x)), 1):
        yield row("domain", f"{root}/d{i}", root, "", i, _text(o.get("concept_id")), o)
    for i, o in enumerate((o for x in both("related") for o in _objects(x)), 1):
        ref = o.get("ref")
        yield row("related", f"{root}/r{i}", root, "", i, _text(ref.get("id")) if isinstance(ref, dict) else "", o)
    for n, (key, o) in enumerate((lo for x in both("localized_concepts") for lo in _localizations(x)), 1):
        lang = _text(o.get("language_code") or key)
        pk = f"{root}/l{n}"
        yield row("localized", pk, root, lang, 0, lang, {k: v for k, v in o.items() if k not in ("terms", "notes", "examples", "sources")})
        for i, t in enumerate(_objects(o.get("terms")), 1):
            yield row("term", f"{pk}/t{i}", pk, lang, i, _text(t.get("designation")), t)
        for tag, field in (("note", "notes"), ("example", "examples")):
            many_texts = o.get(field)
            for i, t in enumerate(many_texts if isinstance(many_texts, list) else [] if many_texts is None else [many_texts], 1):
                t = t if isinstance(t, dict) else {"content": t}
                yield row(tag, f"{pk}/{tag[0]}{i}", pk, lang, i, _text(t.get("content")), t)
        for i, x in enumerate(_objects(o.get("sources")), 1):
            origin = x.get("origin")
            ref = origin.get("ref") if isinstance(origin, dict) else None
            yield row("source", f"{pk}/s{i}", pk, lang, i, _text(ref.get("id")) if isinstance(ref, dict) else "", x)


def _localizations(many) -> list[tuple[str | None, dict]]:
    """(key, object) of localized concepts, which are a map by language, a list, or a single one."""
    if isinstance(many, dict) and "language_code" not in many:
        return [(k, o) for k, v in many.items() for o in _objects(v)]
    return [(None, o) for o in _objects(many)]


_ARROW = pa.schema(
    [("tag", pa.string()), ("pk", pa.string()), ("parent_pk", pa.string()), ("record_id", pa.int64()), ("lang", pa.string()), ("pos", pa.int32()), ("item", pa.string()), ("payload", pa.string())]
)


def tagged_rows(df: DataFrame, record_id: str = "record_id", body: str = "body", tags=tuple(PAYLOAD), payload: bool = True) -> DataFrame:
    """Every object of every complete body as a tagged row.

    Null, empty, blank and cut-off bodies give no rows.  Repeated records give rows under
    each of their ids.  A field of an unexpected kind counts as absent.  Other columns of
    ``df`` are ignored.  ``tags`` and ``payload`` say what is wanted, so that nothing else is
    built and sent back to the JVM.
    """
    wanted = frozenset(tags)

    def walk(batches):
        for batch in batches:
            out = [r for i, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in visit(i, b, wanted, payload)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ARROW.types)], schema=_ARROW) if out else pa.RecordBatch.from_pylist([], schema=_ARROW)

    return df.select(F.col(record_id).cast("long"), F.col(body).cast("string")).mapInArrow(walk, TAGGED)


def write_tables(df: DataFrame, path: str, **names) -> None:
    """Tagged rows of ``df`` as one dataset with a folder per tag, written in a single pass."""
    tagged_rows(df, **names).write.mode("overwrite").partitionBy("tag").parquet(path)


def table_sizes(df: DataFrame, path: str, **names) -> DataFrame:
    """``(tag, n_rows, n_records, n_orphans)`` of the tables written under ``path`` and read again by their schemas.

    An orphan is a row whose parent is in no table; there are none.
    """
    write_tables(df, path, **names)
    spark = df.sparkSession
    links = reduce(DataFrame.unionByName, [read_flat(spark, path, t).select(F.lit(t).alias("tag"), "pk", "parent_pk", "record_id") for t in PAYLOAD])
    parents = links.where(F.col("tag").isin("record", "localized")).select(F.col("pk").alias("_parent")).distinct()
    found = links.join(parents, links["parent_pk"] == parents["_parent"], "left")
    orphan = F.col("parent_pk").isNotNull() & F.col("_parent").isNull()
    return found.groupBy("tag").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("record_id").alias("n_records"), F.count_if(orphan).alias("n_orphans"))


def read_flat(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """One flat table of ``write_tables``: the links, and the payload's fields by the tag's schema."""
    return flat(spark.read.parquet(path), tag)


def flat(tagged: DataFrame, tag: str) -> DataFrame:
    """The flat table of one tag of tagged rows."""
    rows = tagged.where(F.col("tag") == tag)
    return rows.select("pk", "parent_pk", "record_id", "lang", "pos", "item", F.from_json("payload", PAYLOAD[tag], {"maxNestingDepth": str(2**31 - 1)}).alias("_o")).select(
        "pk", "parent_pk", "record_id", F.col("lang").alias("record_lang"), "pos", "item", "_o.*"
    )


def child_objects(df: DataFrame) -> DataFrame:
    """Domains, localized concepts and terms as ``(record_id, kind, lang, pos, item)``."""
    rows = tagged_rows(df).where(F.col("tag").isin("domain", "localized", "term"))
    return rows.select("record_id", F.col("tag").alias("kind"), "lang", "pos", "item")
