"""A corpus as ids of a public tokenizer, and the number of ids of each text."""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from glossweave.llm.transducer import StreamDecoder, encoder


def public_vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """Path of a public vocabulary's rank file and its split pattern; both are parameters of every operator here."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def encode_texts(df: DataFrame, row_id: str, text: str, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """``(row_id, ids)``: the encoding of each text without special tokens, one row per row of ``df``.

    Null and empty texts have the empty list, never null.  Blank texts have the ids of their
    blanks.  Texts of any length are read whole.  Repeated rows each keep theirs.  Other
    columns are ignored.  One pass, no shuffle; each Python worker keeps its machine.
    """
    path, pattern = vocabulary or public_vocabulary()
    schema = T.StructType([df.schema[row_id], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches):
        enc = encoder(path, pattern)
        for b in batches:
            flat, ends = array("i"), array("i", [0])
            for s in b.column(1).to_pylist():
                enc.into(s, flat)
                ends.append(len(flat))
            values = pa.array(np.frombuffer(flat, np.int32)) if flat else pa.array([], pa.int32())
            offsets = pa.array(np.frombuffer(ends, np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, values)], names=[row_id, "ids"])

    return df.select(row_id, text).mapInArrow(run, schema)


def count_tokens(df: DataFrame, text: str, n_tokens: str = "n_tokens", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """``df`` without ``text`` but with its number of ids; 0 for null and empty texts."""
    path, pattern = vocabulary or public_vocabulary()
    kept = [c for c in df.columns if c != text]
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(n_tokens, T.LongType(), False)])

    def run(batches):
        enc = encoder(path, pattern)
        for b in batches:
            n = [enc.count(s) for s in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=schema.names)

    return df.select(*kept, text).mapInArrow(run, schema)


def decode_ids(df: DataFrame, row_id: str, ids: str, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """``(row_id, text)`` by the incremental UTF-8 machine; the empty text for empty and null lists."""
    path, pattern = vocabulary or public_vocabulary()
    schema = T.StructType([df.schema[row_id], T.StructField("text", T.StringType(), False)])

    def run(batches):
        token = encoder(path, pattern).machine.token
        for b in batches:
            out = []
            for one in b.column(1).to_pylist():
                d = StreamDecoder(token)
                out.append(d.feed(one or ()) + d.close())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=[row_id, "text"])

    return df.select(row_id, ids).mapInArrow(run, schema)


def round_trip(df: DataFrame, row_id: str, text: str, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """``(row_id, n_ids, digest, same)``: each text encoded and decoded again, in one pass.

    ``digest`` is the MD5 of the decoded UTF-8, ``same`` whether it is the text (null as '').
    Repeated ids keep a row each.
    """
    path, pattern = vocabulary or public_vocabulary()
    fields = [T.StructField("n_ids", T.LongType(), False), T.StructField("digest", T.StringType(), False), T.StructField("same", T.BooleanType(), False)]
    schema = T.StructType([df.schema[row_id], *fields])

    def run(batches):
        enc = encoder(path, pattern)
        for b in batches:
            sizes, digests, same = [], [], []
            for s in b.column(1).to_pylist():
                ids = array("i")
                enc.into(s, ids)
                d = StreamDecoder(enc.machine.token)
                back = d.feed(ids) + d.close()
                sizes.append(len(ids))
                digests.append(hashlib.md5(back.encode("utf-8", "surrogatepass")).hexdigest())
                same.append(back == (s or ""))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(same, pa.bool_())], names=schema.names)

    return df.select(row_id, text).mapInArrow(run, schema)
