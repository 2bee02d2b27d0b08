"""The attribute cell of a designation: a string that is consumed field by field.

Each field has a pattern; its first hit is cut out of what the fields before it left.  The
order of the table is part of the meaning.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words for parts of speech and for prefixes.
PARTS_OF_SPEECH = {"adj": "adj", "noun": "noun", "verb": "verb", "名詞": "noun", "動詞": "verb", "形容詞": "adj", "형용사": "adj", "Adjektiv": "adj"}
PREFIX_WORDS = ("Präfix", "prefix", "préfixe", "接尾語", "접두사", "przedrostek", "prefixo", "词头")
INLINE_TAGS = re.compile(r"</?(?:sup|sub|i|b|em|strong|span|small)>")


def _word(alternatives) -> str:
    return r"\b(?:" + "|".join(map(re.escape, alternatives)) + r")\b"


#: Field, its pattern, and the group that holds the value (0: the whole hit), in order.
FIELDS = [
    ("gender", re.compile(r"[(\[]([mfn])[)\]]|\b([mfn])\b")),
    ("plural", re.compile(r"([(\[]pl[)\]]|\bpl\b)")),
    ("geographical_area", re.compile(r"(\b[A-Z]{2}$)", re.MULTILINE)),
    ("part_of_speech", re.compile(f"({_word(PARTS_OF_SPEECH)})")),
    ("usage_info", re.compile(r"<(.*?)>|＜(.*?)＞")),
    ("prefix", re.compile(f"({_word(PREFIX_WORDS)})")),
]


@dataclass
class Attributes:
    gender: str | None = None
    number: str | None = None
    geographical_area: str | None = None
    part_of_speech: str | None = None
    usage_info: str | None = None
    prefix: str | None = None

    @property
    def has_grammar(self) -> bool:
        return bool(self.gender or self.number or self.part_of_speech)


def parse(cell: str | None) -> Attributes:
    """The fields of a cell; all null for null and empty cells."""
    left = INLINE_TAGS.sub("", html.unescape(cell or ""))
    got: dict[str, str] = {}
    for name, pattern in FIELDS:
        if name == "usage_info" and ">" not in left and "＞" not in left:
            continue  # an opening bracket alone would be searched from again and again
        hit = pattern.search(left)
        if hit:
            got[name] = next(g for g in hit.groups() if g is not None)
            left = left[: hit.start()] + left[hit.end() :]
    pos = got.get("part_of_speech")
    return Attributes(
        gender=got.get("gender"),
        number="plural" if "plural" in got else "singular" if "gender" in got else None,
        geographical_area=got.get("geographical_area"),
        part_of_speech=PARTS_OF_SPEECH.get(pos, pos),
        usage_info=got["usage_info"].strip() if "usage_info" in got else None,
        prefix=got.get("prefix"),
    )


COLUMNS = ["gender", "number", "geographical_area", "part_of_speech", "usage_info", "prefix"]


@F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS]))
def attributes(cells: pd.Series) -> pd.DataFrame:
    """Struct of a cell's fields; each distinct cell of a batch is parsed once."""
    known = {c: vars(parse(c)) for c in cells.unique()}
    return pd.DataFrame([known[c] for c in cells], columns=COLUMNS)


def grammar(attrs):
    """``ARRAY<STRUCT<gender, number, part_of_speech>>`` of an attributes struct, null if all three are."""
    some = F.coalesce(attrs["gender"], attrs["number"], attrs["part_of_speech"]).isNotNull()
    listed = lambda c: F.when(c.isNotNull(), F.array(c))
    one = F.struct(listed(attrs["gender"]).alias("gender"), listed(attrs["number"]).alias("number"), attrs["part_of_speech"].alias("part_of_speech"))
    return F.when(some, F.array(one))
