"""Markers typed into a term itself: gender, number, part of speech, prefix, usage, domain, references.

Two parts: bracketed matter is lifted out anywhere in the term, then a rule table peels
markers off its end, starting over after each hit, until no rule fires.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marker words and what they mean.
GENDERS = {"f": "feminine", "m": "masculine", "n": "neuter", "ж": "feminine", "м": "masculine", "с": "neuter"}
NUMBERS = {"јд": "singular", "мн": "plural", "sg": "singular", "pl": "plural"}
PARTS_OF_SPEECH = {
    "noun": "noun", "명사": "noun", "名詞": "noun", "اسم": "noun", "именица": "noun",
    "verb": "verb", "verbo": "verb", "동사": "verb", "動詞": "verb", "فعل": "verb", "глагол": "verb",
    "adj": "adj", "adj.": "adj", "adjective": "adj", "agg": "adj", "agg.": "adj", "형용사": "adj", "形容詞": "adj", "صفة": "adj", "adjektiv": "adj", "придев": "adj",
    "adv": "adv", "adv.": "adv", "adverb": "adv", "부사": "adv", "副詞": "adv", "прилог": "adv",
}
PREFIX_WORDS = ("Präfix", "prefix", "préfixe", "접두사", "接頭語", "接尾語")
BASIC_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"))

#: What angle brackets and closing brackets of a term hold.
CROSS_REFERENCE = re.compile(r"<[^>]*IEV\s*(\d{3}-\d{2}-\d{2,3})[^>]*>", re.IGNORECASE)
DOMAIN = re.compile(r"<([^>]+)>")
USAGE = re.compile(r"\(([^)]+)\)\s*(?=,?\s*(?:[fmnжмс]\b|[fmn]/[fmn]|sg|pl|јд|мн|\Z))", re.IGNORECASE)

#: Separators that taking a marker out leaves behind.
SEPARATORS = ",; \t\n\r\f\v"
#: Characters at a term's end that a marker with its comma and blanks can take; blanks are single by then.
LONGEST_MARKER = 64
_I = re.IGNORECASE
#: Pattern at the end of a term, and the kind of marker in each of its groups, in order.
PEEL = [
    (re.compile(r",\s*([жмс])\s+(јд|мн)\s*\Z"), ("gender", "number")),
    (re.compile(r",\s*([fmn])/([fmn])\s*\Z", _I), ("gender", "gender")),
    (re.compile(r",\s*([fmn])\s+(sg|pl)\.?\s*\Z", _I), ("gender", "number")),
    (re.compile(r",\s*(sg|pl)\.?\s*\Z", _I), ("number",)),
    (re.compile(r",\s*(" + "|".join(map(re.escape, PARTS_OF_SPEECH)) + r")\s*\Z", _I), ("part_of_speech",)),
    (re.compile(r",\s*(" + "|".join(PREFIX_WORDS) + r")\s*\Z"), ("prefix",)),
    (re.compile(r",?\s+([fmn])\s*\Z"), ("gender",)),
]


@dataclass
class Marked:
    designation: str | None = None
    genders: list[str] = field(default_factory=list)
    numbers: list[str] = field(default_factory=list)
    domain: str | None = None
    usage_info: str | None = None
    part_of_speech: str | None = None
    related_refs: list[str] | None = None
    is_prefix: bool | None = None


def _lift(text: str, hit: re.Match) -> str:
    """What stands around a hit, without separators at either end."""
    return (text[: hit.start()] + text[hit.end() :]).strip(SEPARATORS).strip()


def parse(term: str | None) -> Marked:
    """A term taken apart; everything null or empty for null."""
    out = Marked()
    if term is None:
        return out
    text = term
    for name, char in BASIC_ENTITIES:
        text = text.replace(name, char)
    text = re.sub(r"\s+", " ", text.strip(), flags=re.ASCII).replace("　", " ")
    bracketed = ">" in text and "<" in text
    while bracketed and "iev" in text.lower() and (hit := CROSS_REFERENCE.search(text)):
        out.related_refs = [*(out.related_refs or []), hit[1]]
        text = _lift(text, hit)
    if bracketed and (hit := DOMAIN.search(text)):
        out.domain, text = hit[1].strip(), _lift(text, hit)
    if hit := USAGE.search(text):
        out.usage_info = hit[1].strip()
        text = re.sub(r"\s+", " ", text.replace(hit[0], "", 1)).strip()
    found: dict[str, list[str]] = {"gender": [], "number": [], "part_of_speech": [], "prefix": []}
    while text:
        for pattern, kinds in PEEL:
            if hit := pattern.search(text, max(0, len(text) - LONGEST_MARKER)):
                for kind, word in zip(kinds, hit.groups()):
                    found[kind].append(word)
                text = text[: hit.start()].strip()
                break
        else:
            break
    out.designation = text
    out.genders = list(dict.fromkeys(GENDERS[w] for w in found["gender"] if w in GENDERS))
    out.numbers = list(dict.fromkeys(NUMBERS[w.lower()] for w in found["number"]))
    out.part_of_speech = PARTS_OF_SPEECH[found["part_of_speech"][-1].lower()] if found["part_of_speech"] else None
    out.is_prefix = bool(found["prefix"])
    return out


def parse_lines(text: str | None) -> list[Marked]:
    """One parse for each line that isn't blank."""
    return [parse(x.strip()) for x in re.split(r"\n+", text or "") if x.strip()]


_LISTS = ("genders", "numbers", "related_refs")
_COLUMNS = list(Marked.__dataclass_fields__)
MARKED = T.StructType(
    [T.StructField(c, T.ArrayType(T.StringType()) if c in _LISTS else T.BooleanType() if c == "is_prefix" else T.StringType()) for c in _COLUMNS]
)


@F.pandas_udf(MARKED)
def markers(terms: pd.Series) -> pd.DataFrame:
    """Struct of a term taken apart."""
    known = {t: vars(parse(t)) for t in terms.unique()}
    return pd.DataFrame([known[t] for t in terms], columns=_COLUMNS)


def term_lines(column):
    """The terms of a text that holds one a line, blank lines dropped: explode, then ``markers`` on each."""
    return F.transform(F.filter(F.split(F.coalesce(column, F.lit("")), "\n+"), lambda x: F.trim(x) != ""), F.trim)
