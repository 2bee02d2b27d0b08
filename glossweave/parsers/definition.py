"""A definition cell taken apart into definition, examples and notes.

The cell is tokenised by one pattern of marker words: text up to the first marker is the
definition, each following piece belongs to the list of the marker before it.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The words that open an example or a note.
EXAMPLE_WORDS = [r"\bEXAMPLE\b", r"^\bExamples\s+are\b:", r"^\bExamples\b:", r"^\bExample\b:", r"\bEXEMPLE\b", r"^\bExemples\b:"]
NOTE_WORDS = [
    r"Note\s*\d+\sto\sentry:",
    r"Note&nbsp;\d+\sto\sentry:",
    r"Note\s*\d+\sto\sthe\sentry:",
    r"Note\sto\sentry\s*\d+:",
    r"Note\s*\d+?\sà\sl'article:",
    r"<NOTE/?>?\s*\d?\s+[–-]\s*",
    r"NOTE(?:\s+-)?\s*",
    r"Note\s+\d+\s[–-]\s*",
    r"Note&nbsp;\d+\s",
]
MARKER = re.compile(rf"(?<!\s)\s*(?:<p>\s*)?(?:(?P<example>{'|'.join(EXAMPLE_WORDS)})|(?P<note>{'|'.join(NOTE_WORDS)}))\s*", re.MULTILINE)
#: A note that begins with the word Example is about one; the mark keeps it from opening a list.
SHIELDED = re.compile(r"^Ex([ae])mple", re.MULTILINE)


def split(cell: str | None) -> tuple[str | None, list[str], list[str]]:
    """(definition, examples, notes); an empty definition is null."""
    if cell is None:
        return None, [], []
    pieces: dict[str, list[str]] = {"definition": [], "example": [], "note": []}
    into, rest, shield = "definition", cell, -1
    while True:
        hit = MARKER.search(rest)
        if hit and hit["example"] and hit.start("example") == shield:
            hit = MARKER.search(rest, shield + 1)
        pieces[into].append(rest[: hit.start()] if hit else rest)
        if not hit:
            break
        into = "example" if hit["example"] else "note"
        rest, shield = rest[hit.end() :], shield - hit.end()
        if into == "note" and (first := SHIELDED.search(rest)):
            shield = first.start()
    return pieces["definition"][0] or None, pieces["example"], pieces["note"]


_TEXTS = T.ArrayType(T.StringType())


@F.pandas_udf(T.StructType([T.StructField("definition", T.StringType()), T.StructField("examples", _TEXTS), T.StructField("notes", _TEXTS)]))
def definition_parts(cells: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([split(c) for c in cells], columns=["definition", "examples", "notes"])
