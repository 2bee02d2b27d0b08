"""The clause that a citation (in one spelling) points to: of all candidates the first, of those at one place the longest."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

CODE = r"\d{2,3}-\d{2,3}-\d{2,3}"
#: How a clause may be written; group 1 is the clause.
CANDIDATES = [
    r"RR (\d+)",
    r"VIM (.+)",
    r"item (\d\.[\d.]+)",
    r"d[eé]finition (\d[\d.]+)",
    r"figure ([\d.\-]+)",
    r"fig\. ([\d.\-]+)",
    rf"IEV ({CODE})",
    rf"({CODE})",
    r"(\d{3} \d{2} \d{2})",
    r",\s?(\d+\.[\d.]+)",
    r"\d{4}, (Appendix \d)",
    r"\d{4}, (Annexe \d)",
    r", (No. \d{4} of the Annex)",
    r", (N° \d{4} 1012 de l’Annexe)",
    r"\), (\d{7}),",
    r"\s(\d+\.[\d.]+)\s?",
    r"\((\d+\.[\d.]+)\)",
    r"\((\d+\.[\d.]+) MOD\)",
    r"\AISO 80000-10:2009, (item [\d.\-]+\w?)",
    r"\AISO 80000-10:2009, (point [\d.\-]+\w?)",
    r"\AIEC 80000-13:2008, ([\d.\-]+\w?),",
    r"\AIEC 80000-13:2008, ([\d.\-]+\w?)\Z",
    r"\AISO [\d:]+, (d[ée]finition \d+)",
    r", ([\d.\w]+ \(\d+\))",
]
_RULES = [re.compile(p, re.ASCII) for p in CANDIDATES]
_MODIFIED = re.compile(r"[, ]*modif.+\s[-–].*\Z")
_FIGURE = re.compile(r"\A(?:see|voir) (?:fig\.|figure) [\d.]+")


def clause(citation: str | None) -> str | None:
    """The clause, or null.

    All hits of a rule count as lying where its last hit lies (kept for parity: the place is
    read after the whole scan), so among them only length decides.
    """
    if citation is None:
        return None
    text = _FIGURE.sub("", _MODIFIED.sub("", citation, count=1))
    best = None
    for rule in _RULES:
        hits = list(rule.finditer(text))
        for h in hits:
            key = (hits[-1].start(), -len(h[1].strip()))
            if best is None or key < best[0]:
                best = (key, h[1].strip())
    return best[1] if best else None


@F.pandas_udf(T.StringType())
def clause_of(citations: pd.Series) -> pd.Series:
    return citations.map(clause)
