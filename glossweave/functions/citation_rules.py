"""Citations of the sheet, read by ordered rule tables that compile to native expressions.

Every table is data: a pattern and what it becomes.  ``cascade`` turns a table into one
``CASE WHEN``, first hit wins; ``rewrite`` applies a table from top to bottom.  Both stay in
whole-stage code generation.  Only the clause search needs the places of all hits; it is a
UDF over the same kind of table (``glossweave.parsers.clauses``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.functions.text import strip

CODE = r"[0-9]{2,3}-[0-9]{2,3}-[0-9]{2,3}"
REF = r"[0-9:\-]+"

#: Where a citation field is cut (";;" marks a cut).
CUTS = [
    (r";\s?([A-Z][A-Z])", ";; $1"),
    (r"MOD[,.]", "MOD;;"),
    (r"MOD,\s*([UIC0-9])", "MOD;; $1"),
    (r"MOD[,.]", "MOD;;"),
    (r"MOD,\s*([0-9]{3})", "MOD;; $1"),
    (r",\s*see\s*([0-9]{3})", ";;see $1"),
    (r",\s*voir\s*([0-9]{3})", ";;voir $1"),
    (r"modified and ([ISOECUT])", "modified;; $1"),
    (r"modifiée et ([ISOECUT])", "modifiée;; $1"),
    (r",\s+ITU", ";; ITU"),
    (rf"({CODE}),\s*({CODE})", "$1;; $2"),
]

#: Spellings brought to one form everywhere in a citation.
SPELLINGS = [
    ("CEI", "IEC"),
    ("Guide IEC", "IEC Guide"),
    ("Guide ISO/IEC", "ISO/IEC Guide"),
    ("VEI", "IEV"),
    ("UIT", "ITU"),
    ("IUT-R", "ITU-R"),
    ("UTI-R", "ITU-R"),
    ("Recomm[ea]ndation ITU-T", "ITU-T Recommendation"),
    (r"ITU-T (\w.[0-9]{3}):([0-9]{4})", "ITU-T Recommendation $1 ($2)"),
    (r"ITU-R Rec. ([0-9]+)", "ITU-R Recommendation $1"),
    (r"[≈≠]\s+", ""),
]
#: Forms of which only the first is rewritten.
FIRST_FORMS = [
    (r"ИЗМ\z", "MOD"),
    (rf"definition ([0-9.]+) of ({REF}) MOD", "IEC $2, $1, modified - "),
    (rf"definition ([0-9.]+) of IEC ({REF}) MOD", "IEC $2, $1, modified - "),
    (rf"définition ([0-9.]+) de la ({REF}) MOD", "IEC $2, $1, modified - "),
    (rf"définition ([0-9.]+) de la IEC ({REF}) MOD", "IEC $2, $1, modified - "),
    (r"([0-9]{3}) ([0-9]{2}) ([0-9]{2})", "$1-$2-$3"),
]

#: Pattern, what the reference becomes ({n} is a group), whether a final colon is cut.
REFERENCES = [
    (r"SI Brochure|Brochure sur le SI", "BBIPM SI Brochure", False),
    (r"VIM", "JCGM VIM", False),
    (rf"IEC 60050-([0-9]+), ({CODE})", "IEC 60050-{1}", False),
    (rf"IEC 60050-([0-9]+):([0-9]+), ({CODE})", "IEC 60050-{1}:{2}", False),
    (r"(AIEA|IAEA) ([0-9]+)", "IAEA {2}", False),
    (rf"IEC\sIEEE ({REF})", "IEC/IEEE {1}", True),
    (rf"CISPR ({REF})", "IEC CISPR {1}", False),
    (r"RR ([0-9]+)", "ITU-R RR", False),
    (r"IEC ([0-9]+)\(([0-9]+)\)", "IEC 600{1}-{1}", False),
    (rf"(ISO|IEC)[/ ](PAS|TR|TS) ({REF})", "{1}/{2} {3}", True),
    (rf"ISO/IEC ({REF})", "ISO/IEC {1}", True),
    (rf"ISO/IEC/IEEE ({REF})", "ISO/IEC/IEEE {1}", True),
    (r"ISO ([0-9]+)/([0-9]+)", "ISO {1}-{2}", False),
    (r"Norme ISO ([0-9]+)-([0-9]+)", "ISO {1}:{2}", False),
    (rf"(?i)ISO/IEC Guide ({REF})", "ISO/IEC Guide {1}", True),
    (rf"(?i)(ISO|IEC) Guide ({REF})", "{1} Guide {2}", True),
    (r"(?i)ITU-T Recommendation (\w.[0-9]+) \(([0-9]+/[0-9]+)\)", "ITU-T Recommendation {1} ({2})", False),
    (r"(?i)ITU-T Recommendation (\w.[0-9]+):([0-9]+)", "ITU-T Recommendation {1} ({2})", False),
    (r"(?i)ITU-T Recommendation (\w\.[0-9]+)", "ITU-T Recommendation {1}", False),
    (r"(?i)ITU-R Recommendation ([0-9]+)", "ITU-R Recommendation {1}", False),
    (r"ISO ([0-9\-]+:\s?[0-9]{4})", "ISO {1}", True),
    (rf"ISO ({REF})", "ISO {1}", True),
    (rf"IEC ({REF})", "IEC {1}", True),
    (r"definition ([0-9]\.[0-9.]+) of ([0-9\-]*)", "IEC {2}", True),
    (r"définition ([0-9]\.[0-9.]+) de la ([0-9\-]*)", "IEC {2}", True),
    (CODE, "IEV", False),
    (r"IEV part\s+([0-9]+)", "IEC 60050-{1}", False),
    (r"partie\s+([0-9]+)\s+de l'IEV", "IEC 60050-{1}", False),
    (r"International Telecommunication Union (ITU) Constitution", "International Telecommunication Union (ITU) Constitution (Ed. 2015)", False),
    (r"Constitution de l’Union internationale des télécommunications (UIT)", "International Telecommunication Union (ITU) Constitution (Ed. 2015)", False),
]

#: Publishers that a reference begins with, longest first.
PUBLISHERS = [
    r"ISO/IEC/IEEE",
    r"ISO/IEC\s+Guide",
    r"ISO/IEC",
    r"IEC/IEEE",
    r"(?:ISO|IEC)/(?:PAS|TR|TS)",
    r"IEC\s+CISPR",
    r"ITU-T\s+Recommendation",
    r"ITU-R\s+Recommendation",
    r"ITU-R",
    r"(?:ISO|IEC)\s+Guide",
    r"ISO|IEC|IAEA",
]

#: What a citation says about its source, first hit wins.
RELATIONSHIPS = [
    ("≠", "not_equal"),
    ("≈", "similar"),
    ("(?m)^([Ss]ee)|([Vv]oir)", "related"),
    ("MOD|ИЗМ|modified|modifié", "modified"),
]


def rewrite(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Every hit of every rule replaced, rules from top to bottom."""
    for pattern, to in rules:
        c = F.regexp_replace(c, pattern, to)
    return c


def rewrite_first(c: Column, rules: list[tuple[str, str]]) -> Column:
    """The first hit of every rule replaced, rules from top to bottom."""
    for pattern, to in rules:
        shifted = to.replace("$3", "$4").replace("$2", "$3").replace("$1", "$2")
        c = F.regexp_replace(c, rf"(?s)\A(.*?){pattern}", "$1" + shifted)
    return c


#: Stands behind a reference whose final colon is still to be cut.
_CUT = "\x01"


def cascade(c: Column, rules: list[tuple[str, str, bool]]) -> Column:
    """What the first rule with a hit makes of the text; null without any.

    A rule is one test and one replacement of the whole text by its template, which keeps the
    generated code small enough to be compiled.
    """
    out = None
    for pattern, template, cut in rules:
        to = re.sub(r"\{(\d)\}", r"$\1", template) + (_CUT if cut else "")
        flags, bare = ("i", pattern[4:]) if pattern.startswith("(?i)") else ("", pattern)
        made = F.regexp_replace(c, rf"(?s{flags})\A.*?(?:{bare}).*\z", to)
        out = F.when(c.rlike(pattern), made) if out is None else out.when(c.rlike(pattern), made)
    return out


def split_field(c: Column) -> Column:
    """The citations of a field as an array; trailing empty ones dropped, null for null."""
    parts = F.transform(F.split(F.regexp_replace(rewrite(c, CUTS), "(;;)+$", ""), ";;", -1), strip)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(parts)


def one_spelling(c: Column) -> Column:
    return rewrite_first(rewrite(c, SPELLINGS), FIRST_FORMS)


def with_reference(df: DataFrame, spelled: str, out: str = "reference") -> DataFrame:
    """``df`` with the reference that each citation (in one spelling) names, the citation itself where no rule hits.

    The rules are spread over projections, so that each is compiled by itself.
    """
    c, n = F.col(spelled), len(REFERENCES)
    steps = [REFERENCES[i : i + 8] for i in range(0, n, 8)]
    df = df.withColumn("_hit0", cascade(c, steps[0]))
    for i, rules in enumerate(steps[1:], 1):
        before = F.col(f"_hit{i - 1}")  # read twice, so the optimizer keeps the projections apart
        df = df.withColumn(f"_hit{i}", F.when(before.isNotNull(), before).otherwise(cascade(c, rules)))
    whole = F.regexp_replace(F.coalesce(F.col(f"_hit{len(steps) - 1}"), c), f":?{_CUT}$", "")
    return df.withColumn(out, strip(F.regexp_replace(whole, r", modifi(ed|é)\z", ""))).drop(*[f"_hit{i}" for i in range(len(steps))])


def publisher_of(ref: Column) -> Column:
    """Struct (source, id) of a reference; the alternatives of one pattern are tried in order."""
    pattern = rf"\A({'|'.join(PUBLISHERS)})\s+(.+)"
    hit, vim, bipm = ref.rlike(pattern), ref.rlike(r"\AJCGM\s+VIM\z"), ref.rlike(r"\ABBIPM")
    source = F.when(hit, F.regexp_extract(ref, pattern, 1)).when(vim, "JCGM").when(bipm, "BIPM").otherwise(ref)
    ident = F.when(hit, F.regexp_extract(ref, pattern, 2)).when(vim, "VIM").when(bipm, "SI Brochure")
    return F.struct(source.alias("source"), ident.alias("id"))


def relationship_of(c: Column) -> Column:
    """Struct (status, modification) of a citation as typed; the modification is its words, not yet converted."""
    status = None
    for pattern, word in RELATIONSHIPS:
        status = F.when(c.rlike(pattern), word) if status is None else status.when(c.rlike(pattern), word)
    tail = r"(?:modified|modifié|modifiée|modifiés|MOD)\s*[–-]?\s+(.+)\z"
    changed = F.when(~c.rlike(r"(?m)^MOD [0-9\-]") & c.rlike(tail), strip(F.regexp_extract(c, tail, 1)))
    return F.struct(status.otherwise("identical").alias("status"), changed.alias("modification"))
