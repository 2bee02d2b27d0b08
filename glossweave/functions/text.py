"""Text clean-up as native column expressions; what needs Unicode normalisation is one Arrow UDF."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Composed Unicode form; null for null."""
    return texts.map(lambda s: s if s is None or s.isascii() else unicodedata.normalize("NFC", s))


@F.pandas_udf(T.StringType())
def decode_entities(texts: pd.Series) -> pd.Series:
    """All character references as characters; null for null."""
    return texts.map(lambda s: s if s is None or "&" not in s else html.unescape(s))


def strip(c: Column) -> Column:
    """Without leading and trailing white space of any kind, NUL included."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r\x00"))


def plain_spaces(c: Column) -> Column:
    """Byte-order marks dropped, non-breaking hyphens and the wide spaces made plain ones."""
    return F.translate(c, "\u2011\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\ufeff", "-" + " " * 8)


def sanitize(c: Column, compose: bool = True) -> Column:
    """A cell in composed form, with plain spaces and hyphens, stripped; null for null."""
    return strip(plain_spaces(nfc(c) if compose else c))


def basic_entities(c: Column) -> Column:
    """The five basic references decoded one after the other, so ``&amp;lt;`` gives ``&lt;``."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def paragraph_breaks(c: Column) -> Column:
    """Written-out newlines and break tags as blank lines; runs of white space around a newline as one blank line."""
    c = F.replace(c, F.lit("\\n"), F.lit("\n\n"))
    c = F.regexp_replace(c, "<[pbr]+>", "\n\n")
    c = F.regexp_replace(c, r"<br\s*/?>", "\n\n")
    return strip(F.regexp_replace(c, r"\s*\n[\n\s]+", "\n\n"))


def without_leading_number(c: Column) -> Column:
    """A note or example without the number and colon it was listed under."""
    c = F.regexp_replace(c, r"^\s*[0-9]+[\s:\u2003]*\s*", "")
    return F.regexp_replace(c, r"^\s*:\s*", "")


def comparable(c: Column, compose: bool = True) -> Column:
    """The form in which two snapshots' texts are compared; '' for null.

    Composed, without tags and invisible characters, marks of the double-quote class as
    ``"``, white space collapsed, lower case.  Curly quotes are not of that class.
    """
    c = F.coalesce(c, F.lit(""))
    c = nfc(c) if compose else c
    c = F.regexp_replace(c, "<[^>]+>", "")
    # blanks, quotes and characters to drop in one go
    c = F.translate(c, "\t\n\x0b\f\r″‴„‟‚‛\u00a0\u200b\ufeff\u00ad", " " * 5 + '"' * 6)
    return F.lower(strip(F.regexp_replace(c, " {2,}", " ")))


#: Names of the Greek letters that are written as entities.
GREEK = (
    "alpha beta gamma Gamma delta Delta epsilon varepsilon zeta eta theta Theta vartheta iota kappa lambda Lambda mu nu xi Xi pi Pi rho "
    "sigma Sigma tau upsilon phi Phi varphi chi psi Psi omega"
).split()


def greek_names(c: Column, as_stem: bool = True) -> Column:
    """Greek entities as formula names, in ``stem:[...]`` or bare."""
    for name in GREEK:
        c = F.replace(c, F.lit(f"&{name};"), F.lit(f"stem:[{name}]" if as_stem else name))
    return c


def shorten(c: Column, most: int = 200) -> Column:
    """'' for null; longer texts cut to ``most`` characters and three dots."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(F.coalesce(c, F.lit("")))


def split_synonyms(c: Column) -> Column:
    """The designations of a synonym cell; trailing empty ones dropped, leading ones kept; [] for null and ''."""
    parts = F.split(F.coalesce(c, F.lit("")), "<[pbr]+>", -1)
    last = F.aggregate(
        F.zip_with(parts, F.sequence(F.lit(1), F.size(parts)), lambda p, i: F.when(p != "", i).otherwise(0)),
        F.lit(0),
        lambda a, i: F.greatest(a, i),
    )
    return F.slice(parts, F.lit(1), last)


def note_and_example_lines(c: Column) -> Column:
    """Struct (definition, notes, examples) of a text whose notes and examples stand on lines of their own."""
    lines = F.split(F.coalesce(c, F.lit("")), "\n", -1)
    note, example = r"(?i)^Note\s+[0-9]+\s+to\s+entry:\s*", r"(?i)^Example\s*:\s*"
    is_note, is_example = (lambda x: strip(x).rlike(note)), (lambda x: strip(x).rlike(example))
    rest = strip(F.array_join(F.filter(lines, lambda x: ~is_note(x) & ~is_example(x)), "\n"))
    return F.struct(
        F.nullif(rest, F.lit("")).alias("definition"),
        F.transform(F.filter(lines, is_note), lambda x: F.regexp_replace(strip(x), note, "")).alias("notes"),
        F.transform(F.filter(lines, lambda x: is_example(x) & ~is_note(x)), lambda x: F.regexp_replace(strip(x), example, "")).alias("examples"),
    )


def without_comments(c: Column) -> Column:
    """Without top-level HTML comments."""
    return F.regexp_replace(c, "(?s)<!--.*?-->", "")
