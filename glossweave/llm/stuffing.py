"""Pages of stuffed keywords, link lists or tags, told by the shapes of their lines.

Each scanned line is reduced to a *shape*: its links, tags and separators, how much of it is
words that the page itself repeats, figures, how many words, capitals and short words it has,
and whether a sentence ends in it.  The words are gone, and no list of words of any language
takes part.  What is left of a page is a small group table, shape by shape, of lines and
characters.

A shape is no sentence if it holds links or tags; if separators cut it into short items; if
most of its longer words are ones that the page repeats beyond what sentences do; or if it is
bare (no short word, no figure, no end of a sentence) and the same shape recurs over much of
the page, as bare names one a line do.  Sentences of any language mix short and long words,
end somewhere and seldom repeat a longer word.  A page is flagged if its few largest
non-sentence shapes hold more than half of its characters.

All of it happens within the row: no shuffle, and a page of any length is two linear scans.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Share of a page's text that its few largest non-sentence shapes must exceed, and how many they are.
DOMINANCE, FEW = 0.5, 8
#: A longer word is repeated beyond what sentences do if it makes up this share of the page's longer words, and so many.
REPEATED_SHARE, REPEATED_LEAST = 0.03, 4
#: Letters of a short word, as the small words of sentences mostly are.
SHORT = 3
#: Words to an item of a list with hard separators, at most.
ITEM_WORDS = 8
#: A bare shape counts as a list of names from so many lines and such a share of the page's text.
UNIFORM_LINES, UNIFORM_SHARE = 8, 0.2

DOMAIN = re.compile(r"[^\W_][\w-]*(?:\.[\w-]+)*\.[^\W\d_A-Z]{2,}(?:/|\)|\]|$|,|\|)")
TAG = re.compile(r"^[#@][^\W\d_]")
END = re.compile(r"[.!?][\"'”»)\]]*$")
WORD = re.compile(r"[^\W\d_]+")
#: Marks that stand between items, hardly in sentences, and those that stand in both.
HARD = frozenset("|+·•*>~=»«\\<_/")
SOFT = frozenset("-–—:;,")
BROKEN = re.compile(r"([^\W\d_])[-\xad¬]\s*\n[ \t]*([^\W\d_]\S*)[ \t]*")

NOT_LISTED, HARD_LIST, SOFT_LIST = 0, 1, 2


class Shape(NamedTuple):
    """What is left of a line; counts are bucketed, so that lines of one make share a shape."""

    link: bool
    tag: bool
    #: not listed, or items between hard or soft separators
    listed: int
    #: how much of its longer words the page repeats: 0, from half, from three quarters
    repeated: int
    #: figures: none, some, from a third of its words
    figures: int
    #: words: none, one, up to five, more
    words: int
    #: words with a capital: none, some, all
    capitals: int
    #: short words: none, up to a quarter, more
    short: int
    end: bool


class Tokens(dict):
    """What a token adds to a shape, made once per token: its nine counts, and its word if that is a longer one."""

    #: Entries at which the table is emptied, and longest token it keeps; only speed depends on them.
    MOST, LONGEST = 300_000, 64

    def __missing__(self, t: str) -> tuple[tuple[int, ...], str | None]:
        got = self.read(t)
        if len(t) <= self.LONGEST:
            if len(self) > self.MOST:
                self.clear()
            self[t] = got
        return got

    @staticmethod
    def read(t: str) -> tuple[tuple[int, ...], str | None]:
        """(word, capital, short, figure, hard, soft, end, link, tag) and the word."""
        if "." in t and ("://" in t or DOMAIN.search(t)) or t[0] == "[" and "]" not in t:
            return (0, 0, 0, 0, 0, 0, 0, 1, 0), None
        if TAG.match(t):
            return (0, 0, 0, 0, 0, 0, 0, 0, 1), None
        if all(c in HARD for c in t):
            return (0, 0, 0, 0, 1, 0, 0, 0, 0), None
        if all(c in SOFT for c in t):
            return (0, 0, 0, 0, 0, 1, 0, 0, 0), None
        hard = int(t[-1] == "|" or t[0] == "|")
        soft = int(t[-1] in ",;:/")
        end = int(END.search(t) is not None)
        figure = int(any(c.isdigit() for c in t))
        words = WORD.findall(t)
        if not words:
            return (0, 0, 0, figure, hard, soft, end, 0, 0), None
        longest = max(words, key=len)
        short = int(len(longest) <= SHORT and longest.islower())
        return (1, int(words[0][0].isupper()), short, figure, hard, soft, end, 0, 0), longest.lower() if len(longest) > SHORT else None


TOKENS = Tokens()


def shape(tokens: list[tuple], repeated: frozenset[str] | set[str] = frozenset()) -> Shape:
    """The shape of a line's tokens, given the words that its page repeats."""
    words, capitals, short, figures, hard, soft, ends, links, tags = map(sum, zip(*[t[0] for t in tokens]))
    longer = [t[1] for t in tokens if t[1]]
    often = sum(w in repeated for w in longer)
    if hard and words <= ITEM_WORDS * hard:
        listed = HARD_LIST
    elif soft and not figures and not ends and (soft > 1 and soft * 5 >= words * 2 or soft * 4 >= words and not short):
        listed = SOFT_LIST
    else:
        listed = NOT_LISTED
    return Shape(
        links > 0,
        tags > 0,
        listed,
        0 if not often or often * 2 < len(longer) else 1 if often * 4 < len(longer) * 3 else 2,
        0 if not figures else 1 if figures * 3 < words else 2,
        words if words < 2 else 2 if words < 6 else 6,
        0 if not capitals else 1 if capitals < words else 2,
        0 if not short else 1 if short * 4 <= words else 2,
        ends > 0,
    )


def shapes(text: str | None) -> dict[Shape, tuple[int, int]]:
    """Lines and characters of a page by shape; words broken at a line's end are whole again on the line they began."""
    lines, seen = [], Counter()
    for line in BROKEN.sub(r"\1\2\n", text or "").split("\n"):
        tokens = [TOKENS[t] for t in line.split()]
        if tokens:
            seen.update(w for _, w in tokens if w)
            lines.append((tokens, len(line.strip())))
    least = max(REPEATED_LEAST, REPEATED_SHARE * seen.total())
    repeated = {w for w, n in seen.items() if n >= least}
    table: dict[Shape, tuple[int, int]] = {}
    for tokens, chars in lines:
        s = shape(tokens, repeated)
        n, sum_of = table.get(s, (0, 0))
        table[s] = n + 1, sum_of + chars
    return table


def no_sentence(s: Shape, lines: int, share: float) -> bool:
    """Whether a shape that so many lines and such a share of the page have is no sentence's (or record's)."""
    if s.link or s.tag:
        return True
    if s.figures == 2:  # results, prices, arrivals
        return False
    if s.listed or s.repeated == 2:
        return True
    if s.figures or s.end or not s.words:
        return False
    return s.repeated == 1 and s.short < 2 or s.short == 0 and lines >= UNIFORM_LINES and share >= UNIFORM_SHARE


def page_score(text: str | None) -> tuple[int, int, int, float]:
    """(number of shapes, characters, those in non-sentence shapes, share of the few largest of these)."""
    table = shapes(text)
    chars = sum(n for _, n in table.values())
    bad = sorted((n for s, (lines, n) in table.items() if no_sentence(s, lines, n / chars)), reverse=True)
    return len(table), chars, sum(bad), sum(bad[:FEW]) / chars if chars else 0.0


SCORES = "n_shapes int, all_chars long, other_chars long, share double"
_SCORES = [("n_shapes", pa.int32()), ("all_chars", pa.int64()), ("other_chars", pa.int64()), ("share", pa.float64())]


def page_scores(df: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row_id, n_shapes, all_chars, other_chars, share)`` per page; zeros for null, empty and blank texts.

    ``share`` is that of the few largest non-sentence shapes in all characters.
    """
    out = T.StructType([df.schema[row_id], *T._parse_datatype_string(SCORES).fields])

    def run(batches):
        for b in batches:
            rows = [page_score(s) for s in b.column(1).to_pylist()]
            arrays = [pa.array(c, t) for c, (_, t) in zip(zip(*rows), _SCORES)] if rows else [pa.array([], t) for _, t in _SCORES]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names=out.names)

    return df.select(row_id, text).mapInArrow(run, out)


def found(documents: DataFrame) -> DataFrame:
    """``(doc_id)`` of the pages that few non-sentence shapes dominate.

    Null, empty and blank pages are no case; a page exactly at half is none; every repeated
    page is judged by itself.
    """
    return page_scores(documents.where("text is not null")).where(f"share > {DOMINANCE}").select("doc_id")
