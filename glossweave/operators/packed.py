"""Several values packed in one field, one row per value with its place.

The field is read by a parsing expression grammar.  Alternatives are ordered and the first
that matches wins; a failed alternative leaves no trace (the parser backtracks)::

    field   <-  junk* (item junk*)* EOF          junk  <-  blank / strong
    item    <-  quoted &end  /  part+
    part    <-  !strong !weak (quoted / bracket / char)
    strong  <-  line break / <br> / ';' / '|' / bullet / '&' / spaced '/' ...
    weak    <-  (',' / 'and' ...) &start         splits only where a new value begins
    end     <-  blank* (strong / weak / EOF)
    quoted  <-  a mark, text, its closing mark, not a word   ('""' inside a '"' pair is one '"')
    bracket <-  '(' ... ')' / '[' ... ']'        may nest

Whether a comma or an "and" separates, or belongs to a value, is not typed in but learnt from
the column: what often begins a value where the separator is beyond doubt (the field's start,
or behind a strong separator), and is not met more often deep inside values, is a *start*.

A quote or bracket that never closes is an ordinary character: the ``quoted`` alternative
fails, the parser goes back and reads it bare; the item carries the flag
``unclosed_quote`` or ``unclosed_bracket``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.session import cut_lineage

#: A start begins at least one of so many values, and two of them.
RARE = 5_000
#: Tokens behind a place where a value may begin that don't count as lying inside one: "see IEC 1".
LEAD_TOKENS = 4
#: What starts are made of: dotted initials, words, numbers with their inner points and hyphens, single marks.
TOKEN = re.compile(r"(?:[^\W\d_]\.\s?){2,}[^\W\d_]?(?![^\W\d_])|[^\W\d_]+|\d+(?:[-.]\d+)*|\S")
_FIGURES = re.compile(r"\d+")


def token_key(t: str) -> str:
    """What a token is counted as: letters without case and stops, figures as 0."""
    if t[0].isdigit():
        return _FIGURES.sub("0", t)
    return t.casefold() if t.isalpha() else "".join(filter(str.isalpha, t)).casefold() or t


class _Keys(dict):
    """Keys of tokens met so far."""

    def __missing__(self, t: str) -> str:
        if len(self) > 100_000:
            self.clear()
        got = token_key(t)
        if len(t) <= 40:
            self[t] = got
        return got


KEYS = _Keys()


@dataclass(frozen=True)
class Grammar:
    """What separates values, and what encloses text that is not divided."""

    strong: str = r"\r\n|[\r\n\u2028\u2029]|<br\s*/?>|;|；|\||•|、|&amp;|&(?!\w+;)|(?<=\s)/(?=\s)"
    weak: str = r",\s*(?:and|et|und)\s+|,\s*|\s(?:and|et|und)\s+"
    #: how values begin, by their first token or first two (joined by a blank); None: a weak separator always separates
    starts: frozenset[str] | None = None
    quotes: tuple[tuple[str, str], ...] = (('"', '"'), ("“", "”"), ("«", "»"), ("„", "“"))
    brackets: tuple[tuple[str, str], ...] = (("(", ")"), ("[", "]"))


#: Characters that read as ASCII while the grammar looks for separators and starts; positions stay the same.
_FOLD = {0xFF01 + i: 0x21 + i for i in range(94)} | {0xA0: " ", 0x3000: " ", 0x2007: " ", 0x202F: " ", 0x2009: " ", 0xFF1B: "；"}
_FOLDS = re.compile("[\uff01-\uff5e\xa0\u3000\u2007\u202f\u2009]")
_BLANK = " \t\n\r\f\v\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"


def folded(text: str) -> str:
    return text.translate(_FOLD) if not text.isascii() and _FOLDS.search(text) else text


@dataclass(frozen=True)
class Item:
    pos: int
    value: str
    quoted: bool
    error: str | None


class FieldParser:
    """The grammar's recogniser; each rule takes a place and gives the place behind its match, or None.

    What was found out about a field (brackets that close, marks that never do) is kept while
    it is read, so that a field of any length and nesting is read in one go.  One parser reads
    one field at a time.
    """

    def __init__(self, grammar: Grammar = Grammar()):
        self.strong_re = re.compile(grammar.strong, re.IGNORECASE)
        self.weak_re = re.compile(grammar.weak, re.IGNORECASE)
        self.starts = grammar.starts
        self.quotes = dict(grammar.quotes)
        self.brackets = dict(grammar.brackets)
        opening = "".join(map(re.escape, [*self.quotes, *self.brackets]))
        self.bracket_re = re.compile("[" + "".join(re.escape(x) for pair in grammar.brackets for x in pair) + "]")
        self.mark_re = re.compile(f"[{opening}]") if opening else re.compile(r"(?!)")
        self._never: set[str] = set()
        self._closed: dict[int, int] = {}
        self._next_strong = self._next_weak = (0, -1)

    def strong(self, s: str, i: int) -> int | None:
        m = self.strong_re.match(s, i)
        return m.end() if m else None

    def start(self, s: str, i: int) -> bool:
        """Whether a value begins at ``i``: with an opening quote or a known start."""
        if self.starts is None:
            return True
        m = TOKEN.search(s, i)
        if m is None:
            return False
        first = m[0]
        if first in self.quotes:
            return True
        first = token_key(first)
        if first in self.starts:
            return True
        m = TOKEN.search(s, m.end())
        return f"{first} {token_key(m[0]) if m else ''}" in self.starts

    def weak(self, s: str, i: int) -> int | None:
        m = self.weak_re.match(s, i)
        return m.end() if m and self.start(s, m.end()) else None

    def end(self, s: str, i: int) -> bool:
        """Whether only blanks lie between ``i`` and a separator or the end."""
        while True:
            if i >= len(s) or self.strong(s, i) is not None or self.weak(s, i) is not None:
                return True
            if s[i] not in _BLANK:
                return False
            i += 1

    def quoted(self, s: str, i: int) -> int | None:
        close = self.quotes.get(s[i])
        if close is None or close in self._never:
            return None
        j = i + 1
        while (j := s.find(close, j)) >= 0:
            if close == s[i] and s.startswith(close, j + 1):
                j += 2  # a doubled mark stands for itself
                continue
            return None if s[j + 1 : j + 2].isalnum() else j + 1  # a mark before a word opens, it doesn't close
        if close != s[i]:
            self._never.add(close)  # no mark of this kind closes further on either
        return None

    def bracket(self, s: str, i: int) -> int | None:
        return self._closed.get(i)

    def _match_brackets(self, s: str) -> dict[int, int]:
        """Place of each bracket that closes -> place behind its closing one; one scan however deep they nest."""
        ends, opened = {}, {c: [] for c in self.brackets}
        closing = {c: o for o, c in self.brackets.items()}
        for m in self.bracket_re.finditer(s):
            c = m[0]
            if c in opened:
                opened[c].append(m.start())
            elif opened[closing[c]]:
                ends[opened[closing[c]].pop()] = m.end()
        return ends

    def separator(self, s: str, i: int) -> int:
        """Place of the first separator at or behind ``i``, or the end.

        The next one of either kind is kept until it is passed, so a field is searched once.
        """
        asked, strong = self._next_strong
        if not asked <= i <= strong:
            m = self.strong_re.search(s, i)
            strong = m.start() if m else len(s)
            self._next_strong = i, strong
        asked, weak = self._next_weak
        if not asked <= i <= weak:
            m = self.weak_re.search(s, i)
            while m and not self.start(s, m.end()):
                m = self.weak_re.search(s, m.start() + 1)
            weak = m.start() if m else len(s)
            self._next_weak = i, weak
        return min(strong, weak)

    def item(self, s: str, i: int) -> tuple[int, bool, str | None]:
        """End of the item at ``i``, whether quotes enclose it whole, and its error flag."""
        error = None
        j = i
        if s[i] in self.quotes:
            j = self.quoted(s, i)
            if j is None:
                error = "unclosed_quote"
            elif self.end(s, j):
                return j, True, None
            j = i
        while True:
            at = self.separator(s, j)
            m = self.mark_re.search(s, j, at)
            if not m:
                return at, False, error
            j = m.start()
            if s[j] in self.quotes:
                k = self.quoted(s, j)
                error = error or ("unclosed_quote" if k is None else None)
            else:
                k = self.bracket(s, j)
                error = error or ("unclosed_bracket" if k is None else None)
            j = k or j + 1

    def parse(self, text: str | None) -> Iterator[Item]:
        """The items of a field in written order; none for null and blank ones."""
        if text is None:
            return
        s = folded(text)
        self._never, self._closed = set(), self._match_brackets(s)
        self._next_strong = self._next_weak = (0, -1)
        i, pos = 0, 0
        while i < len(s):
            k = self.strong(s, i)
            if k is None:
                k = self.weak(s, i)
            if k is None and s[i] in _BLANK:
                k = i + 1
            if k is not None:
                i = k
                continue
            j, whole, error = self.item(s, i)
            raw = text[i:j]
            if whole:
                mark, raw = raw[0], raw[1:-1]
                if self.quotes[mark] == mark:
                    raw = raw.replace(mark * 2, mark)
            value = raw.strip(_BLANK)
            if value.strip(",") and value:
                pos += 1
                yield Item(pos, value, whole, error)
            i = max(j, i + 1)


ITEM_ROW = "pos int, value_text string, quoted boolean, error string"
_ITEMS = pa.list_(pa.struct([("pos", pa.int32()), ("value_text", pa.string()), ("quoted", pa.bool_()), ("error", pa.string())]))


def count_starts(text: str | None, parser: FieldParser, begins: Counter, inside: Counter) -> None:
    """Adds how the values of a field begin, and what stands deep inside them; ``parser`` knows strong separators only."""
    for it in parser.parse(text):
        v = folded(it.value)
        keys = [KEYS[t] for t in TOKEN.findall(v)]
        n = len(keys)
        keys.append("")
        begins[""] += 1
        begins[keys[0]] += 1
        begins[f"{keys[0]} {keys[1]}"] += 1
        if n <= LEAD_TOKENS:
            continue
        deep = range(LEAD_TOKENS, n)
        doubtful = {m.end() for m in parser.weak_re.finditer(v)}
        if doubtful:
            near = [k for k, m in enumerate(TOKEN.finditer(v)) if m.start() in doubtful]
            lead = {k + d for k in near for d in range(LEAD_TOKENS)}
            deep = [k for k in deep if k not in lead]
        for k in deep:
            inside[keys[k]] += 1
            inside[f"{keys[k]} {keys[k + 1]}"] += 1


def learned_starts(df: DataFrame, value: str, grammar: Grammar = Grammar()) -> frozenset[str]:
    """How values of a packed column begin, counted over all its rows.

    Each batch of rows is counted before anything is shuffled.  At most two starts a value,
    each of at least one in ``RARE`` values, reach the driver, whatever the column's size.
    """
    only_strong = replace(grammar, starts=frozenset())

    def count(batches):
        parser, begins, inside = FieldParser(only_strong), Counter(), Counter()
        for b in batches:
            for s in b.column(0).to_pylist():
                count_starts(s, parser, begins, inside)
            if len(begins) + len(inside) > 200_000:
                yield told(begins, inside)
                begins.clear(), inside.clear()
        yield told(begins, inside)

    def told(begins: Counter, inside: Counter) -> pa.RecordBatch:
        keys = list(begins | inside)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([begins[k] for k in keys], pa.int64()), pa.array([inside[k] for k in keys], pa.int64())], names=["key", "begins", "inside"])

    rows = df.where(F.length(F.trim(F.col(value))) > 0).select(F.col(value).alias("_packed"))
    counts = cut_lineage(rows.mapInArrow(count, "key string, begins long, inside long").groupBy("key").agg(F.sum("begins").alias("begins"), F.sum("inside").alias("inside")))
    total = counts.where("key = ''").agg(F.sum("begins")).first()[0] or 0
    often = counts.where((F.col("key") != "") & (F.col("begins") >= max(2, total / RARE)) & (F.col("begins") >= F.col("inside")))
    return frozenset(r[0] for r in often.select("key").collect())


def split_packed(df: DataFrame, value: str, keep: list[str], grammar: Grammar | None = None) -> DataFrame:
    """One row per value of the packed column: ``keep`` columns, pos, value_text, quoted, error.

    Without a ``grammar`` the starts are learnt from the column first.
    Positions count from 1 in written order; empty values are not counted.  Null and blank
    fields give no rows, repeated rows each give their own.  A field of any length is one
    linear scan.  Other columns are ignored.  No shuffle.
    """
    if grammar is None:
        grammar = Grammar(starts=learned_starts(df, value))
    kept = [df.schema[c] for c in keep]
    out = T.StructType([*kept, *T._parse_datatype_string(ITEM_ROW).fields])

    def split(batches):
        parser = FieldParser(grammar)
        for b in batches:
            rows, pos, text, quoted, error = [], [], [], [], []
            for n, s in enumerate(b.column(b.num_columns - 1).to_pylist()):
                for it in parser.parse(s):
                    rows.append(n)
                    pos.append(it.pos)
                    text.append(it.value)
                    quoted.append(it.quoted)
                    error.append(it.error)
            taken = [b.column(c).take(pa.array(rows, pa.int32())) for c in range(b.num_columns - 1)]
            arrays = [*taken, pa.array(pos, pa.int32()), pa.array(text, pa.string()), pa.array(quoted, pa.bool_()), pa.array(error, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    named = df.where(F.length(F.trim(F.col(value))) > 0).select(*keep, F.col(value).alias("_packed"))
    return named.mapInArrow(split, out)


def citations(export: DataFrame) -> DataFrame:
    """Each citation of ``iev_export.source`` as ``(export_id, pos, value_text)``."""
    return split_packed(export, "source", ["export_id"]).select("export_id", "pos", "value_text")
