"""Freely typed citations mapped to the entries of a reference list.

1. A multi-pattern automaton (Aho-Corasick) holds the names of all publishers under every
   alias that the alias table gives, the numbers of the list and its titles.  It runs over
   the citation's letters and digits alone, so spacing and punctuation don't matter.  A
   number directly behind a name of its publisher is a *mention*, and so is a title.
2. An exact check follows on the text around each: the number must be the entry's number,
   not a part of a longer one, and a year, where given, must be an edition's.  Of mentions
   that overlap the longest wins, and every mention that is left counts.
3. A citation without a mention may hold a code that stands for an entry.
4. What is left goes to token-set similarity against the titles, with tokens compared by
   edit distance, so misspelled titles still find their entry.
5. What then is left has no entry and is reported with ``ref_id`` 0, and so is a citation
   that means several works alike.

The operator knows no publisher and no language; ``Wording`` and the alias table say what is
usual in a source.  A list of bounded size is sent to the executors.  A longer one never
passes through the driver: its blocks meet the distinct citations on the executors, each
block gives its *candidates* (mentions with their places, titles with their similarity), and
the same decision is taken over the candidates of all blocks, so blocks change no answer.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import permutations, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.operators.packed import FieldParser, Grammar, learned_starts, split_packed
from glossweave.session import cut_lineage, small_rows

#: Entries of the list that one automaton holds; longer lists are matched in blocks.
BLOCK_ENTRIES = 20_000
#: Bytes of distinct citations that meet a block in one task.
TASK_BYTES = 64 << 20
#: Least token-set similarity of a title.
TITLE_SIMILARITY = 0.8
#: Letters of a word that may be missing from a title that is meant all the same.
SHORT_WORD = 3

YEAR = re.compile(r"^\s*(?:[:,(\-]\s*)?(?:(?:ed\.?|edition|éd\.?)\s*)?((?:19|20)\d{2})(?![\d.]|-\d)")
YEAR_AFTER_TITLE = re.compile(r"^\W*(?:ed\.?\s*)?((?:19|20)\d{2})\b")
MISREAD = re.compile(r"[\d.\-][oоli]")
DASHES = dict.fromkeys(map(ord, "‐‑‒–—―−﹘﹣－"), "-")
QUOTES = "\"“”«»„‟ \t\n\xa0"

MENTION, CODE, SIMILAR = 3, 2, 1
FOUND_BY = {MENTION: "mention", CODE: "code", SIMILAR: "similar"}


@dataclass(frozen=True)
class Wording:
    """What is usual in a source: words beside a publisher's name, and patterns of what stands before a title, of
    remarks behind it, and of codes with the canonical name of the entry that they stand for."""

    fillers: tuple[str, ...] = ()
    lead: str = r"(?!)"
    tail: str = r"(?!)"
    codes: tuple[tuple[str, str], ...] = ()


def canon(text: str) -> str:
    """One spelling of a citation: compatible forms, lower case, one kind of dash and space, digits mistaken for letters."""
    s = text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).casefold().translate(DASHES)
    s = " ".join(s.split()).strip(QUOTES)
    if not MISREAD.search(s):
        return s
    s = re.sub(r"(?<=\d)[oо](?=[\dolо]|\b)", "0", s)
    s = re.sub(r"(?<=\d)[li](?=[\dolо]|\b)|(?<=\.)[li](?=\d{2})|(?<=\d-)[li](?!\w)", "1", s)
    return re.sub(r"(?<=\d)[oо](?=\d|\b)", "0", s)


def letters(s: str) -> str:
    return "".join(c for c in s if c.isalnum())


def flat(s: str) -> str:
    """The letters and digits of a typed name as a citation's are compared."""
    return letters(canon(s))


def names_of(publisher: str, aliases: dict[str, list[str]], fillers: Sequence[str]) -> list[str]:
    """Every spelling of a publisher: the aliases of its parts in any order, with a word beside them or without."""
    parts = [p for p in publisher.split("/") if p]
    spelled = [[flat(p), *aliases.get(flat(p), [])] for p in parts]
    bases = ["".join(x) for order in permutations(spelled) for x in product(*order)] if len(parts) <= 4 else ["".join(x[0] for x in spelled)]
    beside = [flat(f) for f in fillers]
    return list(dict.fromkeys([*bases, *[b + f for b in bases for f in beside], *[f + b for b in bases for f in beside]]))


def edits(n: int) -> int:
    """Edits that a word of ``n`` letters may have and still be the same word."""
    return 1 if n < 4 else max(2, n // 3)


def likeness(a: str, b: str) -> float:
    """1 - edit distance (with swaps of neighbours) / longer length; 0 beyond the edits that the longer word may have."""
    n, m = len(a), len(b)
    most = edits(max(n, m))
    if abs(n - m) > most:
        return 0.0
    before, last = list(range(m + 1)), []
    for i, x in enumerate(a, 1):
        row, left, least = [i], i, i
        for j, y in enumerate(b, 1):
            d = before[j - 1]
            if x != y:
                up = before[j]
                d = (d if d < up else up) if d < left or up < left else left
                d += 1
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and last[j - 2] + 1 < d:
                    d = last[j - 2] + 1
            row.append(d)
            left = d
            if d < least:
                least = d
        if least > most:
            return 0.0
        last, before = before, row
    return 1 - before[m] / max(n, m) if before[m] <= most else 0.0


class WordIndex:
    """The words of a list by their pairs of letters: words near a typed one share some, so only those are compared."""

    def __init__(self, words: Iterable[str]):
        self.words = set(words)
        self.by_pair: dict[str, list[str]] = defaultdict(list)
        self.size = {w: len(self.pairs(w)) for w in self.words}
        for w in self.words:
            for g in self.pairs(w):
                self.by_pair[g].append(w)
        self.longest = max(map(len, self.words), default=0)
        self.kept: dict[str, dict[str, float]] = {}

    @staticmethod
    def pairs(w: str) -> set[str]:
        """Neighbouring letters, the edges included; of the shortest words the letters too, since a swap leaves them no pair."""
        return {*map("".join, zip(f" {w}", f"{w} ")), *(w if len(w) <= SHORT_WORD else ())}

    def near(self, w: str) -> dict[str, float]:
        """Words that share a pair with ``w`` and are like it, with their likeness."""
        got = self.kept.get(w)
        if got is None:
            if len(w) - edits(len(w)) > self.longest:
                return {}  # too long to be like any
            got = {w: 1.0} if w in self.words else {}
            shared: dict[str, int] = {}
            mine = self.pairs(w)
            for g in mine:
                for v in self.by_pair.get(g, ()):
                    shared[v] = shared.get(v, 0) + 1
            for v, n in shared.items():
                # an edit touches three pairs at most
                if n >= self.size[v] - 3 * edits(max(len(v), len(w))) and n >= len(mine) - 3 * edits(max(len(v), len(w))) and v != w and (r := likeness(w, v)):
                    got[v] = r
            if len(self.kept) > 100_000:
                self.kept.clear()
            self.kept[w] = got
        return got


class ReferenceList:
    """The automaton and title index of (a block of) the list.

    ``entries``: tuples (ref_id, publisher, doc_number, edition_year, title_en, title_fr, canonical);
    ``publishers``: those of the whole list, ``aliases``: pairs (name, alias).
    """

    def __init__(self, entries: Sequence[tuple], aliases: Sequence[tuple] = (), wording: Wording = Wording(), publishers: Sequence[str] | None = None):
        import ahocorasick

        self.lead = re.compile(f"^(?:{wording.lead})+")
        self.tail = re.compile(wording.tail, re.DOTALL)
        also: dict[str, list[str]] = defaultdict(list)
        for name, alias in aliases:
            if name and alias:
                also[flat(name)].append(flat(alias))
        self.editions: dict[tuple, dict] = defaultdict(dict)  # work -> {year: ref_id}
        self.titles: dict[frozenset, set] = defaultdict(set)  # title words -> works
        by_name: dict[str, int] = {}
        names: dict[str, set] = defaultdict(set)  # pattern -> publishers
        numbers: dict[str, list] = defaultdict(list)  # pattern -> (work, number)
        whole: dict[str, set] = defaultdict(set)  # pattern -> works
        for ref, publisher, number, year, en, fr, canonical in entries:
            work = (publisher or "", number or "", "" if number else canonical or str(ref))
            self.editions[work].setdefault(year, ref)
            if number:
                numbers[flat(number)].append((work, canon(number).replace(" ", "")))
            elif canonical:
                by_name.setdefault(canonical, ref)
                for name in [flat(canonical), *also.get(flat(canonical), [])]:
                    whole[name].add(work)
            for title in (en, fr):
                if title:
                    spelled = canon(title)
                    whole[letters(spelled)].add(work)
                    self.titles[frozenset(self.words(spelled))].add(work)
        for publisher in dict.fromkeys(publishers if publishers is not None else [e[1] for e in entries]):
            for name in names_of(publisher or "", also, wording.fillers):
                names[name].add(publisher or "")
        self.auto = ahocorasick.Automaton()
        for p in {*names, *numbers, *whole}:
            if p:
                self.auto.add_word(p, (len(p), names.get(p), numbers.get(p), whole.get(p)))
        self.auto.make_automaton()
        self.codes = [(re.compile(pattern), by_name[name]) for pattern, name in wording.codes if name in by_name]
        self.titles.pop(frozenset(), None)
        self.posting: dict[str, list] = defaultdict(list)
        for words in self.titles:
            for w in words:
                self.posting[w].append(words)
        self.index = WordIndex(self.posting)

    @staticmethod
    def words(s: str) -> list[str]:
        return re.findall(r"\w+", s)

    def edition(self, work: tuple, year: int | None) -> int:
        """The ref_id of the edition meant; 0 if the year is no edition's or none is given and there are several."""
        years = self.editions[work]
        if year:
            return years.get(year, 0)
        return next(iter(years.values())) if len(years) == 1 else 0

    def mentions(self, s: str) -> list[tuple]:
        """Candidates ``(MENTION, first, length, 1.0, ref_id)`` of a citation in its one spelling, those that overlap included."""
        places = [i for i, c in enumerate(s) if c.isalnum()]
        text = "".join(s[i] for i in places)
        if not text or not len(self.auto):
            return []
        begins = lambda i: not places[i] or not s[places[i] - 1].isalnum()
        names: dict[int, tuple[int, set]] = {}  # place behind the longest name that ends there -> its first place, its publishers
        out = []
        hits = list(self.auto.iter(text))
        if not hits:
            return []
        for last, (length, publishers, _, _) in hits:
            first = last - length + 1
            if publishers and begins(first) and (last + 1 not in names or first < names[last + 1][0]):
                names[last + 1] = first, publishers
        for last, (length, _, numbers, works) in hits:
            first, behind = last - length + 1, places[last] + 1
            rest = s[behind : behind + 40]
            if works and begins(first) and not re.match(r"\w", rest):
                m = YEAR_AFTER_TITLE.match(rest)
                out += [(MENTION, first, length, 1.0, self.edition(w, int(m[1]) if m else None)) for w in works]
            for work, number in numbers or ():
                start, known = names.get(first, (0, ())) if work[0] else (first, {""} if begins(first) else ())
                if work[0] not in known:
                    continue
                typed = s[places[first] : behind].replace(" ", "")
                m = YEAR.match(rest)
                if typed != number and typed.replace(".", "") != number.replace(".", "") or re.match(r"\d", rest) or not m and re.match(r"\s*-\s*\d", rest):
                    continue
                out.append((MENTION, start, last + 1 - start, 1.0, self.edition(work, int(m[1]) if m else None)))
        return out

    def similar(self, s: str) -> list[tuple]:
        """Candidates ``(SIMILAR, 0, 0, similarity, ref_id)``: the titles most like a citation, if they are like enough.

        A title is compared only if it has a word near one of the citation's rarest words:
        without one it could not reach the least similarity any more.
        """
        head = self.tail.sub("", self.lead.sub("", s))
        cited = list(dict.fromkeys(self.words(head)))
        near = {w: self.index.near(w) for w in cited}
        least = TITLE_SIMILARITY / (2 - TITLE_SIMILARITY)  # of the cited words that must be near, as a title has at most as many that are
        rare = sorted(cited, key=lambda w: sum(len(self.posting[v]) for v in near[w]))[: len(cited) - int(-(-least * len(cited) // 1)) + 1]
        ranked = [sorted(((r, v) for v, r in near[w].items()), reverse=True) for w in cited if near[w]]
        top, best = 0.0, []
        for title in {t for w in rare for v in near[w] for t in self.posting[v]}:
            score = 0.0
            for likes in ranked:
                for r, v in likes:
                    if v in title:
                        score += r
                        break
            score = round(2 * score / (len(cited) + len(title)), 9)
            if score >= TITLE_SIMILARITY and score >= top:
                best = [title] if score > top else [*best, title]
                top = score
        m = YEAR_AFTER_TITLE.match(self.lead.sub("", s)[len(head) :])
        year = int(m[1]) if m else None
        return [(SIMILAR, 0, 0, top, self.edition(w, year) if self.told(cited, near, t) else 0) for t in best for w in self.titles[t]]

    @staticmethod
    def told(cited: list[str], near: dict, title: frozenset) -> bool:
        """Whether no word tells a title from the citation: a longer word of it that is missing, or a short one with another in its place."""
        missing = [v for v in title if not any(v in near[w] for w in cited)]
        if any(len(v) > SHORT_WORD for v in missing):
            return False
        return not missing or not any(len(w) <= SHORT_WORD and not any(v in title for v in near[w]) for w in cited)

    def candidates(self, value: str | None) -> list[tuple]:
        """All that this list has to say about a citation: (kind, first place, length, certainty, ref_id)."""
        s = canon(value or "")
        if not s:
            return []
        found = self.mentions(s) or [(CODE, 0, 0, 1.0, ref) for pattern, ref in self.codes if pattern.search(s)]
        return found or self.similar(s)


def decide(candidates: Sequence[tuple]) -> tuple[list[int], float, str]:
    """(entries meant, certainty, what found them) of a citation, from the candidates of all lists asked.

    The surest kind counts.  Mentions: the longest first, then the leftmost, each that
    overlaps none taken before.  Titles: the most similar.  Works that share a place (or a
    similarity) are ambiguous and mean none, unless only one of them has the edition cited.
    """
    if not candidates:
        return [0], 0.0, "none"
    if len(candidates) == 1:
        kind, _, _, certainty, ref = candidates[0]
        return [ref], certainty, FOUND_BY[kind] if ref else "no edition"
    kind = max(c[0] for c in candidates)
    certainty = max(c[3] for c in candidates if c[0] == kind)
    places: dict[tuple[int, int], set] = defaultdict(set)
    for k, first, length, sure, ref in candidates:
        if k == kind and sure == certainty:
            places[first, length].add(ref)
    refs, taken, ambiguous = set(), [], False
    for first, length in sorted(places, key=lambda p: (-p[1], p[0])):
        if all(first + length <= a or b <= first for a, b in taken):
            taken.append((first, first + length))
            meant = places[first, length] - {0}
            ambiguous |= len(meant) > 1
            refs |= meant if len(meant) == 1 else set()
    return sorted(refs) or [0], certainty, FOUND_BY[kind] if refs else "ambiguous" if ambiguous else "no edition"


ENTRY = ["ref_id", "publisher", "doc_number", "edition_year", "title_en", "title_fr", "canonical"]
ROW = "export_id long, pos int, value_text string, ref_id long, certainty double, found_by string"
_ROW = pa.schema([("export_id", pa.int64()), ("pos", pa.int32()), ("value_text", pa.string()), ("ref_id", pa.int64()), ("certainty", pa.float64()), ("found_by", pa.string())])
_CANDIDATE = pa.schema([("value_text", pa.string()), ("kind", pa.int32()), ("first", pa.int32()), ("length", pa.int32()), ("sure", pa.float64()), ("ref", pa.int64())])
_CANDIDATES = "value_text string, kind int, first int, length int, sure double, ref long"


@lru_cache(maxsize=4)
def _list_of(entries: tuple, aliases: tuple, wording: Wording, publishers: tuple) -> tuple[ReferenceList, dict]:
    """A worker's list and its answers so far, kept from task to task."""
    return ReferenceList(entries, aliases, wording, publishers), {}


def _bounded(df: DataFrame, what: str) -> tuple:
    rows = small_rows(df)
    if rows is None:
        raise ValueError(f"too many {what} to be sent to every task")
    return tuple(sorted((tuple(r) for r in rows), key=str))


def resolve_citations(export: DataFrame, publications: DataFrame, aliases: DataFrame | None = None, wording: Wording = Wording()) -> DataFrame:
    """``(export_id, pos, value_text, ref_id, certainty, found_by)``: each citation of ``source`` with each entry it means, 0 for none.

    Null and blank sources give no rows.  A citation without a year means the only edition;
    a year that no edition has, or no year where there are several editions, has no entry;
    neither has one that several works fit alike.  ``found_by`` is ``mention``, ``code``,
    ``similar``, ``ambiguous``, ``no edition`` or ``none``.  Null titles, numbers and years of
    the list are skipped or match as null; null aliases are no names.  Repeated rows are
    answered alike.  Other columns are ignored.  An empty list answers 0 throughout.
    """
    known = () if aliases is None else _bounded(aliases.select("name", "alias").distinct(), "aliases")
    publishers = tuple(r[0] for r in _bounded(publications.select(F.coalesce("publisher", F.lit(""))).distinct(), "publishers"))
    slim = export.where(F.length(F.trim("source")) > 0).select(F.col("export_id").cast("long"), "source")
    grammar = Grammar(starts=learned_starts(slim, "source"))
    entries = small_rows(publications.select(*ENTRY), BLOCK_ENTRIES)
    if entries is None:
        return _in_blocks(slim, publications, known, wording, publishers, grammar)
    listed = tuple(sorted((tuple(r) for r in entries), key=lambda r: (r[0] is None, r[0])))

    def run(batches):
        parser, (refs, memo) = FieldParser(grammar), _list_of(listed, known, wording, publishers)
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for i, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for it in parser.parse(s):
                    got = memo.get(it.value)
                    if got is None:
                        got = decide(refs.candidates(it.value))
                        if len(it.value) <= 300:  # what is kept stays small
                            if len(memo) > 50_000:
                                memo.clear()
                            memo[it.value] = got
                    for ref in got[0]:
                        for col, x in zip(cols, (i, it.pos, it.value, ref, got[1], got[2])):
                            col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, _ROW.types)], schema=_ROW)

    return slim.mapInArrow(run, ROW)


def _in_blocks(slim: DataFrame, publications: DataFrame, known: tuple, wording: Wording, publishers: tuple, grammar: Grammar) -> DataFrame:
    """The answers of a list of any length: each block meets the distinct citations, then their candidates are decided on."""
    items = cut_lineage(split_packed(slim, "source", ["export_id"], grammar).select("export_id", "pos", "value_text"))
    texts = items.select("value_text").distinct()
    n_entries = publications.count()
    n_bytes = texts.agg(F.sum(F.octet_length("value_text"))).first()[0] or 0
    blocks, salts = -(-2 * n_entries // BLOCK_ENTRIES), n_bytes // TASK_BYTES + 1
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # all editions of a work are in one block; works of one title may not be, their candidates meet afterwards
    work = F.pmod(F.xxhash64(F.coalesce("publisher", F.lit("")), F.coalesce("doc_number", "canonical")), F.lit(blocks)).cast("int")
    asked = texts.select("value_text", F.pmod(F.xxhash64("value_text"), F.lit(salts)).cast("int").alias("_salt"), numbers(blocks).alias("_block"))
    told = publications.select(*ENTRY, work.alias("_block"), numbers(salts).alias("_salt"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        entries = [tuple(r[c] for c in ENTRY) for r in right.select(ENTRY).to_pylist()]
        refs = ReferenceList(sorted(entries, key=lambda r: (r[0] is None, r[0])), known, wording, publishers)
        rows = [(v, *c) for v in left.column("value_text").to_pylist() for c in refs.candidates(v)]
        cols = list(zip(*rows)) if rows else [[]] * len(_CANDIDATE)
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(cols, _CANDIDATE.types)], schema=_CANDIDATE)

    by = ["_block", "_salt"]
    each = asked.groupBy(*by).cogroup(told.groupBy(*by)).applyInArrow(meet, _CANDIDATES)
    listed = each.groupBy("value_text").agg(F.collect_list(F.struct("kind", "first", "length", "sure", "ref")).alias("_c"))

    def settle(batches):
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for i, pos, value, found in zip(*[c.to_pylist() for c in b.columns]):
                refs, sure, how = decide([tuple(x.values()) for x in found or ()])
                for ref in refs:
                    for col, x in zip(cols, (i, pos, value, ref, sure, how)):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, _ROW.types)], schema=_ROW)

    return items.join(listed, "value_text", "left").select("export_id", "pos", "value_text", "_c").mapInArrow(settle, ROW)


def found(export: DataFrame, publications: DataFrame, aliases: DataFrame | None = None, wording: Wording = Wording()) -> DataFrame:
    """Distinct ``(export_id, ref_id)``; 0 says that at least one citation of the row has no entry."""
    return resolve_citations(export, publications, aliases, wording).select("export_id", "ref_id").distinct()
