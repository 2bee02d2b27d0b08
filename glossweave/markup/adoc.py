"""Sheet and page HTML as lightweight markup, one rule per element."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.markup.math import formulas
from glossweave.markup.tree import Comment, Element, parse, serialise

#: Where images and references go, and how figures and codes are written.
IMAGES = "image::/assets/images/parts"
URN = "urn:iec:std:iec:60050"
CODE = re.compile(r"\A(IEV)?\s*(\d{2,3}-\d{2,3}-\d{2,3})\Z")
BARE_CODE = re.compile(r"\A\s*IEV\s*\d{2,3}-\d{2,3}-\d{2,3}\s*\Z")
UNQUOTED = re.compile(r"href=(IEV\s\d{2,3}-\d{2,3}-\d{2,3})(?=[>\s])")
_FILE = r"<simg [^>]*/\$file/([\d\-\w.]+)>"
_CAPTION = r"<p><b>\s*Figure\s+(\d)\s+[–-]\s+([^<]+)\s*</b>(?:</p>)?"
FIGURES = [
    (re.compile(rf"{_FILE}\s*{_CAPTION}\s*{_CAPTION}"), "{0}[Figure {1} - {2}; {3} - {4}]"),
    (re.compile(rf"{_FILE}\s*{_CAPTION}"), "{0}[Figure {1} - {2}]"),
    (re.compile(_FILE), "{0}[]"),
]

#: What list items begin with.
BULLETS = {"ol": ". ", "ul": "* "}
#: Lists within lists whose items are written with those of the list around them.
NESTED_LISTS = 2

Lookup = Callable[[str], "str | None"]


class Writer:
    """Writes a tree of one concept's area; ``term_of`` names the concept of a code that is linked without a name."""

    def __init__(self, area: str, term_of: Lookup | None = None):
        self.area, self.term_of = area, term_of or (lambda code: None)
        self.lists = 0
        inner = lambda e, s: s
        self.rules: dict[str, Callable[[Element, str], str]] = {
            "a": self.link,
            "b": lambda e, s: f"*{s}*",
            "br": lambda e, s: "\n",
            "img": lambda e, s: f"{IMAGES}/{self.area}/{e.attributes.get('src') or next(iter(e.attributes), '')}[]",
            "p": lambda e, s: s + "\n",
            "div": inner,
            "span": inner,
            "li": inner,
            "i": lambda e, s: italic(s),
            "sub": lambda e, s: s and f"~{s}~",
            "sup": lambda e, s: s and f"^{s}^",
            "font": lambda e, s: f"`{s}`" if "sans-serif" in e.attributes.get("style", "") else s,
        }

    def nodes(self, nodes) -> str:
        return "".join(map(self.node, nodes))

    def node(self, n) -> str:
        if isinstance(n, Comment):
            return ""
        if isinstance(n, str):
            return n
        if n.name in BULLETS:
            return self.items(n, BULLETS[n.name])
        rule = self.rules.get(n.name)
        return rule(n, self.nodes(n.children)) if rule else serialise(n)

    def items(self, e: Element, bullet: str) -> str:
        """A list's items, those of lists within it too; far down only its own, or each level would double the text."""
        self.lists += 1
        below = e.all("li") if self.lists <= NESTED_LISTS else [c for c in e.children if isinstance(c, Element) and c.name == "li"]
        written = "\n".join(bullet + self.nodes(li.children) for li in below)
        self.lists -= 1
        return written

    def link(self, e: Element, inner: str) -> str:
        href = e.attributes.get("href", "").strip()
        code = CODE.match(href)
        if code:
            shown = inner.strip()
            if BARE_CODE.match(shown):
                shown = self.term_of(code[2]) or shown
            return f"{{{{{URN}-{code[2]}, {shown}}}}}"
        return f"{href}[{inner}]" if href else inner


def italic(text: str) -> str:
    return "" if not text else f"stem:[{text}]" if len(text) <= 12 else f"_{text}_"


def convert(text: str | None, area: str, term_of: Lookup | None = None) -> str | None:
    """HTML as markup; null for null, texts without a tag unchanged."""
    if text is None or "<" not in text:
        return text
    for pattern, shown in FIGURES:
        text = pattern.sub(lambda m: f"{IMAGES}/{area}/" + shown.format(*m.groups()), text)
    text = UNQUOTED.sub(r'href="\1"', text)
    return Writer(area, term_of).nodes(parse(text).children) if "<" in text else text


def paragraphs(text: str) -> str:
    text = re.sub(r"<[pbr]+>", "\n\n", text.replace("\\n", "\n\n"))
    text = re.sub(r"<br\s*/?>", "\n\n", text)
    return re.sub(r"\s*\n[\n\s]+", "\n\n", text, flags=re.ASCII).strip()


def without_comments(text: str) -> str:
    """Comments at the top level dropped."""
    if "<!--" not in text:
        return text
    for c in parse(text).children:
        if isinstance(c, Comment):
            text = text.replace(f"<!--{c}-->", "")
    return text


def content(text: str | None, area: str, term_of: Lookup | None = None) -> str:
    """The whole chain for a sheet cell: comments, markup, paragraphs, formulas; '' for null."""
    if text is None:
        return ""
    if not any(c in text for c in "<&\n\\"):
        return text.strip()
    return formulas(paragraphs(convert(without_comments(text), area, term_of))).strip()


@F.pandas_udf(T.StringType())
def content_of(texts: pd.Series, areas: pd.Series) -> pd.Series:
    """A cell's markup; null for null."""
    return pd.Series([None if t is None else content(t, a or "") for t, a in zip(texts, areas)], dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def contents_of(lists: pd.Series, areas: pd.Series) -> pd.Series:
    return pd.Series([None if ts is None else [content(t, a or "") for t in ts] for ts, a in zip(lists, areas)], dtype=object)


@F.pandas_udf(T.StringType())
def markup_of(texts: pd.Series, areas: pd.Series) -> pd.Series:
    """HTML as markup without the rest of the chain."""
    return pd.Series([convert(t, a or "") for t, a in zip(texts, areas)], dtype=object)


@F.pandas_udf(T.StringType())
def formulas_of(texts: pd.Series) -> pd.Series:
    return texts.map(formulas)


#: A mention of another concept in converted text: code and shown words.
MENTION = r"\{\{urn:iec:std:iec:60050-([0-9]{2,3}-[0-9]{2,3}-[0-9]{2,3}), ([^}]*)\}\}"


def mentions(column):
    """``ARRAY<STRUCT<code, shown>>`` of a converted text, natively."""
    codes, shown = F.regexp_extract_all(column, F.lit(MENTION), F.lit(1)), F.regexp_extract_all(column, F.lit(MENTION), F.lit(2))
    return F.arrays_zip(codes.alias("code"), shown.alias("shown"))


def with_names(column, names):
    """A converted text whose mentions of a bare code show the code's name in the map ``names``, where it has one, natively."""
    bare = lambda m: m["shown"].rlike(r"^\s*IEV\s*[0-9]{2,3}-[0-9]{2,3}-[0-9]{2,3}\s*$")
    shown = lambda m: F.when(bare(m), F.coalesce(F.try_element_at(names, m["code"]), m["shown"])).otherwise(m["shown"])
    written = F.transform(mentions(column), lambda m: F.concat(F.lit("{{" + URN + "-"), m["code"], F.lit(", "), shown(m), F.lit("}}")))
    woven = F.array_join(F.zip_with(F.split(column, MENTION, -1), written, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(names.isNotNull() & column.contains("{{urn:"), woven).otherwise(column)


def see_relations(column):
    """``ARRAY<STRUCT<type, source, id>>``: a ``see`` relation to each concept that a converted text mentions, each once."""
    return F.transform(F.array_distinct(mentions(column)["code"]), lambda c: F.struct(F.lit("see").alias("type"), F.lit("IEV").alias("source"), c.alias("id")))
