"""Concept pages: HTML tables with a row per language and a row per definition."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.functions.labels import PAGE_LANGUAGES
from glossweave.markup.adoc import convert, italic, paragraphs
from glossweave.markup.math import asciimath
from glossweave.markup.tree import Element, parse

#: The font colour that marks languages and areas, areas that are known, and the blank image.
MARK = "#800080"
AREAS = frozenset("nl be nb nn br pt fr de us gb ch at ca au nz".split())
BLANK = re.compile(r"\A<img.*ecblank")
FORMULA = re.compile(r"(?s)<math[^>]*>.*?</math>")


def enrich(html: str, area: str) -> str:
    """A cell as markup; a formula that can't be read keeps its MathML."""
    html = html.replace("&lt;i&gt;", "<i>").replace("&lt;/i&gt;", "</i>")
    kept: list[str] = []

    def shield(m: re.Match) -> str:
        kept.append(m[0])
        return f"@@MATHML_{len(kept) - 1}@@"

    text = convert(FORMULA.sub(shield, html), area)
    for i, block in enumerate(kept):
        made = asciimath(block)
        text = text.replace(f"@@MATHML_{i}@@", f"stem:[{made}]" if made else block, 1)
    return re.sub(r"<i>([^<]*)</i>", lambda m: italic(m[1]), paragraphs(text)).strip()


class Row:
    """One table row: what its cells say."""

    def __init__(self, tr: Element):
        self.cells = tr.all("td")
        marked = next((f for d in tr.all("div") if d.attributes.get("align") == "center" for f in d.all("font") if f.attributes.get("color") == MARK), None)
        self.language = PAGE_LANGUAGES.get(marked.text.strip().lower()) if marked else None

    @property
    def content(self) -> Element | None:
        return self.cells[2] if len(self.cells) > 2 else None

    def area(self) -> str | None:
        font = self.cells[1].first("font", color=MARK) if len(self.cells) > 1 else None
        name = font.text.strip().lower() if font else ""
        return name if name in AREAS else None

    def term_html(self) -> str | None:
        cell = self.content
        if cell is None:
            return None
        font, bold = cell.first("font", color=MARK), cell.first("b")
        if font and bold is None and cell.text.strip() == font.text.strip() and len(font.text.strip()) <= 3:
            return None
        return (bold or cell).inner().strip() or None

    def blank(self) -> bool:
        """A separator: a rule in any cell, or nothing but blank images."""

        def spacer(cell: Element) -> bool:
            html = cell.inner().strip()
            image = any("ecblank" in e.attributes.get("src", "") for e in cell.all("img"))
            return not html or bool(BLANK.match(html)) or image and not cell.text.strip()

        return any(c.first("hr") for c in self.cells) or all(map(spacer, self.cells))

    def definition_html(self) -> str | None:
        """The definition that this row holds for the language row before it."""
        if self.language or self.blank() or self.content is None:
            return None
        html = self.content.inner().strip()
        return None if not html or BLANK.match(html) else html


def parse_page(html: str | None, code: str) -> list[dict] | None:
    """One entry per language in page order; null for null and for pages that don't show the code in bold."""
    if html is None:
        return None
    root = parse(html)
    if not any(code in b.text for b in root.all("b")):
        return None
    tables = root.all("table")
    rows = [Row(tr) for tr in max(tables, key=lambda t: len(t.all("tr"))).all("tr")] if tables else []
    area = code.rpartition("-")[0]
    found: dict[str, dict] = {}
    for here, after in zip(rows, [*rows[1:], None]):
        term = here.term_html() if here.language else None
        if term is None:
            continue
        entry = found.setdefault(here.language, {"language": here.language, "terms": [], "areas": [], "definition": None})
        entry["terms"].append(enrich(term, area))
        entry["areas"].append(here.area())
        definition = after.definition_html() if after else None
        if definition and entry["definition"] is None:
            entry["definition"] = enrich(definition, area)
    return list(found.values())


PAGE = T.ArrayType(
    T.StructType(
        [
            T.StructField("language", T.StringType()),
            T.StructField("terms", T.ArrayType(T.StringType())),
            T.StructField("areas", T.ArrayType(T.StringType())),
            T.StructField("definition", T.StringType()),
        ]
    )
)


@F.pandas_udf(PAGE)
def page_entries(pages: pd.Series, codes: pd.Series) -> pd.Series:
    return pd.Series([parse_page(h, c) for h, c in zip(pages, codes)], dtype=object)


def area_links(html: str | None) -> list[tuple[str, str]]:
    """(code, title) of links to parts; blank titles skipped, the first of a code wins."""
    out: dict[str, str] = {}
    for a in parse(html or "").all("a"):
        m = re.search(r"part=(\d+)", a.attributes.get("href", ""))
        title = " ".join(a.text.split())
        if m and title:
            out.setdefault(m[1], title)
    return list(out.items())


def section_cells(html: str | None) -> list[tuple[str, str]]:
    """(code, title) of cells ``Section NN-NN: title``; the first of a code wins."""
    out: dict[str, str] = {}
    for td in parse(html or "").all("td"):
        m = re.match(r"Section\s+([\d-]+):\s*(.+)$", td.text.strip())
        if m:
            out.setdefault(m[1], m[2].strip())
    return list(out.items())
