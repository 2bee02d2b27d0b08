"""Formulas: MathML as AsciiMath, and inline markup as formula text."""

from __future__ import annotations

import html
import re
from functools import lru_cache

from glossweave.functions.text import GREEK
from glossweave.markup.tree import Comment, Element, parse, serialise

#: Characters that AsciiMath writes as words.
SYMBOLS = {
    "∫": "int", "∑": "sum", "∏": "prod", "∂": "del", "∞": "oo", "±": "+-", "×": "xx", "⋅": "*", "·": "*", "≤": "<=", "≥": ">=", "≠": "!=", "≈": "~~",
    "→": "->", "⇒": "=>", "∈": "in", "∉": "notin", "⊂": "sub", "∪": "uu", "∩": "nn", "∅": "O/", "∇": "grad", "√": "sqrt", "′": "'", "−": "-",
    "α": "alpha", "β": "beta", "γ": "gamma", "Γ": "Gamma", "δ": "delta", "Δ": "Delta", "ε": "epsilon", "ζ": "zeta", "η": "eta", "θ": "theta", "Θ": "Theta",
    "ι": "iota", "κ": "kappa", "λ": "lambda", "Λ": "Lambda", "μ": "mu", "ν": "nu", "ξ": "xi", "Ξ": "Xi", "π": "pi", "Π": "Pi", "ρ": "rho", "σ": "sigma",
    "Σ": "Sigma", "τ": "tau", "υ": "upsilon", "φ": "phi", "Φ": "Phi", "χ": "chi", "ψ": "psi", "Ψ": "Psi", "ω": "omega", "Ω": "Omega",
}
ACCENTS = {"¯": "bar", "‾": "bar", "^": "hat", "ˆ": "hat", "→": "vec", "~": "tilde", "˜": "tilde", "˙": "dot", "¨": "ddot", "_": "ul"}


class Unsupported(Exception):
    pass


def _kids(e: Element) -> list[Element]:
    return [c for c in e.children if isinstance(c, Element)]


def _word(text: str) -> str:
    return " ".join(SYMBOLS.get(c, c) for c in text.strip()) if any(c in SYMBOLS for c in text) else text.strip()


def _row(e: Element) -> str:
    return " ".join(x for x in map(_math, _kids(e)) if x)


def _arguments(e: Element, n: int) -> list[str]:
    kids = _kids(e)
    if len(kids) != n:
        raise Unsupported(e.name)
    return [_math(k) for k in kids]


def _scripted(e: Element, *signs: str) -> str:
    base, *scripts = _arguments(e, len(signs) + 1)
    return base + "".join(f"{sign}({s})" for sign, s in zip(signs, scripts))


def _over(e: Element) -> str:
    base, mark = _arguments(e, 2)
    raw = _kids(e)[1].text.strip()
    return f"{ACCENTS[raw]}({base})" if raw in ACCENTS else f"{base}^({mark})"


def _fenced(e: Element) -> str:
    inner = (e.attributes.get("separators", ",")[:1] or "").join(map(_math, _kids(e)))
    return f"{e.attributes.get('open', '(')}{inner}{e.attributes.get('close', ')')}"


RULES = {
    **dict.fromkeys(("math", "mrow", "mstyle"), _row),
    "semantics": lambda e: _math(_kids(e)[0]) if _kids(e) else "",
    **dict.fromkeys(("mi", "mn", "mo"), lambda e: _word(e.text)),
    "mtext": lambda e: f'"{e.text.strip()}"' if e.text.strip() else "",
    "mspace": lambda e: "",
    "msub": lambda e: _scripted(e, "_"),
    "msup": lambda e: _scripted(e, "^"),
    "munder": lambda e: _scripted(e, "_"),
    "mover": _over,
    "msubsup": lambda e: _scripted(e, "_", "^"),
    "munderover": lambda e: _scripted(e, "_", "^"),
    "mfrac": lambda e: "({})/({})".format(*_arguments(e, 2)),
    "msqrt": lambda e: f"sqrt({_row(e)})",
    "mroot": lambda e: "root({1})({0})".format(*_arguments(e, 2)),
    "mfenced": _fenced,
}


def _math(e: Element) -> str:
    rule = RULES.get(e.name)
    if rule is None:
        raise Unsupported(e.name)
    return rule(e)


@lru_cache(maxsize=10_000)
def asciimath(mathml: str) -> str:
    """A formula as AsciiMath; '' for one with elements beyond the rules."""
    root = parse(mathml).first("math")
    try:
        return _math(root).strip() if root is not None else ""
    except Unsupported:
        return ""


_ENTITY = re.compile("&(" + "|".join(GREEK) + ");")
_NEEDS_TREE = re.compile(r"<([iI]|sub|sup|ol|ul|font)\b")


def _formula_text(text: str) -> str:
    return _ENTITY.sub(r"\1", html.unescape(text))


def _inline(node) -> str:
    """Inline markup of a node as formula text, everything else serialised as it was."""
    if not isinstance(node, Element):
        return serialise(node)
    if node.name == "i":
        inner = _formula_text(node.text)
        return "" if not inner else f"stem:[{inner}]" if len(inner) <= 12 else f"_{inner}_"
    if node.name in ("sub", "sup"):
        mark = "~" if node.name == "sub" else "^"
        inner = "".join(_inline(c) for c in node.children)
        return f"{mark}{_formula_text(html.unescape(inner))}{mark}" if inner else ""
    if node.name in ("ol", "ul"):
        bullet = ". " if node.name == "ol" else "* "
        return "".join(f"{bullet}{html.escape(c.text, quote=False)}" if isinstance(c, Element) and c.name == "li" else _inline(c) for c in node.children)
    if node.name == "font" and "sans-serif" in node.attributes.get("style", ""):
        return f"`{html.escape(node.text, quote=False)}`"
    return serialise(Element(node.name, node.attributes, [])).removesuffix(f"</{node.name}>") + "".join(map(_inline, node.children)) + ("" if serialise(Element(node.name)) == f"<{node.name}>" else f"</{node.name}>")


def inline_formulas(text: str | None) -> str | None:
    """Inline markup of a text as formula text; texts without any only get Greek entities replaced."""
    if not text:
        return text
    if _NEEDS_TREE.search(text):
        text = "".join(map(_inline, parse(text).children)).replace("]stem:[", "")
    return _ENTITY.sub(r"stem:[\1]", text)


def formulas(text: str | None) -> str | None:
    """MathML and inline markup of a text as formula text; a formula that can't be read is dropped."""
    if text is None or not ("<" in text or "&" in text):
        return text
    if "<math>" in text:
        root = parse(text)

        def put(e: Element) -> None:
            kids = []
            for c in e.children:
                if isinstance(c, Element) and c.name == "math":
                    made = asciimath(serialise(c))
                    kids += [f"stem:[{made}]"] if made else []
                else:
                    if isinstance(c, Element):
                        put(c)
                    kids.append(c)
            e.children = kids

        put(root)
        text = root.inner()
    return inline_formulas(text)


__all__ = ["Comment", "asciimath", "formulas", "inline_formulas"]
