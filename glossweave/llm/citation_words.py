"""How citations of this project's tables are worded; handed to the operator that reads them."""

from __future__ import annotations

from glossweave.llm.canonical_list import Wording

#: Other names of bodies, of kinds of documents and of the vocabulary.
ALIASES = {
    "IEC": ["CEI", "ICE", "МЭК", "International Electrotechnical Commission", "Internat. Electrotechn. Comm.", "Commission électrotechnique internationale"],
    "ISO": [
        "IOS", "ИСО", "International Organization for Standardization", "International Organisation for Standardisation", "Intl. Org. for Standardization",
        "Intl. Org. for Standardisation", "Organisation internationale de normalisation",
    ],
    "ITU-T": ["UIT-T", "МСЭ-Т"],
    "CISPR": ["СИСПР", "IEC CISPR", "CEI CISPR"],
    "TR": ["Technical Report", "Rapport technique"],
    "TS": ["Technical Specification", "Spécification technique"],
    "IEV": ["VEI", "МЭВ"],
}

#: Words beside a publisher's name, before a citation and behind one, and codes that stand for the vocabulary.
WORDING = Wording(
    fillers=("Publ.", "Publication", "Standard", "Int. Standard", "Norme", "Rec.", "Recomm.", "Recommendation", "Recommandation"),
    lead=r"(?:see also|see|voir aussi|voir|from|d['’]apr[èe]s|cf\.?|siehe|[≈≠~])\s*",
    tail=r"\s*(?:[(\[;].*|,?\s+(?:mod|modif\w*|изм)\b.*|,\s*(?:as amended|note added).*|\s[–-]\s.*)$",
    codes=((r"(?<![\w-])\d{3}-\d{2}-\d{2,}(?!\d)", "IEV"),),
)


def aliases(spark):
    """``name, alias`` as a table."""
    return spark.createDataFrame([(n, a) for n, many in ALIASES.items() for a in many], "name string, alias string")
