"""Pages of stuffed keywords."""

import random
import textwrap

import pytest

from glossweave.llm import stuffing as S

NEWS = """NORTHERN LEDGER, 1889-08-19, p. 6
WOODEN MERCHANT PELVAN
At Wesridge the storm was closed by the local
hats at noon. Mr. Falfort of Marmond sold the jury
without delay, and the museum was annu-
al. About 467 persons saw the honest judge
when it examined the choir.
It is said that the tea repaired a careful constable."""
TOWNS = [a + b for a in ("Tol", "Yar", "Wes", "Ros", "Kel", "Ul", "Fen", "Dun", "Sel") for b in ("fort", "nell", "ley", "gate", "ham")]
SHIPS = "\n".join(f"Arr. {('ketch', 'barque', 'steamer')[i % 3]} {TOWNS[i]}, {TOWNS[i + 15]}, from\n{TOWNS[i + 30]}, {('coal', 'wheat', 'tea', 'price', 'hats')[i % 5]}." for i in range(15))
RESULTS = "\n".join(f"{a} {n}, {b} {n + 7}." for n, (a, b) in enumerate([("Velthorpe", "Margate"), ("Corham", "Roswick")] * 6, 100))
PRICES = "\n".join(f"{a}, wheat, {n}s. {n % 12}d. per cwt." for n, a in enumerate(["Norwick", "Keldale", "Normere"] * 5, 5))


def stuffed(kind, n=30, seed=1):
    r = random.Random(seed)
    goods, towns = ["tea", "lamps", "stoves", "boots"], ["Kelham", "Rosgate", "Ulmond"]
    line = {
        "words": lambda: " ".join(r.choice(goods) for _ in range(6)),
        "commas": lambda: ", ".join(r.choice(goods + towns) for _ in range(5)) + ",",
        "dashes": lambda: " - ".join(r.choice(goods) for _ in range(5)),
        "tags": lambda: " ".join(f"#{r.choice(goods)}" for _ in range(5)),
        "at": lambda: " ".join(f"@{r.choice(goods)}-{r.choice(goods)}" for _ in range(3)),
        "labels": lambda: " ".join(f"tag: {r.choice(goods)}" for _ in range(3)),
        "links": lambda: f"http://www.{r.choice(goods)}.example.org/{r.choice(goods)}/{r.randint(1, 999)}",
        "marked": lambda: f"[cheap {r.choice(goods)}](old.{r.choice(goods)}.invalid/x/1)",
        "goods": lambda: " / ".join(f"{r.choice(towns)} {r.choice(goods)} cheap" for _ in range(3)),
        "ends": lambda: f"cheap {goods[0]} Kelham {goods[0]} best {goods[0]}!",
    }[kind]
    return "\n".join(line() for _ in range(n))


def share(text):
    return S.page_score(text)[3]


def test_news_lists_and_prices_are_none():
    for text in (NEWS, SHIPS, RESULTS, PRICES, NEWS + "\nTry our pills, try our pills.\nhttp://a.example/x\nlamps lamps lamps"):
        assert share(text) < 0.35, text[:40]


def test_every_kind_is_flagged():
    for k in ("words", "commas", "dashes", "tags", "at", "labels", "links", "marked", "goods", "ends"):
        assert share(stuffed(k)) > 0.9, k
        assert share("HILL COUNTY TIMES, 1910-02-01, p. 11\n" + stuffed(k)) > 0.8, k


def test_half_is_the_boundary():
    news = NEWS * 3
    lines = stuffed("tags", 200).split("\n")
    little, much = [], []
    for x in lines:
        if sum(map(len, little)) + len(x) < len(news) * 0.7:
            little.append(x)
        if sum(map(len, much)) + len(x) < len(news) * 1.5:
            much.append(x)
    assert share(news + "\n" + "\n".join(little)) < 0.5 < share(news + "\n" + "\n".join(much))


def test_columns_read_across():
    a, b = NEWS.split("\n"), stuffed("goods", 40).split("\n")
    mixed = [x for i, y in enumerate(b) for x in ((a[i], y) if i < len(a) else (y,))]
    assert share("\n".join(mixed)) > 0.5


def of(line, repeated=()):
    return S.shape([S.TOKENS[t] for t in line.split()], frozenset(repeated))


def test_shape():
    assert of("At noon the tea was sold.").end and not S.no_sentence(of("At noon the tea was sold."), 1, 1.0)
    assert of("Norwick, wheat, 8s. 8d. per cwt.").figures == 2
    assert of("#tea #lamps").tag and of("see www.tea.example/x").link
    assert of("Cars for sale | Houses for rent").listed == S.HARD_LIST and of("lamps, boots, stoves,").listed == S.SOFT_LIST
    assert of("lamps and boots", {"lamps", "boots"}).repeated == 2 and of("lamps and boots", {"lamps"}).repeated == 1
    assert of("Northern carriage strike") == of("Western lantern warehouse")


PROSE = {
    "nl": "De burgemeester heeft gisteren in de vergadering van de gemeenteraad verklaard dat de nieuwe brug over de rivier niet voor het einde van het jaar klaar zal zijn. "
    "Volgens hem is de vertraging het gevolg van het slechte weer en van een tekort aan werklieden. De leden van de raad waren niet tevreden met dit antwoord.",
    "it": "Il sindaco ha dichiarato ieri davanti al consiglio comunale che il nuovo ponte sul fiume non sarà pronto prima della fine dell'anno. "
    "Secondo lui il ritardo è dovuto al cattivo tempo e alla mancanza di operai. I consiglieri non sono rimasti soddisfatti della risposta.",
    "fi": "Kaupunginjohtaja ilmoitti eilen valtuuston kokouksessa, että uusi silta joen yli ei valmistu ennen vuoden loppua. "
    "Hänen mukaansa viivästys johtuu huonosta säästä ja työvoiman puutteesta. Valtuutetut eivät olleet tyytyväisiä vastaukseen.",
    "pl": "Burmistrz oświadczył wczoraj na posiedzeniu rady miejskiej, że nowy most na rzece nie będzie gotowy przed końcem roku. "
    "Według niego opóźnienie jest skutkiem złej pogody i braku robotników. Członkowie rady nie byli zadowoleni z tej odpowiedzi.",
    "ru": "Городской голова вчера объявил на заседании думы, что новый мост через реку не будет готов до конца года. "
    "По его словам, задержка вызвана дурной погодой и недостатком рабочих. Члены думы остались недовольны этим ответом.",
}


@pytest.mark.parametrize("lang", PROSE)
@pytest.mark.parametrize("width", [30, 44, 70])
def test_prose_of_any_language_is_none(lang, width):
    assert share("\n".join(textwrap.wrap(PROSE[lang], width))) < 0.35


def test_stuffing_with_small_words_link_titles_and_bare_names():
    assert share("\n".join(["buy cheap shoes for the best price of shoes"] * 11)) == 1.0
    assert share("\n".join(["Cars for sale | Houses for rent", "Rooms to let | Jobs in town", "Loans by post | Tea by mail"] * 6)) == 1.0
    assert share("\n".join("Acora Belvane Cindrex Dolvino Eltrama Farnado Gelvita Hostrel Imbrado Jalvera Kestomir Lorvane Mestrion Noravel Ostrava Pelmira Quandor Restovan Silmara Tolvane".split())) == 1.0


def test_verse_is_none():
    verse = "The moon is on the water now,\nThe wind is in the tree,\nAnd far away across the hill\nMy love is gone from me."
    assert share(verse + "\nOh, come again, my own true love,\nOh, come again to me,\n" + verse) < 0.5


def test_rows(spark):
    rows = [(1, stuffed("words")), (2, NEWS), (3, None), (4, ""), (5, " \n "), (6, stuffed("links", 20_000)), (1, stuffed("words"))]
    df = spark.createDataFrame([(i, t, 0.1) for i, t in rows], "doc_id long, text string, share double")
    assert sorted(r.doc_id for r in S.found(df).collect()) == [1, 1, 6]
    scores = {r.doc_id: r for r in S.page_scores(df).collect()}
    assert scores[3][1:] == (0, 0, 0, 0.0) and scores[5].share == 0.0
    assert S.found(df.limit(0)).count() == 0
    assert "Exchange" not in S.found(df)._jdf.queryExecution().executedPlan().toString()
