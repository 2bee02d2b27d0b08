"""The transducer against the public tokenizer, and the way back."""

import random
from array import array

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

P = pytest.importorskip("public_tokenizers")

from glossweave.llm import tokens as K  # noqa: E402
from glossweave.llm import transducer as X  # noqa: E402
from glossweave.session import table  # noqa: E402


@pytest.fixture(scope="module")
def ours():
    return X.encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def public():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def ids(enc, s):
    out = array("i")
    enc.into(s, out)
    return list(out)


TEXTS = ["", " ", "  a", "it's 12 don't  \n\n x", "日本語 テキスト", "a\x1cb \x1d c", "²³ ½ x² Ⅳ", "😀😃 👩‍👩‍👧", "​﻿\xa0　x", "a" * 3000, "ab" * 2000, "-" * 777 + "!?" * 300, "é" * 500, "<|endoftext|>", "\x85\x85  x", "0123456789" * 50]


@pytest.mark.parametrize("text", TEXTS)
def test_texts(ours, public, text):
    want = public.encode(text, add_special_tokens=False).ids
    assert ids(ours, text) == want and ours.count(text) == len(want)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    from tokenizers import Tokenizer

    enc = X.encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    global _PUBLIC
    if "_PUBLIC" not in globals():
        _PUBLIC = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
        _PUBLIC.encode_special_tokens = True
    got = ids(enc, text)
    assert got == _PUBLIC.encode(text, add_special_tokens=False).ids
    d = X.StreamDecoder(enc.machine.token)
    assert "".join(d.feed([i]) for i in got) + d.close() == text


def test_pieces_against_the_definition(ours):
    r = random.Random(5)
    m = ours.machine
    for _ in range(300):
        piece = bytes(r.choice(b"abcdefgh th\xc3\xa9\xad-") for _ in range(r.randint(1, 24)))
        assert m.encode(piece) == m.merged(piece)


def test_machine_may_be_emptied(ours, monkeypatch):
    want = [ids(ours, t) for t in TEXTS]
    monkeypatch.setattr(X, "MAX_STATES", 50)
    monkeypatch.setattr(X, "MAX_PIECES", 3)
    monkeypatch.setattr(X, "MAX_PAIRS", 20)
    ours.clear()
    assert [ids(ours, t) for t in TEXTS] == want
    # one piece alone may overrun the machine: it is emptied on the way
    r = random.Random(9)
    long = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5000))
    got, most = ids(ours, long), len(ours.machine.states)
    assert most < 200 and len(ours.machine._pair) <= 21 and len(ours.machine._whole) <= 21
    assert list(ours.machine.merged(long.encode())) == got


def test_utf8_machine():
    import codecs

    r = random.Random(2)
    for _ in range(500):
        data = bytes(r.choice([0x41, 0x80, 0xBF, 0xC2, 0xC3, 0xE0, 0xA0, 0xED, 0x9F, 0xEF, 0xF0, 0x90, 0xF4, 0x8F, 0xFF]) for _ in range(r.randint(1, 9)))
        m = X.Utf8Machine()
        got = "".join(map(m.feed, data)) + m.close()
        assert got == data.decode("utf-8", "replace"), data
    assert codecs.getincrementaldecoder("utf-8")


def test_other_vocabulary():
    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = X.encoder(path, P.PATTERN)
    import tiktoken

    public = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=X.read_ranks(path), special_tokens={})
    for t in TEXTS:
        assert ids(enc, t) == public.encode_ordinary(t)


def test_rows(spark):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, None, "y"), (3, "", "z"), (4, " ", "w"), (1, "hello world", "x"), (5, "word " * 200_000, "v")], "doc_id long, text string, ids string")
    got = {r.doc_id: list(r.ids) for r in K.encode_texts(df, "doc_id", "text").collect()}
    assert got[1] == [31373, 995] and got[2] == [] and got[3] == [] and got[4] == [220] and len(got[5]) == 200_001
    assert K.encode_texts(df, "doc_id", "text").count() == 6
    assert K.encode_texts(df.limit(0), "doc_id", "text").count() == 0
    assert K.encode_texts(df, "doc_id", "text").schema["ids"].nullable is False
    assert {r.doc_id: r.n_tokens for r in K.count_tokens(df, "text").collect()} == {1: 2, 2: 0, 3: 0, 4: 1, 5: 200_001}


def test_round_trip(spark, data):
    docs = table(spark, data, "documents")
    got = K.round_trip(docs, "doc_id", "text")
    assert got.count() == docs.count() and got.where("not same").count() == 0
    twice = spark.createDataFrame([(1, "é a"), (1, "é a"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_ids > 0, r.same) for r in K.round_trip(twice, "doc_id", "text").collect()) == [(1, True, True)] * 2 + [(2, False, True)]
    assert "Exchange" not in K.round_trip(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()


def test_plan_is_one_pass(spark, data):
    p = K.encode_texts(table(spark, data, "documents"), "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p and "line_boxes" not in p
