"""Registered functions, configuration, fetching through a cache, observation."""

from pyspark.sql import functions as F

from glossweave.config import Config
from glossweave.functions.register import register
from glossweave.markup.adoc import see_relations
from glossweave.session import cut_lineage, observed, plan_text, shared_dir, small_rows
from glossweave.sources.remote import fetch_text


def test_sql_functions(spark):
    register(spark)
    assert spark.sql("SELECT gw_attributes('f pl').number, gw_markers('x, m').designation, gw_clause('IEC 1, 3.2'), gw_content('<b>a</b>', '1'), gw_nfc('é')").first()[:] == ("plural", "x", "3.2", "*a*", "é")
    page = "<table><tr><td><b>1-1-1</b></td></tr><tr><td><div align=''center''><font color=''#800080''>en</font></div></td><td></td><td><b>t</b></td></tr></table>"
    assert spark.sql(f"SELECT * FROM gw_page('{page}', '1-1-1')").first()[:] == ("eng", ["t"], None)
    assert spark.sql("SELECT * FROM gw_area_links('<a href=\"?part=103\">Functions</a>')").first()[:] == ("103", "Functions")
    assert spark.sql("SELECT * FROM gw_section_cells('<td>Section 103-01: General</td>')").first()[:] == ("103-01", "General")
    assert spark.sql("SELECT * FROM gw_page(NULL, 'x')").count() == 0


def test_config(spark, monkeypatch):
    monkeypatch.setenv("GLOSSWEAVE_DATA_PATH", "/from/env")
    assert Config.of().data_path == "/from/env"
    spark.conf.set("glossweave.data.path", "/from/session")
    assert Config.of(spark).data_path == "/from/session"
    spark.conf.unset("glossweave.data.path")


def test_fetch(tmp_path):
    calls = []

    def transport(code):
        calls.append(code)
        if code == "bad":
            raise OSError("down")
        return (200, "a: 1") if code == "1" else (404, "") if code == "2" else (500, "")

    assert fetch_text("1", transport, str(tmp_path)) == "a: 1" == fetch_text("1", transport, str(tmp_path)) and calls == ["1"]
    assert [fetch_text(c, transport, str(tmp_path)) for c in ("2", "3", "bad")] == [None] * 3


def test_relations(spark):
    text = "{{urn:iec:std:iec:60050-102-01-10, a}} {{urn:iec:std:iec:60050-102-01-10, b}}"
    assert spark.range(1).select(see_relations(F.lit(text))).first()[0] == [("see", "IEV", "102-01-10")]


def test_session_helpers(spark):
    df, seen = observed(spark.range(7), "n")
    assert df.count() == 7 and seen.get["rows"] == 7
    assert "Range" in plan_text(spark.range(3))
    assert small_rows(spark.range(5), 4) is None and len(small_rows(spark.range(5), 5)) == 5
    assert cut_lineage(spark.range(3)).count() == 3 and shared_dir(spark)
