"""Sources and sinks, there and back."""

import csv
import json
import sqlite3
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from glossweave import cli
from glossweave.operators.sheet import COLUMNS, as_sheet, first_wins
from glossweave.session import table
from glossweave.sinks import files
from glossweave.sources import dimensions, dispatch, snapshots
from glossweave.sources.sqlite import read_sqlite
from glossweave.sources.xlsx import column_number, read_xlsx

yaml = pytest.importorskip("yaml")


def make_xlsx(path, rows):
    def cell(r, c, v):
        name = chr(65 + c) + str(r)
        return "" if v is None else f'<c r="{name}" t="inlineStr"><is><t>{v}</t></is></c>' if c % 2 else f'<c r="{name}" t="s"><v>{shared.index(v)}</v></c>'

    shared = sorted({v for row in rows for v in row if v is not None})
    body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate(rows, 1))
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="a" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId7" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/s.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")


ROWS = [["IEVREF", "LANGUAGE", "TERM", "EXTRA"], ["103-01-01", "en", "function", "x"], [None] * 4, ["103-01-01", "ko", "함수", None], ["103-01-01", "en", "again", None]]


def test_xlsx(spark, tmp_path):
    make_xlsx(tmp_path / "a.xlsx", ROWS)
    got = read_xlsx(spark, str(tmp_path / "a.xlsx"))
    assert got.columns == ["_ord", *COLUMNS]
    assert [(r.IEVREF, r.LANGUAGE, r.TERM, r.STATUS) for r in got.orderBy("_ord").collect()] == [("103-01-01", "en", "function", None), ("103-01-01", "ko", "함수", None), ("103-01-01", "en", "again", None)]
    assert column_number("AB7") == 27
    make_xlsx(tmp_path / "b.xlsx", ROWS[:2])
    assert read_xlsx(spark, str(tmp_path)).count() == 4
    make_xlsx(tmp_path / "c.xlsx", [])
    assert read_xlsx(spark, str(tmp_path / "c.xlsx")).count() == 0


def test_sqlite_there_and_back(spark, data, tmp_path):
    sheet = as_sheet(table(spark, data, "iev_export").withColumnRenamed("language_code", "LANGUAGE"), "export_id")
    path = str(tmp_path / "c.sqlite3")
    n = files.write_sqlite(sheet, path)
    assert n == first_wins(sheet, ["IEVREF", "LANGUAGE"]).count()
    back = read_sqlite(spark, path)
    assert back.drop("_ord").exceptAll(first_wins(sheet, ["IEVREF", "LANGUAGE"]).drop("_ord")).count() == 0 and back.count() == n
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    some = read_sqlite(spark, path).where("LANGUAGE in ('eng', 'fr') and TERM is not null")
    assert some.count() == back.where("LANGUAGE in ('eng', 'fr') and TERM is not null").count() > 0
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    with sqlite3.connect(path) as db:
        db.execute("DELETE FROM concepts")
    assert read_sqlite(spark, path).count() == 0


def test_dispatch(spark, tmp_path):
    for bad in ("none.xlsx", "x.txt"):
        with pytest.raises(ValueError):
            (tmp_path / "x.txt").write_text("x")
            dispatch.load_sheet(spark, str(tmp_path / bad))


TERMBASE = {
    "102-01-01": {"termid": "1", "term": "equality", "eng": {"terms": [{"type": "expression", "designation": "equality, noun", "normative_status": "preferred"}], "definition": "d\nNote", "notes": ["n"], "entry_status": "Standard", "date_accepted": "2007-08-01", "date_amended": "2007-08-01"}, "deu": {"terms": [{"designation": "Gleichheit, f", "gender": "f"}], "entry_status": "Draft", "review_decision_event": "published"}},
    "103-01-02": {"term": "functional", "eng": {"terms": [{"designation": "functional"}], "definition": None, "date_accepted": "2009-12-01", "date_amended": "2017-07-01"}, "xx": {"no": "terms"}},
}


def test_termbase(spark, tmp_path, monkeypatch):
    path = tmp_path / "termbase.yaml"
    path.write_text("---\n" + yaml.safe_dump(TERMBASE, allow_unicode=True, sort_keys=False), encoding="utf-8")
    for size in (32 << 20, 40):
        monkeypatch.setattr(snapshots, "RANGE", size)
        got = {(r.code, r.language): r for r in snapshots.read_termbase(spark, str(path)).collect()}
        assert set(got) == {("102-01-01", "eng"), ("102-01-01", "deu"), ("103-01-02", "eng")}
        assert got["102-01-01", "eng"].notes == ["n"] and got["102-01-01", "eng"].date_accepted == "2007-08-01"
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    assert snapshots.read_termbase(spark, str(path)).where("code = '103-01-02'").count() == 1
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    rows = snapshots.read_termbase(spark, str(path))
    dates = {r.code: (r.status, [(d.type, d.date) for d in r.dates]) for r in snapshots.concept_dates(rows).collect()}
    assert dates == {"102-01-01": ("valid", [("accepted", "2007-08-01")]), "103-01-02": ("valid", [("accepted", "2009-12-01"), ("amended", "2017-07-01")])}
    merged = {(r.code, r.language): r for r in snapshots.merged_terms(rows).collect()}
    assert merged["102-01-01", "deu"].gender == ["f", "feminine"] and merged["102-01-01", "eng"].part_of_speech == "noun"


def test_concept_files_and_pages(spark, tmp_path):
    for code, entry in TERMBASE.items():
        (tmp_path / f"concept-{code}.yaml").write_text(yaml.safe_dump(entry), encoding="utf-8")
    assert snapshots.read_concepts(spark, str(tmp_path)).count() == 3
    (tmp_path / "1-1-1.html").write_text("<table><tr><td></td><td></td><td><b>1-1-1</b></td></tr></table>", encoding="utf-8")
    (tmp_path / "2-2-2.html").write_text("nothing", encoding="utf-8")
    got = {r.code: r.parsed for r in snapshots.parsed_pages(snapshots.read_pages(spark, str(tmp_path))).collect()}
    assert got == {"1-1-1": True, "2-2-2": False}


AREAS = {"areas": [{"code": "103", "title": "Functions", "sections": [{"code": "103-01", "title": "General"}]}, {"code": 736, "title": "Empty"}]}


def test_dimensions(spark, tmp_path):
    (tmp_path / "a.yaml").write_text(yaml.safe_dump(AREAS))
    (tmp_path / "l.yaml").write_text(yaml.safe_dump({"deu": {"iso_639_1": "de", "terminology": True, "eng": ["German"]}, "ger": {"iso_639_1": "de", "bibliography": True}, "grc": {"eng": ["x"]}}))
    (tmp_path / "e.yaml").write_text(yaml.safe_dump({"eng": {"gender": {"m": "masculine"}}}))
    assert {r[:] for r in dimensions.subject_areas(spark, str(tmp_path / "a.yaml")).collect()} == {("103", "Functions", "103-01", "General"), ("736", "Empty", None, None)}
    assert [r[:3] for r in dimensions.languages(spark, str(tmp_path / "l.yaml")).collect()] == [("de", "deu", "German")]
    assert dimensions.enum_labels(spark, str(tmp_path / "e.yaml")).first()[:] == ("eng", "gender", "m", "masculine")


def test_documents(spark, tmp_path):
    rows = spark.createDataFrame([("a.yaml", {"x": "1"}), ("b.yaml", {"y": "é"})], "name string, v map<string,string>").select("name", F.struct("v").alias("v"))
    files.write_documents(rows, "name", "v", str(tmp_path / "d"))
    assert yaml.safe_load((tmp_path / "d/b.yaml").read_text()) == {"v": {"y": "é"}}
    assert files.write_list(rows.limit(0), str(tmp_path / "l.yaml")) == 0 and not (tmp_path / "l.yaml").exists()
    bad = spark.createDataFrame([("../x", "b")], "name string, v string")
    with pytest.raises(Exception):
        files.write_documents(bad, "name", "v", str(tmp_path / "d"))


def test_command_line(spark, tmp_path, capsys):
    header = list(COLUMNS)
    row = {"IEVREF": "103-01-01", "LANGUAGE": "en", "TERM": "function", "DEFINITION": "a &amp; b", "SOURCE": "IEC 62302:2007", "STATUS": "Standard"}
    make_xlsx(tmp_path / "s.xlsx", [header, [row.get(c) for c in header]])
    (tmp_path / "areas.yaml").write_text(yaml.safe_dump(AREAS))
    assert cli.main(["export", str(tmp_path / "s.xlsx"), "-o", str(tmp_path / "out"), "--areas", str(tmp_path / "areas.yaml")]) == 0
    documents = list(yaml.safe_load_all((tmp_path / "out/concepts/concept-103-01-01.yaml").read_text()))
    assert documents[0]["id"] == "103-01-01" and documents[1]["data"]["terms"][0]["designation"] == "function"
    assert {p.name for p in (tmp_path / "out/concepts").iterdir()} == {"concept-103-01-01.yaml", "concept-area-103.yaml", "concept-area-736.yaml", "concept-section-103-01.yaml"}
    assert yaml.safe_load((tmp_path / "out/register.yaml").read_text())["sections"][0]["code"] == "103"
    assert cli.main(["xlsx2db", str(tmp_path / "s.xlsx"), "-o", str(tmp_path / "s.db")]) == 0
    assert cli.main(["export", str(tmp_path / "none.xlsx"), "--areas", "x"]) == 1
    (tmp_path / "tb.yaml").write_text(yaml.safe_dump(TERMBASE, sort_keys=False))
    page = "<table><tr><td></td><td></td><td><b>102-01-01</b></td></tr><tr><td><div align='center'><font color='#800080'>en</font></div></td><td></td><td><b>equality</b></td></tr><tr><td></td><td></td><td>new words<br>Note 1 to entry: n</td></tr></table>"
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/102-01-01.html").write_text(page)
    assert cli.main(["reconcile", str(tmp_path / "tb.yaml"), str(tmp_path / "pages"), "-o", str(tmp_path / "rec"), "--detected-at", "2026-07-10"]) == 0
    summary = yaml.safe_load((tmp_path / "rec/summary.yaml").read_text())
    assert summary["total_concepts"] == 2 and summary["sources"] == {"in_both": 1, "termbase_only": 1}
    with open(tmp_path / "rec/changes.csv", newline="") as f:
        assert next(csv.reader(f)) == files.CHANGE_COLUMNS
    assert yaml.safe_load((tmp_path / "rec/retired.yaml").read_text()) == ["103-01-02"]
    assert cli.elapsed(12.34) == "12.3s" and cli.elapsed(125) == "2m 5s"
    json.dumps(summary)


def test_stream_of_deliveries(spark, data, tmp_path):
    from glossweave.streaming.deliveries import changes_per_window, follow, latest_records

    rows = table(spark, data, "termbase")
    folder = str(tmp_path / "in")
    rows.where("snapshot_no = 1").coalesce(1).write.mode("append").parquet(folder)
    rows.where("snapshot_no = 2").coalesce(1).write.mode("append").parquet(folder)
    seen = []
    q = follow(spark, folder, rows.schema, lambda df, n: seen.append(df.count()), "deliveries", once=True, progress=str(tmp_path / "progress"))
    q.awaitTermination(120)
    assert len(seen) == 2 and sum(seen) == rows.where("snapshot_no in (1, 2)").count()
    stream = spark.readStream.schema(rows.schema).parquet(folder)
    assert latest_records(stream, ["code", "language_code"], "loaded_at", "1 day").isStreaming
    q = changes_per_window(stream, "loaded_at", ["language_code"], "7 days", "1 day").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("w").agg(F.sum("n_changes")).first()[0] == sum(seen)
    Path(folder).exists()
