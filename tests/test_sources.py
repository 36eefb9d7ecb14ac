import io
import json
import zipfile

from pyspark.sql import functions as F

from gleanery.sources import files
from gleanery.streaming import intake

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def packed(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/").replace("_DOT_", "."), text)
    return out.getvalue()


def docx():
    p = lambda t, s="": f"<w:p>{f'<w:pPr><w:pStyle w:val={chr(34)}{s}{chr(34)}/></w:pPr>' if s else ''}<w:r><w:t>{t}</w:t></w:r></w:p>"
    cell = lambda t: f"<w:tc>{p(t)}</w:tc>"
    body = p("Scope", "Heading1") + p("Some text") + f"<w:tbl><w:tr>{cell('Label')}{cell('Value')}</w:tr></w:tbl>"
    return packed(word__document_DOT_xml=f"<w:document {W}><w:body>{body}</w:body></w:document>")


def xlsx():
    cells = '<row r="1"><c r="A1" t="inlineStr"><is><t>Account</t></is></c><c r="B1" t="s"><v>0</v></c></row><row r="2"><c r="A2" t="inlineStr"><is><t>Cash</t></is></c><c r="B2"><v>12.0</v></c></row><row r="3"><c r="A3" t="inlineStr"><is><t>Total</t></is></c></row>'
    book = f'<workbook {S} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Trial Balance" r:id="r1"/><sheet name="Cover" r:id="r1"/></sheets></workbook>'
    return packed(
        xl__workbook_DOT_xml=book,
        xl___rels__workbook_DOT_xml_DOT_rels='<Relationships><Relationship Id="r1" Target="worksheets/s1.xml"/></Relationships>',
        xl__sharedStrings_DOT_xml=f"<sst {S}><si><t>Balance</t></si></sst>",
        xl__worksheets__s1_DOT_xml=f'<worksheet {S}><sheetData>{cells}</sheetData><mergeCells><mergeCell ref="A3:B3"/></mergeCells></worksheet>',
    )


def test_routing_and_office_files(spark, tmp_path):
    for name, data in {"a.docx": docx(), "b.bin": docx(), "c.xlsx": xlsx(), "d.pdf": b"%PDF-1.4 x", "e.csv": b"a,b\n1,\n", "f.doc": b"x", ".hidden": b"x", "g.odd": b"x", "h.docx": b"PK\x03\x04 word/ broken"}.items():
        (tmp_path / name).write_bytes(data)
    found = files.routed(files.binary(spark, str(tmp_path)))
    assert {r["name"]: r["kind"] for r in found.collect()} == {"a.docx": "docx", "b.bin": "docx", "c.xlsx": "xlsx", "d.pdf": "pdf", "e.csv": "csv", "f.doc": "skip", "g.odd": "unknown", "h.docx": "docx"}
    blocks = [(r["is_heading"], r["text"]) for r in files.documents(found).where("path LIKE '%a.docx'").orderBy("pos").collect()]
    assert blocks == [(True, "Scope"), (False, "Some text"), (False, "Label | Value")]
    assert files.document_tables(found).where("path LIKE '%a.docx'").first()["rows"] == [["Label", "Value"]]
    assert files.documents(found).where("path LIKE '%h.docx'").first()["error"].startswith("BadZipFile")
    sheet = files.workbooks(found).orderBy("row").collect()
    assert [(r["sheet"], r["cells"], r["is_header"], r["is_subtotal"]) for r in sheet] == [("Trial Balance", ["Account", "Balance"], True, False), ("Trial Balance", ["Cash", "12"], False, False), ("Trial Balance", ["Total", "Total"], False, True)]
    assert files.delimited(spark, str(tmp_path / "e.csv")).collect()[0].asDict() == {"a": "1", "b": ""}


def test_json(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert files.valid_lines(spark, str(tmp_path / "a.jsonl")).first()["n"] == 2
    (tmp_path / "b.json").write_text(json.dumps({"x": 1, "y": {"z": [1, 2]}, "w": "t", "v": None}))
    got = {r["key"]: r["value"] for r in files.json_sections(spark, str(tmp_path / "b.json")).collect()}
    assert got["x"] == "1" and got["y"] == '{"z":[1,2]}' and got["w"] == "t" and len(got) == 4


def test_append_new(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = lambda *ks: spark.createDataFrame([(k, "x") for k in ks], "pair_hash string, v string")
    assert files.append_new(rows("a", "b", "a"), path, "pair_hash") == 2
    assert files.append_new(rows("b", "c"), path, "pair_hash") == 1
    assert spark.read.json(path).count() == 3


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    day = lambda d, *ks: spark.createDataFrame([(k, d) for k in ks], "file_hash string, d string").withColumn("at", F.to_timestamp("d"))
    schema = day("2024-01-01", "a").schema
    day("2024-01-01", "a", "b", "a").write.parquet(src)
    run = lambda: intake.run_available(intake.once_each(intake.stream(spark, src, schema), "file_hash"), out, state).awaitTermination(60)
    assert run() and spark.read.parquet(out).count() == 2
    day("2024-01-02", "b", "c").write.mode("append").parquet(src)
    assert run() and sorted(r["file_hash"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_stream_windows(spark, tmp_path):
    src, state = str(tmp_path / "src"), str(tmp_path / "state")
    df = spark.createDataFrame([("2024-01-03 01:00:00", 2.0), ("2024-01-09 00:00:00", 4.0)], "t string, value double").withColumn("ts", F.to_timestamp("t"))
    df.write.parquet(src)
    q = intake.rolling(intake.stream(spark, src, df.schema), "ts", "value").writeStream.format("memory").queryName("rolled").outputMode("complete").option("checkpointLocation", state).trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    got = {str(r["start"])[:10]: (r["n"], r["mean"]) for r in spark.table("rolled").collect()}
    assert got["2024-01-03"] == (2, 3.0) and got["2024-01-09"] == (1, 4.0) and len(got) == 13


def test_last_entries_as_state(spark, tmp_path):
    src, state = str(tmp_path / "src"), str(tmp_path / "state")
    rows = lambda *xs: spark.createDataFrame(list(xs), "key string, at string, value string").withColumn("at", F.to_timestamp("at"))
    first = rows(("a", "2024-01-01", "1"), ("a", "2024-01-03", "3"), ("b", "2024-01-02", "2"), ("a", "2024-01-02", "2"))
    first.write.parquet(src)
    got = {}

    def keep(batch, _):
        for r in batch.collect():
            got.setdefault(r["key"], []).append(r["value"])

    run = lambda: intake.into_table(intake.last_entries(spark, intake.stream(spark, src, first.schema), "key", "at", 2), keep, state).awaitTermination(60)
    assert run() and sorted(got["a"]) == ["2", "3"] and got["b"] == ["2"]
    got.clear()
    rows(("a", "2024-01-09", "9")).write.mode("append").parquet(src)
    assert run() and sorted(got["a"]) == ["3", "9"] and "b" not in got
