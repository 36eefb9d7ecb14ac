"""Queries over files: what kind they are, what their readers find in them, and what sinks write. Files are written to the shared folder first and read back."""

from __future__ import annotations

import io
import struct
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import functions as F

from gleanery.operators import pairs, retrieval, review
from gleanery.plans.registry import query
from gleanery.shipping import ship
from gleanery.sources import files, scratch, xls

_SIGNS = ("504B0304", "25504446", "D0CF11E0", "", "89504E47")
_ENDS = ("docx", "xlsx", "xls", "csv", "tsv", "json", "jsonl", "pdf", "txt", "md", "doc", "dbf", "odd")
_INSIDE = ("word/", "xl/", "")


def _pick(i, xs):
    return F.element_at(F.array(*[F.lit(x) for x in xs]), (i % len(xs) + 1).cast("int"))


def _duck(i, xs):
    return "[" + ", ".join(f"'{x}'" for x in xs) + f"][({i}) % {len(xs)} + 1]"


@query(
    f"""
WITH f AS (SELECT doc_id, {_duck("length(text)", _SIGNS)} AS sign, {_duck("doc_id", _ENDS)} AS ext, {_duck("length(source)", _INSIDE)} AS inside, unhex({_duck("length(text)", _SIGNS)}) || encode({_duck("length(source)", _INSIDE)} || text) AS content FROM documents WHERE text IS NOT NULL AND source IS NOT NULL)
SELECT doc_id, upper(hex(content[:4])) AS magic, coalesce(content[:4] = unhex('25504446'), false) AS is_pdf, sha256(content) AS file_hash,
 CASE WHEN ext IN ('doc', 'dbf', 'db', 'ini', 'lnk', 'tmp') THEN 'skip' WHEN sign = '25504446' THEN 'pdf' WHEN sign = '504B0304' AND (inside = 'word/' OR contains(text, 'word/')) THEN 'docx' WHEN sign = '504B0304' AND (inside = 'xl/' OR contains(text, 'xl/')) THEN 'xlsx' WHEN sign = 'D0CF11E0' AND ext = 'xls' THEN 'xls'
 WHEN ext IN ('docx', 'xlsx', 'xls', 'json', 'jsonl', 'pdf') THEN ext WHEN ext IN ('csv', 'tsv') THEN 'csv' WHEN ext IN ('txt', 'md') THEN 'text' ELSE 'unknown' END AS kind
FROM f JOIN documents USING (doc_id)
"""
)
def file_kinds(t):
    """Files routed by their first bytes, by what an archive holds, and by their names."""
    n = F.length("text")
    content = F.concat(F.unhex(_pick(n, _SIGNS)), F.encode(F.concat(_pick(F.length("source"), _INSIDE), F.col("text")), "UTF-8"))
    found = t.documents.where("text IS NOT NULL AND source IS NOT NULL").select("doc_id", content.alias("content"), _pick(F.col("doc_id"), _ENDS).alias("extension"))
    return files.routed(found).select("doc_id", files.magic(F.col("content")).alias("magic"), files.magic_is(F.col("content"), F.lit(files.PDF.lower())).alias("is_pdf"), "file_hash", "kind")


@query("SELECT doc_id::VARCHAR AS doc_id, coalesce(source, '') AS source, sha256(text) AS text FROM documents WHERE text IS NOT NULL AND text NOT LIKE '%' || chr(13) || '%'")
def delimited_files(t):
    """Texts of many lines through delimited files: all columns text, nulls empty."""
    path = scratch.folder(t.spark, "delimited")
    rows = t.documents.where("text IS NOT NULL AND NOT contains(text, '\r')").select("doc_id", "source", "text")
    rows.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return files.delimited(t.spark, path).select("doc_id", "source", F.sha2("text", 256).alias("text"))


@query("WITH r AS (SELECT c_custkey, concat_ws(' | ', c_name, c_mktsegment, c_nationkey) AS line, row_number() OVER (ORDER BY c_custkey) AS n, count(*) OVER () AS total FROM customer) SELECT sha256(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE n <= 500) || CASE WHEN max(total) > 500 THEN chr(10) || '[... ' || (max(total) - 500) || ' more rows truncated]' ELSE '' END) AS text FROM r")
def table_text(t):
    """A table as one text of at most 500 rows."""
    return files.as_text(t.customer, "c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string")).select(F.sha2("text", 256).alias("text"))


@query("SELECT n_nationkey, k AS key, CASE k WHEN 'name' THEN n_name ELSE n_regionkey::VARCHAR END AS value FROM nation, (VALUES ('name'), ('region')) x(k)")
def json_files(t):
    """The entries of JSON files, one file a nation."""
    path = scratch.folder(t.spark, "json")
    text = F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")))
    t.nation.select("n_nationkey", text.alias("value")).write.partitionBy("n_nationkey").text(path)
    out = files.json_sections(t.spark, path)
    return out.select(F.regexp_extract("path", r"n_nationkey=(\d+)", 1).cast("int").alias("n_nationkey"), "key", "value")


@query("SELECT count(*) FILTER (WHERE json_valid(CASE WHEN event_id % 7 = 0 THEN left(props, length(props) - 1) ELSE props END)) AS n FROM events")
def json_line_files(t):
    """Lines of files that parse as JSON; broken and blank ones don't count."""
    path = scratch.folder(t.spark, "lines")
    line = F.when(F.col("event_id") % 7 == 0, F.left("props", F.length("props") - 1)).otherwise(F.col("props"))
    t.events.select(F.concat(line, F.when(F.col("event_id") % 5 == 0, "\n").otherwise("")).alias("value")).write.text(path)
    return files.valid_lines(t.spark, path)


def _archive(**parts: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/").replace("_DOT_", "."), text)
    return out.getvalue()


_SHEETS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_WORDS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def workbook(rows: list[list[str]], merged: str) -> bytes:
    """A workbook of one sheet of rows and a cover, with a merged rectangle."""
    cell = lambda r, c, x: f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{escape(x)}</t></is></c>' if x else ""
    body = "".join(f'<row r="{r}">{"".join(cell(r, c, x) for c, x in enumerate(row))}</row>' for r, row in enumerate(rows, 1))
    links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s1.xml"/>' for i in (1, 2))
    return _archive(
        xl__workbook_DOT_xml=f'<workbook {_SHEETS} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Cover" r:id="r1"/><sheet name="Customers" r:id="r2"/></sheets></workbook>',
        xl___rels__workbook_DOT_xml_DOT_rels=f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>',
        xl__worksheets__s1_DOT_xml=f'<worksheet {_SHEETS}><sheetData>{body}</sheetData><mergeCells><mergeCell ref="{merged}"/></mergeCells></worksheet>',
    )


def document(heading: str, text: str, table: list[list[str]]) -> bytes:
    """A word-processing file of a heading, a paragraph and a table."""
    p = lambda x, style="": f"<w:p>{f'<w:pPr><w:pStyle w:val={chr(34)}{style}{chr(34)}/></w:pPr>' if style else ''}<w:r><w:t>{escape(x)}</w:t></w:r></w:p>"
    rows = "".join(f"<w:tr>{''.join(f'<w:tc>{p(x)}</w:tc>' for x in r)}</w:tr>" for r in table)
    return _archive(word__document_DOT_xml=f"<w:document {_WORDS}><w:body>{p(heading, 'Heading1')}{p(text)}<w:tbl>{rows}</w:tbl></w:body></w:document>")


def binary_workbook(rows: list[list[str]], merged: str) -> bytes:
    """The same workbook in the binary format: texts shared, numbers as numbers."""
    record = lambda n, b: struct.pack("<HH", n, len(b)) + b
    opened = lambda kind: record(xls.BOF, struct.pack("<HHHHII", 0x0600, kind, 0, 0, 0, 0))
    shared = sorted({x for r in rows for x in r if x and not x.isdigit()})
    parts = [struct.pack("<II", len(shared), len(shared))]
    for x in shared:
        body = x.encode("utf-16-le")
        if len(parts[-1]) + 5 > _PART:
            parts.append(b"")
        parts[-1] += struct.pack("<HB", len(body) // 2, 1)
        while body:
            room = (_PART - len(parts[-1])) // 2 * 2
            parts[-1], body = parts[-1] + body[:room], body[room:]
            if body:
                parts.append(b"\x01")
    texts = record(xls.SST, parts[0]) + b"".join(record(xls.CONTINUE, p) for p in parts[1:])

    def cell(r: int, c: int, x: str) -> bytes:
        if not x.isdigit():
            return record(xls.LABELSST, struct.pack("<HHHI", r, c, 0, shared.index(x)))
        if int(x) % 2:
            return record(xls.NUMBER, struct.pack("<HHHd", r, c, 0, int(x)))
        return record(xls.RK, struct.pack("<HHHI", r, c, 0, int(x) << 2 | 2))

    (left, top), (right, bottom) = ((ord(x[0]) - 65, int(x[1:]) - 1) for x in merged.split(":"))
    sheet = opened(0x10) + b"".join(cell(r, c, x) for r, row in enumerate(rows) for c, x in enumerate(row) if x) + record(xls.MERGED, struct.pack("<5H", 1, top, bottom, left, right)) + record(xls.EOF, b"")
    head = lambda *at: opened(5) + b"".join(record(xls.BOUNDSHEET, struct.pack("<IBBBB", place, 0, 0, len(name), 0) + name.encode()) for name, place in zip(("Cover", "Customers"), at)) + texts + record(xls.EOF, b"")
    size = len(head(0, 0))
    return _compound(head(size, size) + sheet)


_PART = 8224  # bytes of a record at most


def _compound(book: bytes) -> bytes:
    """A compound file with one stream, which lies in the small sectors if it is short."""
    small = len(book) < 4096
    blocks = lambda b, n=512: [b[i : i + n].ljust(n, b"\0") for i in range(0, len(b), n)]
    end, table, unused = 0xFFFFFFFE, 0xFFFFFFFD, 0xFFFFFFFF
    chain = lambda first, n: [*range(first + 1, first + n), end] if n else []
    body, minis = blocks(book), len(book) // 64 + 1
    count = next(k for k in range(1, 110) if k * 128 >= k + 2 + len(body))  # sectors of the table, the folder, small sectors' table, the stream
    start = count + 2
    places = [table] * count + [end, end] + chain(start, len(body))
    entry = lambda name, kind, child, first, n: (name.encode("utf-16-le").ljust(64, b"\0") + struct.pack("<HBB3I", 2 * len(name) + 2, kind, 1, unused, unused, child)).ljust(116, b"\0") + struct.pack("<3I", first, n, 0)
    root = entry("Root Entry", 5, 1, start if small else end, 512 * len(body) if small else 0)
    folder = root + entry("Workbook", 2, unused, 0 if small else start, len(book))
    numbers = lambda xs, n: struct.pack(f"<{n}I", *xs, *[unused] * (n - len(xs)))
    head = xls.SIGN + bytes(16) + struct.pack("<5H", 0x3E, 3, 0xFFFE, 9, 6) + bytes(10) + struct.pack("<8I", count, count, 0, 4096, count + 1 if small else end, int(small), end, 0) + numbers(range(count), 109)
    return head + numbers(places, 128 * count) + folder.ljust(512, b"\0") + numbers(chain(0, minis) if small else [], 128) + b"".join(body)


_BOOK = 50

_BOOK_ROWS = f"""
WITH c AS (SELECT c_custkey // {_BOOK} AS book, row_number() OVER (PARTITION BY c_custkey // {_BOOK} ORDER BY c_custkey) + 1 AS row, c_name AS a, CASE WHEN c_acctbal < 0 THEN 'Total' ELSE c_mktsegment END AS b, c_custkey::VARCHAR AS k FROM customer),
m AS (SELECT *, CASE WHEN row = 3 THEN lag(a) OVER (PARTITION BY book ORDER BY row) ELSE a END AS shown FROM c)
SELECT book, row::INTEGER AS row, shown || '/' || b || '/' || k AS cells, false AS is_header, b = 'Total' AS is_subtotal FROM m UNION ALL SELECT DISTINCT book, 1, 'Name/Kind/Key', true, false FROM c
"""


def _book_rows(t, make, extension: str):
    """The rows that are read from workbooks which `make` writes."""
    ship(t.spark)

    def build(pdf):
        import pandas as pd

        rows = [["Name", "Kind", "Key"], *([n, k, str(i)] for n, k, i in zip(pdf["name"], pdf["kind"], pdf["c_custkey"]))]
        return pd.DataFrame({"path": [str(pdf["book"].iloc[0])], "content": [make(rows, "A2:A3")]})

    kind = F.when(F.col("c_acctbal") < 0, "Total").otherwise(F.col("c_mktsegment"))
    named = t.customer.select(F.floor(F.col("c_custkey") / _BOOK).alias("book"), "c_custkey", F.col("c_name").alias("name"), kind.alias("kind"))
    books = named.groupBy("book").applyInPandas(lambda pdf: build(pdf.sort_values("c_custkey")), "path string, content binary")
    out = files.workbooks(files.routed(books.withColumn("extension", F.lit(extension))))
    return out.where("error IS NULL").select(F.col("path").cast("long").alias("book"), "row", F.array_join("cells", "/").alias("cells"), "is_header", "is_subtotal")


@query(_BOOK_ROWS)
def workbook_cells(t):
    """Rows of workbooks of some dozen customers each: covers left out, merged cells filled, headers and subtotals told apart."""
    return _book_rows(t, workbook, "xlsx")


@query(_BOOK_ROWS)
def binary_workbook_cells(t):
    """The same of workbooks in the binary format."""
    return _book_rows(t, binary_workbook, "xls")


@query("SELECT p_partkey, x.pos::INTEGER AS pos, x.pos = 0 AS is_heading, x.text FROM part, LATERAL (VALUES (0, p_name), (1, p_type), (2, 'Brand | Size' || chr(10) || p_brand || ' | ' || p_size)) x(pos, text)")
def document_blocks(t):
    """Headings, paragraphs and tables of word-processing files, one a part."""
    ship(t.spark)

    def build(frames):
        import pandas as pd

        for pdf in frames:
            content = [document(n, k, [["Brand", "Size"], [b, str(s)]]) for n, k, b, s in zip(pdf["p_name"], pdf["p_type"], pdf["p_brand"], pdf["p_size"])]
            yield pd.DataFrame({"path": pdf["p_partkey"].astype(str), "content": content})

    made = t.part.select("p_partkey", "p_name", "p_type", "p_brand", "p_size").mapInPandas(build, "path string, content binary")
    out = files.documents(files.routed(made.withColumn("extension", F.lit("bin"))))
    return out.where("error IS NULL").select(F.col("path").cast("long").alias("p_partkey"), "pos", "is_heading", "text")


@query("SELECT CASE WHEN lang = 'en' THEN 'stage2_domain' ELSE 'stage3_firm' END AS stage, count(*) AS n, count(DISTINCT sha256(text)) AS pairs FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY 1")
def stage_files(t):
    """Pairs written as JSON lines by stage, and read back."""
    path = scratch.folder(t.spark, "stages")
    rows = t.documents.where("lang IS NOT NULL AND text IS NOT NULL").select(F.when(F.col("lang") == "en", "stage2_domain").otherwise("stage3_firm").alias("stage"), F.sha2("text", 256).alias("pair_hash"))
    files.write_lines(rows, path, "stage")
    return t.spark.read.json(path).groupBy("stage").agg(F.count("*").alias("n"), F.countDistinct("pair_hash").alias("pairs"))


@query("WITH h AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE text IS NOT NULL) SELECT count(DISTINCT h) FILTER (WHERE doc_id % 2 = 0) AS first, count(DISTINCT h) - count(DISTINCT h) FILTER (WHERE doc_id % 2 = 0) AS second, count(DISTINCT h) AS written FROM h")
def append_files(t):
    """Two appends of pairs to one file: keys that it has aren't written again."""
    path = scratch.folder(t.spark, "pairs")
    h = t.documents.where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("pair_hash"))
    first = files.append_new(h.where("doc_id % 2 = 0"), path, "pair_hash")
    second = files.append_new(h, path, "pair_hash")
    return t.spark.read.json(path).agg(F.lit(first).cast("long").alias("first"), F.lit(second).cast("long").alias("second"), F.count("*").alias("written"))


@query("SELECT doc_id, n_chars >= 50 AND quality = 1 AND c >= 0.7 AND length(trim(text)) > 0 AND lang <> 'de' AS training, n_chars >= 50 AND c >= 0.5 AND lang <> 'de' AS drafting FROM (SELECT *, length(text) % 10 / 10 AS c FROM documents JOIN labels USING (doc_id)) WHERE text IS NOT NULL AND lang IS NOT NULL")
def readiness(t):
    """Which records may teach, and which may be drafted from."""
    d = t.documents.join(t.labels, "doc_id").where("text IS NOT NULL AND lang IS NOT NULL")
    c = {"status": F.when(F.col("n_chars") >= 50, "success").otherwise("failed"), "scrubbed": F.col("lang") != "de", "approved": F.col("quality") == 1, "confidence": F.length("text") % 10 / 10, "text": F.col("text"), "incomplete": F.lit(False)}
    return d.select("doc_id", pairs.training_ready(c).alias("training"), pairs.drafting_ready(c).alias("drafting"))


@query("SELECT doc_id, coalesce(len(string_split(text, chr(10))) > 1 AND regexp_replace(text, '[ \\n\\t\\r\\f\\x0b]', '', 'g') <> '' AND source <> 'src0', false) AS healthy FROM documents WHERE source IS NOT NULL")
def retrieval_health(t):
    """Whether a search gives enough to build on."""
    chunks = F.size(F.split("text", "\n", -1)) - 1
    return t.documents.where("source IS NOT NULL").select("doc_id", retrieval.healthy(chunks, F.col("text"), F.when(F.col("source") == "src0", "fallback_empty").otherwise("filtered")).alias("healthy"))


@query("SELECT p_partkey, p_brand, p_type FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21')")
def chosen_fields(t):
    """Rows by the values that a reader picks; a picker left empty lets all through."""
    return review.chosen(t.part.select("p_partkey", "p_brand", "p_type"), p_brand=["Brand#11", "Brand#12", "Brand#13", "Brand#21"], p_type=[])


@query("SELECT source AS engagement_id, count(*) FILTER (WHERE quality IS NULL) AS missing, count(*) FILTER (WHERE quality IS NULL) = 0 AS complete FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source")
def label_completeness(t):
    """Engagements whose papers all have a label."""
    papers = t.documents.join(t.labels, "doc_id", "left").select(F.col("source").alias("engagement_id"), F.col("quality").alias("workpaper_type"))
    return pairs.unlabelled(papers)


@query("WITH g AS (SELECT user_id, event_id FROM events WHERE event_type IN ('click', 'purchase') AND value <= 95), p AS (SELECT user_id, min(event_id) AS event_id FROM g GROUP BY 1) SELECT count(*) AS n, count(*) >= 300 AS enough, sum(event_id)::BIGINT AS ids FROM p")
def preference_rules(t):
    """Preference pairs by reviewer, rating and likeness, one a feedback, and whether they are enough."""
    tier = F.when(F.col("event_type") == "click", "partner").when(F.col("event_type") == "purchase", "senior").otherwise("staff")
    good = pairs.preference_pairs(t.events.select(F.col("user_id").alias("feedback_id"), tier.alias("reviewer_tier"), F.lit("corrected").alias("rating"), (F.col("value") / 100).alias("similarity"), F.col("event_id").alias("pos")))
    return pairs.enough_pairs(good).crossJoin(good.agg(F.coalesce(F.sum("pos"), F.lit(0)).cast("long").alias("ids")))  # one row each
