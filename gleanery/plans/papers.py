"""Queries over printed pages, cells, facts, versions and pairs for every client type."""

from __future__ import annotations

import zlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.functions import keys
from gleanery.operators import authority, facts, forms, mining, pairs, retrieval, review
from gleanery.plans import pairs as pair_plans
from gleanery.plans.intake import document
from gleanery.plans.registry import query
from gleanery.plans.review_pairs import Dimensions, review_pairs
from gleanery.shipping import ship
from gleanery.sources import files, scratch

LINES = 40

_UNITS = b"/CIDInit begincmap 1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfrange <0000> <FFFF> <0000> endbfrange endcmap"


def printed(pages: list[list[str]]) -> bytes:
    """A PDF file with a page for each list of lines, in a font whose codes are UTF-16."""
    out = bytearray(b"%PDF-1.5\n")

    def put(n: int, head: str, body: bytes | None = None) -> None:
        nonlocal out
        out += f"{n} 0 obj\n".encode()
        if body is None:
            out += head.encode()
        else:
            packed = zlib.compress(body)
            out += f"<< {head} /Filter /FlateDecode /Length {len(packed)} >>\nstream\n".encode() + packed + b"\nendstream"
        out += b"\nendobj\n"

    put(1, "<< /Type /Catalog /Pages 2 0 R >>")
    put(2, f"<< /Type /Pages /Count {len(pages)} /Resources << /Font << /F1 3 0 R >> >> /Kids [{' '.join(f'{5 + 2 * i} 0 R' for i in range(len(pages)))}] >>")
    put(3, "<< /Type /Font /Subtype /Type0 /BaseFont /Any /Encoding /Identity-H /ToUnicode 4 0 R >>")
    put(4, "", _UNITS)
    for i, lines in enumerate(pages):
        put(5 + 2 * i, f"<< /Type /Page /Parent 2 0 R /Contents {6 + 2 * i} 0 R >>")
        put(6 + 2 * i, "", b"BT /F1 10 Tf 12 TL 72 720 Td " + b" T* ".join(b"<%s> Tj" % x.encode("utf-16-be", "surrogatepass").hex().encode() for x in lines) + b" ET")
    return bytes(out) + b"trailer << /Root 1 0 R >>\n%%EOF\n"


def _papers(t):
    """The pages of a PDF file for each document."""
    ship(t.spark)

    def build(frames):
        import pandas as pd

        for pdf in frames:
            lines = [x.split("\n") for x in pdf["text"]]
            yield pd.DataFrame({"path": pdf["doc_id"].astype(str), "content": [printed([x[i : i + LINES] for i in range(0, len(x), LINES)]) for x in lines]})

    made = t.documents.where("text IS NOT NULL").select("doc_id", "text").mapInPandas(build, "path string, content binary")
    return files.pages(files.routed(made.withColumn("extension", F.lit("bin"))))


_PAGES = f"p AS (SELECT doc_id, i // {LINES} + 1 AS page, array_to_string(list_filter(lines[i + 1:i + {LINES}], lambda x: x <> ''), chr(10)) AS text FROM (SELECT doc_id, lines, unnest(range(0, len(lines), {LINES})) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL)))"


@query(f"WITH {_PAGES} SELECT doc_id, page::INTEGER AS page, length(text)::INTEGER AS chars, sha256(text) AS text FROM p")
def pdf_pages(t):
    """Texts of the pages of PDF files, one file a document."""
    return _papers(t).where("error IS NULL").select(F.col("path").cast("long").alias("doc_id"), "page", F.length("text").alias("chars"), F.sha2("text", 256).alias("text"))


@query(f"WITH {_PAGES} SELECT doc_id, avg(length(text)) >= 100 AS text_native FROM p WHERE page <= 5 GROUP BY 1")
def text_native(t):
    """PDF files whose first pages have enough text to be no scans."""
    return files.is_text_native(_papers(t)).select(F.col("path").cast("long").alias("doc_id"), "text_native")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CASE WHEN regexp_full_match(p_type, '[A-Z][A-Z\\s,.&''()-]{3,79}') THEN p_type END END AS heading, coalesce(p_size % 5 <> 0 AND p_size % 3 <> 0 AND p_brand <> 'Brand#2', false) AS is_value FROM part")
def cell_values(t):
    """Which cells may be values, and the headings of pages."""
    s = F.col("p_size")
    cell = F.when(s % 5 == 0, F.concat("p_name", F.lit(": "))).when(s % 3 == 0, "True").otherwise(F.col("p_brand"))
    page = F.when(s % 2 == 0, F.concat_ws("\n", "p_type", "p_name")).otherwise(F.concat_ws("\n", "p_name", "p_type"))
    return t.part.select("p_partkey", mining.heading(page).alias("heading"), mining.looks_like_value(cell, F.array(F.lit("brand#2"))).alias("is_value"))


@query(
    """
WITH l AS (SELECT l_orderkey, list_sort(list(DISTINCT l_linenumber)) AS have, list_sort(list(DISTINCT l_linenumber) FILTER (WHERE l_quantity > 10)) AS strict FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_filter(range(1, 8), lambda x: NOT list_contains(have, x)), ',') AS missing, array_to_string(list_filter(have, lambda x: NOT list_contains(coalesce(strict, []), x)), ',') AS lost FROM l
"""
)
def missing_and_lost(t):
    """Registered fields that records lack, and those that a stricter run loses."""
    names = lambda cond: F.array_sort(F.collect_set(F.when(cond, F.col("l_linenumber").cast("string"))))
    per = t.lineitem.groupBy("l_orderkey").agg(names(F.lit(True)).alias("fields_present"), names(F.col("l_quantity") > 10).alias("strict"))
    per = per.withColumn("registered", F.array(*[F.lit(str(i)) for i in range(1, 8)]))
    return per.select("l_orderkey", F.array_join(facts.missing(per, None), ",").alias("missing"), F.array_join(facts.lost(F.col("fields_present"), F.col("strict")), ",").alias("lost"))


@query("SELECT doc_id, source AS value, round(n_chars / 7, 3) AS confidence, sha256(array_to_string(list_transform(string_split(text, chr(10))[1:3], lambda x: left(x, 200)), '|')) AS sources FROM documents WHERE source IS NOT NULL AND text IS NOT NULL")
def fact_summary(t):
    """Facts as a prompt shows them: three sources at most, quotes cut."""
    f = t.documents.where("text IS NOT NULL").select("doc_id", F.lit("source").alias("field"), F.col("source").alias("value"), (F.col("n_chars") / 7).alias("confidence"), F.split("text", "\n", -1).alias("sources"))
    return facts.summary(f, "doc_id").select("doc_id", "value", "confidence", F.sha2(F.array_join("sources", "|"), 256).alias("sources"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' WHEN 'P' THEN 'na' END AS mark, CASE o_orderstatus WHEN 'F' THEN 'closing' WHEN 'O' THEN 'planning' ELSE 'fieldwork' END AS workflow FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')")
def form_marks(t):
    """The marks of answers, and the workflow of each type of form."""
    status = F.col("o_orderstatus")
    answer = F.when(status == "F", "Yes").when(status == "O", "false").otherwise("N/A")
    return t.orders.where(status.isin("F", "O", "P")).select("o_orderkey", forms.marks(answer).alias("mark"), retrieval.known_workflow(status, {"F": "closing", "O": "planning", "P": "fieldwork"}).alias("workflow"))


@query("SELECT n_regionkey, '1.' || max(n_nationkey) AS newest, '1.' || max(n_nationkey) + 1 AS next, string_agg('1.' || n_nationkey, ',' ORDER BY n_nationkey) AS versions FROM nation GROUP BY 1")
def newest_versions(t):
    """Versions in the order of their numbers, the newest, and the one after it."""
    named = t.nation.select("n_regionkey", F.concat(F.lit("1."), F.col("n_nationkey").cast("string")).alias("version"))
    key = keys.version_key(F.col("version"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), "version"))), lambda x: x["version"])
    return named.groupBy("n_regionkey").agg(F.max_by("version", key).alias("newest"), listed.alias("v")).select("n_regionkey", "newest", keys.next_version(F.col("newest")).alias("next"), F.array_join("v", ",").alias("versions"))


@query("SELECT c_custkey, coalesce(arg_max(o_orderpriority, o_orderkey), c_name) AS completion, sha256(c_name) AS pair_hash, count(o_orderkey) > 0 AS edited FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name")
def edited_entries(t):
    """Queued pairs with the latest edit of their completion; their hash stays."""
    queue = t.customer.select("c_custkey", F.col("c_name").alias("completion"), F.sha2("c_name", 256).alias("pair_hash"))
    return review.edited(queue, t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("completion")), "c_custkey")


@query(f"WITH {pair_plans._EVENTS} SELECT pair_hash, status FROM q WHERE status IN ('pending', 'approved', 'conditional')")
def pending_entries(t):
    """Entries that wait for a decision, and those that may be exported."""
    queue = pair_plans._queue(t)
    return review.pending(queue).select("pair_hash", "status").unionByName(review.exportable(queue, ("approved", "conditional")).select("pair_hash", "status"))


@query("SELECT DISTINCT p_brand AS field, p_type AS client_type, CASE WHEN p_size % 2 = 0 AND p_size % 3 = 0 THEN 'eligible_and_locked' WHEN p_size % 2 = 0 AND p_size % 5 = 0 THEN 'eligible_and_informational' WHEN p_size > 45 THEN 'severity' ELSE 'no_consequence' END AS problem FROM part WHERE p_size % 6 = 0 OR p_size % 10 = 0 OR p_size > 45 OR p_size % 7 = 0")
def graph_problems(t):
    """What is wrong in a table of procedures: fields of two classes, unknown severities, empty consequences."""
    s = F.col("p_size")
    graph = t.part.select(F.col("p_brand").alias("field"), F.col("p_type").alias("client_type"), (s % 2 == 0).alias("allowed"), (s % 3 == 0).alias("locked"), (s % 5 == 0).alias("informational"), F.when(s > 45, "Grave").otherwise("High").alias("severity"), F.when(s % 7 == 0, " ").otherwise(F.col("p_name")).alias("consequence"))
    return authority.graph_violations(graph)


@query(
    """
WITH r AS (SELECT l_orderkey, list([CASE WHEN l_quantity > 25 THEN l_returnflag ELSE ' ' END, CASE WHEN l_quantity > 40 THEN l_linestatus ELSE '' END] ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rows FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_transform(list_filter(rows, lambda r: trim(r[1]) <> '' OR trim(r[2]) <> ''), lambda r: array_to_string(r, ',')), ';') AS cells FROM r
"""
)
def cleaned_tables(t):
    """Tables without their empty rows."""
    cell = F.array(F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).otherwise(" "), F.when(F.col("l_quantity") > 40, F.col("l_linestatus")).otherwise(""))
    order = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    per = t.lineitem.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, cell.alias("cell")))), lambda x: x["cell"]).alias("rows"))
    cleaned = mining.cleaned_table(F.col("rows"))
    shown = F.array_join(F.transform(cleaned, lambda r: F.array_join(r, ",")), ";")
    return per.select("l_orderkey", F.coalesce(shown, F.lit("")).alias("cells"))


@query("SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def neighbour_cosines(t):
    """The cosine of each vector and the next."""
    after = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return t.embeddings.join(after, "vec_id").select("vec_id", F.round(retrieval.cosine(F.col("embedding"), F.col("next")), 4).alias("cosine"))


@query(
    """
WITH c AS (SELECT c_custkey, t.client_type, c_nationkey % 3 > 0 AS named, c_nationkey % 4 > 0 AS dated, c_nationkey % 5 > 0 AS signed FROM customer, (VALUES ('NPO'), ('Government')) t(client_type)),
s AS (SELECT *, round(0.35 * 0.6 * (named::INT + dated::INT) + 0.3 * 0.6 * signed::INT, 4) AS score FROM c)
SELECT c_custkey, client_type, CASE WHEN score >= 0.5 THEN 'clean' ELSE 'low_confidence' END AS pair_type, concat_ws(',', CASE WHEN NOT named THEN 'client_name' END, CASE WHEN NOT dated THEN 'fiscal_year_end' END, CASE WHEN NOT signed THEN 'preparer' END) AS missing, score AS confidence, client_type = 'Government' AS is_gagas, score < 0.5 AS stopped FROM s
"""
)
def variant_pairs(t):
    """From papers to pairs for two client types: type, missing fields, confidence and first gate of those that aren't drawn."""
    k = F.col("c_nationkey")
    line = lambda cond, label, value: F.when(cond, F.concat(F.lit(f"{label}: "), value))
    text = F.concat_ws("\n", line(k % 3 > 0, "Client Name", F.col("c_mktsegment")), line(k % 4 > 0, "Fiscal Year End", F.lit("6/30/2024")), line(k % 5 > 0, "Prepared by", F.lit("staff")), F.lit("other text"))
    docs = t.customer.select(F.col("c_custkey").alias("doc_id"), F.concat("c_name", F.lit(".docx")).alias("file_name"), text.alias("text"))
    tiers = t.rows("field string, tier int, exempt boolean, reason string", ("client_name", 1, False, "§1"), ("fiscal_year_end", 1, False, "§2"), ("preparer", 2, False, "x"))
    names = t.rows("canonical string, variant string, pos int", ("client_name", "client name", 1), ("fiscal_year_end", "fiscal year end", 2), ("preparer", "prepared by", 3))
    risks = tiers.select("field", F.lit("High").alias("severity"))
    classes = t.rows("field string, slug string, class string, severity string, label string, pos int", ("fiscal_year_end", "q2", "deficiency_eligible", "medium", "Year end", 1))
    out = review_pairs(docs, Dimensions(names, tiers, risks, classes), ("NPO", "Government")).where("pair_type <> 'deficient'")
    return out.select(F.col("doc_id").alias("c_custkey"), "client_type", "pair_type", F.array_join("fields_missing", ",").alias("missing"), F.col("extraction_confidence").alias("confidence"), "is_gagas", (F.col("gate") == "extraction_gate").alias("stopped"))


@query(
    """
WITH s AS (SELECT l_orderkey, l_linenumber <= 5 AS canonical, CASE WHEN l_discount > 0 THEN l_returnflag END AS f, l_quantity > 20 AS e FROM lineitem)
SELECT l_orderkey, count(*) FILTER (WHERE canonical AND f IS NULL) AS violations, count(*) FILTER (WHERE NOT canonical) AS drift,
 coalesce(round((count(*) FILTER (WHERE canonical AND (f = 'R' OR f = 'A' AND NOT e))) / nullif(count(*) FILTER (WHERE canonical), 0), 4), 0) AS uncertain_rate, coalesce(round((count(*) FILTER (WHERE canonical AND f = 'A' AND NOT e)) / nullif(count(*) FILTER (WHERE canonical AND f = 'A'), 0), 4), 0) AS rejection_rate
FROM s GROUP BY 1
"""
)
def validation_signals(t):
    """How well the states of a record's fields hold against the registry and the text."""
    flag = F.col("l_returnflag")
    state = F.when(F.col("l_discount") > 0, F.when(flag == "A", "present").when(flag == "N", "absent").otherwise("uncertain"))
    return pairs.validation_signals(t.lineitem.select("l_orderkey", (F.col("l_linenumber") <= 5).alias("canonical"), state.alias("state"), (F.col("l_quantity") > 20).alias("evidence")), "l_orderkey")


@query(
    """
WITH c AS (SELECT l_orderkey, row_number() OVER w AS row, CASE WHEN l_quantity % 3 = 0 THEN l_returnflag || ':' WHEN l_quantity % 3 = 1 THEN l_linestatus ELSE 'x' || l_linenumber END AS l, CASE WHEN l_partkey % 4 = 0 THEN 'v' ELSE '' END AS v FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)),
m AS (SELECT *, lead(l) OVER w AS below, coalesce(v = '' AND lead(v) OVER w = '' AND NOT ends_with(lead(l) OVER w, ':') AND lead(l) OVER w <> 'x2', false) AS may FROM c WINDOW w AS (PARTITION BY l_orderkey ORDER BY row)),
r AS (SELECT *, may AND (row - coalesce(max(row) FILTER (WHERE NOT may) OVER (PARTITION BY l_orderkey ORDER BY row), 0)) % 2 = 1 AS takes FROM m)
SELECT l_orderkey, row, l || '|' || CASE WHEN takes THEN below ELSE v END AS cells FROM (SELECT *, lag(takes, 1, false) OVER (PARTITION BY l_orderkey ORDER BY row) AS gone FROM r) WHERE NOT gone
"""
)
def continued_rows(t):
    """Rows of tables with the values that stand below their labels."""
    q = F.col("l_quantity")
    label = F.when(q % 3 == 0, F.concat("l_returnflag", F.lit(":"))).when(q % 3 == 1, F.col("l_linestatus")).otherwise(F.concat(F.lit("x"), F.col("l_linenumber").cast("string")))
    row = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    rows = t.lineitem.select("l_orderkey", F.lit(0).alias("table"), row.alias("row"), F.array(label, F.when(F.col("l_partkey") % 4 == 0, "v").otherwise("")).alias("cells"))
    return mining.continued(rows, F.array(F.lit("x2")), "l_orderkey").select("l_orderkey", "row", F.array_join("cells", "|").alias("cells"))


@query("SELECT c_custkey, 'Customer | Segment' || chr(10) || 'What is the name? | ' || c_name || chr(10) || 'Which segment | ' || c_mktsegment AS text, 'matched_row' AS segment, 'not_found' AS balance FROM customer")
def filled_forms(t):
    """Forms with the answers in their rows, read back, and where each answer went."""
    template = document("Form", "Please answer.", [["Customer", "Segment"], ["What is the name?", ""], ["Which segment", ""]])
    asked = [("name", "what is the name", "c_name"), ("segment", "Which  Segment", "c_mktsegment"), ("balance", "account balance", "c_mktsegment")]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"), F.lit(q).alias("question"), F.col(c).alias("answer")) for i, (n, q, c) in enumerate(asked)]))
    made = files.filled_forms(t.customer.select("c_custkey", each.alias("x")).select("c_custkey", "x.*"), template, "c_custkey")
    kept = made.select(F.col("c_custkey").cast("string").alias("path"), "content", F.lit("docx").alias("extension"), "placements")
    text = files.documents(files.routed(kept)).where("pos = 2")
    out = text.join(kept.select("path", "placements"), "path")
    return out.select(F.col("path").cast("long").alias("c_custkey"), "text", F.col("placements")["segment"].alias("segment"), F.col("placements")["balance"].alias("balance"))


@query("SELECT n_nationkey, a AS artefact, CASE a WHEN 'prompt' THEN n_name || chr(10) || 'second line' WHEN 'raw_output' THEN CASE WHEN n_regionkey = 0 THEN '[raw_output not captured]' ELSE n_name END WHEN 'parsed_output' THEN '{\"name\":\"' || n_name || '\"}' ELSE '[gate_failures not captured]' END AS text FROM nation, (VALUES ('prompt'), ('raw_output'), ('parsed_output'), ('gate_failures')) x(a)")
def failure_bundles(t):
    """What failed runs leave for those who look into them, written and read back."""
    path = scratch.folder(t.spark, "bundles")
    runs = t.nation.select("n_nationkey", F.concat("n_name", F.lit("\nsecond line")).alias("prompt"), F.when(F.col("n_regionkey") == 0, "").otherwise(F.col("n_name")).alias("raw_output"), F.to_json(F.struct(F.col("n_name").alias("name"))).alias("parsed_output"), F.lit(None).cast("string").alias("gate_failures"))
    files.write_bundles(runs, path, "n_nationkey")
    back = t.spark.read.text(path, wholetext=True)
    return back.select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "artefact", F.rtrim("value", F.lit("\n")).alias("text"))


@query("SELECT doc_id, length(text)::DOUBLE AS chars, (length(text) - length(replace(text, 'e', '')))::DOUBLE AS es FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '\\S')")
def embedded_chunks(t):
    """Vectors of texts by an embedder that is passed in; here one of two counts."""
    out = retrieval.embedded(t.documents.where("text IS NOT NULL"), lambda texts: [[len(x), x.count("e")] for x in texts], "doc_id")
    return out.where("vector IS NOT NULL").select("doc_id", F.col("vector")[0].alias("chars"), F.col("vector")[1].alias("es"))
