"""Fields from lines, cells and pages of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.text import has_mark, let, short_question, strip
from gleanery.operators.aliases import alias_map
from gleanery.operators.sizes import small

# Labels that are headings of a form, not fields.
NOISE = ("instructions", "practical consideration", "comments", "yes", "no", "n/a", "date", "transaction_date")
LABEL = r"^[A-Za-z][A-Za-z0-9 /&\-.()]{1,60}:\s*.+$"
EMBEDDED = r"\s+[A-Z][A-Za-z0-9 /&\-.()]{1,60}:\s+"
# Categories by words of a file name, the first that fits; and by words of the text.
NAME_PATTERNS = (
    (r"npo[-_]cx|gov[-_]cx|nfp[-_]cx|trb[-_]cx", "engagement_form"),
    (r"engagement.{0,20}(accept|cont|form|decision)", "engagement_form"),
    (r"(acceptance|continuance|accept\.?cont)", "engagement_form"),
    (r"final.{0,10}audit.{0,10}report", "financial_statement"),
    (r"financial.{0,5}statements?", "financial_statement"),
    (r"(draft|audited).{0,10}financial", "financial_statement"),
    (r"planning.{0,10}(memo|memorandum|doc)", "planning_memo"),
    (r"risk.{0,10}(assessment|memo|matrix)", "planning_memo"),
    (r"engagement|accept|acceptance|continuance", "engagement_form"),
)
CONTENT = (
    ("engagement_form", ("engagement",), ("accept", "continue", "continuance", "decline", "engagement partner", "engagement decision", "gagas", "single audit", "yellow book", "independence", "npo-cx", "engagement form"), 3),
    ("financial_statement", ("financial statement",), ("independent auditor", "auditor's report", "opinion", "balance sheet", "statement of activities", "net assets", "total assets", "total revenue", "notes to financial", "management is responsible"), 2),
    ("planning_memo", ("audit plan",), ("risk assessment", "materiality", "planning memo", "preliminary", "significant risk", "inherent risk", "control risk", "fraud risk"), 2),
)
DOCUMENT_TYPES = (
    (("engagement_letter", "engagement-letter", "engagementletter"), "engagement_letter"),
    (("prior_year", "prior-year", "prioryear"), "prior_year_file"),
    (("intake_form", "intake-form", "intakeform", "client_intake"), "client_intake_form"),
    (("financial_statement", "financial-statement"), "financial_statements"),
    (("audit_report", "audit-report"), "audit_report"),
    (("board_minutes", "board-minutes"), "board_minutes"),
    (("management_letter",), "management_letter"),
    (("trial_balance",), "trial_balance"),
)
# What opens and closes an auditor's report, and phrases that name a scope.
ANCHOR, LEADERS = "INDEPENDENT AUDITOR", r"\.{5,}"
SALUTATION = r"(?i)^(To the |The )(Board of Directors|Members|Governing Board|Trustees|Partners)"
CITY = r"^[A-Za-z][A-Za-z\s\-]+,\s+[A-Za-z][A-Za-z\s]+$"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATE = rf"\b((?:{MONTHS})\s+\d{{1,2}},\s+\d{{4}})\b"


def name_category(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for pattern, category in reversed(NAME_PATTERNS):
        out = F.when(F.lower(name).rlike(pattern), category).otherwise(out)
    return out


def content_category(headings: Column, text: Column, chars: int = 800) -> Column:
    """The first category whose required words all, and of whose others enough, are in the headings or the first characters."""
    sample = F.concat_ws(" ", F.lower(headings), F.lower(F.left(F.coalesce(text, F.lit("")), F.lit(chars))))
    out = F.lit(None).cast("string")
    for category, required, optional, least in reversed(CONTENT):
        hits = sum(((F.instr(sample, w) > 0).cast("int") for w in optional), F.lit(0))
        need = hits >= least
        for w in required:
            need = need & (F.instr(sample, w) > 0)
        out = F.when(need, category).otherwise(out)
    return out


def category(name: Column, headings: Column, text: Column) -> Column:
    return F.coalesce(name_category(name), content_category(headings, text), F.lit("unknown"))


def document_type(name: Column) -> Column:
    low, out = F.lower(name), F.lit("unknown")
    for words, kind in reversed(DOCUMENT_TYPES):
        hit = F.lit(False)
        for w in words:
            hit = hit | (F.instr(low, w) > 0)
        out = F.when(hit, kind).otherwise(out)
    return out


def line_fields(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, label, value): the last value of each `label: value` line; a value ends at ` | ` and where another label begins in it; noise labels and overlong parts don't count."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x.rlike(LABEL))

    def parted(line, pos):
        value = strip(F.substring_index(F.substring(line, F.instr(line, ":") + 1, F.length(line)), " | ", 1))
        value = strip(F.regexp_replace(F.ltrim(value, F.lit(":")), rf"(?s){EMBEDDED}.*\z", ""))
        return F.struct(pos.alias("pos"), strip(F.substring_index(line, ":", 1)).alias("label"), value.alias("value"))

    good = lambda x: (F.length(x["label"]) > 0) & (F.length(x["label"]) < 80) & (F.length(x["value"]) > 0) & (F.length(x["value"]) < 300) & ~F.lower(x["label"]).isin(*NOISE)
    found = docs.select(key, F.explode(F.filter(F.transform(lines, parted), good)).alias("x"))  # arrays, so that each part is computed once
    return found.groupBy(key, F.col("x.label").alias("label")).agg(F.max_by("x.value", "x.pos").alias("value"))


def cells(tables: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, table, row, col, text) of tables(key, table, headers, rows): the header is row 0."""
    rows = tables.select(key, "table", F.posexplode(F.concat(F.array("headers"), "rows")).alias("row", "r"))
    return rows.select(key, "table", "row", F.posexplode("r").alias("col", "text"))


def cell_fields(tables: DataFrame, aliases: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, canonical, value, method) of tables(key, table, headers, rows): values beside known labels, the first of: the row above, the header of a column, the cell to the left. Labels, noise and marks are no values; each field once. Neighbours are looked up within a table's arrays; only what was found is shuffled."""
    names = alias_map(aliases).agg(F.map_from_entries(F.collect_list(F.struct("variant", "canonical"))).alias("__names"))
    name = lambda x: F.try_element_at("__names", F.lower(x))
    is_value = lambda x: name(x).isNull() & (x != "") & ~x.endswith(":") & ~F.lower(x).isin(*NOISE, "true", "false")

    def beside(values, labels, method, row, col_of):
        """What stands in `labels` with the element of `values` at the same place as its value."""
        both = F.transform(F.arrays_zip(values.alias("v"), labels.alias("l")), lambda x, i: F.struct(F.lit(method).alias("pass"), row(i).alias("row"), col_of(i).alias("col"), name(F.coalesce(x["l"], F.lit(""))).alias("canonical"), x["v"].alias("value")))
        return F.filter(both, lambda x: x["canonical"].isNotNull() & F.coalesce(is_value(x["value"]), F.lit(False)))

    def found(all_rows):
        first = F.transform(all_rows, lambda r: F.coalesce(F.filter(r, lambda x: x != "")[0], F.lit("")))
        n = F.size(all_rows)
        above = let(first, lambda f: beside(F.slice(f, 1, F.greatest(n - 1, F.lit(0))), F.slice(f, 2, F.greatest(n - 1, F.lit(0))), 1, lambda i: i + 1, lambda i: F.lit(0)))
        column = F.when(n > 1, beside(all_rows[1], F.slice(all_rows[0], 1, F.size(all_rows[1])), 2, lambda i: F.lit(0), lambda i: i)).otherwise(F.array())
        left = F.flatten(F.transform(all_rows, lambda r, j: beside(F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), 3, lambda i: j, lambda i: i + 1)))
        return F.concat(above, column, left)

    plain = F.transform(F.concat(F.array("headers"), "rows"), lambda r: F.transform(r, lambda x: strip(F.coalesce(x, F.lit("")))))
    hits = tables.join(F.broadcast(names)).select(key, "table", F.explode(let(plain, found)).alias("x"))  # names is one row
    method = F.element_at(F.array(F.lit("above"), F.lit("column"), F.lit("left")), F.col("b.pass"))
    best = F.min_by(F.struct("x.value", "x.pass"), F.struct("x.pass", "table", "x.row", "x.col"))
    return hits.groupBy(key, F.col("x.canonical").alias("canonical")).agg(best.alias("b")).select(key, "canonical", "b.value", method.alias("method"))


def checkbox_answers(tables: DataFrame, aliases: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, canonical, answer): Yes or No by the ticked column of a table whose first five rows name both, for questions that are known by their short form."""
    rows = tables.select(key, "table", F.concat(F.array("headers"), "rows").alias("all"))
    low = lambda r: F.transform(r, lambda x: F.lower(strip(x)))
    head = F.filter(F.slice("all", 1, 5), lambda r: F.array_contains(low(r), "yes") & F.array_contains(low(r), "no"))[0]
    rows = rows.withColumn("__h", head).where("__h IS NOT NULL").withColumn("__y", F.array_position(low(F.col("__h")), "yes").cast("int")).withColumn("__n", F.array_position(low(F.col("__h")), "no").cast("int"))
    one = rows.select(key, "table", "__y", "__n", F.posexplode("all").alias("row", "r")).where((F.size("r") >= F.greatest("__y", "__n")) & (strip(F.col("r")[0]) != ""))
    yes, no = has_mark(F.element_at("r", F.col("__y"))), has_mark(F.element_at("r", F.col("__n")))
    found = one.select(key, "table", "row", F.lower(short_question(F.col("r")[0])).alias("variant"), F.when(yes, "Yes").when(no, "No").alias("answer")).where("answer IS NOT NULL")
    return found.join(small(alias_map(aliases)), "variant").groupBy(key, "canonical").agg(F.min_by("answer", F.struct("table", "row")).alias("answer"))


def checkbox_completion(tables: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, eligible, checked, incomplete): question rows of Yes/No tables and those answered; incomplete with five or more of them and no answer."""
    low = lambda r: F.transform(r, lambda x: F.lower(strip(x)))
    rows = tables.select(key, F.concat(F.array("headers"), "rows").alias("all"))
    head = F.filter(F.slice("all", 1, 5), lambda r: F.array_contains(low(r), "yes") & F.array_contains(low(r), "no"))[0]
    rows = rows.withColumn("__h", head).where("__h IS NOT NULL").withColumn("__y", F.array_position(low(F.col("__h")), "yes").cast("int")).withColumn("__n", F.array_position(low(F.col("__h")), "no").cast("int"))
    fit = F.filter("all", lambda r: (F.size(r) >= F.greatest("__y", "__n")) & (strip(r[0]) != ""))
    done = F.filter(fit, lambda r: has_mark(F.element_at(r, F.col("__y"))) | has_mark(F.element_at(r, F.col("__n"))))
    out = rows.groupBy(key).agg(F.sum(F.size(fit)).alias("eligible"), F.sum(F.size(done)).alias("checked"))
    return out.withColumn("incomplete", (F.col("eligible") >= 5) & (F.col("checked") == 0))


def unrepeated(row: Column) -> Column:
    """A row with cells equal to the one on their left blanked, as merged cells are read."""
    return F.transform(row, lambda x, i: F.when((i > 0) & (x != "") & (x == F.element_at(row, F.greatest(i, F.lit(1)))), "").otherwise(x))


def sections(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, section, heading, content) of blocks(key, pos, text, is_heading): a heading opens a section; blank blocks don't count."""
    w = Window.partitionBy(key).orderBy("pos")
    grouped = blocks.where(F.trim("text") != "").withColumn("section", F.sum(F.col("is_heading").cast("int")).over(w))
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("is_heading"), F.struct("pos", "text")))), lambda x: x["text"]), "\n")
    return grouped.groupBy(key, "section").agg(F.max(F.when(F.col("is_heading"), F.col("text"))).alias("heading"), content.alias("content"))


def numeric_columns(rows: DataFrame, key: str = "table_id", share: float = 0.80) -> DataFrame:
    """(key, col): columns of rows(key, row array) of whose filled cells `share` or more are numbers."""
    from gleanery.functions.text import parses_as_number

    c = rows.select(key, F.posexplode("row").alias("col", "x")).where(F.trim("x") != "")
    return c.groupBy(key, "col").agg(F.avg(parses_as_number(F.col("x")).cast("int")).alias("s")).where(F.col("s") >= share).select(key, "col")


def merged_cells(cells_: DataFrame, rectangles: DataFrame, key: str = "sheet") -> DataFrame:
    """cells(key, row, col, text) with every cell of rectangles(key, top, left, bottom, right) showing its top left one."""
    inside = rectangles.select(key, "top", "left", F.explode(F.sequence("top", "bottom")).alias("row"), "right").select(key, "top", "left", "row", F.explode(F.sequence("left", "right")).alias("col"))
    source = cells_.select(key, F.col("row").alias("top"), F.col("col").alias("left"), F.col("text").alias("__t"))
    fill = inside.join(source, [key, "top", "left"]).select(key, "row", "col", "__t")
    return cells_.join(fill, [key, "row", "col"], "left").withColumn("text", F.coalesce("__t", "text")).drop("__t")


def page_lines(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, page, line, text, ahead): filled lines with the next six."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    out = pages.select(key, "page", lines.alias("l")).select(key, "page", "l", F.posexplode("l").alias("line", "text"))
    return out.select(key, "page", "line", "text", F.slice("l", F.col("line") + 2, 6).alias("ahead"), (F.size("l") - F.col("line")).alias("from_end"))


def report_blocks(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, page, entity, city): the first auditor's report, known by its title with a salutation, an entity and a city among the next six lines; tables of contents (dot leaders) don't count."""
    lines = page_lines(pages, key).where(F.upper("text").contains(ANCHOR) & ~F.exists("ahead", lambda x: x.rlike(LEADERS)))
    at = F.array_position(F.transform("ahead", lambda x: x.rlike(SALUTATION)), True).cast("int")
    found = lines.withColumn("at", at).where("at > 0").withColumn("entity", F.try_element_at("ahead", F.col("at") + 1)).withColumn("city", F.try_element_at("ahead", F.col("at") + 2))
    found = found.where(F.col("city").rlike(CITY) & F.col("entity").isNotNull())
    best = F.min_by(F.struct("page", "entity", "city"), F.struct("page", "line"))
    return found.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def fiscal_year_end(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, value, confidence, page): the best date of the first three pages: .92 a line in capitals, .85 the line alone, .75 a short line, .55 any other; the first among equals."""
    lines = page_lines(pages.where("page <= 3"), key).withColumn("value", F.regexp_extract("text", f"(?i){DATE}", 1)).where("value <> ''")
    alone = F.col("text") == F.col("value")
    score = F.when(alone & (F.col("text") == F.upper("text")), 0.92).when(alone & (F.length("text") < 30), 0.85).when(F.length("text") < 40, 0.75).otherwise(0.55)
    best = F.max_by(F.struct("value", "confidence", "page"), F.struct("confidence", F.negative("page").alias("p"), F.negative("line").alias("l")))
    return lines.withColumn("confidence", score).groupBy(key).agg(best.alias("b")).select(key, "b.*")


def sign_off(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, value, confidence, page): the first date on a short line among the last six of a page."""
    lines = page_lines(pages, key).where("from_end <= 6").withColumn("value", F.regexp_extract("text", f"(?i){DATE}", 1)).where((F.col("value") != "") & (F.length("text") < 40))
    best = F.min_by(F.struct("value", F.when(F.length("text") < 25, 0.85).otherwise(0.72).alias("confidence"), "page"), F.struct("page", "line"))
    return lines.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def located(page: Column, value: Column, around: int = 7) -> Column:
    """struct<char_start, char_end, quote>: where a value stands in a page, with up to `around` words of its line on either side; null offsets if it isn't there."""
    from gleanery.functions.text import words

    at = F.instr(page, value)
    before = F.substring_index(F.substring(page, F.lit(1), at - 1), "\n", -1)
    after = F.substring_index(F.substring(page, at + F.length(value), F.length(page)), "\n", 1)
    head = words(before)
    tail = F.slice(words(after), 1, around)
    quote = F.concat_ws(" ", F.array_join(F.slice(head, F.greatest(F.size(head) - around + 1, F.lit(1)), around), " "), value, F.array_join(tail, " "))
    return F.struct(F.when(at > 0, at - 1).alias("char_start"), F.when(at > 0, at - 1 + F.length(value)).alias("char_end"), F.when(at > 0, F.trim(quote)).otherwise(value).alias("quote"))


# Phrases that tell a scope or a framework in running text.
PROSE = {
    "includes_gagas": ("government auditing standards", "yellow book", "gagas", "gao standards"),
    "includes_single_audit": ("uniform guidance", "single audit", "2 cfr", "a-133", "federal awards", "major federal program"),
    "includes_gaas_audit": ("generally accepted auditing standards", "gaas", "aicpa", "au-c", "public company accounting"),
    "reporting_framework": ("accounting principles generally accepted in the united states", "u.s. generally accepted accounting principles", "gaap", "gasb", "special purpose framework", "cash basis", "tax basis"),
}


def prose_flags(text: Column) -> Column:
    """Map of flag -> confidence, by how many of its phrases a text holds."""
    from gleanery.operators.scoring import prose_confidence

    low, entries = F.lower(text), []
    for name, phrases in PROSE.items():
        hits = sum(((F.instr(low, p) > 0).cast("int") for p in phrases), F.lit(0))
        entries.append(F.struct(F.lit(name).alias("flag"), prose_confidence(hits).alias("confidence")))
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["confidence"] > 0))


def framework(text: Column) -> Column:
    low = F.lower(text)
    return F.when(F.instr(low, "gasb") > 0, "GASB").when((F.instr(low, "special purpose") > 0) | (F.instr(low, "cash basis") > 0), "Special Purpose Framework").otherwise("GAAP")


def looks_like_value(cell: Column, labels: Column) -> Column:
    """Whether a cell may be a value: filled, no known label (an array of lower-cased ones), no colon at its end, no mark."""
    t = strip(cell)
    return (t != "") & ~F.array_contains(labels, F.lower(t)) & ~t.endswith(":") & ~F.lower(t).isin("true", "false")


def continued(rows: DataFrame, labels: Column, key: str = "doc_id") -> DataFrame:
    """rows(key, table, row, cells) in which a label without a value takes the first cell of the next row as its value, if that may be one and has none beside it; the row it comes from goes, so it is no label itself. Tables whose first row names yes and no, or has one cell, stay as they are. Where several rows in a run could, every other one does, from the first."""
    w = Window.partitionBy(key, "table").orderBy("row")
    at = lambda i: strip(F.coalesce(F.get("cells", F.lit(i)), F.lit("")))
    first = F.first("cells").over(w)
    low = F.transform(first, lambda x: F.lower(strip(F.coalesce(x, F.lit("")))))
    plain = (F.size(first) >= 2) & ~(F.array_contains(low, "yes") & F.array_contains(low, "no"))
    out = rows.withColumn("__l", at(0)).withColumn("__v", at(1)).withColumn("__p", plain).withColumn("__n", F.row_number().over(w))
    below = F.lead("__l").over(w)
    may = F.coalesce(F.col("__p") & (F.col("__l") != "") & (F.col("__v") == "") & (F.lead("__v").over(w) == "") & looks_like_value(below, labels), F.lit(False))
    out = out.withColumn("__below", below).withColumn("__may", may)
    before = F.coalesce(F.max(F.when(~F.col("__may"), F.col("__n"))).over(w), F.lit(0))  # the last row that can't
    out = out.withColumn("__takes", F.col("__may") & ((F.col("__n") - before) % 2 == 1))
    out = out.withColumn("__gone", F.coalesce(F.lag("__takes").over(w), F.lit(False))).where("NOT __gone")
    merged = F.concat(F.slice("cells", 1, 1), F.array("__below"), F.slice("cells", 3, F.greatest(F.size("cells"), F.lit(1))))
    return out.withColumn("cells", F.when(F.col("__takes"), merged).otherwise(F.col("cells"))).drop("__l", "__v", "__p", "__n", "__below", "__may", "__takes", "__gone")


def heading(text: Column) -> Column:
    """A page's first line, if it is in capitals."""
    first = F.trim(F.substring_index(F.trim(text), "\n", 1))
    return F.when(first.rlike(r"^[A-Z][A-Z\s,.&'()-]{3,79}$"), first)


def note_sections(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, section, heading, content): pages split where a line opens a numbered note."""
    lines = pages.select(key, "page", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    blocks = lines.select(key, F.struct("page", "line").alias("pos"), "text", F.col("text").rlike(r"(?i)^\s*note\s+\d+\b").alias("is_heading"))
    return sections(blocks, key)


def cleaned_table(rows: Column) -> Column:
    """Rows without empty ones; null for a table of one cell, which is noise."""
    filled = F.filter(rows, lambda r: F.exists(r, lambda c: strip(F.coalesce(c, F.lit(""))) != ""))
    return F.when(~((F.size(filled) <= 1) & (F.coalesce(F.size(F.try_element_at(filled, F.lit(1))), F.lit(0)) <= 1)), filled)
