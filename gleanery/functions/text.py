"""Text functions as Column expressions: normal forms, labels, citations, cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that stand for ticked and for empty boxes, in Unicode and in symbol fonts.
CHECKED = "\u2713\u2714\u2611\u2612\u25a0\u25aa\u25cf\uf0fe\uf0fc\uf0fb\uf061\uf0a3\uf052\u2717\u2718"
UNCHECKED = "\u2610\u25a1\u25cb\u25ef\uf0a1"
# Spaces that become one ordinary space, and characters that vanish.
WIDE_SPACES = "\u2002\u2003\u2004\u2005\u2009\u00a0"
ZERO_WIDTH = "\u200b\u200c\u200d\u2060\u00ad\ufeff"
# Wording of decisions and scopes beside a ticked (x).
TICK = r"\(\s*[xX✓✔]\s*\)"
ACCEPT = r"(?:Accept|Continue|Accepted|Go|Proceed)"
DECLINE = r"(?:Decline|Discontinue|Reject|No.Go|Do Not Accept|Should Not Accept)"
GOVERNMENT_STANDARDS = r"(?:Government Auditing Standards|Yellow Book|GAGAS|GAS Audit)"
SINGLE_AUDIT = r"(?:Single Audit|Uniform Guidance|2 CFR 200|A.133|Federal Program Audit)"
# Placeholders that count as no value.
PLACEHOLDER = r"(?i)^\[(client_entity|preparer|date|ein|ssn|itin|routing_num|account_num|name|address|phone|email|organization|entity|person|redacted|pii_removed|confidential)\]$"
# Accents and typographic signs that a bad scan leaves in labels, and what they become.
OCR_FROM = "áàâäãéèêëíìîïóòôöõúùûüýÿñç\u2018\u2019\u201c\u201d\u2013\u2014\u2012\u00a0\u2002\u2003\u200b\u200c\u200d\ufeff"
OCR_TO = "aaaaaeeeeiiiiooooouuuuyync''\"\"---   "
# Whole cells, and words in a cell, that mark rows and sheets to be set apart.
SKIPPED_SHEETS = "cover|index|toc|table of contents|instructions|summary|legend|contents|readme|notes|changes|log|template|example|sample"
SUBTOTAL_WORDS = r"(?i)\b(total|subtotal|grand total|net total|sum|balance|carried forward|c/f|b/f|brought forward)\b"
#: White space as Python's str.strip() sees it.
SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def let(value: Column, f) -> Column:
    """f(value) with value computed once: an expression that a lambda uses is otherwise computed for each of its elements."""
    return F.transform(F.array(value), f)[0]


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(c, F.lit(SPACES))


def words(c: Column, space: str = SPACE) -> Column:
    """The words of a text, parted by white space of any kind; an empty array without one."""
    return F.filter(F.split(c, rf"{space}+"), lambda x: x != "")


def first_words(c: Column, n: int) -> Column:
    return F.array_join(F.slice(words(c), 1, n), " ")


def checkboxes(c: Column) -> Column:
    """Ticked boxes become `true`, empty ones `false`."""
    return F.regexp_replace(F.regexp_replace(c, f"[{CHECKED}]", "true"), f"[{UNCHECKED}]", "false")


def underscores(c: Column) -> Column:
    """Underscores around digits, slashes and spaces go, with the spaces at the ends; other runs of two or more that touch no word become a space."""
    parts = F.split(F.regexp_replace(c, r"(_+)([\d/ ]+)(_*)|([\d/ ]+)(_+)", "\x01$2$4\x01"), "\x01")
    # parts alternate between text that stays and what stood between underscores
    joined = F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 1, F.trim(x)).otherwise(x)), "")
    return F.when(F.instr(c, "_") > 0, F.regexp_replace(joined, r"(?<!\w)_{2,}(?!\w)", " ")).otherwise(c)


def spaces(c: Column) -> Column:
    """Exotic spaces become ordinary ones; characters without width go."""
    return F.translate(c, WIDE_SPACES + ZERO_WIDTH, " " * len(WIDE_SPACES))


def collapse(c: Column) -> Column:
    """Runs of blanks become one, three and more newlines two; the ends are stripped."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"))


def _ticked(c: Column, words_: str) -> Column:
    return c.rlike(rf"(?i){TICK}\s*{words_}|{words_}\s*{TICK}")


def inline_markers(c: Column) -> Column:
    """The text with a line for each decision or scope that is ticked in it; accepting wins over declining."""
    lines = [
        F.when(_ticked(c, ACCEPT), "engagement_decision: Accept").when(_ticked(c, DECLINE), "engagement_decision: Decline"),
        F.when(_ticked(c, GOVERNMENT_STANDARDS), F.lit("includes_gagas: true")),
        F.when(_ticked(c, SINGLE_AUDIT), F.lit("includes_single_audit: true")),
    ]
    return F.when(c.isNull() | (c == ""), c).otherwise(F.concat_ws("\n", c, *lines))


def normalised(c: Column) -> Column:
    """The full normal form: boxes, underscores, spaces, runs of blanks, inline marks."""
    return inline_markers(collapse(spaces(underscores(checkboxes(c)))))


def iso_date(c: Column) -> Column:
    """M/D/YYYY as YYYY-MM-DD, by form alone; anything else as it is."""
    part = lambda n: F.regexp_extract(c, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", n)
    return F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.concat_ws("-", part(3), F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0"))).otherwise(c)


def comparable(c: Column) -> Column:
    """The form in which extracted values are compared; null becomes empty."""
    plain = F.translate(F.coalesce(c.cast("string"), F.lit("")), "\u2002\u00a0\u200b", "  ")
    return iso_date(F.regexp_replace(F.lower(strip(plain)), rf"{SPACE}+", " "))


def is_placeholder(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")).rlike(PLACEHOLDER), F.lit(False))


def is_empty(c: Column) -> Column:
    return (comparable(c) == "") | is_placeholder(c)


def ocr_corrected(c: Column) -> Column:
    """Accents and typographic signs made plain; digits read for letters inside words made letters, unless a number of two or more digits stands in the label."""
    plain = F.translate(c, OCR_FROM, OCR_TO)
    letters = F.regexp_replace(plain, r"(?<=[a-zA-Z])1(?=[a-zA-Z]{3,})", "l")
    letters = F.regexp_replace(letters, r"(?<=[a-zA-Z])0(?=[a-zA-Z]{3,})", "o")
    letters = F.regexp_replace(letters, r"(?<=[a-zA-Z]{6})1(?=\s|$|[^a-zA-Z0-9])", "l")
    return F.when(plain.rlike(r"\b\d{2,}\b"), plain).otherwise(letters)


def without_pictures(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{So}", "")


def expanded(c: Column, abbreviations: dict[str, str]) -> Column:
    """Whole-word abbreviations written out, longest first; labels with a number of two or more digits stay as they are."""
    out = c
    for i, short in enumerate(sorted(abbreviations, key=lambda k: (-len(k), k))):
        out = F.regexp_replace(out, rf"(?i)\b\Q{short}\E\b", f"\x02{i}\x03")
    for i, short in enumerate(sorted(abbreviations, key=lambda k: (-len(k), k))):
        out = F.replace(out, F.lit(f"\x02{i}\x03"), F.lit(abbreviations[short]))
    return F.when(c.rlike(r"\b\d{2,}\b"), c).otherwise(out)


def label_unit(c: Column, abbreviations: dict[str, str] | None = None) -> Column:
    """One label's comparable form."""
    out = F.lower(expanded(without_pictures(ocr_corrected(c)), abbreviations or {}))
    out = F.regexp_replace(strip(out), r"""^[:.?!,;"'()]+|[:.?!,;"'()]+\z""", "")
    return strip(F.regexp_replace(F.regexp_replace(out, rf"{SPACE}+", " "), r":+\z", ""))


def label_units(c: Column, abbreviations: dict[str, str] | None = None, least: int = 3) -> Column:
    """The comparable forms of the parts of a compound label (parted by |, /, and, &) of `least` letters or more."""
    parts = F.split(strip(without_pictures(c)), r"(?i)\s*\|\s*|\s*/\s*|\s+and\s+|\s+&\s+")
    parts = F.filter(F.transform(parts, strip), lambda x: x != "")
    return F.filter(F.transform(parts, lambda x: label_unit(x, abbreviations)), lambda x: F.length(x) >= least)


def short_question(c: Column) -> Column:
    """A question's first line up to a parenthesis, without ? and : at the end."""
    head = F.substring_index(strip(F.substring_index(c, "\n", 1)), "(", 1)
    return strip(F.regexp_replace(F.regexp_replace(strip(head), r"\?+\z", ""), r":+\z", ""))


def form_text(c: Column) -> Column:
    """Lower case, hyphens gone, anything but letters and digits one space."""
    return F.trim(F.regexp_replace(F.replace(F.lower(c), F.lit("-"), F.lit("")), "[^a-z0-9]+", " "))


def title_label(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def shown(c: Column, most: int = 80) -> Column:
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most - 3)), F.lit("..."))).otherwise(c)


def section_prefix(c: Column) -> Column:
    """`SOP §n — Title: ` from a heading like `§ 3.1 — Title`; empty if there is none."""
    pattern = r"(?m)\A(?:§\s*|Section\s+|SECTION\s+)?(\d+(?:\.\d+)*)\s*[-—–]?\s*([A-Z][^\n]{3,60})"
    text = F.trim(c)
    title = F.regexp_replace(strip(F.regexp_extract(text, pattern, 2)), r":+\z", "")
    return F.when(text.rlike(pattern), F.concat(F.lit("SOP §"), F.regexp_extract(text, pattern, 1), F.lit(" — "), title, F.lit(": "))).otherwise("")


def token_estimate(c: Column) -> Column:
    return F.floor(F.size(words(c)) * F.lit(1.3)).cast("int")


def citation_key(c: Column) -> Column:
    """What follows § in a citation; without § the text without blanks and the letters s, o, p at its start."""
    low = F.lower(strip(c))
    return F.when(low.rlike(r"§\s*[a-z0-9]"), F.regexp_extract(low, r"§\s*([a-z0-9]+(?:[.\-][a-z0-9]+)*)", 1)).otherwise(F.regexp_replace(F.regexp_replace(F.replace(low, F.lit(" "), F.lit("")), "^[sop]+", ""), "^§+", ""))


def slug_section(c: Column) -> Column:
    """`§Q12(b)` from `q12b`, `§Part Ii Q3` from `part_ii_q3`; null for other slugs."""
    slug, pattern = F.lower(strip(c)), r"^(?:(part_[ivx]+)_)?q(\d+)([a-z]?)$"
    part, num, letter = (F.regexp_extract(slug, pattern, n) for n in (1, 2, 3))
    body = F.concat(F.lit("Q"), num, F.when(letter != "", F.concat(F.lit("("), letter, F.lit(")"))).otherwise(""))
    return F.when(slug.rlike(pattern), F.concat(F.lit("§"), F.when(part != "", F.concat(title_label(part), F.lit(" "))).otherwise(""), body))


def severity(c: Column, tier: Column) -> Column:
    """High, Medium, Low or Informational; by tier where the value is none of them."""
    given = F.initcap(c)
    return F.when(given.isin("High", "Medium", "Low", "Informational"), given).when(tier == "tier1", "High").otherwise("Medium")


def cell_text(c: Column) -> Column:
    """A numeric cell as text: empty for null and NaN, without a fraction where it is whole."""
    return F.when(c.isNull() | F.isnan(c), "").when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def is_empty_row(row: Column, filled: float = 0.15) -> Column:
    return F.size(F.filter(row, lambda x: strip(x) != "")) / F.greatest(F.size(row), F.lit(1)) <= F.lit(1 - (1 - filled))


def is_subtotal_row(row: Column) -> Column:
    return F.exists(row, lambda x: F.coalesce(x.rlike(SUBTOTAL_WORDS), F.lit(False)))


def is_skipped_sheet(c: Column) -> Column:
    return strip(c).rlike(rf"(?i)^({SKIPPED_SHEETS})\z")


def page_cleaned(c: Column) -> Column:
    """Without form feeds and dot leaders, blank runs collapsed."""
    return strip(F.regexp_replace(F.regexp_replace(F.replace(c, F.lit("\f"), F.lit("\n")), r"\.{4,}\s*\d*", " "), r"\n{3,}", "\n\n"))


def is_readable(c: Column) -> Column:
    return ~c.rlike(r"[\x00-\x08\x0b-\x1f]")


def quality_class(chars: Column) -> Column:
    return F.when(chars < 200, "failed").when(chars < 2000, "low").otherwise("good")


def has_mark(c: Column) -> Column:
    """Whether a form cell is ticked."""
    return F.lower(strip(c)).isin("true", "x") | F.coalesce(c.rlike(f"[{CHECKED}\ue000-\uf8ff]"), F.lit(False))


def parses_as_number(c: Column) -> Column:
    """Whether a cell is a number once commas, dollar signs and accounting parentheses are read."""
    return F.replace(F.translate(c, ",$)", ""), F.lit("("), F.lit("-")).try_cast("double").isNotNull()


def capped_words(c: Column, most: int = 1500) -> Column:
    return first_words(c, most)


def json_payload(c: Column) -> Column:
    """The outermost {...} of a model's answer, code fences removed; the text itself if it has none."""
    plain = F.trim(F.regexp_replace(c, r"(?m)^```(?:json)?\s*|```\s*$", ""))
    return F.when(plain.rlike(r"(?s)\{.*\}"), F.regexp_extract(plain, r"(?s)(\{.*\})", 1)).otherwise(plain)
