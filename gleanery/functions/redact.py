"""Redaction of personal data, with counts by type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import let


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    replacement: str
    near: tuple[str, ...] = ()
    #: Text that every match holds; where it is absent the pattern isn't tried.
    needs: str = ""


# What is redacted, in this order; `near` names words of which one must stand within WINDOW characters.
WINDOW = 60
RULES = (
    Rule("EIN", r"\b\d{2}-\d{7}\b", "[EIN]", needs="-"),
    Rule("SSN", r"\b\d{3}-\d{2}-\d{4}\b", "[SSN]", needs="-"),
    Rule("ITIN", r"\b9\d{2}-\d{2}-\d{4}\b", "[ITIN]", needs="-"),
    Rule("PREPARER_INITIALS", r"(Completed\s+by[\s:\u2002\u200b]+)([A-Z]{1,3}\d?)(?=\b|\s|$|\|)", "$1[PREPARER]", needs="Completed"),
    Rule(
        "CLIENT_ENTITY",
        r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s+(?:Inc\.|LLC|Corp\.|L\.P\.|LLP|County|City of|Township of|School District|Housing Authority|Nonprofit|Foundation|Institute|Project|Center|Program|STEP|Association|Society|Trust|Authority|Agency|Bureau|Department|Coalition)\b",
        "[CLIENT_ENTITY]",
    ),
    Rule("ACCOUNT_NUM", r"\b\d{8,17}\b", "[ACCOUNT_NUM]", ("account", "acct", "checking", "savings", "routing", "deposit")),
    Rule("ROUTING_NUM", r"\b\d{9}\b", "[ROUTING_NUM]", ("routing", "aba", "transit", "wire")),
)
#: Types by pattern that a named-entity model would find as well.
EXTRA = (
    Rule("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]", needs="@"),
    Rule("PHONE", r"\+?\d{0,2} ?\(\d{3}\) \d{3}-\d{4}", "[PHONE]", needs="("),
)
# Instructions to a model that are struck out of source texts.
INJECTIONS = (
    r"\[INST\]",
    r"\[/INST\]",
    r"</s>",
    r"<s>",
    r"(?i)\bignore\s+(all\s+)?(previous|prior|above)\s+instructions?\b",
    r"(?i)\bforget\s+(everything|all|your)\b",
    r"(?i)\byou\s+are\s+now\b",
    r"(?i)\bact\s+as\s+(a|an)\b",
    r"(?i)\bnew\s+persona\b",
)


def _pattern(rule: Rule) -> str:
    """A rule with context as one pattern: a word before, wholly inside the window, or one after."""
    if not rule.near:
        return rule.pattern
    words = "(?i:" + "|".join(rule.near) + ")"
    return rf"(?s)(?:(?<={words}.{{0,{WINDOW}}}){rule.pattern}|{rule.pattern}(?=.{{0,{WINDOW}}}{words}))"


def redacted(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct<text, counts>: the text after all rules, each over what the ones before left, and a map of type -> number of replacements, types without one left out. Every pattern runs once over a text to count, and again only where it is found. Blank texts stay as they are. A word counts as context where it lies wholly within the window of the text before this rule's own replacements."""

    def step(now: Column, rest: tuple[Rule, ...], counts: list[Column]) -> Column:
        if not rest:
            found = F.map_from_entries(F.filter(F.array(*counts), lambda x: x["n"] > 0)) if counts else F.create_map().cast("map<string,int>")
            return F.struct(now.alias("text"), found.alias("counts"))
        rule, pattern = rest[0], _pattern(rest[0])

        def replaced(n: Column) -> Column:
            then = F.when(n > 0, F.regexp_replace(now, pattern, rule.replacement)).otherwise(now)
            return let(then, lambda t: step(t, rest[1:], [*counts, F.struct(F.lit(rule.name).alias("type"), n.alias("n"))]))

        count = F.regexp_count(now, F.lit(pattern))
        return let(F.when(F.contains(now, F.lit(rule.needs)), count).otherwise(F.when(now.isNotNull(), 0)) if rule.needs else count, replaced)

    return let(text, lambda t: step(t, rules, []))


def scrubbed(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The text after all rules; see redacted(), which is cheaper where counts are wanted too."""
    out = text
    for rule in rules:
        out = F.regexp_replace(out, _pattern(rule), rule.replacement)
    return F.when(F.trim(text) == "", text).otherwise(out)


def redactions(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Map of type -> number of replacements, types without one left out."""
    return redacted(text, rules)["counts"]


def finding_count(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """How many matches a text holds, all rules over the same text."""
    total = F.lit(0)
    for rule in rules:
        total = total + F.regexp_count(text, F.lit(_pattern(rule)))
    return total


def disarmed(text: Column, patterns: tuple[str, ...] = INJECTIONS) -> Column:
    for p in patterns:
        text = F.regexp_replace(text, p, "[REDACTED]")
    return text
