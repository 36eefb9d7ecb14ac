"""Hashes, fingerprints, seeds and versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seed(*parts: Column) -> Column:
    """The first 32 bits of the MD5 of the parts joined by ::."""
    return F.conv(F.substring(F.md5(F.concat_ws("::", *parts)), 1, 8), 16, 10).cast("long")


def hash_mod(c: Column, n: int) -> Column:
    """The MD5 of a text, as a 128-bit number, modulo n; digit by digit, so that nothing overflows."""
    digits = F.transform(F.filter(F.split(F.md5(c), ""), lambda x: x != ""), lambda x: F.conv(x, 16, 10).cast("int"))
    return F.aggregate(digits, F.lit(0), lambda acc, d: (acc * 16 + d) % n)


def split_of(c: Column, train: int = 70, validation: int = 15) -> Column:
    """train, validation or test, by hash: the same key always falls in the same split."""
    bucket = hash_mod(c, 100)
    return F.when(bucket < train, "train").when(bucket < train + validation, "validation").otherwise("test")


def json_string(c: Column) -> Column:
    """A JSON string literal as Python's json.dumps(ensure_ascii=False) writes it."""
    out = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, escaped in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit('"'), out, F.lit('"'))


def messages_json(messages: Column) -> Column:
    """array<struct<role, content>> as canonical JSON: keys sorted, `, ` and `: ` between."""
    one = lambda m: F.concat(F.lit('{"content": '), json_string(m["content"]), F.lit(', "role": '), json_string(m["role"]), F.lit("}"))
    return F.concat(F.lit("["), F.array_join(F.transform(messages, one), ", "), F.lit("]"))


def pair_hash(messages: Column) -> Column:
    return F.sha2(messages_json(messages), 256)


def variant_hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def chunk_id(document: Column, start: Column) -> Column:
    return F.sha2(F.concat(document, F.lit(":"), start.cast("string")), 256)


def _names(fields: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(F.coalesce(fields, F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)))), ",")


def fingerprint(client_type: Column, pair_type: Column, missing: Column, present: Column, with_client: bool = True) -> Column:
    """16 hex digits for the structure of a pair: its types and the names of its missing and present fields, in any order."""
    word = lambda c: F.lower(F.trim(F.coalesce(c, F.lit("unknown"))))
    parts = [F.concat(F.lit("pair_type:"), word(pair_type)), F.concat(F.lit("missing:"), _names(missing)), F.concat(F.lit("present:"), _names(present))]
    if with_client:
        parts = [F.concat(F.lit("client_type:"), word(client_type)), *parts]
    return F.left(F.sha2(F.concat_ws("|", *parts), 256), F.lit(16))


def version_key(c: Column) -> Column:
    """A dotted version as numbers, which sort as versions do."""
    return F.transform(F.split(c, r"\."), lambda x: x.cast("int"))


def next_version(c: Column) -> Column:
    parts = F.split(c, r"\.")
    return F.concat(parts[0], F.lit("."), (parts[1].cast("int") + 1).cast("string"))
