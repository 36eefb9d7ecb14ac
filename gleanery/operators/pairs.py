"""Training pairs: assembly, redaction of evidence, variants, ordered gates, deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.keys import fingerprint, pair_hash, split_of
from gleanery.functions.text import capped_words, let

# File of each stage, thresholds of the gates, wording that final pairs must not have.
STAGE_FILES = {"stage2_domain": "stage2_domain.jsonl", "stage3_firm": "stage3_firm.jsonl"}
EXTRACTION, REVIEW = 0.50, 0.70
STALE = (r"(?i)SOP\s+§Q\d", r"ET\s+1\.300\b", r"(?i)government auditing standards.*chapter.*§")
GOVERNMENT = r"(?i)\bgas\s+[§ch]|yellow book|government auditing standards"
FEDERAL = r"(?i)2\s+cfr\s+200"
CLIENT_FLAGS = {"Government": (True, None), "Tribal": (True, True), "For-Profit": (False, False)}
GAGAS_WORDS = ("government auditing standards", "yellow book", "gagas")
SINGLE_AUDIT_WORDS = ("single audit", "uniform guidance", "2 cfr 200")


def mentions_any(text: Column, phrases: tuple[str, ...]) -> Column:
    low, out = F.lower(text), F.lit(False)
    for p in phrases:
        out = out | (F.instr(low, p) > 0)
    return out


def engagement_flags(client_type: Column, text: Column) -> tuple[Column, Column]:
    """(is_gagas, has_single_audit): fixed for governments (the first), tribes and companies; read from the text for others."""
    gagas, single = mentions_any(text, GAGAS_WORDS), mentions_any(text, SINGLE_AUDIT_WORDS)
    for name, (g, s) in CLIENT_FLAGS.items():
        gagas = F.when(client_type == name, F.lit(g)).otherwise(gagas) if g is not None else gagas
        single = F.when(client_type == name, F.lit(s)).otherwise(single) if s is not None else single
    return gagas, single


def assembled(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, messages, pair_hash) of conversations(key, turn, role, text): the messages in the order of turns."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda m: F.struct(m["role"].alias("role"), F.coalesce(m["text"], F.lit("")).alias("content")))
    return turns.groupBy(key).agg(ordered.alias("messages")).withColumn("pair_hash", pair_hash(F.col("messages")))


def first_of(messages: Column, role: str) -> Column:
    return F.coalesce(F.filter(messages, lambda m: m["role"] == role)[0]["content"], F.lit(""))


def user_prompt(title: Column, body: Column, most: int = 1500) -> Column:
    return F.concat(title, F.lit("\n\n"), capped_words(body, most))


def first_failure(*gates: tuple[str, Column]) -> Column:
    """The name of the first gate that isn't passed, or ok."""
    out = F.lit("ok")
    for name, passed in reversed(gates):
        out = F.when(~F.coalesce(passed, F.lit(False)), name).otherwise(out)
    return out


def export_gate(pairs: DataFrame, written: DataFrame, index: DataFrame, file: Column | None = None, strict: bool = False) -> DataFrame:
    """pairs with `structural_duplicate` and `gate`: extraction, review confidence, approval, pair not yet written, stage and file, and (if strict) no pair of the same structure before. written has pair_hash, index fingerprint and pos."""
    stages = F.create_map(*[F.lit(x) for kv in STAGE_FILES.items() for x in kv])
    done = written.select("pair_hash", F.lit(True).alias("__w")).distinct()
    prior = index.groupBy("fingerprint").agg(F.min_by("pair_hash", "pos").alias("prior_hash"))
    out = pairs.join(done, "pair_hash", "left").join(prior, "fingerprint", "left")
    stage_ok = F.try_element_at(stages, F.col("stage")).isNotNull()
    if file is not None:
        stage_ok = stage_ok & (F.try_element_at(stages, F.col("stage")) == file)
    duplicate = F.col("prior_hash").isNotNull()
    gates = [("extraction_gate", F.col("extraction_confidence") >= EXTRACTION), ("review_confidence", F.col("review_confidence") >= REVIEW), ("auditor_approved", F.col("approved")), ("no_duplicate", F.col("__w").isNull()), ("stage_isolation", stage_ok), ("structural_duplicate", ~duplicate if strict else F.lit(True))]
    return out.withColumn("structural_duplicate", duplicate).withColumn("gate", first_failure(*gates)).drop("__w")


def final_gate(completion: Column, prompt: Column, pair_type: Column, disallowed: Column, evidence: Column, gagas: Column, single_audit: Column) -> Column:
    """citation_valid, sop_authority, evidence_consistent, context_consistent or ok. disallowed: fields that may not be found deficient; evidence: phrases of which a deficient pair's prompt must hold none."""
    stale = F.lit(False)
    for p in STALE:
        stale = stale | completion.rlike(p)
    residue = (pair_type == "deficient") & F.exists(F.coalesce(evidence, F.array().cast("array<string>")), lambda a: F.instr(F.lower(prompt), a) > 0)
    context = (~gagas & completion.rlike(GOVERNMENT)) | (~single_audit & completion.rlike(FEDERAL))
    return first_failure(("citation_valid", ~stale), ("sop_authority", F.size(disallowed) == 0), ("evidence_consistent", ~residue), ("context_consistent", ~context))


def redacted(docs: DataFrame, field: str, phrases: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the lines that hold a phrase of two words or more replaced by one placeholder (runs of it become one), and `removed`, their number. A text is one row throughout: no line is shuffled."""
    mark = f"[NOT DOCUMENTED: {field}]"
    long = sorted((p.lower() for p in phrases if len(p.split()) >= 2), key=lambda p: -len(p.split()))
    hit = lambda line: F.coalesce(mentions_any(line, tuple(long)), F.lit(False)) if long else F.lit(False)
    def collapsed(m):
        before = lambda i: F.when(i > 0, F.element_at(m, F.greatest(i, F.lit(1))))
        pairs_ = F.transform(m, lambda x, i: F.struct(x.alias("x"), before(i).alias("before")))
        return F.transform(F.filter(pairs_, lambda s: ~((s["x"] == mark) & F.coalesce(s["before"] == mark, F.lit(False)))), lambda s: s["x"])

    lines = F.split(F.col(text), "\n", -1)
    out = docs.withColumn("removed", F.size(F.filter(lines, hit)))
    return out.withColumn(text, F.array_join(let(F.transform(lines, lambda x: F.when(hit(x), mark).otherwise(x)), collapsed), "\n"))


def appended(new: DataFrame, written: DataFrame, key: str = "pair_hash") -> DataFrame:
    """The rows to append: each key once, those that were written left out."""
    return new.dropDuplicates([key]).join(written.select(key), key, "left_anti")


def with_split(pairs: DataFrame, key: str) -> DataFrame:
    return pairs.withColumn("split", split_of(F.col(key).cast("string")))


def training_ready(c: dict[str, Column]) -> Column:
    """Extracted, scrubbed, approved, confident, with text, and not an empty template."""
    return (c["status"] == "success") & c["scrubbed"] & c["approved"] & (c["confidence"] >= REVIEW) & (F.length(F.trim(c["text"])) > 0) & ~c["incomplete"]


def drafting_ready(c: dict[str, Column]) -> Column:
    return (c["status"] == "success") & c["scrubbed"] & (c["confidence"] >= EXTRACTION)


def unlabelled(papers: DataFrame, key: str = "engagement_id", label: str = "workpaper_type") -> DataFrame:
    """(key, missing, complete): papers without a label by engagement; pairs may be built only of those that are complete."""
    missing = F.count_if(F.col(label).isNull())
    return papers.groupBy(key).agg(missing.alias("missing"), (missing == 0).alias("complete"))


# Who may rank answers, how alike two of them may be, and how many pairs a run needs.
RANKERS, MOST_ALIKE, LEAST_PAIRS = ("partner", "senior"), 0.95, 300


def preference_pairs(candidates: DataFrame) -> DataFrame:
    """candidates(feedback_id, reviewer_tier, rating, similarity, pos) that may teach a preference: corrected by a ranker, the two answers not alike; the first of each feedback."""
    good = candidates.where(F.col("reviewer_tier").isin(*RANKERS) & (F.col("rating") == "corrected") & (F.col("similarity") <= MOST_ALIKE))
    first = Window.partitionBy("feedback_id").orderBy("pos")
    return good.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def enough_pairs(pairs_: DataFrame, least: int = LEAST_PAIRS) -> DataFrame:
    """(n, enough): one row."""
    return pairs_.agg(F.count("*").alias("n"), (F.count("*") >= least).alias("enough"))


def variants(records: DataFrame, client_types: tuple[str, ...]) -> DataFrame:
    """A row for each record and client type, with their flags."""
    out = records.withColumn("client_type", F.explode(F.array(*[F.lit(c) for c in client_types])))
    gagas, single = engagement_flags(F.col("client_type"), F.col("text"))
    return out.withColumn("is_gagas", gagas).withColumn("has_single_audit", single)


def stage(fields_present: Column, firm_fields: list[str]) -> Column:
    return F.when(F.arrays_overlap(fields_present, F.array(*[F.lit(f) for f in firm_fields])), "stage3_firm").otherwise("stage2_domain")


def uncertain_sections(flagged: Column, scores: Column, deficiencies: Column) -> Column:
    """Sorted names: flagged, scored above 0 and below .70, or made deficient."""
    weak = F.map_keys(F.map_filter(scores, lambda _, v: (v > 0) & (v < 0.70)))
    return F.array_sort(F.array_union(F.array_union(flagged, weak), deficiencies))


def reconciled(phase1: Column, model: Column, extraction: Column, deficient: Column) -> Column:
    """A field's state: absent if made deficient; present if extraction found it; absent if it found none with .70 confidence or more; else what the model says."""
    return F.when(deficient, "absent").when(phase1 == "present", "present").when((phase1 == "absent") & (extraction >= 0.70), "absent").otherwise(model)


def validation_signals(states: DataFrame, key: str = "pair_id") -> DataFrame:
    """(key, violations, drift, uncertain_rate, rejection_rate) of states(key, canonical, state, evidence), a row for each field: canonical fields without a state, fields that the registry doesn't know, the share of canonical fields that are uncertain or present without evidence, and the share of present ones without it. Shares of none are 0."""
    canonical, present = F.coalesce("canonical", F.lit(False)), F.col("state") == "present"
    refuted = present & ~F.coalesce("evidence", F.lit(False))
    share = lambda part, whole: F.when(whole == 0, 0.0).otherwise(F.round(part / whole, 4))
    n = lambda cond: F.count_if(canonical & cond)
    return states.groupBy(key).agg(
        n(F.col("state").isNull()).alias("violations"),
        F.count_if(~canonical).alias("drift"),
        share(n((F.col("state") == "uncertain") | refuted), F.count_if(canonical)).alias("uncertain_rate"),
        share(n(refuted), n(present)).alias("rejection_rate"),
    )


def derived_state(states: Column, source: str = "includes_single_audit", derived: str = "includes_gagas") -> Column:
    """A single audit is done under government standards: where the first is present, so is the second, if it is a field at all."""
    return F.when((F.try_element_at(states, F.lit(source)) == "present") & F.map_contains_key(states, derived), F.map_concat(F.map_filter(states, lambda k, _: k != derived), F.create_map(F.lit(derived), F.lit("present")))).otherwise(states)


def deficiency_sets(records: DataFrame, tier1: dict[str, float], tier2: dict[str, float], variants_: int = 2, most: int = 3, tries: int = 8) -> DataFrame:
    """(file_name, client_type, combination, fields): up to variants_ different sorted sets of 1 to `most` present fields, at least one of tier 1. records: (file_name, client_type, fields_present); a record without a field of tier 1 gives none, null and repeated fields count for nothing.

    A try orders the present fields by exponential keys of their weights, drawn from a hash of record, try and field:
    the first of tier 1 leads, the next in order follow, as many as another hash says, in which size s weighs 1 / s.
    The different sets among `tries` tries a variant are the result, in the order of the tries.
    """
    known = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(float(w)).alias("weight"), F.lit(f in tier1).alias("leads")) for f, w in (tier2 | tier1).items()])
    uniform = lambda *parts: (F.pmod(F.xxhash64("file_name", "client_type", *parts), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    harmonic = F.array(*[F.lit(sum(1 / s for s in range(1, n + 1))) for n in range(1, most + 1)])

    def one_try(i: Column) -> Column:
        keyed = F.array_sort(F.transform("__pool", lambda x: F.struct((-F.log(uniform(i, x["field"])) / x["weight"]).alias("key"), x["field"].alias("field"), x["leads"].alias("leads"))))

        def chosen(order: Column) -> Column:
            lead = F.filter(order, lambda x: x["leads"])[0]["field"]
            draw = uniform(i, F.lit("size")) * F.element_at(harmonic, F.least(F.size(order), F.lit(most)))
            others = F.transform(F.filter(order, lambda x: x["field"] != lead), lambda x: x["field"])
            return F.array_sort(F.concat(F.array(lead), F.slice(others, 1, F.size(F.filter(harmonic, lambda h: h < draw)))))

        return let(keyed, chosen)

    pool = records.withColumn("__pool", F.filter(known, lambda x: F.coalesce(F.array_contains("fields_present", x["field"]), F.lit(False)))).where(F.exists("__pool", lambda x: x["leads"]))
    sets = F.slice(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(tries * variants_)), one_try)), 1, variants_)
    return pool.select("file_name", "client_type", F.posexplode(sets).alias("combination", "fields"))


def with_fingerprint(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("fingerprint", fingerprint(F.col("client_type"), F.col("pair_type"), F.col("fields_missing"), F.col("fields_present")))


def claims(findings: DataFrame, anchor: DataFrame, key: str = "pair_id") -> DataFrame:
    """findings(key, idx, text, citation_grounded) with the state of the field each is about: anchor(key, idx, field, state, fixed). VALID, HALLUCINATED, MISANCHORED or UNANCHORED."""
    out = findings.join(anchor, [key, "idx"], "left")
    status = (
        F.when(F.col("field").isNull(), "UNANCHORED")
        .when((F.col("state") == "present") & F.col("fixed"), "UNANCHORED")
        .when(F.col("state") == "present", "MISANCHORED")
        .when((F.col("state") == "missing") & (F.col("citation_grounded") == F.lit(False)), "HALLUCINATED")
        .when(F.col("state") == "missing", "VALID")
        .otherwise("UNANCHORED")
    )
    return out.withColumn("status", status)


def grounding(claims_: DataFrame, missing: DataFrame, key: str = "pair_id") -> DataFrame:
    """(key, claims, valid, hallucinated, misanchored, grounding, coverage_gap). missing(key, field, tier1): the canonical fields that a pair lacks; grounding is 1 for a pair that lacks none."""
    counts = claims_.groupBy(key).agg(F.count("*").alias("claims"), *[F.count_if(F.col("status") == s.upper()).alias(s) for s in ("valid", "hallucinated", "misanchored", "unanchored")])
    covered = claims_.where("status = 'VALID'").select(key, "field", F.lit(True).alias("__c")).distinct()
    need = missing.join(covered, [key, "field"], "left").groupBy(key).agg(F.count("*").alias("n"), F.count("__c").alias("c"), F.count_if("tier1").alias("t"), F.count_if(F.col("tier1") & F.col("__c").isNull()).alias("u"))
    out = counts.join(need, key, "left")
    return out.select(key, "claims", "valid", "hallucinated", "misanchored", "unanchored", F.when(F.coalesce("n", F.lit(0)) == 0, 1.0).otherwise(F.round(F.col("c") / F.col("n"), 4)).alias("grounding"), F.when(F.coalesce("t", F.lit(0)) == 0, 0.0).otherwise(F.round(F.col("u") / F.col("t"), 4)).alias("coverage_gap"))


def findings(scores: DataFrame, tiers: DataFrame, risks: DataFrame, key: str = "doc_id", low: float = 0.50) -> DataFrame:
    """(key, field, tier, status, severity): what a record lacks. scores(key, field, score, deficient, flagged), a row for each field; tiers(field, tier), risks(field, severity); a field without a risk gives none. Of tier 2, missing is Medium at most and low confidence Low; other flagged fields with a score are llm_only. One shuffle: a record's scores become a map, which is held against the dimension as an array."""
    dim = tiers.join(risks, "field", "left").agg(F.collect_list(F.struct("field", "tier", "severity")).alias("__dim"))
    per = scores.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct("score", F.coalesce("deficient", F.lit(False)).alias("deficient"), F.coalesce("flagged", F.lit(False)).alias("flagged")).alias("s")))).alias("__m"))

    def lacking(d):
        s = F.try_element_at("__m", d["field"])
        score = F.coalesce(s["score"], F.lit(0.0))
        status = F.when(F.coalesce(s["deficient"], F.lit(False)) | (score == 0), "missing").when(score < low, "low_confidence")
        severity = F.when((d["tier"] == 2) & (status == "low_confidence"), "Low").when((d["tier"] == 2) & (d["severity"] == "High"), "Medium").otherwise(d["severity"])
        return F.struct(d["field"].alias("field"), d["tier"].alias("tier"), status.alias("status"), severity.alias("severity"))

    own = F.filter(F.transform(F.filter("__dim", lambda d: d["tier"].isin(1, 2) & d["severity"].isNotNull()), lacking), lambda x: x["status"].isNotNull())
    out = per.join(F.broadcast(dim)).withColumn("__own", own)  # dim is one row
    tier = lambda f: F.coalesce(F.filter("__dim", lambda d: d["field"] == f)[0]["tier"], F.lit(3))
    only = F.filter(F.map_entries("__m"), lambda e: e["value"]["flagged"] & (e["value"]["score"] > 0) & ~e["value"]["deficient"] & ~F.exists("__own", lambda x: x["field"] == e["key"]))
    more = F.transform(only, lambda e: F.struct(e["key"].alias("field"), tier(e["key"]).alias("tier"), F.lit("llm_only").alias("status"), F.lit("Informational").alias("severity")))
    return out.select(key, F.explode(F.concat("__own", more)).alias("x")).select(key, "x.*")


def latest(rows: DataFrame, key: str, at: str, pos: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(at), F.desc(pos))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def instruction(prompt: Column, completion: Column) -> tuple[Column, Column]:
    """(prompt, completion) in the envelope of instruction training."""
    return F.concat(F.lit("<s>[INST] "), prompt, F.lit(" [/INST]")), F.concat(completion, F.lit("</s>"))


def ordered_json(fields: Column) -> Column:
    """A map as JSON with its keys sorted."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(fields))))


def parsed_answer(raw: Column) -> Column:
    """A model's answer as a map of text, null values empty; null where it isn't a JSON object."""
    from gleanery.functions.text import json_payload

    fields = F.from_json(json_payload(raw), "map<string,string>")
    return F.when(F.try_parse_json(json_payload(raw)).isNotNull(), F.transform_values(fields, lambda _, v: F.trim(F.coalesce(v, F.lit("")))))


def parsed_field(answer: Column, field: str) -> Column:
    """struct<value, found, confident, hint> of one field, given as {value, confident, source_hint} or as a plain value."""
    raw = F.try_element_at(answer, F.lit(field))
    inner = F.from_json(raw, "struct<value:string,confident:string,source_hint:string>")
    structured = raw.startswith("{")
    value = F.coalesce(F.trim(F.when(structured, inner["value"]).otherwise(raw)), F.lit(""))
    return F.struct(value.alias("value"), (value != "").alias("found"), F.coalesce(structured & (F.lower(inner["confident"]) == "true"), F.lit(False)).alias("confident"), F.when(structured, F.left(F.coalesce(inner["source_hint"], F.lit("")), F.lit(200))).otherwise("").alias("hint"))


def procedure_map(tiers: DataFrame, classes: DataFrame) -> DataFrame:
    """(field, section, severity, label) of the fields that may be found deficient: tiers(field, tier, reason) with the first of classes(field, slug, class, severity, label, pos) each; a field without a class takes its section from the reason."""
    from gleanery.functions.text import severity, slug_section, title_label

    first = classes.groupBy("field").agg(F.min_by(F.struct("slug", "class", "severity", "label"), "pos").alias("c"))
    out = tiers.join(F.broadcast(first), "field", "left").where("c IS NULL OR c.class = 'deficiency_eligible'")
    cited = F.regexp_extract("reason", r"§\s*([\w.()-]+)", 1)
    section = F.when(F.col("c").isNotNull(), slug_section(F.col("c.slug"))).when(cited != "", F.concat(F.lit("§"), cited))
    return out.select("field", section.alias("section"), severity(F.col("c.severity"), F.col("tier")).alias("severity"), F.coalesce("c.label", title_label(F.col("field"))).alias("label"))


def rendered_findings(absent: DataFrame, table: DataFrame, key: str = "pair_id") -> DataFrame:
    """(key, n, findings): numbered lines for the absent fields of absent(key, pos, field) that the table has, in order."""
    found = absent.join(F.broadcast(table), "field").withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("pos")))
    cited = F.when(F.col("section").isNotNull(), F.concat(F.lit(" ("), "section", F.lit(")"))).otherwise("")
    line = F.concat(F.col("n").cast("string"), F.lit(". "), "label", cited, F.lit("\n   Severity: "), "severity")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", line.alias("l")))), lambda x: x["l"]), "\n\n")
    return found.groupBy(key).agg(F.count("*").alias("n"), text.alias("findings"))


def numbered_findings(completion: DataFrame, key: str = "pair_id", text: str = "text") -> DataFrame:
    """(key, idx, text) of the numbered lines between FINDINGS: and RECOMMENDATION:, or of the whole text where there are no such marks."""
    body = F.coalesce(F.nullif(F.regexp_extract(text, r"(?is)FINDINGS:\s*\n(.*?)(?=\nRECOMMENDATION:|\z)", 1), F.lit("")), F.col(text))
    lines = completion.select(key, F.posexplode(F.regexp_extract_all(body, F.lit(r"(?m)^\s*(\d+\.\s+.+)$"), F.lit(1))).alias("pos", "l"))
    return lines.select(key, F.regexp_extract("l", r"^(\d+)", 1).cast("int").alias("idx"), F.trim(F.regexp_extract("l", r"^\d+\.\s+(.+)$", 1)).alias("text"))


def without_evidence(text: Column, fields: Column) -> tuple[Column, Column]:
    """(text, failed) after the evidence of each of fields (array<struct<field, phrases>>, phrases lower-cased) was replaced in order, as redacted() does for one field; failed names the fields of which no line was found."""
    mark = lambda f: F.concat(F.lit("[NOT DOCUMENTED: "), f["field"], F.lit("]"))
    hit = lambda line, f: F.exists(f["phrases"], lambda p: F.instr(F.lower(line), p) > 0)

    def step(lines, f):
        marked = F.transform(lines, lambda x: F.when(hit(x, f), mark(f)).otherwise(x))
        pairs_ = lambda m: F.transform(m, lambda x, i: F.struct(x.alias("x"), F.when(i > 0, F.element_at(m, F.greatest(i, F.lit(1)))).alias("before")))
        return let(marked, lambda m: F.transform(F.filter(pairs_(m), lambda s: ~((s["x"] == mark(f)) & F.coalesce(s["before"] == mark(f), F.lit(False)))), lambda s: s["x"]))

    lines = F.split(text, "\n", -1)
    failed = F.transform(F.filter(fields, lambda f: ~F.exists(lines, lambda x: hit(x, f))), lambda f: f["field"])
    return F.array_join(F.aggregate(fields, lines, step), "\n"), failed
