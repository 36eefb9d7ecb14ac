"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from gleanery.llm.bitsliced import OP4_SQL, op4_bitsliced
from gleanery.llm.language_id import op9_language_id
from gleanery.llm.line_dedup import op2_line_dedup
from gleanery.llm.mixing import OP3_SQL, op3_mix
from gleanery.llm.packing import op5_pack
from gleanery.llm.rules import ABLATIONS_SQL, OP6_SQL, op6_rules, rule_ablations
from gleanery.llm.simhash import op7_simhash
from gleanery.llm.url_filter import op10_url_filter
from gleanery.llm.warc import OP1_SQL, op1_warc
from gleanery.llm.weak_quality import op8_weak_quality

QUERIES = {
    "op1_warc": op1_warc,
    "op2_line_dedup": op2_line_dedup,
    "op3_mix": op3_mix,
    "op4_bitsliced": op4_bitsliced,
    "op5_pack": op5_pack,
    "op6_rules": op6_rules,
    "op7_simhash": op7_simhash,
    "op8_weak_quality": op8_weak_quality,
    "op9_language_id": op9_language_id,
    "op10_url_filter": op10_url_filter,
    "rule_ablations": rule_ablations,
}
ORACLES = {"op1_warc": OP1_SQL, "op3_mix": OP3_SQL, "op4_bitsliced": OP4_SQL, "op6_rules": OP6_SQL, "rule_ablations": ABLATIONS_SQL}
