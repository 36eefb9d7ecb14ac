import numpy as np

import corpus_pipeline as P
from gleanery.llm.packing import public_tokenizer
from tokenizers import Tokenizer

PROSE = "Then the small river ran on past the old mill. It was cold, and nobody saw it there. "


def corpus():
    passage = " ".join(f"passage{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(70)) + "."
    rows = []
    for i in range(60):
        own = " ".join(w.rstrip(".,") + chr(97 + (i * 7 + k) % 26) + chr(97 + (i + k * 3) % 26) + w[len(w.rstrip(".,")) :] for k, w in enumerate((PROSE * 6).split()))
        rows.append((i, f"{own}\n{passage}\nend of number {chr(97 + i % 26)}." if i % 3 == 0 else own, "src" + str(i % 3)))
    rows += [(100, rows[1][1], "src0"), (101, rows[1][1].upper().lower(), "src1"), (102, "word### " * 90, "src2"), (103, None, None), (104, "", "src0"), (1, rows[1][1], "src1")]
    return rows


def test_stages(spark, tmp_path):
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in corpus()], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in P.STAGES:
        before, docs = docs, stage(spark, docs, str(tmp_path)).cache()
        seen[name] = docs
        if name != P.STAGES[-1][0]:
            assert docs.columns == before.columns
    ids = lambda n: {r["doc_id"] for r in seen[n].collect()}
    assert not ids("quality classifier") & {102, 103, 104} and len(ids("quality classifier")) >= 60
    texts = {r["doc_id"]: r["text"] for r in seen["line dedup"].collect()}
    assert sum("passageaa" in t for t in texts.values()) == 1 and "passageaa" in texts[0]
    assert not ids("near-dedup") & {100, 101} and 1 in ids("near-dedup") and seen["near-dedup"].where("doc_id = 1").count() == 1
    mixed, packed = seen["mixing"].collect(), seen["packing"].collect()
    tokenizer = Tokenizer.from_file(public_tokenizer())
    assert sum(r["length"] for r in packed) == sum(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in mixed)
    assert P.run(spark, str(tmp_path)).count() == len(packed)
    ends = {}
    for r in packed:
        ends[r["sequence_id"]] = ends.get(r["sequence_id"], 0) + r["length"]
    assert max(ends.values()) <= 4096 and np.sum(list(ends.values())) == sum(r["length"] for r in packed)
