"""The registered queries over the smallest tables, against plain versions."""

from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest
from test_line_dedup import brute
from test_simhash import groups, plain
from test_url_filter import plain as plain_url
from tokenizers import Tokenizer

from gleanery.llm import queries
from gleanery.llm.packing import public_tokenizer

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no tables here")


def table(name, at=SMALL):
    return pq.read_table(f"{at}/{name}.parquet").to_pylist()


def result(spark, name, at=SMALL):
    return [r.asDict() for r in queries.QUERIES[name](spark, at).collect()]


def test_op2(spark):
    docs = [(r["doc_id"], r["text"]) for r in table("documents")]
    gone = dict(zip([i for i, _ in docs], brute(docs, 50)))
    out = result(spark, "op2_line_dedup")
    assert {r["doc_id"]: r["lines_removed"] for r in out} == {i: len(g) for i, g in gone.items()} and any(gone.values())
    assert all(r["n_lines"] == t.count("\n") + 1 for r in out for t in [dict(docs)[r["doc_id"]]])


def test_op4(spark):
    rows = {r["vec_id"]: np.floor(1024 * np.array(r["embedding"], np.float32).astype(float)).astype(int) for r in table("embeddings")}
    want = []
    for q in rows:
        if q % 100 == 0:
            best = sorted((-int(rows[q] @ v), i) for i, v in rows.items() if i != q)[:10]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in result(spark, "op4_bitsliced")) == want


def test_op5(spark):
    tokenizer, pieces, ends = Tokenizer.from_file(public_tokenizer()), {}, {}
    for r in result(spark, "op5_pack"):
        pieces.setdefault(r["doc_id"], []).append(r)
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc in table("documents"):
        ids = [*tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids, 1]
        parts = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        got = [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in sorted(pieces.pop(doc["doc_id"]), key=lambda r: r["piece"])]
        assert got == [(n, 4096 * n, len(p), crc32(np.array(p, "<u4").tobytes())) for n, p in enumerate(parts)]
    assert not pieces
    for places in ends.values():
        assert [o for o, _ in sorted(places)] == [0, *np.cumsum([n for _, n in sorted(places)])[:-1]] and sum(n for _, n in places) <= 4096
    assert len(ends) <= -(-sum(n for p in ends.values() for _, n in p) // 4096) + 1


def test_op7(spark):
    docs = sorted((r["doc_id"], plain(r["text"])) for r in table("documents"))
    at = groups([f for _, f in docs], 3)
    want = {i: (f"{f:016x}", docs[g][0]) for (i, f), g in zip(docs, at)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in result(spark, "op7_simhash")} == want


def test_op8_against_the_labels(spark):
    kept = {r["doc_id"]: r["kept"] for r in result(spark, "op8_weak_quality", MIDDLE)}
    labels = [(r["quality"], kept[r["doc_id"]]) for r in table("labels", MIDDLE)]
    assert len(kept) == len(table("documents", MIDDLE))
    assert np.mean([k for q, k in labels if q]) > 0.98 and np.mean([not k for q, k in labels if not q]) > 0.85


def test_op9_on_held_out_rows(spark):
    docs = {r["doc_id"]: r for r in table("documents", MIDDLE)}
    out = [r for r in result(spark, "op9_language_id", MIDDLE)]
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in out)
    right = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in out if r["held_out"] and len(docs[r["doc_id"]]["text"].split()) >= 10]
    assert len(out) == len(docs) and np.mean(right) > 0.97


def test_op10(spark):
    pages = {r["page_id"]: r["url"] for r in table("pages")}
    out = result(spark, "op10_url_filter")
    for r in out:
        host, path, rule, verdict = plain_url(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or ("block" if r["p_block"] > 0.5 else "allow"))
    assert len(out) == len(pages)
