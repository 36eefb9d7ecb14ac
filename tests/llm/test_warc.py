import gzip
import hashlib
import io
import zlib

import pytest

from gleanery.llm import warc
from gleanery.llm.warc import LEAST_BYTES


def sample():
    rows = [(1, "http://a/", b"x" * 500), (2, "http://b/\r\nEvil: 1", "é€".encode() * 90), (3, None, b""), (4, "u", b"WARC/1.1\r\n\r\n" * 30)]
    return [warc.record(i, u, p, hashlib.sha256(p).hexdigest(), None) for i, u, p in rows] + [warc.record(9, "v", b"x" * 500, "d", 1)]


@pytest.mark.parametrize("members", [1, 2, 5])
@pytest.mark.parametrize("block", [3, 1 << 20])
def test_normalise_round_trip(monkeypatch, members, block):
    monkeypatch.setattr(warc, "_BLOCK", block)
    records = sample()
    if members == 1:
        data = gzip.compress(b"".join(records))
    else:
        data = b"".join(gzip.compress(b"".join(records[i::members])) for i in range(members))
        records = [r for i in range(members) for r in records[i::members]]
    out = io.BytesIO()
    index = list(warc.normalise(io.BytesIO(data), out))
    assert [zlib.decompress(out.getvalue()[e["offset"] : e["offset"] + e["length"]], 31) for e in index] == records
    assert gzip.decompress(out.getvalue()) == b"".join(records)
    for e in reversed(index):
        fields, body = warc.read_record(io.BytesIO(out.getvalue()), e["offset"], e["length"])
        assert len(body) == int(fields["content-length"]) and fields["warc-record-id"] == e["id"] and "evil" not in fields


def test_broken_streams_are_refused():
    data = gzip.compress(b"".join(sample()))
    with pytest.raises(ValueError, match="ends early"):
        list(warc.normalise(io.BytesIO(data[:-20]), io.BytesIO()))
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.normalise(io.BytesIO(gzip.compress(b"HTTP/1.1 200\r\n\r\n")), io.BytesIO()))
    assert list(warc.normalise(io.BytesIO(b""), io.BytesIO())) == []


def test_round_trip(spark, monkeypatch):
    long, short = "é" * LEAST_BYTES, "s" * (LEAST_BYTES - 1)
    rows = [(7, "u", long), (5, "v", long), (5, "v", long), (None, None, long), (1, "a", short), (2, "b", short), (3, "c", None), (4, None, ""), (-8, "n", "z" * 200), (None, "y", "q" * 200), (None, "y", "q" * 200)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    out = warc.round_trip(df).collect()
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out)
    want = sorted((str(i), len((t or "").encode()), digest(t), "revisit" if t == long and i != 5 else "response", 5 if t == long and i != 5 else None) for i, _, t in rows)
    assert got == want
    assert warc.round_trip(df.limit(0)).count() == 0
