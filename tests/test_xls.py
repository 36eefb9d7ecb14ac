import struct

import pytest
from pyspark.sql import functions as F

from gleanery.plans.intake import _compound, binary_workbook
from gleanery.sources import files, xls


def rec(n, b=b""):
    return struct.pack("<HH", n, len(b)) + b


def book(*cells, more=b"", sheet="Data"):
    bof = lambda kind, version=0x0600: rec(xls.BOF, struct.pack("<HH", version, kind))
    head = lambda at: bof(5) + more + rec(xls.BOUNDSHEET, struct.pack("<IBBBB", at, 0, 0, len(sheet), 0) + sheet.encode()) + rec(xls.EOF)
    return _compound(head(len(head(0))) + bof(16) + b"".join(cells) + rec(xls.EOF))


@pytest.mark.parametrize("n", [3, 400, 6000])
def test_round_trip(n):
    rows = [["Name", "Key"], *([f"näme {i} " + "ü𝄞x" * (i % 40), str(i * 7)] for i in range(n)), ["long " * 7000, "1"]][: n + 1 + (n == 400)]
    got = list(files.xls_rows(binary_workbook(rows, "A1:A1")))
    assert [r[2] for r in got if r[0] == "Customers"] == [[x.strip() for x in r] for r in rows]
    assert {r[0] for r in got} == {"Cover", "Customers"}


def test_kinds_of_cells():
    here = lambda r, c: struct.pack("<HHH", r, c, 0)
    whole = lambda x: struct.pack("<I", (x << 2 | 2) & 0xFFFFFFFF)
    cells = [
        rec(xls.LABEL, here(0, 0) + struct.pack("<HB", 2, 0) + b"ab"),
        rec(xls.NUMBER, here(0, 1) + struct.pack("<d", 2.5)),
        rec(xls.RK, here(0, 2) + whole(-7)),
        rec(xls.RK, here(0, 3) + struct.pack("<I", 12345 << 2 | 3)),
        rec(xls.MULRK, struct.pack("<HH", 1, 0) + b"".join(struct.pack("<H", 0) + whole(x) for x in (4, 5)) + struct.pack("<H", 1)),
        rec(xls.RK, here(1, 2) + struct.pack("<I", struct.unpack("<Q", struct.pack("<d", 0.5))[0] >> 32)),
        rec(xls.BOOLERR, here(1, 3) + b"\x01\x00"),
        rec(xls.BOOLERR, here(2, 0) + b"\x07\x01"),
        rec(xls.FORMULA, here(2, 1) + struct.pack("<d", 9.0) + bytes(8)),
        rec(xls.FORMULA, here(2, 2) + b"\x00\0\0\0\0\0\xff\xff" + bytes(8)),
        rec(xls.STRING, struct.pack("<HB", 3, 0) + b"sum"),
        rec(xls.FORMULA, here(2, 3) + b"\x01\0\x01\0\0\0\xff\xff" + bytes(8)),
    ]
    assert [r[2] for r in files.xls_rows(book(*cells))] == [["ab", "2.5", "-7", "123.45"], ["4", "5", "0.5", "TRUE"], ["#DIV/0!", "9", "sum", "TRUE"]]


def test_what_cannot_be_read(spark):
    data = {"locked": book(more=rec(xls.FILEPASS, b"\0\0")), "cut": binary_workbook([["a", "b"]] * 900, "A1:A1")[:700], "sign": xls.SIGN, "none": b"text"}
    df = spark.createDataFrame(list(data.items()), "path string, content binary").withColumn("extension", F.lit("xls"))
    got = {r["path"]: r["error"] for r in files.workbooks(files.routed(df)).collect()}
    assert set(got) == set(data) and all(got.values()) and got["locked"] == "ValueError: encrypted"
