"""Cells of binary workbooks (records of the eighth version in a compound file) with the standard library."""

from __future__ import annotations

import struct
from collections.abc import Iterator

SIGN = bytes.fromhex("D0CF11E0A1B11AE1")
_LAST = 0xFFFFFFFC  # numbers from here on are no sectors

# Numbers of records.
FORMULA, EOF, FILEPASS, CONTINUE, BOUNDSHEET, MULRK, MERGED, SST, LABELSST = 0x0006, 0x000A, 0x002F, 0x003C, 0x0085, 0x00BD, 0x00E5, 0x00FC, 0x00FD
NUMBER, LABEL, BOOLERR, STRING, RK, BOF = 0x0203, 0x0204, 0x0205, 0x0207, 0x027E, 0x0809
ERRORS = {0: "#NULL!", 7: "#DIV/0!", 15: "#VALUE!", 23: "#REF!", 29: "#NAME?", 36: "#NUM!", 42: "#N/A"}


def stream(data: bytes, names: tuple[str, ...]) -> bytes:
    """The first stream of a compound file that has one of the names."""
    if not data.startswith(SIGN):
        raise ValueError("no compound file")
    shift, mini_shift = struct.unpack_from("<HH", data, 30)
    first_dir, _, cutoff, first_mini, _, first_more, _ = struct.unpack_from("<7I", data, 48)
    size = 1 << shift
    sector = lambda n: data[(n + 1) * size : (n + 2) * size]
    numbers = lambda b: list(struct.unpack(f"<{len(b) // 4}I", b[: len(b) // 4 * 4]))
    listed, more, seen = list(struct.unpack_from("<109I", data, 76)), first_more, set()
    while more < _LAST and more not in seen:
        seen.add(more)
        *rest, after = numbers(sector(more))
        listed += rest
        more = after
    table = [x for n in listed if n < _LAST for x in numbers(sector(n))]

    def chain(start: int, next_: list[int], part) -> bytes:
        out, done = [], 0
        while start < _LAST:
            if start >= len(next_) or done > len(next_):
                raise ValueError("a chain of sectors that doesn't end")
            out.append(part(start))
            start, done = next_[start], done + 1
        return b"".join(out)

    folder = chain(first_dir, table, sector)
    entries = {}
    for i in range(0, len(folder) - 127, 128):
        e = folder[i : i + 128]
        entries.setdefault(e[: max(0, struct.unpack_from("<H", e, 64)[0] - 2)].decode("utf-16-le", "ignore"), (e[66], *struct.unpack_from("<II", e, 116)))
    found = next((entries[n] for n in names if n in entries), None)
    if not found:
        raise ValueError("no workbook inside")
    _, start, length = found
    if length >= cutoff:
        return chain(start, table, sector)[:length]
    small_sectors = chain(next(s for t, s, _ in entries.values() if t == 5), table, sector)
    mini = 1 << mini_shift
    return chain(start, numbers(chain(first_mini, table, sector)), lambda n: small_sectors[n * mini : (n + 1) * mini])[:length]


def records(book: bytes, at: int) -> Iterator[tuple[int, list[bytes]]]:
    """(number, parts) of the records from a place to the end of their part of the workbook; the first part, then those that continue it."""
    depth, held = 0, None
    while at + 4 <= len(book):
        number, length = struct.unpack_from("<HH", book, at)
        body = book[at + 4 : at + 4 + length]
        at += 4 + length
        if number == CONTINUE and held:
            held[1].append(body)
            continue
        if held:
            yield held
        held = number, [body]
        depth += (number == BOF) - (number == EOF)
        if number == EOF and depth <= 0:
            break
    if held:
        yield held


class _Parts:
    """Reads on over the parts of a record."""

    def __init__(self, parts: list[bytes], part: int = 0, at: int = 0):
        self.parts, self.part, self.at = parts, part, at

    def take(self, n: int) -> bytes:
        out = b""
        while n:
            if self.part >= len(self.parts):
                raise ValueError("a record that is cut off")
            got = self.parts[self.part][self.at : self.at + n]
            out, n, self.at = out + got, n - len(got), self.at + len(got)
            if n:
                self.part, self.at = self.part + 1, 0
        return out

    def text(self, count: int) -> str:
        """A text of `count` letters with its flags; letters that go on in a new part begin with flags again."""
        flags = self.take(1)[0]
        runs = struct.unpack("<H", self.take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", self.take(4))[0] if flags & 4 else 0
        out, wide = [], flags & 1
        while count:
            if self.at >= len(self.parts[self.part]):
                self.part, self.at = self.part + 1, 0
                wide = self.take(1)[0] & 1
            n = min(count, (len(self.parts[self.part]) - self.at) // (1 + wide))
            if not n:
                raise ValueError("a text that is cut off")
            out.append(self.take(n * (1 + wide)).decode("utf-16-le" if wide else "latin-1", "surrogatepass" if wide else "strict"))
            count -= n
        self.take(4 * runs + extra)
        return "".join(out).encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")  # a pair of surrogates may be parted


def _number(value: float) -> str:
    return str(int(value)) if value == value and abs(value) < 1e300 and value == int(value) else repr(value)


def _packed(rk: int) -> float:
    """A number in 30 bits: whole or the high bits of a double, perhaps a hundredfold."""
    value = float(rk >> 2 if rk < 1 << 31 else (rk >> 2) - (1 << 30)) if rk & 2 else struct.unpack("<d", struct.pack("<Q", (rk & 0xFFFFFFFC) << 32))[0]
    return value / 100 if rk & 1 else value


def xls_cells(data: bytes) -> Iterator[tuple[str, dict[tuple[int, int], str], list[tuple[int, int, int, int]]]]:
    """(sheet, text by row and column from 1, merged rectangles as top, left, bottom, right) of each sheet of cells."""
    book = stream(data, ("Workbook", "Book"))
    shared, sheets = [], []
    for number, parts in records(book, 0):
        if number == FILEPASS:
            raise ValueError("encrypted")
        if number == BOF and struct.unpack_from("<H", parts[0])[0] != 0x0600:
            raise ValueError("a workbook of an older version")
        if number == SST:
            r, count = _Parts(parts, at=8), struct.unpack_from("<I", parts[0], 4)[0]
            shared = [r.text(struct.unpack("<H", r.take(2))[0]) for _ in range(count)]
        elif number == BOUNDSHEET and parts[0][5] == 0:
            sheets.append((_Parts(parts, at=7).text(parts[0][6]), struct.unpack_from("<I", parts[0])[0]))
    for name, place in sheets:
        cells, merged, waiting = {}, [], None
        for number, parts in records(book, place):
            b = parts[0]
            if number in (LABELSST, NUMBER, RK, MULRK, LABEL, FORMULA, BOOLERR):
                row, col = struct.unpack_from("<HH", b)
                here = row + 1, col + 1
            if number == LABELSST:
                cells[here] = shared[struct.unpack_from("<I", b, 6)[0]]
            elif number == LABEL:
                cells[here] = _Parts(parts, at=8).text(struct.unpack_from("<H", b, 6)[0])
            elif number == NUMBER:
                cells[here] = _number(struct.unpack_from("<d", b, 6)[0])
            elif number == RK:
                cells[here] = _number(_packed(struct.unpack_from("<I", b, 6)[0]))
            elif number == MULRK:
                for i in range((len(b) - 6) // 6):
                    cells[row + 1, col + 1 + i] = _number(_packed(struct.unpack_from("<I", b, 6 + 6 * i)[0]))
            elif number == BOOLERR:
                cells[here] = ERRORS.get(b[6], "#N/A") if b[7] else ("TRUE" if b[6] else "FALSE")
            elif number == FORMULA:
                if b[12:14] != b"\xff\xff":
                    cells[here] = _number(struct.unpack_from("<d", b, 6)[0])
                elif b[6] == 0:
                    waiting = here
                elif b[6] in (1, 2):
                    cells[here] = ("TRUE" if b[8] else "FALSE") if b[6] == 1 else ERRORS.get(b[8], "#N/A")
            elif number == STRING and waiting:
                cells[waiting], waiting = _Parts(parts, at=2).text(struct.unpack_from("<H", b)[0]), None
            elif number == MERGED:
                for i in range(struct.unpack_from("<H", b)[0]):
                    top, bottom, left, right = struct.unpack_from("<4H", b, 2 + 8 * i)
                    merged.append((top + 1, left + 1, bottom + 1, right + 1))
        yield name, cells, merged
