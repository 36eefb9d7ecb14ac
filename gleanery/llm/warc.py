"""WARC archives: a writer, a normaliser of whole-file gzip streams, and a reader by offset.

An archive that is one gzip stream can only be read from its start. The normaliser inflates such a file once, rewrites
every record as a gzip member of its own, and writes a sidecar index of offsets, by which any record is read alone.
Archives are files in the shared folder. A task names its files after its attempt and returns what it wrote; only files
in the table of a finished job are read on, so a lost executor or a second attempt leaves no trace in the results.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, bounded, drop_path, prepare, scratch_path, table, tidy

#: Uncompressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
#: Equal payloads of fewer bytes are not revisits.
LEAST_BYTES = 100
LEVEL = 5
_BLOCK = 1 << 20
_GZIP = 31
_DATE = "2020-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    where, path = pafs.FileSystem.from_uri(uri)
    where.create_dir(path, recursive=True)
    return where, path


def _line(text: object) -> str:
    """A header's value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(text))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return ("\r\n".join([*head, f"Content-Length: {len(body)}"]) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


class Inflated:
    """Reads of a gzip file, of one member or many, block by block."""

    def __init__(self, raw):
        self.raw, self.z, self.held, self.started = raw, zlib.decompressobj(_GZIP), bytearray(), False

    def more(self) -> bool:
        if self.z.eof and self.z.unused_data:
            rest, self.z = self.z.unused_data, zlib.decompressobj(_GZIP)
        else:
            rest = self.z.unconsumed_tail or self.raw.read(_BLOCK)
            if not rest:
                if not self.z.eof and self.started:
                    raise ValueError("the gzip stream ends early")
                return False
            if self.z.eof:
                self.z = zlib.decompressobj(_GZIP)
        self.started = True
        self.held += self.z.decompress(rest, _BLOCK)
        return True

    def until(self, end: bytes) -> bytes | None:
        """Up to and with `end`; None at the end of the file."""
        seen = 0
        while (at := self.held.find(end, max(0, seen - len(end)))) < 0:
            seen = len(self.held)
            if not self.more():
                if bytes(self.held).strip(b"\r\n"):
                    raise ValueError("a record's header ends early")
                return None
        out = bytes(self.held[: at + len(end)])
        del self.held[: at + len(end)]
        return out

    def blocks(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("a record ends early")
            part = bytes(self.held[:n])
            del self.held[: len(part)]
            n -= len(part)
            if part:
                yield part


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def normalise(raw, out, level: int = LEVEL) -> Iterator[dict]:
    """Rewrites the records of one gzip stream as members of their own; yields offset, length and header fields of each. Memory is bounded by a block, not by a record."""
    source, offset = Inflated(raw), 0
    while (head := source.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        if not head:
            continue
        fields = headers(head)
        z, length = zlib.compressobj(level, zlib.DEFLATED, _GZIP), 0
        length += _write(out, z.compress(head))
        for part in source.blocks(int(fields["content-length"])):
            length += _write(out, z.compress(part))
        length += _write(out, z.compress(b"\r\n\r\n") + z.flush())
        yield {"offset": offset, "length": length, "id": fields.get("warc-record-id"), "type": fields.get("warc-type"), "uri": fields.get("warc-target-uri")}
        offset += length


def _write(out, data: bytes) -> int:
    out.write(data)
    return len(data)


def read_record(raw, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """(header fields, block) of the record of one member."""
    raw.seek(offset)
    data = zlib.decompress(raw.read(length), _GZIP)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = headers(head)
    return fields, rest[: int(fields["content-length"])]


def first_copies(pages: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(digest, first_id) of the payloads of LEAST_BYTES or more that several rows have, and their number. Rows with ids and digests alone are counted, before any shuffle as far as possible."""
    many = pages.where(F.col("bytes") >= LEAST_BYTES).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first_id")).where("n > 1 AND first_id IS NOT NULL")
    out = scratch.keep(many.select("digest", "first_id"), "copies")
    return out, out.count()


def write_archives(pages: DataFrame, folder: str, level: int = LEVEL, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(path, records) of the archives, each one gzip stream, of pages(page_id, url, payload, digest, refers_to). Materialise it once: each run writes files."""

    def run(batches):
        from pyspark import TaskContext

        where, at = _open_folder(folder)
        task, n, state = TaskContext.get(), 0, None
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"

        def close():
            out, z, path, records, _ = state
            out.write(z.flush())
            out.close()
            return pa.record_batch([pa.array([path], pa.string()), pa.array([records], pa.int64())], ["path", "records"])

        for b in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if state is None:
                    path = f"{name}-{n:04d}.warc.gz"
                    state, n = [where.open_output_stream(f"{at}/{path}", compression=None), zlib.compressobj(level, zlib.DEFLATED, _GZIP), path, 0, 0], n + 1
                data = record(page_id, url, payload or b"", digest, refers_to)
                state[0].write(state[1].compress(data))
                state[3] += 1
                state[4] += len(data)
                if state[4] >= archive_bytes:
                    yield close()
                    state = None
        if state is not None:
            yield close()

    prepare(pages.sparkSession)
    return pages.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(tidy(run), "path string, records long")


def normalise_archives(archives: DataFrame, source: str, folder: str, level: int = LEVEL) -> DataFrame:
    """(path, records) of the rewritten archives: for each file of archives(path) in `source`, one in `folder` with a member for each record, and <path>.index beside it, a line of JSON a record. Materialise it once."""

    def run(batches):
        from pyspark import TaskContext

        given, at = _open_folder(source)
        where, to = _open_folder(folder)
        attempt = TaskContext.get().taskAttemptId()
        for b in batches:
            for path in b.column(0).to_pylist():
                name, n = path.replace(".warc.gz", f"-{attempt}.warc.gz"), 0
                with given.open_input_stream(f"{at}/{path}", compression=None) as raw, where.open_output_stream(f"{to}/{name}", compression=None) as out, where.open_output_stream(f"{to}/{name}.index", compression=None) as index:
                    for entry in normalise(raw, out, level):
                        index.write(json.dumps(entry).encode() + b"\n")
                        n += 1
                yield pa.record_batch([pa.array([name], pa.string()), pa.array([n], pa.int64())], ["path", "records"])

    return archives.select("path").mapInArrow(tidy(run), "path string, records long")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, archive, offset) of every record, each read by its offset in the index. A response's digest is that of the payload as read, and must be its header's."""

    def run(batches):
        where, at = _open_folder(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                with where.open_input_stream(f"{at}/{path}.index", compression=None) as index:
                    entries = [json.loads(x) for x in index.read().splitlines()]
                with where.open_input_file(f"{at}/{path}") as raw:
                    for e in entries:
                        fields, block = read_record(raw, e["offset"], e["length"])
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = fields["warc-payload-digest"].removeprefix("sha256:")
                        refers_to = fields.get("warc-refers-to")
                        if refers_to is None:
                            size, own = len(payload), hashlib.sha256(payload).hexdigest()
                            if own != digest:
                                raise ValueError(f"{path}, {e['offset']}: the payload's digest is {own}, not {digest}")
                        else:
                            size = int(http.rpartition(b"Content-Length: ")[2])
                        rows.append((_id(fields["warc-record-id"]), size, digest, fields["warc-type"], _id(refers_to), path, e["offset"]))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 7, kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset"])

    return archives.select("path").mapInArrow(tidy(run), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long")


def _id(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() else None


def _spread(archives: DataFrame) -> DataFrame:
    return archives.repartition(min(10_000, max(1, archives.count())))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """What read_archives() gives after all rows were written as whole-file streams and normalised.

    Of rows with equal payloads of LEAST_BYTES bytes or more, those with the smallest id are responses and the others
    revisit it; a row without an id is a revisit if any has one. A null payload is empty, a null url is left out;
    repeated rows give a record each; an empty table gives an empty result; other columns are ignored.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    copies, n = first_copies(rows.select("page_id", "digest", "bytes"), scratch)
    first = F.when((F.col("bytes") >= LEAST_BYTES) & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    told = rows.join(bounded(copies, n), "digest", "left").withColumn("refers_to", first)
    raw, clean = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    whole = scratch.keep(write_archives(told, raw), "archives")
    parts = scratch.keep(normalise_archives(_spread(whole), raw, clean), "archives")
    drop_path(spark, raw)
    scratch.drop(whole, copies)
    return read_archives(_spread(parts), clean)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).drop("archive", "offset")


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS payload_bytes, sha256(t) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f
"""
