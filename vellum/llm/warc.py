"""WARC archives: a PySpark Python data source that reads and writes them.

Writing: rows (id or record_id, uri, payload, sha, refers_to), sha being the payload's SHA-1, become WARC/1.1 records, each its own gzip
member: a response with the payload, or a revisit (identical-payload-digest) without it, where refers_to names another row. A member's
gzip header holds its lengths (the extra field `sl` that the WARC standard describes), so it can be passed over. Each task writes
files of up to FILE_BYTES to a folder that all executors reach, under names of their own; only files named in a commit's
manifest are read, so repeated or lost attempts leave no records. Each append has its own manifest, and all are read; an
overwrite takes the place of those before it.

Reading: a folder written so, any folder of .warc and .warc.gz files, or one file. A partition is a file, or a run of small
ones. Predicates on record_type and on the other header columns (equality, IN, comparisons, null tests) are pushed down: each record's
headers are parsed first, and only the records that pass are decoded further, and only if the payload is asked for; else the
rest of the member is not even inflated, where its length is known, and inflated and dropped where it isn't. A file that ends inside a
record, or whose checksum is wrong in what is read whole, fails the read.

Columns: record_id, refers_to_id and uri are strings as they stand in the record; id and refers_to are the numbers in those that
this source wrote, null for others. The payload is the record's block, with its HTTP head if it has one. Nulls: a null payload is
empty; a null id or uri is left out of the headers and reads as null. URIs with characters that a header can't hold are
percent-encoded, and marked as such by a header of their own. Empty payloads are records like others. Repeated ids stay
repeated records. An empty table writes a manifest without files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, IsNotNull, IsNull, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, WriterCommitMessage

from . import common as C
from .components import join_least

FILE_BYTES = 256 << 20
READ_BYTES = 4 << 20
MANIFEST = "manifest-"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "record_id string, id bigint, uri string, record_type string, digest string, refers_to_id string, refers_to bigint, date string, content_type string, payload_bytes bigint, payload binary"
TYPES = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
MOST_HEADERS = 1 << 20


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    fs, inner = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs, inner


def _urn(row_id: int | str) -> str:
    return row_id if isinstance(row_id, str) else f"<urn:vellum:{row_id}>"


def _number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:vellum:(-?\d{1,19})>", urn or "")
    return int(found[1]) if found else None


def record(row_id: int | str | None, uri: str | None, payload: bytes, digest: str, refers_to: int | str | None) -> bytes:
    """One record, uncompressed. Header values hold printable ASCII."""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    if row_id is not None:
        lines.append(f"WARC-Record-ID: {_urn(row_id)}")
    if uri is not None:
        plain = re.fullmatch(r"[!-~]*", uri)
        lines.append("WARC-Target-URI: " + (uri if plain else "".join(f"%{b:02X}" if not 33 <= b < 127 or b == 37 else chr(b) for b in uri.encode())))
        lines += [] if plain else ["X-Target-URI-Encoding: percent"]
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
        payload = b""
    lines += ["Content-Type: application/octet-stream", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(lines).encode("ascii") + payload + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member with its lengths, compressed and not, in the extra field `sl`; without it, if they don't fit."""
    pack = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    size = 10 + 2 + 12 + len(body) + 8
    if max(size, len(data)) >> 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\0\xff" + body + tail
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data)) + body + tail


def header_row(lines: list[bytes]) -> dict:
    """The header columns of a record."""
    joined: list[str] = []
    for x in (line.decode("utf-8", "replace") for line in lines[1:]):
        if x[:1] in (" ", "\t") and joined:  # a folded line
            joined[-1] += " " + x.strip()
        else:
            joined.append(x)
    found = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in joined)}
    uri = found.get("warc-target-uri")
    if uri is not None and found.get("x-target-uri-encoding") == "percent":
        uri = re.sub(rb"%([0-9A-F]{2})", lambda m: bytes([int(m[1], 16)]), uri.encode()).decode()
    digest = found.get("warc-payload-digest")
    length = int(found["content-length"])
    record_id, refers = found.get("warc-record-id"), found.get("warc-refers-to")
    return {
        "record_id": record_id, "id": _number(record_id), "uri": uri, "record_type": found.get("warc-type"), "digest": digest and digest.removeprefix("sha1:"),
        "refers_to_id": refers, "refers_to": _number(refers), "date": found.get("warc-date"), "content_type": found.get("content-type"),
        "payload_bytes": int(found.get("x-payload-length", length)), "length": length,
    }


class _Stream:
    """The decoded bytes of a file of gzip members, or of plain records, read forward."""

    WINDOW = 1 << 16

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, self.size = file, file.size()
        self.at, self.base, self.window = 0, 0, b""
        self.buffer = b""
        self.inflate = self.end = self.left = None  # of the member at hand: its end in the file, and decoded bytes not used yet
        self.zipped = self._raw(2) == b"\x1f\x8b"

    def _raw(self, n: int) -> bytes:
        """Up to n bytes of the file, from self.at on."""
        lo = self.at - self.base
        if not 0 <= lo < len(self.window):
            self.file.seek(min(self.at, self.size))
            self.base, self.window, lo = self.at, self.file.read(max(n, self.WINDOW)), 0
        return self.window[lo : lo + n]

    def _exact(self, n: int) -> bytes:
        out = b""
        while len(out) < n:
            part = self._raw(n - len(out))
            if not part:
                raise ValueError("the file ends inside a gzip member")
            out += part
            self.at += len(part)
        return out

    def _begin(self) -> None:
        start, head = self.at, self._exact(10)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {start}")
        self.end = self.left = None
        if head[3] & 4:
            extra = self._exact(struct.unpack("<H", self._exact(2))[0])
            while len(extra) >= 4:
                name, size = struct.unpack("<2sH", extra[:4])
                if name == b"sl" and size == 8 and not self.buffer:
                    size_, self.left = struct.unpack("<II", extra[4:12])
                    self.end = start + size_
                extra = extra[4 + size :]
        for flag in (8, 16):  # name, comment
            while head[3] & flag and self._exact(1) != b"\0":
                pass
        if head[3] & 2:
            self._exact(2)
        self.inflate, self.check, self.step = zlib.decompressobj(-15), 0, 1 << 11

    def _more(self) -> bool:
        if not self.zipped:
            data = self._raw(1 << 20)
            self.at += len(data)
            self.buffer += data
            return bool(data)
        if self.inflate is None:
            if self.at >= self.size:
                return False
            self._begin()
        data = self._raw(self.step)
        if not data:
            raise ValueError("the file ends inside a gzip member")
        out = self.inflate.decompress(data, 4 << 20)
        self.at += len(data) - len(self.inflate.unconsumed_tail) - len(self.inflate.unused_data)
        self.step = self.WINDOW
        self.check = zlib.crc32(out, self.check)
        self.buffer += out
        if self.inflate.eof:
            self.inflate = None
            if struct.unpack("<I", self._exact(8)[:4])[0] != self.check:
                raise ValueError("a gzip member's checksum is wrong")
        return True

    def _used(self, n: int) -> None:
        if self.zipped and self.left is not None:
            self.left -= n

    def headers(self) -> list[bytes] | None:
        """The next record's header lines; none at the end."""
        seen = 0
        while True:
            text = self.buffer.lstrip(b"\r\n")
            self._used(len(self.buffer) - len(text))
            self.buffer = text
            end = text.find(b"\r\n\r\n", max(0, seen - 3))
            if end >= 0:
                break
            seen = len(text)
            if seen > MOST_HEADERS:
                raise ValueError("no end of a record's headers")
            if not self._more():
                if self.buffer.strip(b"\r\n"):
                    raise ValueError("the file ends inside a record's headers")
                return None
        self.buffer = text[end + 4 :]
        self._used(end + 4)
        if not text.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        return text[:end].split(b"\r\n")

    def take(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            if not self.buffer and not self._more():
                raise ValueError("the file ends inside a record")
            parts.append(self.buffer[: n - have])
            self.buffer = self.buffer[n - have :]
            have += len(parts[-1])
        self._used(n)
        return b"".join(parts)

    def skip(self, n: int) -> None:
        """Passes n bytes: by their place, if plain or if the member ends with them."""
        if self.zipped and self.left == n and self.end is not None and (self.inflate is not None or len(self.buffer) == n):
            if self.end > self.size:
                raise ValueError("the file ends inside a record")
            self.buffer, self.inflate, self.at = b"", None, self.end
            return
        if not self.zipped and n > len(self.buffer):
            self.at += n - len(self.buffer)
            self.buffer = b""
            if self.at > self.size:
                raise ValueError("the file ends inside a record")
            return
        while n > len(self.buffer):
            n -= len(self.buffer)
            self._used(len(self.buffer))
            self.buffer = b""
            if not self._more():
                raise ValueError("the file ends inside a record")
        self.buffer = self.buffer[n:]
        self._used(n)


@dataclass
class _Files(InputPartition):
    names: tuple[str, ...]


@dataclass
class _Written(WriterCommitMessage):
    files: tuple[tuple[str, int], ...]


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path.rstrip("/"), overwrite

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        fs, inner = _open(self.path)
        files: list[tuple[str, int]] = []
        name, out, size = "", None, 0
        for row in iterator:
            if out is None or size >= FILE_BYTES:
                if out is not None:
                    out.close()
                    files.append((name, size))
                name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                out = fs.open_output_stream(f"{inner}/{name}", compression=None)
            row_id = row["record_id"] if "record_id" in row.__fields__ else row["id"]
            data = member(record(row_id, row["uri"], bytes(row["payload"] or b""), base64.b32encode(row["sha"]).decode(), row["refers_to"]))
            out.write(data)
            size += len(data)
        if out is not None:
            out.close()
            files.append((name, size))
        return _Written(tuple(files))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, inner = _open(self.path)
        fs.create_dir(inner, recursive=True)
        old = manifests(fs, inner) if self.overwrite else []
        named = [f for m in messages if m for f in m.files]
        gone = [f for path in old for f, _ in listed(fs, path)]
        with fs.open_output_stream(f"{inner}/{MANIFEST}{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(named).encode())
        for path in [*old, *(f"{inner}/{f}" for f in gone)]:
            fs.delete_file(path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, inner = _open(self.path)
        for m in messages:
            for name, _ in m.files if m else ():
                fs.delete_file(f"{inner}/{name}")


def manifests(fs: pafs.FileSystem, inner: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    return [f.path for f in found if f.base_name.startswith(MANIFEST) and f.base_name.endswith(".json")]


def listed(fs: pafs.FileSystem, manifest: str) -> list[tuple[str, int]]:
    with fs.open_input_stream(manifest, compression=None) as raw:
        return [(name, size) for name, size in json.loads(raw.read())]


_TESTS = {
    EqualTo: lambda v, f: v is not None and v == f.value, In: lambda v, f: v is not None and v in f.value, IsNull: lambda v, f: v is None, IsNotNull: lambda v, f: v is not None,
    GreaterThan: lambda v, f: v is not None and v > f.value, GreaterThanOrEqual: lambda v, f: v is not None and v >= f.value,
    LessThan: lambda v, f: v is not None and v < f.value, LessThanOrEqual: lambda v, f: v is not None and v <= f.value,
}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]) -> None:
        self.path, self.columns, self.filters = path.rstrip("/"), columns, []

    def pushFilters(self, filters):  # noqa: N802
        """Takes every predicate on a header column; yields those that Spark must apply itself."""
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] != "payload":
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, inner = _open(self.path)
        if fs.get_file_info(inner).type == pafs.FileType.File:
            return [_Files((inner,))]
        if found := manifests(fs, inner):
            files = [(f"{inner}/{name}", size) for m in found for name, size in listed(fs, m)]
        else:
            every = fs.get_file_info(pafs.FileSelector(inner, recursive=True))
            files = [(f.path, f.size) for f in every if f.type == pafs.FileType.File and f.base_name.endswith((".warc", ".warc.gz"))]
        out: list[InputPartition] = []
        group, held = [], 0
        for name, size in sorted(files, key=lambda f: (f[1], f[0])):
            if group and held + size > READ_BYTES:
                out.append(_Files(tuple(group)))
                group, held = [], 0
            group.append(name)
            held += size
        return out + [_Files(tuple(group))]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        wants = "payload" in self.columns
        kinds = dict(x.split() for x in SCHEMA.split(", "))
        tests = [(f.attribute[0], _TESTS[type(f)], f) for f in self.filters]
        rows: dict[str, list] = {c: [] for c in self.columns}
        held = count = 0

        def flush() -> pa.RecordBatch:
            nonlocal rows, held, count
            out = pa.RecordBatch.from_arrays([pa.array(v, TYPES[kinds[c]]) for c, v in rows.items()], names=list(rows))
            rows, held, count = {c: [] for c in self.columns}, 0, 0
            return out

        for name in partition.names:
            with fs.open_input_file(name) as raw:
                try:
                    stream = _Stream(raw)
                    while (lines := stream.headers()) is not None:
                        row = header_row(lines)
                        length = row.pop("length")
                        good = all(test(row[c], f) for c, test, f in tests)
                        if good and wants:
                            row["payload"] = stream.take(length)
                            stream.skip(4)
                            held += length
                        else:
                            stream.skip(length + 4)
                        if not good:
                            continue
                        for c in self.columns:
                            rows[c].append(row[c])
                        count += 1
                        if held > 8 << 20 or count >= 10_000:
                            yield flush()
                except (ValueError, KeyError, zlib.error) as e:
                    raise ValueError(f"{name}: {type(e).__name__}: {e}") from e
        if count:
            yield flush()


class WarcSource(DataSource):
    """Format "warc": load(path) and save(path); option columns lists the columns to read, all by default."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        wanted = self.options.get("columns")
        every = [x.strip() for x in SCHEMA.split(",")]
        return ", ".join(x for x in every if not wanted or x.split()[0] in [c.strip() for c in wanted.split(",")])

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], [f.name for f in schema.fields])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        fs, inner = _open(self.options["path"])
        fs.create_dir(inner, recursive=True)
        return WarcWriter(self.options["path"], overwrite)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_revisits(df: DataFrame, id_col: str, uri_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """Rows to write: of rows with equal payloads of at least least_bytes, that with the largest id is a response
    (the rows with it, if the id repeats), the others refer to it; smaller ones are all responses. The rows of a payload that
    many share are salted."""
    text = df.schema[payload_col].dataType.typeName() == "string"
    payload = F.col(f"`{payload_col}`")
    row_id, body = F.col(f"`{id_col}`").cast("bigint"), F.coalesce(F.encode(payload, "UTF-8") if text else payload, F.lit(b""))
    sha = F.unhex(F.sha1("payload"))
    slim = df.select(row_id.alias("id"), body.alias("payload")).where(F.octet_length("payload") >= least_bytes).select("id", sha.alias("sha"))
    last = slim.groupBy("sha").agg(F.max("id").alias("m"), F.count("*").alias("n"))
    rows = df.select(row_id.alias("id"), F.col(f"`{uri_col}`").cast("string").alias("uri"), body.alias("payload")).withColumn("sha", sha)
    large = join_least(rows.where(F.octet_length("payload") >= least_bytes), last, "sha", df.count())
    out = large.select("id", "uri", "payload", "sha", F.when(F.col("id") < F.col("m"), F.col("m")).alias("refers_to"))
    if not least_bytes:
        return out
    return out.unionByName(rows.where(F.octet_length("payload") < least_bytes).withColumn("refers_to", F.lit(None).cast("bigint")))


def op4_warc(spark, sf_dir: str) -> DataFrame:
    register(spark)
    path = C.fresh_path(spark, "warc")
    with_revisits(C.table(spark, sf_dir, "pages"), "page_id", "url", "html").write.format("warc").mode("append").save(path)

    @C.lean
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digest and length of the payloads that were read."""
        for batch in batches:
            found = [(len(p), digest(p)) for p in batch.column("payload").to_pylist()]
            size, sha = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(size, pa.int64()), pa.array(sha, pa.string())], names=["page_id", "payload_bytes", "payload_digest"])

    read = lambda kind, columns: spark.read.format("warc").option("columns", columns).load(path).where(F.col("record_type") == kind)
    whole = read("response", "id,record_type,payload").select(F.col("id").alias("page_id"), "payload")
    whole = whole.mapInArrow(checked, "page_id bigint, payload_bytes bigint, payload_digest string").select("*", F.lit("response").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to"))
    again = read("revisit", "id,record_type,digest,refers_to,payload_bytes")  # of a revisit, what its headers say
    return whole.unionByName(again.select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"))
