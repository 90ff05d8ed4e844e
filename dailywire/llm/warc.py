"""WARC archives as a Spark data source, and the deduplicating export of pages.

Reading takes any ``*.warc`` and ``*.warc.gz`` in a folder: records are stepped over by their Content-Length,
in plain files and in gzip files with a member per record or fewer. The archives written here have
one gzip member per record with the record's compressed length in the header's extra field, a hint by
which a reader steps over a record without inflating it. The reader plans one partition per file, takes
predicates on the record type and on headers, reads the head of a record first to judge it, and keeps
the payload only of records that pass, unless the option ``payload`` is ``false``.

``write`` rolls to a new file every ``roll`` bytes. Each commit lists its files in a manifest of its own, so
appends add up and files of failed task attempts are not read; ``overwrite`` removes the archives and
manifests that were there. Files that were not written here need no manifest.

    spark.dataSource.register(WarcSource)
    spark.read.format("warc").load(folder).where("record_type = 'response'")

Export: of pages with equal payloads of at least ``least`` bytes the one with the smallest page_id is
a response record, the others are revisit records that refer to it and carry no payload.

Defined cases: null html is an empty payload; a page without id is a response, and none refers to it;
rows that repeat a page_id with the same payload are all responses if it is the smallest; null url
gives no target header; an empty table gives an empty archive. Other columns are ignored. Of foreign records,
page_id and refers_to are null, payload_bytes is the payload's length (null while an HTTP payload is not
read), and the payload of an ``application/http`` block is what follows its HTTP head.
"""

from __future__ import annotations

import datetime
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

LEAST = 100
ROLL = 64 << 20
HEAD = 4096
#: Records of one batch, and payload bytes after which it is handed on.
BATCH, BATCH_BYTES = 512, 8 << 20

SCHEMA = "record_type string, page_id long, target_uri string, payload_digest string, payload_bytes long, refers_to long, record_id string, warc_date string, payload binary"
_COLUMNS = [x.split()[0] for x in SCHEMA.split(", ")]
_KINDS = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
#: Column -> header that holds it.
_HEADERS = {"record_type": "WARC-Type", "page_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length", "refers_to": "WARC-Refers-To", "record_id": "WARC-Record-ID", "warc_date": "WARC-Date"}
_MANIFEST, _OWN = "_files-", "part-"
#: Bytes of a record's head, at most.
LONGEST_HEAD = 1 << 20


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _urn(page_id) -> str:
    return f"<urn:page:{page_id}>"


def _quoted(text: str) -> str:
    """A header value on one line."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unquoted(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def encode_record(row: dict) -> bytes:
    """One gzip member: the record, its compressed and full length in the extra field 'sl'."""
    body = row["payload"] if row["record_type"] == "response" and row["payload"] is not None else b""
    now = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    name = f"<urn:uuid:{uuid.uuid4()}>" if row["page_id"] is None else _urn(row["page_id"])
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {name}", f"WARC-Date: {row.get('warc_date') or now}"]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_quoted(row['target_uri'])}")
    lines += [f"WARC-Payload-Digest: sha256:{row['payload_digest']}", f"X-Payload-Length: {row['payload_bytes']}"]
    if row["refers_to"] is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(row['refers_to'])}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    record = "\r\n".join(lines).encode() + body + b"\r\n\r\n"
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    packed = deflate.compress(record) + deflate.flush()
    total = 10 + 2 + 4 + 16 + len(packed) + 8
    extra = b"sl" + struct.pack("<HQQ", 16, total, len(record))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + packed + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _parse_head(head: bytes) -> dict:
    """The typed header columns, ``length`` (of the block) and ``http`` (the block is an HTTP message)."""
    fields: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if colon:
            last = name.strip().lower()
            fields[last] = value.strip()
    get = {column: fields.get(header.lower()) for column, header in _HEADERS.items()}

    def page(name: str | None) -> int | None:
        number = (name or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if name and name.startswith("<urn:page:") and number.lstrip("-").isdigit() else None

    length, digest, own = int(fields.get("content-length", 0)), get["payload_digest"], get["payload_bytes"]
    http = fields.get("content-type", "").lower().startswith("application/http")
    return get | {
        "page_id": page(get["page_id"]), "refers_to": page(get["refers_to"]), "target_uri": None if get["target_uri"] is None else _unquoted(get["target_uri"]) if own else get["target_uri"],
        "payload_digest": None if digest is None else digest.removeprefix("sha256:"), "payload_bytes": int(own) if own else None if http else length,
        "length": length, "http": http,
    }


class _Plain:
    """The bytes of a plain archive."""

    def __init__(self, stream):
        self.stream, self.held = stream, b""

    def _more(self) -> bytes:
        return self.stream.read(HEAD)

    def read(self, n: int) -> bytes:
        while len(self.held) < n and (more := self._more()):
            self.held += more
        out, self.held = self.held[:n], self.held[n:]
        return out

    def skip(self, n: int) -> None:
        if n > len(self.held):
            self.stream.seek(self.stream.tell() + n - len(self.held))
        self.held = self.held[n:]

    def head(self) -> bytes:
        """The record's head up to its blank line; empty at the end."""
        while True:
            self.held = self.held.lstrip(b"\r\n")
            end = self.held.find(b"\r\n\r\n")
            if end >= 0:
                out, self.held = self.held[:end], self.held[end + 4 :]
                return out
            if len(self.held) > LONGEST_HEAD:
                raise ValueError("not a WARC record: no end of its head")
            if not (more := self._more()):
                return b""
            self.held += more

    def next_record(self) -> None:
        """Called before a record's head."""

    def leave(self, n: int) -> None:
        """Step over what is left of the record, ``n`` bytes of its block."""
        self.skip(n)


class _Gzip(_Plain):
    """The bytes of a gzip archive, member after member."""

    def __init__(self, stream):
        super().__init__(stream)
        #: bytes read and not yet inflated, place in the file after them, and the hinted end of the member
        self.raw, self.at, self.inflate, self.end = b"", 0, None, None

    def _more(self) -> bytes:
        while True:
            if not self.raw:
                self.raw = self.stream.read(HEAD)
                self.at += len(self.raw)
                if not self.raw:
                    return b""
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
            out = self.inflate.decompress(self.raw, 1 << 20)
            self.raw = self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data, None
            if out:
                return out

    def read(self, n: int) -> bytes:
        parts, have = [self.held], len(self.held)
        while have < n and (more := self._more()):
            parts.append(more)
            have += len(more)
        whole = b"".join(parts)
        self.held = whole[n:]
        return whole[:n]

    def skip(self, n: int) -> None:
        while n > len(self.held):
            n -= len(self.held)
            self.held = self._more()
            if not self.held:
                return
        self.held = self.held[n:]

    def next_record(self) -> None:
        """Note where the next member begins, if this one has the length hint."""
        self.end = None
        if self.held.strip(b"\r\n") or self.inflate is not None:
            return
        while len(self.raw) < 32 and (more := self.stream.read(HEAD)):
            self.raw += more
            self.at += len(more)
        if self.raw[3:4] == b"\x04" and self.raw[10:16] == b"\x14\0sl\x10\0":
            self.end = self.at - len(self.raw) + struct.unpack("<Q", self.raw[16:24])[0]

    def leave(self, n: int) -> None:
        if self.end is None:
            self.skip(n)
            return
        self.stream.seek(self.end)
        self.raw, self.at, self.held, self.inflate = b"", self.end, b"", None


def read_records(stream, tests: dict[str, tuple], payload: bool, packed: bool = True) -> Iterator[dict]:
    """The records of one archive whose header columns pass ``tests`` (column -> allowed values)."""
    reader = _Gzip(stream) if packed else _Plain(stream)
    while True:
        reader.next_record()
        head = reader.head()
        if not head:
            return
        row = _parse_head(head)
        row["payload"] = None
        if any(row[c] not in allowed for c, allowed in tests.items()):
            reader.leave(row["length"])
            continue
        if payload and row["record_type"] != "revisit":
            body = reader.read(row["length"])
            if row["http"]:
                body = body.partition(b"\r\n\r\n")[2]
                row["payload_bytes"] = len(body)
            row["payload"] = body
            reader.leave(0)
        else:
            reader.leave(row["length"])
        yield row


def _listing(fs, base: str) -> tuple[list[str], set[str]]:
    """(archives in the folder, those that a manifest lists)."""
    from pyarrow import fs as pfs

    names = [f.base_name for f in fs.get_file_info(pfs.FileSelector(base)) if f.type == pfs.FileType.File]
    listed: set[str] = set()
    for name in names:
        if name.startswith(_MANIFEST):
            with fs.open_input_stream(f"{base}/{name}") as f:
                listed.update(json.loads(f.read()))
    return [n for n in names if n.endswith((".warc", ".warc.gz"))], listed


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, {}

    def pushFilters(self, filters):
        """Takes equality and membership tests of header columns; Spark keeps the others."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column not in _HEADERS:
                yield f
                continue
            allowed = {f.value} if isinstance(f, EqualTo) else set(f.value)
            allowed.discard(None)  # a test never holds for null
            self.tests[column] = tuple(allowed & set(self.tests.get(column, allowed)))

    def partitions(self):
        fs, base = _filesystem(self.path)
        names, listed = _listing(fs, base)
        return [_File(f"{base}/{n}") for n in sorted(names) if not n.startswith(_OWN) or n in listed] or [_File("")]

    def read(self, partition):
        if not partition.path:
            return
        fs, _ = _filesystem(self.path)
        rows, held = [], 0
        with fs.open_input_file(partition.path) as stream:
            for row in read_records(stream, self.tests, self.payload, partition.path.endswith(".gz")):
                rows.append(row)
                held += len(row["payload"] or b"")
                if len(rows) >= BATCH or held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(_COLUMNS, _KINDS, strict=True)], names=_COLUMNS)


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, roll: int, overwrite: bool):
        self.path, self.roll, self.overwrite = path, roll, overwrite

    def write(self, iterator):
        fs, base = _filesystem(self.path)
        fs.create_dir(base, recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    names.append(f"{_OWN}{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{base}/{names[-1]}", compression=None), 0
                record = encode_record(row)
                out.write(record)
                size += len(record)
                if size >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages):
        from pyarrow import fs as pfs

        fs, base = _filesystem(self.path)
        fs.create_dir(base, recursive=True)
        mine = sorted(n for m in messages if m is not None for n in m.names)
        former = [f.base_name for f in fs.get_file_info(pfs.FileSelector(base)) if f.type == pfs.FileType.File and f.base_name not in mine]
        with fs.open_output_stream(f"{base}/{_MANIFEST}{uuid.uuid4().hex}.json", compression=None) as f:
            f.write(json.dumps(mine).encode())
        if self.overwrite:
            # manifests first, so that no listed file is missing
            for name in sorted(former, key=lambda n: not n.startswith(_MANIFEST)):
                if name.startswith(_MANIFEST) or name.endswith((".warc", ".warc.gz")):
                    fs.delete_file(f"{base}/{name}")

    def abort(self, messages):
        """Nothing to undo: files that no manifest lists are not read."""


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"], self.options.get("payload", "true") != "false")

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], int(self.options.get("roll", ROLL)), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def export_pages(pages: DataFrame, path: str, least: int = LEAST) -> None:
    """Write the records of ``pages`` (page_id, url, html) to archives in ``path``."""
    register(pages.sparkSession)
    x = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    x = x.withColumn("payload_digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    # decisions on narrow rows: the smallest id per repeated digest, joined to those that come after it
    narrow = x.where(F.col("payload_bytes") >= least).select("page_id", "payload_digest")
    first = narrow.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = narrow.join(first, "payload_digest").where("page_id > refers_to").distinct()
    rows = x.join(later, ["page_id", "payload_digest"], "left").withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))
    rows = rows.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))
    rows.select(*[c for c in _COLUMNS if c in rows.columns]).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
