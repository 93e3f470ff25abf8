"""WARC archives as a Python data source, and archives of pages without repeated payloads.

``register(spark)`` makes the format ``warc`` known. Written, every row is a ``response``
or ``revisit`` record in files of about ``maxBytes``; with ``compression`` gzip (the
default) each record is a gzip member whose extra field tells its length. Files appear
under the path when the whole job commits, so a lost or repeated task leaves nothing.

Read, the files are packed into partitions of about ``maxBytes`` (each file whole). Predicates on header
columns (type, ids, uri, date, digest) are pushed down: a record's header is parsed
first, and an unwanted record is passed over by its length, without inflating or
decoding what follows. ``payload`` tells what is made of wanted payloads: ``full``
returns them, ``digest`` measures and digests them piece by piece, ``none`` passes over
them and takes length and digest from the headers.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from verdigris.session import materialize, scratch_table_path

SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, "
          "payload_digest string, payload_length long, payload binary")
#: fixed values: columns and the header fields that they hold
FIELDS = {"record_type": b"WARC-Type", "record_id": b"WARC-Record-ID", "target_uri": b"WARC-Target-URI", "date": b"WARC-Date",
          "refers_to": b"WARC-Refers-To", "payload_digest": b"WARC-Payload-Digest"}
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "1970-01-01T00:00:00Z"
FILE_BYTES, PART_BYTES = 128 << 20, 16 << 20  # of a file written, and of a partition read
READ = 1 << 16
ARROW_BYTES = 8 << 20


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _located(path: str) -> tuple[fs.FileSystem, str]:
    local = re.sub(r"^file:/*", "/", path)
    if "://" in local:
        return fs.FileSystem.from_uri(local)
    return fs.LocalFileSystem(), local


def _clean(value: str) -> bytes:
    """A header value: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1F\x7F]", lambda m: f"%{ord(m[0]):02X}", value).encode()


# ------------------------------------------------------------------ writing ----

def record(row: dict) -> bytes:
    """One record; a revisit has the HTTP header of its payload, not the payload."""
    payload = row["payload"] or b""
    payload = payload.encode() if isinstance(payload, str) else payload
    revisit = row["record_type"] == "revisit"
    length = row.get("payload_length")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % (
        len(payload) if length is None or not revisit else length)
    out = [b"WARC/1.1"]
    values = {c: row.get(c) for c in FIELDS} | {"date": row.get("date") or DATE}
    values["payload_digest"] = "sha1:" + (row.get("payload_digest") or base32_sha1(payload))
    for c in ("record_id", "refers_to"):
        values[c] = values[c] and f"<{values[c]}>"
    out += [name + b": " + _clean(values[c]) for c, name in FIELDS.items() if values[c] is not None]
    if revisit:
        out.append(b"WARC-Profile: " + PROFILE)
    else:
        block += payload
    out += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join([*out, b"", block, b"", b""])


def info_record() -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return b"\r\n".join([b"WARC/1.1", b"WARC-Type: warcinfo", b"WARC-Record-ID: <urn:uuid:%s>" % str(uuid.uuid4()).encode(),
                         b"WARC-Date: " + DATE.encode(), b"Content-Type: application/warc-fields",
                         b"Content-Length: %d" % len(block), b"", block, b"", b""])


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member with its compressed and its plain length in the extra field ``sl``."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 24 + len(body) + 8
    fits = max(size, len(data)) < 1 << 32
    sl = b"sl\x08\x00" + (size if fits else 0).to_bytes(4, "little") + (len(data) if fits else 0).to_bytes(4, "little")
    return (b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x0c\x00" + sl + body
            + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little"))


@dataclass
class Written(D.WriterCommitMessage):
    files: list[str]


class WarcWriter(D.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.plain = options.get("compression", "gzip").lower() == "none"
        self.max_bytes = int(options.get("maxBytes", FILE_BYTES))
        self.job = uuid.uuid4().hex

    def _folder(self, path: str) -> str:
        return f"{path}/_temporary-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, path = _located(self.path)
        store.create_dir(self._folder(path), recursive=True)
        pack = (lambda x: x) if self.plain else member
        files, out, held = [], None, 0
        try:
            for batch in iterator:
                for i in range(batch.num_rows):  # one record in memory besides the batch
                    if out is None or held >= self.max_bytes:
                        if out is not None:
                            out.close()
                        files.append(f"part-{uuid.uuid4().hex}.warc" + ("" if self.plain else ".gz"))
                        out, held = store.open_output_stream(f"{self._folder(path)}/{files[-1]}", compression=None), 0
                        held += out.write(pack(info_record()))
                    held += out.write(pack(record({c: batch[c][i].as_py() for c in batch.schema.names})))
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        store, path = _located(self.path)
        store.create_dir(path, recursive=True)
        if self.overwrite:
            for f in store.get_file_info(fs.FileSelector(path)):
                if f.base_name != f"_temporary-{self.job}":
                    (store.delete_dir if f.type == fs.FileType.Directory else store.delete_file)(f.path)
        for m in messages:
            for name in m.files if m else ():
                store.move(f"{self._folder(path)}/{name}", f"{path}/{name}")
        self._drop(store, path)

    def abort(self, messages: list) -> None:
        self._drop(*_located(self.path))

    def _drop(self, store: fs.FileSystem, path: str) -> None:
        if store.get_file_info(self._folder(path)).type == fs.FileType.Directory:
            store.delete_dir(self._folder(path))


# ------------------------------------------------------------------ reading ----

class _Plain:
    """Bytes of an uncompressed file, taken or passed over."""

    def __init__(self, file, name: str):
        self.file, self.name, self.held = file, name, b""

    def more(self) -> bool:
        data = self.file.read(READ)
        self.held += data
        return bool(data)

    def head(self) -> bytes | None:
        """Bytes up to the next empty line, None at the end of the file."""
        while (at := self.held.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.held.strip():
                    raise ValueError(f"{self.name} ends inside a header")
                return None
        out, self.held = self.held[:at], self.held[at + 4:]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError(f"{self.name} ends inside a record")
            out, self.held = self.held[:n], self.held[n:]
            n -= len(out)
            yield out

    def skip(self, n: int) -> None:
        if n <= len(self.held):
            self.held = self.held[n:]
        else:
            to = self.file.tell() + n - len(self.held)
            if to > self.file.size():
                raise ValueError(f"{self.name} ends inside a record")
            self.file.seek(to)
            self.held = b""


class _Gzip(_Plain):
    """Bytes of the members of a gzip file; a rest of a member whose length is told is not inflated."""

    def __init__(self, file, name: str):
        super().__init__(file, name)
        self.raw, self.inflate = b"", None
        self.inflated = 0  # bytes

    def _open(self) -> bool:
        """Read the header of the next member."""
        start = self.file.tell() - len(self.raw)
        while len(self.raw) < 24:
            if not (data := self.file.read(READ)):
                break
            self.raw += data
        if not self.raw:
            return False
        size = plain = 0
        if self.raw[3:4] == b"\x04" and self.raw[10:16] == b"\x0c\x00sl\x08\x00":
            size, plain = int.from_bytes(self.raw[16:20], "little"), int.from_bytes(self.raw[20:24], "little")
        self.member, self.plain, self.made = start + size if size else 0, plain, 0
        self.inflate = zlib.decompressobj(31)
        return True

    def more(self) -> bool:
        while True:
            if self.inflate is None and not self._open():
                return False
            data = self.raw or self.file.read(READ)
            if not data:
                raise ValueError(f"{self.name} ends inside a gzip member")
            made = self.inflate.decompress(data, READ)
            self.raw = self.inflate.unconsumed_tail or self.inflate.unused_data
            self.made += len(made)
            self.inflated += len(made)
            if self.inflate.eof:
                self.inflate = None
            self.held += made
            if made:
                return True

    def skip(self, n: int) -> None:
        # the record ends with its member: go to the next one
        if self.inflate is not None and self.member and self.made - len(self.held) + n == self.plain:
            if self.member > self.file.size():
                raise ValueError(f"{self.name} ends inside a gzip member")
            self.file.seek(self.member)
            self.held = self.raw = b""
            self.inflate = None
            return
        for _ in self.pieces(n):
            pass


def _fields(head: bytes) -> dict[bytes, str]:
    """Header fields by lower-case name; lines that begin with a space go on with the one before."""
    out: dict[bytes, str] = {}
    for line in re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out.setdefault(name.strip().lower(), value.strip().decode("utf-8", "replace"))
    return out


def _columns(fields: dict[bytes, str]) -> dict[str, str | None]:
    out = {c: fields.get(name.lower()) for c, name in FIELDS.items()}
    for c in ("record_id", "refers_to"):
        out[c] = out[c] and out[c].removeprefix("<").removesuffix(">")
    out["payload_digest"] = out["payload_digest"] and out["payload_digest"].removeprefix("sha1:")
    return out


def _holds(f: D.Filter, row: dict) -> bool | None:
    """The filter's value over the header columns; None if unknown, as in SQL."""
    if isinstance(f, D.Not):
        inner = _holds(f.child, row)
        return None if inner is None else not inner
    x = row[f.attribute[0]]
    if isinstance(f, D.IsNull):
        return x is None
    if isinstance(f, D.IsNotNull):
        return x is not None
    if isinstance(f, D.EqualNullSafe):
        return x == f.value
    if x is None:
        return None
    return {D.EqualTo: lambda: x == f.value, D.In: lambda: x in f.value, D.StringStartsWith: lambda: x.startswith(f.value),
            D.StringEndsWith: lambda: x.endswith(f.value), D.StringContains: lambda: f.value in x}[type(f)]()


def _on_header(f: D.Filter) -> bool:
    if isinstance(f, D.Not):
        return _on_header(f.child)
    kinds = (D.EqualTo, D.EqualNullSafe, D.In, D.IsNull, D.IsNotNull, D.StringStartsWith, D.StringEndsWith, D.StringContains)
    values = [] if isinstance(f, (D.IsNull, D.IsNotNull)) else [f.value] if hasattr(f, "value") else []
    known = all(v is None or isinstance(v, (str, tuple, list)) for v in values) and not (isinstance(f, D.EqualTo) and f.value is None)
    return isinstance(f, kinds) and known and len(f.attribute) == 1 and f.attribute[0] in FIELDS and not (
        isinstance(f, D.In) and None in f.value)


def records(stream: _Plain, wanted, payload: str) -> Iterator[dict]:
    """The wanted records of a file, their payloads full, digested or passed over."""
    while (head := stream.head()) is not None:
        head = head.lstrip(b"\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError(f"{stream.name}: not a WARC header: {head[:40]!r}")
        fields = _fields(head)
        row, left = _columns(fields), int(fields[b"content-length"])
        if not wanted(row):
            stream.skip(left + 4)
            continue
        row |= {"payload_length": left, "payload": None}
        if fields.get(b"content-type", "").startswith("application/http"):
            http = stream.head()
            left -= len(http) + 4
            declared = _fields(http).get(b"content-length", "")
            row["payload_length"] = int(declared) if declared.isdigit() else left
        if row["record_type"] == "revisit" or payload == "none":
            stream.skip(left + 4)
        else:
            sha, whole = hashlib.sha1(), []
            for piece in stream.pieces(left):
                sha.update(piece)
                if payload == "full":
                    whole.append(piece)
            stream.skip(4)
            row |= {"payload_length": left, "payload_digest": base64.b32encode(sha.digest()).decode(),
                    "payload": b"".join(whole) if payload == "full" else None}
        yield row


@dataclass
class Files(D.InputPartition):
    paths: list[str]


class WarcReader(D.DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.path, self.names = options["path"], names
        self.payload = options.get("payload", "full").lower()
        if self.payload not in ("full", "digest", "none"):
            raise ValueError("payload must be full, digest or none")
        self.max_bytes = int(options.get("maxBytes", PART_BYTES))
        self.filters: list[D.Filter] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for f in filters:
            if _on_header(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Files in parts of about ``maxBytes``; names that begin with _ or . are left out."""
        store, path = _located(self.path)
        info = store.get_file_info(path)
        found = [info] if info.type == fs.FileType.File else [
            f for f in store.get_file_info(fs.FileSelector(path, recursive=True)) if f.type == fs.FileType.File
            and re.search(r"\.warc(\.gz)?$", f.path) and not re.search(r"/[_.]", f.path[len(path):])]
        parts, held = [Files([])], 0
        for f in sorted(found, key=lambda f: (-f.size, f.path)):
            if parts[-1].paths and held + f.size > self.max_bytes:
                parts.append(Files([]))
                held = 0
            parts[-1].paths.append(f.path)
            held += f.size
        return parts

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _located(self.path)
        types = [pa.int64() if c == "payload_length" else pa.binary() if c == "payload" else pa.string() for c in self.names]
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(self.names, types)], self.names)

        def wanted(row: dict) -> bool:
            return all(_holds(f, row) for f in self.filters)

        for path in partition.paths:
            with store.open_input_file(path) as file:
                stream = (_Gzip if path.endswith(".gz") else _Plain)(file, path)
                for row in records(stream, wanted, self.payload):
                    rows.append(row)
                    held += 512 + len(row["payload"] or b"")
                    if held >= ARROW_BYTES:
                        yield batch()
                        rows, held = [], 0
        yield batch()


class WarcSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options), schema.names)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        missing = {"record_type", "record_id", "target_uri", "payload"} - set(schema.names)
        if missing:
            raise ValueError(f"columns are missing: {sorted(missing)}")
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known; predicates on it are pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# -------------------------------------------------------------------- pages ----

def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1, which needs no padding: of every 5 hex digits 4 letters."""
    bits = lambda hexed, i: F.conv(F.substr(hexed, F.floor(i / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
    letter = lambda hexed, i: F.substr(F.lit(BASE32), F.floor(bits(hexed, i) / F.pow(F.lit(2), 15 - 5 * (i % 4))).cast("int") % 32 + 1, F.lit(1))
    return F.transform(F.array(F.sha1(data)), lambda h: F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: letter(h, i)), ""))[0]


def page_records(pages: DataFrame, min_bytes: int = 0, share: int = 1000) -> DataFrame:
    """Rows to write as records: of equal payloads of at least ``min_bytes`` bytes one response, else revisits.

    The row with the largest page_id is the response (rows that repeat this id are all responses; rows without
    page_id come last, and all are responses if none has one). A null html is an empty payload. A payload that
    at least 1/``share`` of the rows hold is joined by a broadcast, of at most ``share`` rows; others by a
    shuffle, in which the hot ones lie spread.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    source = pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload"),
                          F.octet_length(payload).cast("long").alias("payload_length"), sha1_base32(payload).alias("payload_digest"))
    sizes = source.where(F.col("payload_length") >= min_bytes).select("payload_digest", "page_id")
    counts = materialize(sizes.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first")), "payloads")
    least = max(2, -(-(counts.agg(F.sum("n")).first()[0] or 0) // share))
    copied = materialize(counts.where((F.col("n") > 1) & (F.col("n") < least)).select(F.col("payload_digest").alias("__key"), "first"), "copied")
    hot = materialize(counts.where(F.col("n") >= least).select("payload_digest", F.col("first").alias("__hot")), "hot_payloads")
    known = source.join(F.broadcast(hot.withColumn("__is_hot", F.lit(True))), "payload_digest", "left")
    key = F.when(F.col("__is_hot"), F.concat_ws(":", "payload_digest", F.xxhash64("page_id", "target_uri").cast("string"))).otherwise(F.col("payload_digest"))
    joined = known.withColumn("__key", key).join(copied, "__key", "left")
    first = F.coalesce("__hot", "first")
    again = (F.col("payload_length") >= min_bytes) & first.isNotNull() & ~F.col("page_id").eqNullSafe(first)
    name = lambda i: F.concat(F.lit("urn:pages:"), i.cast("string"))
    return joined.select(
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.coalesce(name(F.col("page_id")), F.concat(F.lit("urn:pages:none:"), "payload_digest")).alias("record_id"), "target_uri",
        F.when(again, name(first)).alias("refers_to"), "payload_digest", "payload_length", F.when(~again, F.col("payload")).alias("payload"))


def archive(pages: DataFrame, path: str, min_bytes: int = 0, **options) -> DataFrame:
    """Write the pages as archives under ``path``, and return the format's rows of them, payloads digested."""
    spark = pages.sparkSession
    register(spark)
    page_records(pages, min_bytes).write.format("warc").mode("overwrite").options(**options).save(path)
    return spark.read.format("warc").option("payload", "digest").load(path)


def archived_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """What the archives of the pages hold: one row per page, its payload's size and digest, record type and target of a revisit.

    An empty table gives empty archives and no rows.
    """
    found = archive(pages, scratch_table_path(pages.sparkSession, "warc"), min_bytes).where(F.col("record_type").isin("response", "revisit"))
    number = lambda c: F.regexp_extract(c, r"^urn:pages:(-?[0-9]+)$", 1).try_cast("long")
    return found.select(number(F.col("record_id")).alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest",
                        "record_type", number(F.col("refers_to")).alias("refers_to"))
