"""WARC archives as a PySpark data source, and archiving of pages with revisit records.

Reading: files are the partitions.  Of every record the headers are parsed
first; predicates on header columns that Spark pushes down are tested on
them, and the block of an unwanted record is skipped (seek in plain files,
inflate and forget in gzip ones) and never decoded.
Writing: tasks write gzip members, one per record, to files with names of
their own; the driver lists the files of the successful attempts in a
manifest of the commit's own, so what a lost task left behind is never read.
Appending adds a manifest; overwriting adds one that names those it replaces.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, IsNull,
    StringStartsWith, WriterCommitMessage)

from parchment.llm.common import stage
from parchment.session import checkpoint_root

SCHEMA = ("record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
          "headers map<string,string>, payload_length long, payload binary")
_ARROW = pa.schema([
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
    ("payload_digest", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("payload_length", pa.int64()),
    ("payload", pa.binary())])
#: Header columns a predicate may be pushed to, and the WARC fields they stand for.
FIELDS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
          "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
_MANIFEST = "_manifest.json"
_FILE_BYTES = 64 << 20
_CHUNK = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(row: dict, date: str) -> bytes:
    """The bytes of one WARC/1.1 record of type response or revisit; the digest is base32 text or the raw SHA-1."""
    length, told = row["payload_length"], row["payload_digest"]
    told = base64.b32encode(told).decode() if isinstance(told, bytes) else told or digest(row["payload"] or b"")
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    if row["record_type"] == "response":
        body += row["payload"] or b""
    head = {"WARC-Type": row["record_type"], "WARC-Record-ID": row["record_id"], "WARC-Target-URI": row["target_uri"],
            "WARC-Date": date, "WARC-Payload-Digest": f"sha1:{told}"}
    if row["record_type"] == "revisit":
        head |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": row["refers_to"]}
    head |= dict(row["headers"] or ()) | {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(body))}
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def _open(path: str):
    return pafs.FileSystem.from_uri(path)


class _Bytes:
    """A forward reader over a plain or gzip-per-record file."""

    def __init__(self, file, packed: bool):
        self.file, self.packed, self.held, self.inflate = file, packed, bytearray(), None
        self.raw = b""

    def _more(self) -> bool:
        if not self.packed:
            got = self.file.read(_CHUNK)
            self.held += got
            return bool(got)
        while True:
            if not self.raw:
                self.raw = self.file.read(_CHUNK)
                if not self.raw:
                    return False
            self.inflate = self.inflate or zlib.decompressobj(31)
            got = self.inflate.decompress(self.raw, _CHUNK)
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data, None
            else:
                self.raw = self.inflate.unconsumed_tail
            if got:
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with ``mark``; None at the end of the file."""
        start = 0
        while (at := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self._more():
                if self.held.strip():
                    raise ValueError("a WARC file ends within a record's headers")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("a WARC file ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def skip(self, n: int) -> None:
        if not self.packed and n > len(self.held):
            self.file.seek(n - len(self.held), 1)
            self.held.clear()
            return
        while n:
            here = min(n, len(self.held))
            del self.held[:here]
            n -= here
            if n and not self._more():
                raise ValueError("a WARC file ends within a record")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _value(fields: dict[str, str], column: str) -> str | None:
    value = fields.get(FIELDS[column])
    return value.removeprefix("sha1:") if value is not None and column == "payload_digest" else value


def _holds(test, fields: dict[str, str]) -> bool:
    value = _value(fields, test.attribute[0])
    if isinstance(test, IsNull):
        return value is None
    if value is None:
        return False
    if isinstance(test, EqualTo):
        return value == test.value
    if isinstance(test, In):
        return value in test.value
    return value.startswith(test.value) if isinstance(test, StringStartsWith) else True


def _manifests(system, base: str) -> dict[str, list[dict]]:
    """The files of each commit to a folder by the name of its manifest, without those that an overwrite replaced.

    ``_MANIFEST`` itself, a bare list of files, is that of an older writer.
    """
    if system.get_file_info(base).type != pafs.FileType.Directory:
        return {}
    stem, end = os.path.splitext(_MANIFEST)
    files, gone = {}, set()
    for x in system.get_file_info(pafs.FileSelector(base)):
        if x.base_name == _MANIFEST or x.base_name.startswith(f"{stem}-") and x.base_name.endswith(end):
            with system.open_input_stream(x.path) as f:
                told = json.loads(f.read())
            files[x.base_name] = told if isinstance(told, list) else told["files"]
            gone.update([] if isinstance(told, list) else told["replaces"])
    return {name: x for name, x in files.items() if name not in gone}


@dataclass
class WarcFiles(InputPartition):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.tests: list = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In, IsNotNull, IsNull, StringStartsWith)) and len(f.attribute) == 1 and f.attribute[0] in FIELDS:
                self.tests.append(f)
            else:
                yield f

    def partitions(self):
        """One partition per file; small files share one."""
        system, base = _open(self.path)
        if lists := _manifests(system, base):
            found = [(f"{base}/{x['file']}", x["bytes"]) for files in lists.values() for x in files]
        elif system.get_file_info(base).type == pafs.FileType.File:
            found = [(base, _FILE_BYTES)]
        else:
            found = [(x.path, x.size) for x in system.get_file_info(pafs.FileSelector(base, recursive=True))
                     if x.path.endswith((".warc", ".warc.gz"))]
        out, held, size = [], [], 0
        for path, n in sorted(found):
            if held and size + n > _FILE_BYTES // 4:
                out.append(WarcFiles(tuple(held)))
                held, size = [], 0
            held.append(path)
            size += n
        return out + ([WarcFiles(tuple(held))] if held else []) or [WarcFiles(())]

    def _records(self, path):
        system, _ = _open(self.path)
        with system.open_input_file(path) as file:
            data = _Bytes(file, path.endswith(".gz"))
            while (head := data.until(b"\r\n\r\n")) is not None:
                fields = _fields(head.lstrip(b"\r\n"))
                length = int(fields.get("Content-Length", 0))
                if not all(_holds(t, fields) for t in self.tests):
                    data.skip(length + 4)
                    continue
                if not (self.payload or self.verify or "http" in fields.get("Content-Type", "")):
                    data.skip(length)
                    body, size = None, length
                else:
                    body, size = data.take(length), length
                    if "http" in fields.get("Content-Type", ""):
                        http, _, body = body.partition(b"\r\n\r\n")
                        size = len(body)
                        if fields.get("WARC-Type") == "revisit":
                            told = [x.split(b":")[1] for x in http.lower().split(b"\r\n") if x.startswith(b"content-length:")]
                            body, size = None, int(told[0]) if told else 0
                if self.verify and body is not None and digest(body) != _value(fields, "payload_digest"):
                    raise ValueError(f"the payload of {fields.get('WARC-Record-ID')} does not match its digest")
                data.skip(4)
                yield (*(_value(fields, c) for c in FIELDS), list(fields.items()), size, body if self.payload else None)

    def read(self, partition):
        held, size = [], 0
        for path in partition.paths:
            for row in self._records(path):
                held.append(row)
                size += len(row[-1] or b"") + 500
                if size > 8 << 20:
                    yield self._batch(held)
                    held, size = [], 0
        if held:
            yield self._batch(held)

    @staticmethod
    def _batch(rows):
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    files: tuple


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite=False):
        self.path, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")
        self.overwrite = overwrite

    def write(self, iterator):
        system, base = _open(self.path)
        system.create_dir(base, recursive=True)
        files, out, name, size = [], None, "", 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                press = zlib.compressobj(4, zlib.DEFLATED, 31)
                member = press.compress(record(row, self.date)) + press.flush()
                out.write(member)
                size += len(member)
                if size >= _FILE_BYTES:
                    out.close()
                    files.append({"file": name, "bytes": size})
                    out = None
        if out is not None:
            out.close()
            files.append({"file": name, "bytes": size})
        return Written(tuple(files))

    def commit(self, messages):
        system, base = _open(self.path)
        system.create_dir(base, recursive=True)
        replaces = sorted(_manifests(system, base)) if self.overwrite else []
        stem, end = os.path.splitext(_MANIFEST)
        with system.open_output_stream(f"{base}/{stem}-{uuid.uuid4().hex}{end}") as f:
            f.write(json.dumps({"files": [x for m in messages if m for x in m.files], "replaces": replaces}).encode())

    def abort(self, messages):
        system, base = _open(self.path)
        for m in messages:
            for x in m.files if m else ():
                system.delete_file(f"{base}/{x['file']}")


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``.

    Options: ``path``; reading: ``payload`` (false: no payload bytes are
    returned), ``verify`` (true: payload digests are recomputed); writing:
    ``date`` (WARC-Date of the records).
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive(pages: DataFrame, path: str, min_bytes: int = 0, page_id: str = "page_id", url: str = "url",
            html: str = "html", date: str = "2024-02-01T00:00:00Z") -> None:
    """Write one record per row of ``pages``: response, or revisit of an equal payload's response.

    Of rows with equal payloads of at least ``min_bytes`` bytes, that with the
    largest page_id is the response (rows that repeat it are responses too).
    Null html is the empty payload; a null url is left out; null page_ids
    are smaller than any other.  Only digests meet in the grouping, and only
    the responses' payloads are shuffled, by page.
    """
    spark = pages.sparkSession
    register(spark)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    narrow = stage(rows.select("page_id", "url", "key", F.octet_length("payload").cast("long").alias("payload_length"),
                               F.unhex(F.sha1("payload")).alias("sha1")), "warc-pages")
    first = stage(narrow.where(F.col("payload_length") >= min_bytes).groupBy("key").agg(F.max("page_id").alias("first"))
                  .withColumnRenamed("key", "f_key"), "warc-responses")
    named = narrow.join(first, F.col("key") == F.col("f_key"), "left").withColumn(
        "record_type", F.when(F.col("f_key").isNull() | F.col("page_id").eqNullSafe(F.col("first")), "response").otherwise("revisit"))
    typed = stage(named.select("page_id", "url", "key", "payload_length", "sha1", "record_type", "first"), "warc-typed")
    responses = typed.where("record_type = 'response'").select(
        F.col("page_id").alias("r_page"), F.col("key").alias("r_key")).distinct()
    whole = (rows.join(responses, F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("key") == F.col("r_key")), "left_semi")
             .withColumns({"payload_length": F.octet_length("payload").cast("long"), "sha1": F.unhex(F.sha1("payload")),
                           "record_type": F.lit("response"), "first": F.lit(None).cast("long")}))
    again = typed.where("record_type = 'revisit'").withColumn("payload", F.lit(None).cast("binary"))
    cols = ["page_id", "url", "key", "payload_length", "sha1", "record_type", "first", "payload"]

    def urn(column: str):
        return F.concat(F.lit("<urn:sha256:"), F.lower(F.hex("key")), F.lit(":"), F.coalesce(F.col(column).cast("string"), F.lit("none")), F.lit(">"))

    table = whole.select(cols).unionByName(again.select(cols)).select(
        "record_type", urn("page_id").alias("record_id"), F.col("url").alias("target_uri"),
        F.when(F.col("record_type") == "revisit", urn("first")).alias("refers_to"),
        F.col("sha1").alias("payload_digest"),
        F.create_map(F.lit("X-Page-ID"), F.col("page_id").cast("string"), F.lit("X-Refers-To-Page-ID"), F.col("first").cast("string")).alias("headers"),
        "payload_length", "payload")
    table.write.format("warc").mode("append").option("path", path).option("date", date).save()


def pages_through_archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the archive written from ``pages`` and read back.

    Payloads are verified against their digests.  One row per row of
    ``pages``; an empty table gives an empty archive and result.  Other
    columns are not read.
    """
    spark = pages.sparkSession
    path = os.path.join(checkpoint_root(spark), f"archive-{uuid.uuid4().hex}")
    archive(pages, path, min_bytes)
    back = spark.read.format("warc").option("path", path).option("payload", "false").option("verify", "true").load()
    return back.select(F.col("headers")["X-Page-ID"].cast("long").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
                       "payload_digest", "record_type",
                       F.when(F.col("record_type") == "revisit", F.col("headers")["X-Refers-To-Page-ID"].cast("long")).alias("refers_to"))
