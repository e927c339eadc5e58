"""WARC archives as a PySpark data source.

Writing: every task makes files of its own, each record a gzip member whose extra field ``sl`` has
its two lengths (a value of a Spark row has less than 2 GiB, so they fit). The driver's commit lists
the files of the successful tasks, and places in them where a record begins, in a manifest of the
job, so what failed or repeated tasks left is never read. A folder has all jobs that were appended;
overwriting removes the manifests of earlier ones first, then their files.

Reading: the driver plans partitions of about equal bytes; a long file is cut at the listed places.
A task inflates only the head of each member, tests the pushed-down predicates on the WARC headers,
and skips the rest of an unwanted record (and of every record, if payloads aren't asked for) by its
length. In a folder without manifests every ``*.warc.gz`` is read; archives from elsewhere, without
``sl``, are read member by member.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from .shared import materialise, scratch
from .url_filter import encode

COLUMNS = ("record_id", "record_type", "target_uri", "refers_to", "payload_digest")
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS) + ", payload_bytes long, payload binary"
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
FILE_BYTES = 256 << 20
#: Bytes between the places at which a file can be cut, and of a read partition.
MARK_BYTES, PARTITION_BYTES = 4 << 20, 16 << 20
#: Owners of repeated payloads that are broadcast, at about 80 bytes each, and bits of the filter that stands for more of them.
FEW_OWNERS, FILTER_BITS = 200_000, 1 << 25
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_digest(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(record_id: str, kind: str, uri: str | None, digest: str, payload: bytes | None, payload_bytes: int, refers_to: str | None = None) -> bytes:
    """One gzip member. A revisit has only the HTTP head, whose Content-Length is the full payload's."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % payload_bytes + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if uri is not None:
        head.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {PROFILE}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    whole = 12 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, whole & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}


def records(file, at: int, size: int, wanted, payloads: bool) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of the members from ``at`` to ``size`` that ``wanted(headers)`` takes; the block is empty unless asked for or short."""
    while at < size:
        file.seek(at)
        start = file.read(min(4096, size - at))
        if start[:2] != b"\x1f\x8b":
            raise ValueError(f"no gzip member at byte {at}")
        inflate, whole = zlib.decompressobj(31), None
        if start[3] & 4 and start[12:14] == b"sl":
            whole = struct.unpack("<I", start[16:20])[0]
            start = start[:whole]
        raw, read = inflate.decompress(start), len(start)
        while b"\r\n\r\n" not in raw and not inflate.eof and read < size - at:
            more = file.read(65536)
            read += len(more)
            raw += inflate.decompress(more)
        head, _, block = raw.partition(b"\r\n\r\n")
        found = headers_of(head)
        keep = wanted(found)
        if keep and payloads or whole is None or keep and b"\r\n\r\n" not in block:
            parts = [block]
            while not inflate.eof:
                more = file.read(1 << 20 if whole is None else max(1, min(1 << 20, whole - read)))
                if not more:
                    raise ValueError(f"the member at byte {at} has no end")
                read += len(more)
                parts.append(inflate.decompress(more))
            block = b"".join(parts)[: int(found.get("content-length", 0))]
        if whole is None:
            whole = read - len(inflate.unused_data)
        if keep:
            yield found, block
        at += whole


def manifests(system: fs.FileSystem, path: str) -> list[str]:
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.startswith("manifest-") and f.base_name.endswith(".json"))


def listed(system: fs.FileSystem, path: str) -> list[list]:
    """``[name, size, places]`` of the files below ``path``."""
    names = manifests(system, path)
    if not names:
        found = system.get_file_info(fs.FileSelector(path))
        return sorted([f.base_name, f.size, [0]] for f in found if f.base_name.endswith(".warc.gz"))
    out = []
    for name in names:
        with system.open_input_stream(name) as file:
            out += json.loads(file.read())
    return sorted(out)


class Files(InputPartition):
    """Parts of files: name, first byte and end, each at the edge of a record."""

    def __init__(self, files: list[tuple[str, int, int]]):
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload, self.verify = options["path"], options.get("payload", "true") == "true", options.get("verify", "false") == "true"
        self.partition_bytes = int(options.get("partitionbytes", options.get("partitionBytes", PARTITION_BYTES)))
        self.filters: dict[str, set] = {}

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if column in COLUMNS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.filters[column] = self.filters.get(column, values) & values
            else:
                yield f

    def partitions(self):
        system, path = fs.FileSystem.from_uri(self.path)
        out, own, total = [], [], 0
        for name, size, places in listed(system, path):
            for first, end in zip(places, [*places[1:], size], strict=True):
                if own and total + end - first > self.partition_bytes:
                    out.append(Files(own))
                    own, total = [], 0
                if own and own[-1][0] == name:
                    own[-1] = (name, own[-1][1], end)
                else:
                    own.append((name, first, end))
                total += end - first
        return [*out, Files(own)] if own else out or [Files([])]

    def _wanted(self, found: dict) -> bool:
        return all(plain(c, found.get(HEADERS[c])) in values for c, values in self.filters.items())

    def read(self, partition):
        system, path = fs.FileSystem.from_uri(self.path)
        for name, first, end in partition.files:
            with system.open_input_file(f"{path}/{name}") as file:
                for found, block in records(file, first, end, self._wanted, self.payload):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    full = int(headers_of(head).get("content-length", 0)) if head.startswith(b"HTTP/") else len(payload)
                    kind, digest = found.get("warc-type"), plain("payload_digest", found.get("warc-payload-digest"))
                    if self.payload and self.verify and kind == "response":
                        if len(payload) != full or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"{found.get('warc-record-id')}: the payload doesn't match its digest")
                    yield (*(plain(c, found.get(HEADERS[c])) for c in COLUMNS), full, payload if self.payload and kind != "revisit" else None)


def plain(column: str, value: str | None) -> str | None:
    return value.removeprefix("sha1:") if value and column == "payload_digest" else value


class Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int, list[int]]]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    """Takes the columns of ``SCHEMA`` by name; payload_digest is bare base32."""

    def __init__(self, options: dict, overwrite: bool = False):
        self.path, self.file_bytes, self.overwrite = options["path"], int(options.get("filebytes", FILE_BYTES)), overwrite

    def write(self, iterator):
        system, path = fs.FileSystem.from_uri(self.path)
        system.create_dir(path, recursive=True)
        files, out, size, name, places = [], None, 0, "", []
        for batch in iterator:
            for row in zip(*(batch.column(c).to_pylist() for c in (*COLUMNS, "payload_bytes", "payload")), strict=True):
                if out is None:
                    name, size, places = f"part-{uuid.uuid4().hex}.warc.gz", 0, [0]
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                if size >= places[-1] + MARK_BYTES:
                    places.append(size)
                rid, kind, uri, refers, digest, full, payload = row
                size += out.write(record(rid, kind, uri, digest, payload, full, refers))
                if size >= self.file_bytes:
                    out.close()
                    files.append((name, size, places))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size, places))
        return Written(files)

    def commit(self, messages):
        system, path = fs.FileSystem.from_uri(self.path)
        system.create_dir(path, recursive=True)
        old, gone = (manifests(system, path), listed(system, path)) if self.overwrite else ([], [])
        for name in old:
            system.delete_file(name)
        new = [f for m in messages if m for f in m.files]
        with system.open_output_stream(f"{path}/manifest-{uuid.uuid4().hex}.json", compression=None) as file:
            file.write(json.dumps(new).encode())
        for name in {f[0] for f in gone} - {f[0] for f in new}:
            system.delete_file(f"{path}/{name}")

    def abort(self, messages):
        system, path = fs.FileSystem.from_uri(self.path)
        for name, *_ in [f for m in messages if m for f in m.files]:
            system.delete_file(f"{path}/{name}")


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder)``; options ``payload`` and ``verify`` (true or false), ``partitionBytes``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options), overwrite)


def read_warc(spark: SparkSession, path: str, payload: bool = True, verify: bool = False) -> DataFrame:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).option("verify", str(verify).lower()).load(path)


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, few_owners: int = FEW_OWNERS) -> None:
    """Archive every row; of equal payloads of ``least_bytes`` or more, that of the smallest id is the response, the others revisit it.

    Null payloads count as empty, null URLs give no target URI. Rows that repeat the id of the
    response are responses too. Rows without id never own a payload but may revisit one.
    Only (digest, length, id) is grouped, with a partial aggregate, so a payload that a third of the
    pages share costs a row a task. The owners of up to ``few_owners`` repeated digests are
    broadcast; of more, a Bloom filter of bounded size tells which rows can be repeated, and only
    these are shuffled, by a join whose large side Spark splits where it is skewed.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("target_uri"), body.alias("payload"), F.sha1(body).alias("sha"), F.octet_length(body).cast("long").alias("payload_bytes"))
    owners = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha").agg(F.min("id").alias("owner"), F.count("*").alias("n")).where("n > 1 and owner is not null").select("sha", "owner")
    owners = materialise(owners, "owners")
    if (count := owners.count()) <= few_owners:
        full = rows.join(F.broadcast(owners), "sha", "left")
    else:
        seen = encode(owners.select(F.col("sha").alias("key")), min(FILTER_BITS, 16 * count), 8, 0)
        alone = rows.where(~seen.passes(F.col("sha"))).withColumn("owner", F.lit(None).cast("long"))
        full = rows.where(seen.passes(F.col("sha"))).join(owners, "sha", "left").unionByName(alone)
    revisit = F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    full.select(
        F.coalesce(name(F.col("id")), F.lit("<urn:page:>")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.when(revisit, name(F.col("owner"))).alias("refers_to"), base32("sha").alias("payload_digest"), "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"),
    ).write.format("warc").mode("append").save(path)


def base32(hex_column: str):
    """Bare base32 of a SHA-1 in hex: 32 digits of 5 bits."""
    quintets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.lpad(F.conv(F.substring(F.col(hex_column), i * 10 + 1, F.lit(10)), 16, 32), 8, "0"))
    return F.translate(F.array_join(quintets, ""), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def archived(pages: DataFrame, id_col: str = "page_id", **columns) -> DataFrame:
    """Write ``pages`` as WARC in the shared folder and read every record back, payloads verified."""
    spark = pages.sparkSession
    spark.dataSource.register(WarcDataSource)
    path = scratch(spark, "warc")
    write_pages(pages, path, id_col=id_col, **columns)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(-?[0-9]+)>', 1) as bigint)")
    back = read_warc(spark, path, verify=True)
    return back.select(number("record_id").alias(id_col), "target_uri", "payload", "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
