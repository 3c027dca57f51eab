"""WARC archives: a deterministic, sharded writer and a reader of what it committed."""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import ranges
from tallyloom.llm.common import stored
from tallyloom.llm.files import attempt, publish, store, written

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # a run writes the same bytes each time, so the date is a parameter, not the clock
CHUNK = 1 << 16
LEVEL = 6
RECORD_BYTES = 600  # of headers, about; counts in the size of a range


def verdicts(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """(page_id, digest, refers_to): the rows that revisit an equal payload, once each.

    Among equal payloads of at least ``least_bytes`` the one with the largest page_id is the
    response. Rows that share that page_id are all responses, and so are rows without a page_id
    if no row of the group has one.
    """
    keys = pages.select("page_id", "digest", "payload_bytes").filter(F.col("payload_bytes") >= least_bytes)
    kept = keys.groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    repeated = kept.filter("n > 1 and refers_to is not null").drop("n")
    found = keys.join(repeated, ["digest", "payload_bytes"])
    return found.filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def prepared(pages: DataFrame, text: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, digest): payload is the text in UTF-8, null as empty."""
    payload = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    return rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})


def _headers(pairs: Iterable[tuple[str, str]]) -> bytes:
    return b"".join(f"{name}: {value}\r\n".encode() for name, value in pairs)


def _target(page_id: int | None, url: str | None) -> str:
    """The page's address as a header value; control characters and blanks are percent-encoded."""
    if not url:
        return f"urn:page:{'' if page_id is None else page_id}"
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_id(page_id: int | None, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{sha1}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One whole record; headers and digests are made anew from the payload."""
    http = b"HTTP/1.1 200 OK\r\n" + _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]) + b"\r\n"
    block = http if refers_to is not None else http + payload
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    named = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, sha1)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _target(page_id, url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{block_digest}"),
    ]
    if page_id is not None:
        named.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        named += [("WARC-Refers-To", record_id(refers_to, sha1)), ("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    named += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + _headers(named) + b"\r\n" + block + b"\r\n\r\n"


def compressed(data: bytes) -> bytes:
    """One gzip member without a time stamp, so equal records give equal bytes."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Files:
    """Files of one shard: written under temporary names, renamed when complete."""

    def __init__(self, folder: str, shard: int, attempt: str, roll_bytes: int) -> None:
        self.fs, self.folder = store(folder)
        self.shard, self.attempt, self.roll_bytes = shard, attempt, roll_bytes
        self.done: list[dict] = []
        self.out = None

    def write(self, member: bytes) -> None:
        if self.out is not None and self.size + len(member) > self.roll_bytes:
            self.close()
        if self.out is None:
            self.temporary = f"{self.folder}/_temporary-{self.shard:05d}-{len(self.done):05d}-{self.attempt}"
            self.out, self.size, self.records, self.sha = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        name = f"part-{self.shard:05d}-{len(self.done):05d}.warc.gz"
        publish(self.fs, self.temporary, f"{self.folder}/{name}")
        self.done.append({"file": name, "bytes": self.size, "records": self.records, "sha256": self.sha.hexdigest()})
        self.out = None

    def commit(self) -> None:
        """Close the last file and publish the shard's manifest, which makes its files count."""
        self.close()
        temporary = f"{self.folder}/_temporary-manifest-{self.shard:05d}-{self.attempt}"
        with self.fs.open_output_stream(temporary) as out:
            out.write(json.dumps({"shard": self.shard, "files": self.done}).encode())
        publish(self.fs, temporary, f"{self.folder}/manifest-{self.shard:05d}.json")


def write(pages: DataFrame, folder: str, shards: int, least_bytes: int = 1000, roll_bytes: int = 64 << 20, date: str = DATE) -> dict:
    """Archive pages (page_id, url, html) under ``folder``; returns the committed totals.

    Rows are range-sorted by page_id over at most ``shards`` tasks; equal input and settings give
    equal files, as the ranges follow from exact sums of payload bytes and not from a sample. Their
    first keys are in the manifest. Each task writes its records in order and starts a new file
    before the compressed size passes ``roll_bytes``. Files and shard manifests get their names by
    renaming, so a lost executor or a second attempt leaves nothing half-written under a final name;
    readers follow ``_MANIFEST.json`` alone, which the driver writes last. Temporary files that
    failed attempts left are removed then.

    Null payloads are empty, null addresses get a ``urn:page:`` address, null ids no id header;
    repeated rows give repeated records; other columns are ignored; an empty table gives an
    archive without records. Revisit verdicts travel through the same sort as their pages, as
    narrow rows before them, so payloads are shuffled once. All rows of one page_id share a file's
    task.
    """
    spark = pages.sparkSession
    ready = prepared(pages)
    sizes = stored(ready.select("page_id", "digest", "payload_bytes"), "payloads")
    told = stored(verdicts(sizes, least_bytes), "verdicts")
    chosen = ranges.cuts(sizes, "page_id", F.col("payload_bytes") + RECORD_BYTES, shards)
    heavy = ready.select("page_id", "digest", F.lit(1).alias("page"), "url", "payload", F.lit(None).cast("long").alias("refers_to"))
    narrow = told.select("page_id", "digest", F.lit(0).alias("page"), F.lit(None).cast("string").alias("url"),
                         F.lit(None).cast("binary").alias("payload"), "refers_to")
    rows = ranges.by_shard(heavy.union(narrow), "page_id", chosen, ["page_id", "digest", "page", "url"])

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, files, told_of, refers_to = attempt(), None, None, None
        done: list[_Files] = []
        for batch in batches:
            for page_id, digest, page, url, payload, refers, shard in zip(*(column.to_pylist() for column in batch.columns)):
                if files is None or files.shard != shard:
                    if files:
                        files.commit()
                    files = _Files(folder, shard, mark, roll_bytes)
                    done.append(files)
                if not page:
                    told_of, refers_to = (page_id, digest), refers
                    continue
                own = refers_to if told_of == (page_id, digest) else None
                files.write(compressed(record(page_id, url, payload, digest, own, date)))
        if files:
            files.commit()
        columns = [[f.shard for f in done], [sum(one["records"] for one in f.done) for f in done], [len(f.done) for f in done]]
        yield pa.RecordBatch.from_pydict(dict(zip(("shard", "records", "files"), columns)),
                                         schema=pa.schema([("shard", pa.int32()), ("records", pa.int64()), ("files", pa.int32())]))

    fs, path = store(folder)
    fs.create_dir(path, recursive=True)
    written_rows = rows.select("page_id", "digest", "page", "url", "payload", "refers_to", "shard").mapInArrow(archive, "shard int, records long, files int")
    totals = written_rows.agg(F.max("shard"), F.sum("records"), F.sum("files")).first()
    manifest = {"shards": 0 if totals[0] is None else totals[0] + 1, "records": totals[1] or 0, "files": totals[2] or 0, "cuts": chosen}
    for left in fs.get_file_info(pa.fs.FileSelector(path)):
        if left.base_name.startswith("_temporary"):
            fs.delete_file(left.path)
    with written(fs, f"{path}/_MANIFEST.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def _members(stream, sha) -> Iterator[bytes]:
    """The unpacked gzip members of a file, one record each, read in small pieces; ``sha`` takes in the file's bytes."""
    unpacker, held = zlib.decompressobj(31), io.BytesIO()
    while data := stream.read(CHUNK):
        sha.update(data)
        while data:
            held.write(unpacker.decompress(data))
            data = b""
            if unpacker.eof:
                yield held.getvalue()
                data, unpacker, held = unpacker.unused_data, zlib.decompressobj(31), io.BytesIO()
    if held.getvalue() or unpacker.unused_data:
        raise ValueError("the archive ends inside a record")


def parse(member: bytes) -> dict:
    """Fields of one record; raises ValueError where length or digests do not fit the content."""
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION:
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    named = dict(line.decode().split(": ", 1) for line in lines)
    block, end = rest[: int(named["Content-Length"])], rest[int(named["Content-Length"]) :]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.decode().split(": ", 1) for line in http.split(b"\r\n")[1:])
    size, sha1 = int(fields["Content-Length"]), base64.b32decode(named["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if end != b"\r\n\r\n" or base64.b32encode(hashlib.sha1(block).digest()).decode() != named["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"damaged record {named['WARC-Record-ID']}")
    response = named["WARC-Type"] == "response"
    if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != sha1):
        raise ValueError(f"damaged payload in {named['WARC-Record-ID']}")
    page, refers = named.get("X-Page-Id"), named.get("X-Refers-To-Page-Id")
    return {
        "page_id": None if page is None else int(page), "target_uri": named["WARC-Target-URI"], "payload_bytes": size,
        "payload_digest": sha1, "record_type": named["WARC-Type"], "refers_to": None if refers is None else int(refers),
        "payload": payload if response else None,
    }


FIELDS = pa.schema([
    ("page_id", pa.int64()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of a committed archive; every file is checked against its manifest (bytes, records, SHA-256), every record against its digests."""
    fs, path = store(folder)
    with fs.open_input_stream(f"{path}/_MANIFEST.json") as source:
        shards = json.loads(source.read())["shards"]
    wanted = FIELDS if with_payload else FIELDS.remove(FIELDS.get_field_index("payload"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                with files.open_input_stream(f"{root}/manifest-{shard:05d}.json") as source:
                    parts = json.loads(source.read())["files"]
                for listed in parts:
                    yield from records(files, f"{root}/{listed['file']}", listed)

    def records(files: pa.fs.FileSystem, name: str, listed: dict) -> Iterator[pa.RecordBatch]:
        held, size, count, info, sha = [], 0, 0, files.get_file_info(name), hashlib.sha256()
        if info.size != listed["bytes"]:
            raise ValueError(f"{name} has {info.size} bytes, its manifest says {listed['bytes']}")
        with files.open_input_stream(name, compression=None) as stream:
            for member in _members(stream, sha):
                held.append(parse(member))
                size, count = size + len(member), count + 1
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema=wanted)
                    held, size = [], 0
        if (count, sha.hexdigest()) != (listed["records"], listed["sha256"]):
            raise ValueError(f"{name} is not the file that its manifest lists")
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=wanted)

    columns = "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    shard_rows = spark.range(0, max(shards, 1), 1, max(shards, 1)).filter(F.col("id") < shards)
    return shard_rows.mapInArrow(unpack, columns + (", payload binary" if with_payload else ""))
