"""WARC archives: one gzip member per record, written and read record by record.

Payloads are compared by SHA-1 before anything is written; a repeated payload becomes
a revisit record that refers to the one response. The reader inflates a file in small
steps, takes each record by its Content-Length, and checks block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerwatch.workspace import new_folder, stage

#: Payloads from this size on are kept once.
REVISIT_BYTES = 1000
#: Compressed bytes that are read, and inflated bytes that are taken, at a time.
READ_BYTES = 1 << 16
RECORDS = 256
_LEVEL = 3


class DamagedRecord(ValueError):
    """A record that does not say what it holds."""


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _http(url: str, length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = "".join(f"{k}: {_header(v)}\r\n" for k, v in [*headers, ("WARC-Block-Digest", sha1_label(block)), ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _header(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _members(file: BinaryIO) -> Iterator[Iterator[bytes]]:
    """The gzip members of a file, each as inflated pieces; at most one piece is held."""
    left = b""
    while left or (left := file.read(READ_BYTES)):
        packer = zlib.decompressobj(31)

        def pieces() -> Iterator[bytes]:
            nonlocal left
            while not packer.eof:
                if not left and not (left := file.read(READ_BYTES)):
                    raise DamagedRecord("the file ends inside a gzip member")
                piece = packer.decompress(left, READ_BYTES)
                left = packer.unused_data if packer.eof else packer.unconsumed_tail
                if piece:
                    yield piece

        own = pieces()
        yield own
        for _ in own:  # what the caller left of this member
            pass


def read_records(file: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record, in order. Raises :class:`DamagedRecord`."""
    for pieces in _members(file):
        held = bytearray()
        end = -1
        for piece in pieces:
            start = max(len(held) - 3, 0)
            held += piece
            if (end := held.find(b"\r\n\r\n", start)) >= 0:
                break
        if end < 0 or not held.startswith(b"WARC/1."):
            raise DamagedRecord("no record header")
        headers = {}
        for line in bytes(held[:end]).decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = _plain(value.strip())
        length = int(headers["content-length"])
        del held[: end + 4]
        for piece in pieces:
            held += piece
            if len(held) > length + 4:
                break
        if len(held) != length + 4 or held[length:] != b"\r\n\r\n":
            raise DamagedRecord("the block is not as long as its header says")
        block = bytes(held[:length])
        if headers.get("warc-block-digest", sha1_label(block)) != sha1_label(block):
            raise DamagedRecord("the block digest differs")
        yield headers, block


#: Hadoop's names of stores that Arrow knows by another.
STORES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def store_uri(path: str) -> str:
    """A Hadoop path as the address by which Arrow opens it; a plain path is a local or mounted file.

    Arrow takes keys and regions from the environment or the machine's role, not from Hadoop's settings.
    """
    scheme, mark, rest = path.partition("://")
    if not mark:
        return "file://" + path.removeprefix("file:")
    return f"{STORES.get(scheme.lower(), scheme)}://{rest}"


def _file(path: str):
    """File system and path of a shared file, for any store that Arrow opens."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(store_uri(path))


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part = f"part-{context.partitionId():06d}"
        store, final = _file(f"{folder}/{part}.warc.gz")
        own = f"{final}.{context.taskAttemptId()}"
        store.create_dir(final.rpartition("/")[0], recursive=True)
        count = 0
        with store.open_output_stream(own, compression=None) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    payload = row["payload"]
                    name = "none" if row["id"] is None else str(row["id"])
                    http = _http(row["url"] or "", len(payload))
                    headers = [
                        ("WARC-Type", "revisit" if row["revisit"] else "response"),
                        ("WARC-Record-ID", f"<urn:page:{name}>"),
                        ("WARC-Date", "1970-01-01T00:00:00Z"),
                        ("Content-Type", "application/http; msgtype=response"),
                        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()),
                    ]
                    if row["url"] is not None:
                        headers.append(("WARC-Target-URI", row["url"]))
                    if row["revisit"]:
                        headers += [
                            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                            ("WARC-Refers-To", f"<urn:page:{row['refers_to']}>"),
                        ]
                    out.write(record(headers, http if row["revisit"] else http + payload))
                    count += 1
        if count:  # a repeated task writes the same name again; readers only see whole files
            store.move(own, final)
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{part}.warc.gz"], "records": [count]})
        else:
            store.delete_file(own)

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per row below ``folder``, a file per task; ``path`` and ``records`` of the files.

    Of rows with equal payloads of ``REVISIT_BYTES`` or more, those with the largest id are
    responses and the others revisits. Rows without an id are revisits of rows with one, and
    responses among themselves. A null payload is empty.
    """
    payload = F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    last = rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.max("id").alias("last"))
    last = last.where("last is not null").withColumnRenamed("digest", "same")
    both = rows.join(last, rows.digest == last.same, "left").drop("same")
    revisit = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    both = both.select("id", "url", "payload", "digest", revisit.alias("revisit"), F.when(revisit, F.col("last")).alias("refers_to"))
    return stage(both.mapInArrow(_write(folder), "path string, records long"), "warc-files")


RECORD = T.StructType(
    [
        T.StructField("id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()), T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType()),
    ]
)


def _page(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def parse(headers: dict[str, str], block: bytes) -> dict:
    """A record's page, its payload's length and digest, and the payload if it is there. Checks both."""
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.partition(": ")[::2] for line in http.decode().split("\r\n")[1:])
    kind = headers["warc-type"]
    length = int(fields["Content-Length"])
    stated = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != stated):
        raise DamagedRecord("the payload is not what its header says")
    refers = headers.get("warc-refers-to")
    return {
        "id": _page(headers["warc-record-id"]), "url": headers.get("warc-target-uri"), "record_type": kind,
        "refers_to": _page(refers) if refers else None, "payload_bytes": length, "payload_digest": stated,
        "payload": payload if kind == "response" else None,
    }


def _read(with_payload: bool, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, inner = _file(path)
                rows: list[dict] = []
                with store.open_input_stream(inner, compression=None) as file:
                    for headers, block in read_records(file):
                        found = parse(headers, block)
                        rows.append(found if with_payload else {**found, "payload": None})
                        if len(rows) == RECORDS:
                            yield pa.RecordBatch.from_pylist(rows, schema=out)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=out)

    return run


def read_archives(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the files in column ``path``; one task reads a file from front to end."""
    n = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    spread = files.select("path").repartition(n, "path")
    return spread.mapInArrow(_read(with_payload, to_arrow_schema(RECORD)), RECORD)


def archive_folder(spark) -> str:
    return new_folder(spark, "warc")
