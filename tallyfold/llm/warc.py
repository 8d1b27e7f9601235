"""WARC archives with an index that is written first, and reads of sorted, coalesced byte ranges.

Each task writes the records of its rows to an archive of its own, a gzip member per record, and gives back where each
lies. Only what a successful task gives back enters the index, so a task that runs again leaves no trace but an unused
file. Reading takes index rows, sorts them by archive and offset, joins neighbouring ranges into one read, and checks
each payload against its digest. Archives lie in a folder that all executors share, on any file system of pyarrow.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import Scratch, text_bytes

LEAST_SHARED = 1000  # payload bytes from which equal payloads are written once
GAP = 64 << 10  # unread bytes that a read may span
READ = 8 << 20  # bytes of one read, beyond a single longer record
PIECE = 32 << 20  # bytes of an archive that one reading task takes
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # of every record, so that a second run writes the same bytes

def _schema(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind()) for name, kind in columns.items()])


INDEX = _schema(page_id=T.LongType, url=T.StringType, archive=T.StringType, offset=T.LongType, length=T.LongType,
                payload_digest=T.StringType, record_type=T.StringType, refers_to=T.LongType)
READ_BACK = _schema(page_id=T.LongType, url=T.StringType, payload=T.BinaryType, payload_bytes=T.LongType,
                    payload_digest=T.StringType, record_type=T.StringType, refers_to=T.LongType)


def _open(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _id(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _clean(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 else c for c in url)


def record(page_id, url, payload: bytes, refers_to) -> tuple[bytes, str]:
    """A WARC record of a page and the SHA-1 of its payload; a revisit carries the headers alone."""
    digest = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_id(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest.digest()).decode()}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest.hexdigest()


def parse(data: bytes) -> tuple[dict[str, str], bytes, dict[str, str]]:
    """Headers, payload and HTTP headers of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, payload, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])


def revisits(pages: DataFrame, *, least: int = LEAST_SHARED) -> DataFrame:
    """(page_id, body, refers_to) of the pages whose payload a larger page_id also has."""
    payload = F.coalesce("html", F.lit(""))
    slim = pages.select("page_id", F.sha1(payload.cast("binary")).alias("digest"), F.xxhash64(payload).alias("body"),
                        F.octet_length(payload).alias("bytes")).where(F.col("bytes") >= least)
    last = slim.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    several = last.where("n > 1 AND refers_to IS NOT NULL").drop("n")
    met = slim.join(several, ["digest", "bytes"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return met.select(F.col("page_id").alias("of"), F.col("body").alias("held"), "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, *, least: int = LEAST_SHARED, scratch: Scratch) -> DataFrame:
    """Write every page to archives below ``folder`` and return the stored index, a row per record."""
    known = scratch.keep(revisits(pages, least=least), "revisits")
    slim = pages.select("page_id", "url", "html", F.xxhash64(F.coalesce("html", F.lit(""))).alias("body"))
    same = slim["page_id"].eqNullSafe(known["of"]) & (slim["body"] == known["held"])
    rows = slim.join(known, same, "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator) -> Iterator:
        files, top = _open(folder)
        files.create_dir(top, recursive=True)
        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
        stream = None
        try:
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    if stream is None:
                        stream = files.open_output_stream(f"{top}/{name}", compression=None)
                    data, digest = record(row["page_id"], row["url"], text_bytes(row["html"]), row["refers_to"])
                    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                    member = packer.compress(data) + packer.flush()
                    stream.write(member)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    out.append((row["page_id"], row["url"], name, offset, len(member), digest, kind, row["refers_to"]))
                    offset += len(member)
                yield _arrow(out, INDEX)
        finally:
            if stream is not None:
                stream.close()

    return scratch.keep(rows.mapInArrow(run, INDEX), "index")


def _arrow(rows: list[tuple], kind: T.StructType):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(kind)
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def read_records(index: DataFrame, folder: str, *, payload: bool = True) -> DataFrame:
    """The records that ``index`` selects: payload as stored, size and SHA-1 of the full payload, type, refers_to.

    A payload that differs from its digest, in the record or in the index, stops the job.
    """
    piece = F.floor(F.col("offset") / PIECE)
    rows = index.repartition("archive", piece).sortWithinPartitions("archive", "offset")

    def ranges(wanted: list[dict]) -> Iterator[list[dict]]:
        held: list[dict] = []
        for row in wanted:
            if held:
                start, end = held[0]["offset"], held[-1]["offset"] + held[-1]["length"]
                far = row["archive"] != held[0]["archive"] or row["offset"] < end or row["offset"] - end > GAP
                if far or row["offset"] + row["length"] - start > READ:
                    yield held
                    held = []
            held.append(row)
        if held:
            yield held

    def run(batches: Iterator) -> Iterator:
        files, top = _open(folder)
        name, stream = None, None
        for batch in batches:
            for group in ranges(batch.to_pylist()):
                if group[0]["archive"] != name:
                    if stream is not None:
                        stream.close()
                    name = group[0]["archive"]
                    stream = files.open_input_file(f"{top}/{name}")
                start = group[0]["offset"]
                data = stream.read_at(group[-1]["offset"] + group[-1]["length"] - start, start)
                out = []
                for row in group:
                    at = row["offset"] - start
                    fields, body, http = parse(zlib.decompress(data[at:at + row["length"]], 31))
                    kind = fields["WARC-Type"]
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    wrong = kind == "response" and hashlib.sha1(body).hexdigest() != digest
                    if wrong or digest != row["payload_digest"] or fields["WARC-Record-ID"] != _id(row["page_id"]):
                        raise ValueError(f"record at {name}:{row['offset']} is not what the index says")
                    other = fields.get("WARC-Refers-To")
                    refers = None if other is None else int(other.removeprefix("<urn:page:").removesuffix(">"))
                    out.append((row["page_id"], fields.get("WARC-Target-URI"), body if payload else None,
                                int(http["Content-Length"]), digest, kind, refers))
                yield _arrow(out, READ_BACK)
        if stream is not None:
            stream.close()

    return rows.mapInArrow(run, READ_BACK)


def round_trip(spark: SparkSession, pages: DataFrame, *, least: int = LEAST_SHARED) -> DataFrame:
    """Write all pages, read all records back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    One row per input row. A null html is an empty payload. Of equal payloads of at least ``least`` bytes, all rows of
    the largest page_id are responses, the others revisit it; rows without page_id revisit too, and are responses where
    no equal payload has an id. Columns other than page_id, url and html are not read.
    """
    scratch = Scratch(spark, "warc")
    folder = f"{scratch.folder}/archives"
    index = write_archives(pages, folder, least=least, scratch=scratch)
    return read_records(index, folder, payload=False).drop("payload", "url")
