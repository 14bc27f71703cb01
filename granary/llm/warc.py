"""WARC records in ZIP packages: written by tasks, and read back by ranges.

A package is a ZIP file with two stored members: ``archive/data.warc.gz``, one gzip member for
each record, and ``indexes/index.cdx``, a line for each record with its offset and length.
Every task writes packages of its own under names that no other attempt uses; the list of the
packages that count is what the writing job returned, so a lost or repeated attempt leaves
nothing that is read. Readers parse the directory of a package, take its index, and range-read
the records; no member is extracted.

Equal payloads: of the records whose payloads are equal and of at least ``least`` bytes, the
one with the largest page_id is a response and the others are revisits of it. A group of equal
pages is a row of counts before it is joined back, and adaptive execution splits a page that
very many rows share.

Results: a null html is an empty payload; rows of one page_id and payload are all responses,
if any is; a null page_id is smaller than any other; an empty table gives no packages and no
rows. Only the columns page_id, url and html are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import folder_uri, longs
from granary.llm.zipfiles import Writer, data_offset, directory
from granary.session import durable

LEAST_PAYLOAD = 1000
PACKAGE_BYTES = 256 << 20
#: Records that one read takes at most; their bytes are adjacent.
RUN = 64
#: Partitions of a reading job at most, and stored bytes that one of them is meant for.
READERS, READ_BYTES = 10_000, 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
# Names and values of the WARC format; fixed values.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"
DATE = "2024-01-01T00:00:00Z"


def planned(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null for responses) of every page."""
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = rows.where(F.length("payload") >= least).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    return rows.join(large.where("n > 1").drop("n"), "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )


def _id(page: str | None) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """The bytes of a response, or of a revisit, which keeps the HTTP header and its length; ids in decimal."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(page)}",
        f"WARC-Date: {DATE}",
        f"Content-Type: {HTTP}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%-._~')}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    block = http if revisit else http + payload
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """What a record says; payload length and digest of a response are taken from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if fields["warc-type"] == "response":
        length, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if digest != stated:
            raise ValueError(f"{fields['warc-record-id']}: the payload is not the one written")
    else:
        headers = dict(x.lower().split(": ", 1) for x in http.decode().split("\r\n")[1:])
        length, digest = int(headers["content-length"]), stated
    return {
        "page_id": _number(fields["warc-record-id"]),
        "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": _number(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
    }


def _number(urn: str) -> int | None:
    value = urn.strip("<>").rpartition(":")[2]
    return None if value == "null" else int(value)


def _packages(folder: str, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, int]]:
    """Write the rows of a task; (path, bytes, records) of every package."""
    store, at = fs.FileSystem.from_uri(folder)
    store.create_dir(at, recursive=True)
    out, rows = None, 0
    for batch in batches:
        for page, url, payload, digest, refers in zip(*(batch[c] for c in ("page_id", "url", "payload", "digest", "refers_to"))):
            if out is None:
                name = f"{at}/{uuid.uuid4().hex}.wacz"
                stream = store.open_output_stream(name)
                out, index, rows = Writer(stream), [], 0
                out.begin(DATA)
            packed = gzip.compress(record(page, url, bytes(payload), digest, refers), compresslevel=1, mtime=0)
            index.append(f"{out.write(packed)} {len(packed)}")
            rows += 1
            if out.at >= PACKAGE_BYTES:
                yield name, _finish(out, stream, index), rows
                out = None
    if out is not None:
        yield name, _finish(out, stream, index), rows


def _finish(out: Writer, stream, index: list[str]) -> int:
    out.end()
    out.begin(INDEX)
    out.write("\n".join(index).encode())
    out.end()
    out.close()
    stream.close()
    return out.at


def write(pages: DataFrame, folder: str, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Write the packages of all ``pages`` below ``folder``; their paths, sizes and record counts."""

    def packages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, size, rows in _packages(folder, batches):
            yield pd.DataFrame({"package": [name], "bytes": [size], "records": [rows]})

    # ids as text: a long column with nulls would reach pandas as floats
    spelled = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    return durable(planned(pages, least).withColumns(spelled).mapInPandas(packages, "package string, bytes long, records long"))


def _reader(folder: str, package: str):
    return fs.FileSystem.from_uri(folder)[0].open_input_file(package)


def ranges(packages: DataFrame, folder: str) -> DataFrame:
    """(package, offset, lengths): runs of adjacent records, from directory and index of each package."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for package in batch["package"]:
                with _reader(folder, package) as file:
                    members = {m.name: m for m in directory(lambda at, n: file.read_at(n, at), file.size())}
                    start = data_offset(lambda at, n: file.read_at(n, at), members[DATA])
                    index = members[INDEX]
                    raw = file.read_at(index.size, data_offset(lambda at, n: file.read_at(n, at), index))
                    if zlib.crc32(raw) != index.crc:
                        raise ValueError(f"{package}: the index is not the one written")
                lines = [tuple(map(int, x.split())) for x in raw.decode().split("\n")]
                for i in range(0, len(lines), RUN):
                    part = lines[i : i + RUN]
                    yield pd.DataFrame({"package": [package], "offset": [start + part[0][0]], "lengths": [[n for _, n in part]]})

    # a row is a whole package, however few its bytes are
    parts = min(READERS, max(1, packages.count()))
    return packages.select("package").repartition(parts, F.col("package")).mapInPandas(runs, "package string, offset long, lengths array<long>")


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(packages: DataFrame, folder: str) -> DataFrame:
    """Every record of the packages, range-read from the stored archives."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for package, offset, lengths in zip(batch["package"], batch["offset"], batch["lengths"]):
                with _reader(folder, package) as file:
                    found, at = [], int(offset)
                    for n in lengths:
                        found.append(parse(gzip.decompress(file.read_at(int(n), at))))
                        at += int(n)
                ids = {c: longs(x[c] for x in found) for c in ("page_id", "refers_to")}
                yield pd.DataFrame(found).assign(**ids)

    size = packages.agg(F.sum("bytes")).first()[0] or 0
    parts = min(READERS, max(1, -(-size // READ_BYTES)))
    return ranges(packages, folder).repartition(parts, F.col("package"), F.col("offset")).mapInPandas(records, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Write all pages as packages into the shared folder and read every record back."""
    folder = folder_uri(spark, "warc")
    return read(write(pages, folder, least), folder)
