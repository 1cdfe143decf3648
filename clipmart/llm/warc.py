"""Converting legacy ARC archives to WARC.

``write_arcs`` lays out rows as ARC files (versions 1 and 2 in turn, a gzip
member per record).  ``arc_records`` parses them: the version block of a file
names the fields of its header lines, and each record's body is as long as its
line declares.  ``convert`` writes a WARC file per ARC file with synthesised
record identifiers, ISO timestamps, types and digests; a record whose payload
another record already has becomes a revisit of it.  ``read_warcs`` reads the
WARC files back.

Tasks read and write one bounded file at a time in the shared folder, and put
finished files in place by name, so a task that runs again replaces its own
files.  Of records with equal payloads the one with the smallest key is the
response, of rows with equal keys the first in file order; rows without a key
come last.  Payload groups meet only as counts and minima, however large.

Defined cases: a null or empty html is an empty payload; with ``at_least`` 0
empty payloads revisit each other too; a null url is written as ``-``, and
white space and control characters in a url are percent-encoded; a null key is
a record without one, whose revisits have null ``refers_to``; an empty table
makes no archives and an empty result.  A header line or body that is cut off
raises with the file's name.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipmart.llm.common import new_folder, only, read_file, small_batches, staged, write_file

FILE_BYTES, FILE_RECORDS = 8_000_000, 20_000  # of an archive, before compression; a longer record has its own
CAPTURED = "20000101000000"  # ARC dates where the input has none
BROADCAST_ROWS = 100_000  # of payloads found twice or more, about 100 bytes each
#: Header fields of the two ARC versions (fixed values of the format).
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- ARC ---------------------------------------------------------------------------

def arc_line(version: int, url: str, date: str, kind: str, length: int, name: str = "-") -> bytes:
    middle = f"{kind} {length}" if version == 1 else f"{kind} 200 - - 0 {name} {length}"
    return f"{url} 0.0.0.0 {date} {middle}\n".encode()


def arc_start(version: int, name: str) -> bytes:
    """The version block, which names the fields of the header lines."""
    body = f"{version} 0 clipmart\n{ARC_FIELDS[version]}\n\n".encode()
    return arc_line(version, f"filedesc://{name}", CAPTURED, "text/plain", len(body), name) + body + b"\n"


def arc_url(url: str | None) -> str:
    return re.sub(r"[\s\x00-\x1f\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "-"


def http_head(key: int | None, size: int) -> bytes:
    own = "" if key is None else f"X-Page-Id: {key}\r\n"
    return f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {size}\r\n\r\n".encode()


def write_arcs(pages: DataFrame, root: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the rows as ARC files and return their names (``file``)."""
    small_batches(pages.sparkSession)
    given = only(pages, key=key, url=url, html=html).withColumn("key", F.col("key").cast("long"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, number, out, size, records = TaskContext.get().partitionId(), 0, [], 0, 0

        def name() -> str:
            return f"{part:06d}-{number:06d}.arc.gz"

        for b in batches:
            done = []
            for k, u, h in zip(b["key"].tolist(), b["url"].tolist(), b["html"].tolist()):
                version = 1 + (part + number) % 2
                if not out:
                    out.append(gzip.compress(arc_start(version, name()), 1, mtime=0))
                payload = h.encode("utf-8", "surrogatepass") if isinstance(h, str) else b""
                body = http_head(None if pd.isna(k) else int(k), len(payload)) + payload
                line = arc_line(version, arc_url(u if isinstance(u, str) else None), CAPTURED, "text/html", len(body), name())
                out.append(gzip.compress(line + body + b"\n", 1, mtime=0))
                size, records = size + len(line) + len(body), records + 1
                if size >= FILE_BYTES or records >= FILE_RECORDS:
                    done.append(write_file(root, name(), b"".join(out)))
                    out, size, records, number = [], 0, 0, number + 1
            yield pd.DataFrame({"file": pd.Series(done, dtype=object)})
        if out:
            yield pd.DataFrame({"file": [write_file(root, name(), b"".join(out))]})

    return given.mapInPandas(run, "file string")


def arc_records(stream: BinaryIO, name: str) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(number, header fields, body) of every record; number 0 is the version block."""
    names, number = ARC_FIELDS[1].split(), 0
    while line := stream.readline():
        if line in (b"\n", b"\r\n"):  # between records
            continue
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        values = text.rsplit(" ", len(names) - 1) if number else text.split(" ")
        if not values[-1].isdigit() or (number and len(values) != len(names)):
            raise ValueError(f"{name}: record {number} has no proper header line: {line[:200]!r}")
        body = stream.read(int(values[-1]))
        if len(body) < int(values[-1]):
            raise ValueError(f"{name}: record {number} is cut off")
        if number == 0:
            about = body.decode("utf-8", "replace").split("\n")
            names = about[1].split() if len(about) > 1 and about[1].strip() else ARC_FIELDS[int(about[0].split()[0])].split()
            yield 0, {"URL": values[0], "Version": about[0].split(" ")[0]}, body
        else:
            yield number, dict(zip(names, values)), body
        number += 1


def http_parts(body: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """(head with its empty line, payload, header fields); a body that isn't
    an HTTP response is all payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body, {}
    end = re.search(rb"\r?\n\r?\n", body)
    cut = end.end() if end else len(body)
    lines = body[:cut].decode("latin-1").splitlines()[1:]
    return body[:cut], body[cut:], {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if ":" in x)}


# --- WARC --------------------------------------------------------------------------

def record_id(key: int | None, file: str, number: int) -> str:
    """A record's URN: a custom (version 8) UUID whose last 64 free bits are
    the key and whose first 58 tell records with one key apart, or a
    name-based (version 5) one without a key."""
    if key is None:
        return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{number}')}"
    mark = int.from_bytes(hashlib.sha1(f"{file}#{number}".encode()).digest()[:8]) >> 6
    bits = mark << 64 | key % 2**64
    value = bits >> 74 << 80 | 8 << 76 | (bits >> 62 & 0xFFF) << 64 | 2 << 62 | bits & (1 << 62) - 1
    return f"urn:uuid:{uuid.UUID(int=value)}"


def key_of(urn: str) -> int | None:
    """The key in an identifier of ``record_id``."""
    u = uuid.UUID(urn.strip("<>"))
    if u.version != 8:
        return None
    key = (u.int >> 64 & 0xFFF) << 62 & (1 << 64) - 1 | u.int & (1 << 62) - 1
    return key - 2**64 if key >= 2**63 else key


def iso_date(arc: str) -> str:
    """2000-01-01T00:00:00Z of 20000101000000; missing digits are the earliest."""
    d = arc[:14] + "00000101000000"[len(arc[:14]):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))]) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 1, mtime=0)


def converted(file: str, number: int, header: dict[str, str], body: bytes, refers: str | None) -> bytes:
    """The WARC record of an ARC record; ``refers`` is the identifier of the
    record that has its payload, if it is to be a revisit."""
    if number == 0:
        about = f"software: clipmart\r\nformat: WARC file version 1.1\r\nconverted-from: {header['URL']}\r\n".encode()
        return warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_id(None, file, 0)}>"),
                            ("WARC-Date", iso_date(CAPTURED)), ("Content-Type", "application/warc-fields")], about)
    head, payload, http = http_parts(body)
    block = head if refers else body
    kind = "revisit" if refers else "response" if head else "resource"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id(page_key(http), file, number)}>"),
              ("WARC-Target-URI", header["URL"]), ("WARC-Date", iso_date(header["Archive-date"])),
              ("WARC-IP-Address", header["IP-address"]), ("WARC-Payload-Digest", f"sha1:{sha1(payload)}"),
              ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
              ("Content-Type", "application/http;msgtype=response" if head else header["Content-type"])]
    if refers:
        fields += [("WARC-Refers-To", f"<{refers}>"), ("WARC-Profile", REVISIT_PROFILE)]
    return warc_record(fields, block)


def page_key(http: dict[str, str]) -> int | None:
    return int(http["x-page-id"]) if "x-page-id" in http else None


def warc_records(stream: BinaryIO, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: a record begins with {line[:100]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode("utf-8").rstrip("\r\n").partition(":")
            fields[k.lower()] = v.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"{name}: a record is cut off")
        yield fields, block


# --- jobs --------------------------------------------------------------------------

def spread(files: DataFrame) -> DataFrame:
    """A task per file, or per few files where there are very many."""
    return files.repartition(max(1, min(files.count(), 10_000)))


def unzipped(root: str, name: str) -> BinaryIO:
    data = io.BytesIO(read_file(root, name))
    return io.BufferedReader(gzip.GzipFile(fileobj=data)) if name.endswith(".gz") else data


def read_arcs(files: DataFrame, root: str) -> DataFrame:
    """file, no, key, size and digest of every record but the version blocks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for f in b["file"]:
                rows = []
                for no, _, body in arc_records(unzipped(root, f), f):
                    if no:
                        _, payload, http = http_parts(body)
                        rows.append((f, no, page_key(http), len(payload), sha1(payload)))
                out = pd.DataFrame(rows, columns=["file", "no", "key", "size", "digest"])
                yield out.astype({"key": "Int64"})

    return spread(files).mapInPandas(run, "file string, no long, key long, size long, digest string")


def revisits(records: DataFrame, at_least: int = 0) -> DataFrame:
    """(file, no, key, to_file, to_no): the records that become revisits, and
    which record each refers to (``key`` is that record's)."""
    order = F.struct(F.col("key").isNull().alias("without"), "key", "file", "no")
    first = (records.where(F.col("size") >= at_least).groupBy("digest", "size")
             .agg(F.count("*").alias("n"), F.min(order).alias("first")).where("n > 1"))
    first = staged(first.select("digest", "size", F.col("first.key").alias("to_key"),
                                F.col("first.file").alias("to_file"), F.col("first.no").alias("to_no")), "warc-first")
    side = F.broadcast(first) if first.count() <= BROADCAST_ROWS else first
    return (records.join(side, ["digest", "size"]).where("file <> to_file OR no <> to_no")
            .select("file", "no", F.col("to_key").alias("key"), "to_file", "to_no"))


def convert(files: DataFrame, root: str, out: str, at_least: int = 0) -> DataFrame:
    """Convert ARC files of the folder ``root`` to WARC files in ``out``;
    returns their names (``file``)."""
    records = staged(read_arcs(files, root), "arc-records")
    # at most FILE_RECORDS of a file
    refers = revisits(records, at_least).groupBy("file").agg(
        F.collect_list(F.struct("no", "key", "to_file", "to_no")).alias("refers"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for f, refers_ in zip(b["file"], b["refers"]):
                to = {} if refers_ is None else {
                    r["no"]: record_id(None if pd.isna(r["key"]) else int(r["key"]), r["to_file"], r["to_no"])
                    for r in refers_}
                data = b"".join(converted(f, no, header, body, to.get(no))
                                for no, header, body in arc_records(unzipped(root, f), f))
                name = re.sub(r"\.arc(\.gz)?$", "", f) + ".warc.gz"
                yield pd.DataFrame({"file": [write_file(out, name, data)]})

    both = files.join(refers, "file", "left")
    n = max(1, min(files.count(), 10_000))
    return both.repartition(n).mapInPandas(run, "file string")


def read_warcs(files: DataFrame, root: str) -> DataFrame:
    """key, payload_bytes, payload_digest, record_type, refers_to and url of
    every response, resource and revisit record."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for f in b["file"]:
                rows = []
                for fields, block in warc_records(unzipped(root, f), f):
                    if fields["warc-type"] == "warcinfo":
                        continue
                    _, payload, http = http_parts(block)
                    declared = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] == "revisit":  # the payload is with the record it refers to
                        size, to = int(http["content-length"]), key_of(fields["warc-refers-to"])
                    else:
                        size, to = len(payload), None
                        if sha1(payload) != declared:
                            raise ValueError(f"{f}: {fields['warc-record-id']} doesn't have the payload it declares")
                    rows.append((key_of(fields["warc-record-id"]), size, declared, fields["warc-type"], to,
                                 fields["warc-target-uri"]))
                out = pd.DataFrame(rows, columns=["key", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])
                yield out.astype({"key": "Int64", "refers_to": "Int64"})

    return spread(files).mapInPandas(
        run, "key long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", at_least: int = 0) -> DataFrame:
    """Pages as ARC files, converted to WARC and read back."""
    spark = pages.sparkSession
    arcs, warcs = new_folder(spark, "arcs"), new_folder(spark, "warcs")
    files = staged(write_arcs(pages, arcs, key, url, html), "arc-files")
    return read_warcs(staged(convert(files, arcs, warcs, at_least), "warc-files"), warcs)
