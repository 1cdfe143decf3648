"""Token ids in binary files: frequency-ranked, byte-aligned, variable length.

Every document's ids, with an end id, are written in ascending id order.  Ids
are first replaced by their rank in order of frequency, so that common ones
are short.  Four ranks share a control byte with two bits each for their
lengths of 1 to 4 bytes; control bytes and data bytes are stored apart, and
numpy decodes a file by looking the control bytes up in a table of lengths.

A folder holds ``ranks.u32`` (the id of every rank) and files of at most
about ``FILE_TOKENS`` ids (a longer document has one of its own): ``HEAD``,
then document ids, null marks and lengths, control bytes, data bytes, all
little-endian.  Names sort in the order of the documents.

Defined cases: a null or empty text has the end id alone; a null document id
comes first; rows with equal ids lie side by side in an order of their own
ids' bytes, and equal rows follow each other; an empty table makes no files
and an empty result.  Every text is encoded whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipmart.llm import bpe
from clipmart.llm.common import new_folder, only, read_file, small_batches, staged, write_file

END = 0
FILE_TOKENS = 1_000_000
#: Characters of the texts that are encoded together; a longer one goes alone.
TEXTS_CHARS = 4_000_000
#: Files that a task reads, one after the other.
TASK_FILES = 4
HEAD = "<4sIQQQ"  # magic, version, documents, ids, data bytes
MAGIC, VERSION = b"VIDS", 1
RANKS = "ranks.u32"
#: Lengths of the four ranks of each control byte.
LENGTHS = (np.arange(256, dtype=np.uint8)[:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    v = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    v[:len(ranks)] = ranks
    code = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code[len(ranks):] = 0
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    keep = np.arange(4) <= code[:len(ranks), None]
    return control.tobytes(), v[:len(ranks)].view(np.uint8).reshape(-1, 4)[keep].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks of control and data bytes."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    end = np.cumsum(size, dtype=np.int64)
    at = end - size
    bytes_ = np.frombuffer(data, np.uint8)
    if (int(end[-1]) if n else 0) != len(bytes_):
        raise ValueError("the data bytes don't match the control bytes")
    out = bytes_[at].astype(np.uint32)
    more = np.arange(n)
    for k in range(1, 4):
        more = more[size[more] > k]
        out[more] |= bytes_[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def some(b: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """(rows, their texts) of a batch, up to 1,000 rows or until they hold
    ``TEXTS_CHARS`` characters."""
    for i in range(0, b.num_rows, 1000):
        part = b.slice(i, 1000)
        texts, first, held = [t or "" for t in part.column(1).to_pylist()], 0, 0
        for k, t in enumerate(texts):
            if held and held + len(t) > TEXTS_CHARS:
                yield part.slice(first, k - first), texts[first:k]
                first, held = k, 0
            held += len(t)
        yield part.slice(first), texts[first:]


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every row with the end id, as the bytes of
    unsigned 16- or 32-bit integers."""
    path = tokenizer or bpe.tokenizer_path()
    small_batches(docs.sparkSession)
    given = only(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = bpe.worker_encoder(path)
        end = np.array([END], e.kind).tobytes()
        for b in batches:
            for part, texts in some(b):
                cuts = [e.cut(t) if len(t) <= TEXTS_CHARS else None for t in texts]
                plain = e.together([c for c in cuts if c is not None], end)
                if len(plain) < len(texts):
                    rest = iter(plain.to_pylist())
                    plain = pa.array([e.ids(t) + end if c is None else next(rest) for t, c in zip(texts, cuts)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), plain], ["doc_id", "ids"])

    return given.mapInArrow(run, "doc_id long, ids binary")


def id_ranks(ids: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    """The id of every rank: by count, then by id; one row per id reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column(0):
                n += np.bincount(np.frombuffer(x.as_buffer(), kind), minlength=size) if len(x.as_py()) > size else 0
            short = [x for x in b.column(0).to_pylist() if len(x) <= size]
            if short:
                n += np.bincount(np.frombuffer(b"".join(short), kind), minlength=size)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n[found])], ["id", "n"])

    rows = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(size, np.int64)
    for r in rows:
        n[r["id"]] = r["n"]
    return np.lexsort((np.arange(size), -n)).astype("<u4")


def write_files(ids: DataFrame, root: str, ranks: np.ndarray, kind: np.dtype) -> DataFrame:
    """Write (doc_id, ids) rows in order; returns (part, number, file,
    documents, tokens) of every file."""
    rank_of = np.empty(len(ranks), np.uint32)
    rank_of[ranks] = np.arange(len(ranks), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, keys, parts, tokens = TaskContext.get().partitionId(), 0, [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, keys, parts, tokens
            name = f"{part:06d}-{number:06d}.ids"
            all_ = np.frombuffer(b"".join(parts), kind)
            control, data = pack(rank_of[all_])
            own = np.array([0 if k is None else k for k in keys], "<i8")
            null = np.array([k is None for k in keys], np.uint8)
            lengths = np.array([len(p) // kind.itemsize for p in parts], "<u8")
            write_file(root, name, struct.pack(HEAD, MAGIC, VERSION, len(keys), len(all_), len(data)) + own.tobytes()
                       + null.tobytes() + lengths.tobytes() + control + data)
            out = pa.RecordBatch.from_pylist([{"part": part, "number": number, "file": name,
                                               "documents": len(keys), "tokens": len(all_)}])
            number, keys, parts, tokens = number + 1, [], [], 0
            return out

        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys.append(k)
                parts.append(x)
                tokens += len(x) // kind.itemsize
                if tokens >= FILE_TOKENS:
                    yield flush()
        if keys:
            yield flush()

    in_order = (ids.repartitionByRange("doc_id", F.xxhash64("ids"))
                .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids"))
    return in_order.mapInArrow(run, "part long, number long, file string, documents long, tokens long")


def read_rows(root: str, name: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids as unsigned 32-bit integers) of a file."""
    ranks = np.frombuffer(read_file(root, RANKS), "<u4")
    data = read_file(root, name)
    magic, version, n, tokens, size = struct.unpack_from(HEAD, data)
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError(f"{name} is no file of token ids")
    at = struct.calcsize(HEAD)
    own = np.frombuffer(data, "<i8", n, at).tolist()
    null = np.frombuffer(data, np.uint8, n, at + 8 * n)
    lengths = np.frombuffer(data, "<u8", n, at + 9 * n).astype(np.int64)
    at += 17 * n
    control = -(-tokens // 4)
    ids = ranks[unpack(data[at:at + control], data[at + control:at + control + size], tokens)]
    end = np.cumsum(lengths)
    for k, no_id, a, b in zip(own, null, end - lengths, end):
        yield None if no_id else k, ids[a:b]


def read_files(files: DataFrame, root: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of
    every document, from the files.  Only the list of files, one row each,
    is summed up in one task."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    todo = files.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, start in zip(b["file"], b["start"]):
                rows = []
                for k, ids in read_rows(root, name):
                    rows.append((k, start, len(ids), zlib.crc32(ids)))
                    start += len(ids)
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield out.astype({"doc_id": "Int64"})

    n = max(1, min(-(-files.count() // TASK_FILES), 10_000))
    return todo.repartition(n).mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def written(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None
            ) -> tuple[DataFrame, str]:
    """Encode and write all rows; returns the list of files and their folder."""
    path = tokenizer or bpe.tokenizer_path()
    e = bpe.worker_encoder(path)  # only its vocabulary's size is used here
    ids = staged(encoded(docs, doc_id, text, path), "token-ids", "zstd")
    root = new_folder(docs.sparkSession, "token-files")
    ranks = id_ranks(ids, e.kind, e.size)
    write_file(root, RANKS, ranks.tobytes())
    return staged(write_files(ids, root, ranks, e.kind), "token-file-list"), root
