"""Byte-level BPE encoding and decoding by segment trees over byte positions.

A pre-token's tree has one leaf per byte position: the rank of the pair that
starts there, with the position behind it, so the smallest value of a tree is
the leftmost pair of minimum rank and stands in its root.  A merge joins a
token with its live right neighbour and changes three leaves (the merged
token, the neighbour that is gone, the live neighbour on the left); each
change climbs to the root, which makes a merge logarithmic in the length.
Trees of many pre-tokens are rows of one numpy array and merge side by side,
every tree at its own position.

A pre-token that is itself in the vocabulary is one id, as in the tiktoken
library.  What recurs between two certain pre-token boundaries (words, mostly)
is encoded once per worker and remembered, up to a bound.

Defined cases: a null or empty text has no ids and decodes to the empty text
(the hashes are those of the empty string); texts and pre-tokens are encoded
whole, whatever their length; repeated rows get equal results; rows without an
id are rows like others; an empty table gives an empty result; other columns
are left behind, whatever their names.  Only PATTERN splits texts and strings
of special tokens are ordinary text.  A byte that is missing from the
vocabulary is an error.  The vocabulary file's path is a parameter; the file
must be readable under it on every worker.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clipmart.llm.bpe import ODD_RUNS, SEGMENT
from clipmart.llm.common import only, per_worker, small_batches

#: Segments of a generation (a worker keeps two) and the characters of the longest that is kept.
REMEMBERED, LONGEST = 300_000, 40
#: Tree nodes that are held at once (8 bytes each).
NODES = 1 << 21
NONE = np.int64(1) << 62
#: These marks behind letters or digits, in texts of ASCII.
MARKS = {m: re.compile(f"([A-Za-z0-9])[{m}]").sub for m in ".,"}


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank, one pair in a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """A vocabulary and the memory of one worker."""

    def __init__(self, path: str):
        import regex
        from public_tokenizers import PATTERN

        self.ranks = ranks = read_ranks(path)
        self.bytes = {r: t for t, r in ranks.items()}
        self.decimal = {r: str(r) for r in self.bytes}
        self.kind = "H" if max(self.bytes) < 2**16 else "I"
        self.pretokens = regex.compile(PATTERN).findall
        self.base = max(self.bytes) + 1
        single = [ranks.get(bytes([b])) for b in range(256)]
        if None in single:
            raise ValueError("every byte must have a rank")
        self.single = np.array(single, np.int64)
        # every pair of tokens that makes up a token: left * base + right, ascending, and the rank of both together
        pairs = sorted((ranks[t[:i]] * self.base + ranks[t[i:]], r) for t, r in ranks.items()
                       for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.pairs, self.pair_ranks = (np.array(c, np.int64) for c in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 2
        self.segments: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the generation before; what is used again moves on

    def leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The leaves of pairs of tokens (-1: none) at positions."""
        if not len(self.pairs):
            return np.full(len(left), NONE)
        pair = left * self.base + right
        found = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        ok = (self.pairs[found] == pair) & (left >= 0) & (right >= 0)
        return np.where(ok, self.pair_ranks[found] << 32 | at, NONE)

    def merged(self, words: list[bytes], leaves: int) -> list[bytes]:
        """The ids of words shorter than ``leaves`` - 1 bytes, a power of two."""
        n, width = len(words), leaves + 1
        sizes = np.fromiter(map(len, words), np.int64, n)
        row = np.repeat(np.arange(n), sizes)
        col = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        # positions from 1 on; 0 and the position behind the last byte hold no token
        token = np.full(n * width, -1, np.int64)
        token[row * width + col] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        after = np.tile(np.arange(1, width + 1), n)
        before = np.tile(np.arange(-1, width - 1), n)
        tree = np.full(n * 2 * leaves, NONE)
        at = row * width + col
        tree[row * 2 * leaves + leaves + col] = self.leaf(token[at], token[at + 1], col)
        whole = tree.reshape(n, 2 * leaves)
        level = leaves
        while level > 1:
            whole[:, level // 2:level] = np.minimum(whole[:, level:2 * level:2], whole[:, level + 1:2 * level:2])
            level //= 2
        live = np.arange(n)
        while True:
            best = tree[live * 2 * leaves + 1]
            go = best < NONE
            if not go.all():
                live, best = live[go], best[go]
            if not len(live):
                break
            i, rank, of, root = best & 0xFFFFFFFF, best >> 32, live * width, live * 2 * leaves
            gone = after[of + i]
            right, left = after[of + gone], before[of + i]
            token[of + i] = rank
            token[of + gone] = -1
            after[of + i] = right
            before[of + right] = i
            changed = np.concatenate([i, gone, left])
            values = np.concatenate([self.leaf(rank, token[of + right], i), np.full(len(live), NONE),
                                     self.leaf(token[of + left], rank, left)])
            root = np.tile(root, 3)
            node = leaves + changed
            tree[root + node] = values
            while node[0] > 1:  # all leaves are equally deep
                node >>= 1
                tree[root + node] = np.minimum(tree[root + 2 * node], tree[root + 2 * node + 1])
        token = token.reshape(n, width)
        kept = token >= 0
        ids = token[kept].astype(self.kind).tobytes()
        size = np.dtype(self.kind).itemsize
        ends = (np.cumsum(kept.sum(1)) * size).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def words(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of pre-tokens, as bytes of ``kind``."""
        out, by_size = {}, {}
        for w in words:
            rank = self.ranks.get(w)
            if rank is not None:
                out[w] = array(self.kind, (rank,)).tobytes()
            else:
                by_size.setdefault(max(3, (len(w) + 1).bit_length()), []).append(w)
        for bits, some in by_size.items():
            step = max(1, NODES >> (bits + 1))
            for i in range(0, len(some), step):
                out.update(zip(some[i:i + step], self.merged(some[i:i + step], 1 << bits)))
        return out

    def learn(self, segments: set[str]) -> dict[str, bytes]:
        """The ids of segments, each split by the pattern first."""
        split = {s: [s.encode()] if (s[1:] if s[:1] == " " else s).isalpha()
                 else [p.encode() for p in self.pretokens(s)] for s in segments}
        known = self.words({p for parts in split.values() for p in parts})
        return {s: known[parts[0]] if len(parts) == 1 else b"".join(map(known.__getitem__, parts))
                for s, parts in split.items()}

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of some texts."""
        split = [segments(t) for t in texts]
        new = set().union(*split)
        if len(self.segments) > REMEMBERED:
            self.segments, self.older = {}, self.segments
        known, older = self.segments, self.older
        new.difference_update(known)
        again = {s: older[s] for s in new if s in older}
        found = self.learn(new.difference(again)) | again
        known.update(found)
        out = [np.frombuffer(b"".join(map(known.__getitem__, parts)), self.kind) for parts in split]
        for s in found:
            if len(s) > LONGEST:
                del known[s]
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids) -> bytes:
        """The bytes of a list of ids."""
        return b"".join(map(self.bytes.__getitem__, ids))


def segments(text: str) -> list[str]:
    """A text, cut before runs of white space behind other characters: no
    pre-token goes on there."""
    if not text:
        return []
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\0" in text or ODD_RUNS.search(text):
        return SEGMENT.findall(text)
    if text.isascii():  # nor does one between a letter or digit and these marks
        for mark in ".,":
            if mark in text:
                text = MARKS[mark](rf"\1{chr(0)}{mark}", text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")



def worker_codec(path: str) -> Codec:
    return per_worker(f"bytebpe:{path}", lambda: Codec(path))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row."""
    path = ranks or ranks_path()
    small_batches(docs.sparkSession)
    given = only(docs, doc_id=doc_id, text=text)
    schema = T.StructType([given.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path)
        for b in slices(batches):
            ids = codec.encode_all([t or "" for t in b.column(1).to_pylist()])
            edge = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
            flat = np.concatenate([np.empty(0, codec.kind), *ids]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(edge), pa.array(flat))],
                                             ["doc_id", "ids"])

    return given.mapInArrow(run, schema)


def decode(rows: DataFrame, doc_id: str = "doc_id", ids: str = "ids", ranks: str | None = None) -> DataFrame:
    """doc_id and ``bytes`` of every row; null ids decode to nothing."""
    path = ranks or ranks_path()
    given = only(rows, doc_id=doc_id, ids=ids)
    schema = T.StructType([given.schema["doc_id"], T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path)
        for b in slices(batches):
            out = [codec.decode(x or ()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return given.mapInArrow(run, schema)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the bytes that the ids decode to) of every row: both
    directions in one task, so that no ids are shuffled or stored."""
    path = ranks or ranks_path()
    small_batches(docs.sparkSession)
    given = only(docs, doc_id=doc_id, text=text)
    schema = T.StructType([given.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path)
        decimal, sha = codec.decimal.__getitem__, hashlib.sha256
        for b in slices(batches):
            counts, of_ids, of_bytes = [], [], []
            for ids in codec.encode_all([t or "" for t in b.column(1).to_pylist()]):
                ids = ids.tolist()
                counts.append(len(ids))
                of_ids.append(sha(",".join(map(decimal, ids)).encode()).hexdigest())
                of_bytes.append(sha(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                                              pa.array(of_bytes, pa.string())], [f.name for f in schema])

    return given.mapInArrow(run, schema)
