"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice of a text has an edge for every piece that ends at a position.  A
model of merges (BPE) has no additive piece scores; its encoding is the one
path on which every piece and every two neighbouring pieces encode to
themselves.  So edges weigh nothing or are forbidden, one backpointer per
position survives, and the search is exact.

The search runs along a text and holds no more than a window of positions, as
a piece can reach back no further than the longest one: every longest piece's
length it follows the surviving paths back, commits the ids up to the boundary
on which all of them converge, and forgets what lies before.  Between two
characters that stand side by side in no piece, every path has a boundary; there
the paths converge whatever follows, so ids are committed at once.  Such
stretches (words, mostly) recur; each worker searches a stretch once and
remembers its ids, up to a bound, whatever the stretch's length is up to
LONGEST_UNIT; longer ones are searched each time they come.

Defined cases: a null text has null ids, an empty one none.  A character
without a piece becomes the pieces of its UTF-8 bytes.  U+2581, the mark for a
space, decodes to a space; every other text decodes to itself.  Texts are
encoded whole, whatever their length; repeated rows get equal ids.  The model file's path is
a parameter; the file must be readable under it on every worker.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clipmart.llm.common import only, per_worker, small_batches

SPACE = "▁"
#: Units of a generation (about 200 bytes each; a worker keeps two), and pairs of pieces.
REMEMBERED = 300_000
LONGEST_UNIT = 40  # characters of a unit that is worth remembering
NEVER = -np.inf


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# --- the model file: protocol-buffer fields, as far as they are needed ---------------

def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of every field of a message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at:at + size]
            at += size


NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


class Lengths(dict):
    """Lengths of the pieces that may end behind some (up to three) characters, longest first."""

    def __init__(self, pieces):
        super().__init__()
        self.pieces, self.by_end = pieces, {}
        for p in pieces:
            if len(p) > 2:
                self.by_end.setdefault(p[-3:], set()).add(len(p))

    def __missing__(self, end: str) -> tuple[int, ...]:
        found = self.by_end.get(end, set()) | {n for n in (1, 2) if n <= len(end) and end[-n:] in self.pieces}
        if len(self) > REMEMBERED:
            self.clear()
        self[end] = out = tuple(sorted(found, reverse=True))
        return out


class Model:
    """Pieces, merge order and the memory of one worker."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            top = list(fields(f.read()))
        pieces = []
        for number, value in top:
            if number == 1:
                p = dict(fields(value))
                pieces.append((p[1].decode(), struct.unpack("<f", p.get(2, b"\0" * 4))[0], p.get(3, NORMAL)))
        trainer = dict(fields(dict(top)[2]))
        normalizer = dict(fields(dict(top)[3]))
        if trainer.get(3, 1) != BPE or any(k in (USER, UNUSED) for *_, k in pieces):
            raise ValueError("the model must be one of merges, without user-defined or unused pieces")
        if normalizer.get(2) or not normalizer.get(5, 1) or normalizer.get(4, 1):
            raise ValueError("the model must leave texts as they are but for spaces")
        self.prefix = SPACE if normalizer.get(3, 1) else ""
        self.id = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.piece = {p: p for p in self.id}  # one string object per piece
        self.score = {p: s for p, s, k in pieces if k == NORMAL}
        self.byte = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.text = [p.replace(SPACE, " ").encode() if k == NORMAL else bytes([int(p[3:5], 16)]) if k == BYTE else
                     "⁇".encode() if k == UNKNOWN else b"" for p, _, k in pieces]
        self.inside = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}  # neighbours within a piece
        self.longest = max(map(len, self.id))
        self.lengths = Lengths(self.id)
        self.line = not any("\n" in p for p in self.id)
        #: marks before which there is a boundary unless one of these pairs stands there
        self.marks = {c: [pair for pair in self.inside if pair[1] == c] for c in ".,"}
        self.kind = "H" if len(pieces) <= 2**16 else "I"
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the generation before; what is used again moves on
        self.known: dict[str, dict] = {"": {}}  # of a piece, by the piece behind it: that one's, or False if they don't fit
        self.commits, self.held = 0, 0  # commits within stretches, and the longest window before one

    def merged(self, text: str) -> list[str]:
        """The merges by definition: the best pair first, of equals the left one."""
        parts, score = list(text), self.score.get
        pairs = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > NEVER:
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], NEVER)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], NEVER)
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether the two pieces (left may be empty) encode to themselves."""
        if left and left[-1] + right[0] not in self.inside:
            return self.fits("", right)
        return self.merged(left + right) == ([left, right] if left else [right])

    def judged(self, left: str, right: str, row: dict) -> dict | bool:
        """Remember whether ``right`` fits behind ``left``, whose row this is."""
        right = self.piece[right]
        row[right] = found = self.known.setdefault(right, {}) if self.fits(left, right) else False
        return found

    def search(self, text: str, alike: list | None = None) -> Iterator[list[int]]:
        """The ids of a text, run by run as they are committed.  ``alike`` holds
        the nodes of another text for the positions up to which both are the
        same, and then those of this one; none if ids had to be committed on the way."""
        ids, lengths, judged, longest = self.id, self.lengths, self.judged, self.longest
        root = self.known[""]
        # a node per position from ``base`` on: the node before, the piece between, what may follow, the position
        base, nodes = 0, [] if alike is None else alike
        if not nodes:
            nodes.append([None, "", root, 0])

        def path(node: list) -> list[int]:
            out = []
            while node[0] is not None:
                out.append(ids[node[1]])
                node = node[0]
            return out[::-1]

        for end in range(len(nodes), len(text) + 1):
            for n in lengths[text[end - 3:end] if end > 2 else text[:end]]:
                at = end - n
                if at < base:
                    continue
                right = text[at:end]
                if right not in ids:
                    continue
                before = nodes[at - base]
                row = before[2].get(right)
                if row is None:
                    row = judged(before[1], right, before[2])
                if row is not False:
                    nodes.append([before, right, row, end])
                    break
            else:  # a character without a piece: every path ends before it
                yield path(nodes[-1])
                yield [self.byte[b] for b in text[end - 1].encode("utf-8", "surrogatepass")] if self.byte else [self.unknown]
                base, nodes = end, [[None, "", root, end]]
                if alike:
                    alike.clear()
            if end - base >= 2 * longest:
                self.held = max(self.held, end - base)
                alive = {node[3]: node for node in nodes[-longest:]}
                while len(alive) > 1:
                    node = alive.pop(max(alive))[0]
                    alive[node[3]] = node
                common = alive.popitem()[1]
                if common[3] > base:
                    self.commits += 1
                    yield path(common)
                    common[0] = None  # what lies before is forgotten; the piece stays, as the next one must fit it
                    nodes, base = nodes[common[3] - base:], common[3]
                    if alike:
                        alike.clear()
        yield path(nodes[-1])

    def learn(self, units: set[str]) -> dict[str, bytes]:
        """Ids of stretches."""
        if sum(map(len, self.known.values())) > 2 * REMEMBERED:
            self.known = {"": {}}
        out, last, nodes = {}, "", []
        for u in sorted(units):  # a stretch goes on from the positions that it shares with the one before
            shared = 0
            for a, b in zip(u, last):
                if a != b:
                    break
                shared += 1
            del nodes[shared + 1:]
            out[u] = array(self.kind, [i for run in self.search(u, nodes) for i in run]).tobytes()
            last = u if nodes else ""
        return out

    def split(self, text: str) -> list[str]:
        """A text, its spaces marked, cut where every path has a boundary."""
        if SPACE + SPACE in text or "\0" in text:
            return WITH_SPACES.findall(text)
        cut = text.replace(SPACE, "\0" + SPACE)
        for mark, near in self.marks.items():
            if not any(map(text.__contains__, near)):
                cut = cut.replace(mark, "\0" + mark)
        return (cut.replace("\n", "\0\n\0") if self.line else cut).split("\0")

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of some texts."""
        split = [self.split(self.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        different = set().union(*split)
        if len(self.units) > REMEMBERED:
            self.units, self.older = {}, self.units
        known, older = self.units, self.older
        different.difference_update(known)
        again = {u: older[u] for u in different if u in older}
        new = self.learn(different.difference(again)) | again
        known.update(new)
        out = [np.frombuffer(b"".join(map(known.__getitem__, units)), self.kind) for units in split]
        for u in new:
            if len(u) > LONGEST_UNIT:
                del known[u]
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        """The text of a list of ids."""
        text = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


WITH_SPACES = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def worker_model(path: str) -> Model:
    return per_worker(f"spm:{path}", lambda: Model(path))


def id_lists(m: Model, texts: list[str | None]) -> tuple[list, pa.Array]:
    """The ids of some texts, also as one Arrow list column."""
    found = iter(m.encode_all([t for t in texts if t is not None]))
    ids = [None if t is None else next(found) for t in texts]
    flat = np.concatenate([np.empty(0, m.kind), *(x for x in ids if x is not None)]).astype(np.int32)
    edge = np.r_[0, np.cumsum([0 if x is None else len(x) for x in ids])].astype(np.int32)
    return ids, pa.ListArray.from_arrays(pa.array(edge), pa.array(flat), mask=pa.array([x is None for x in ids], pa.bool_()))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str | None = None,
           verify: bool = False) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row; with ``verify`` also
    ``lossless``, whether the ids decode to the text (null for a null text)."""
    path = model or model_path()
    small_batches(docs.sparkSession)
    given = only(docs, doc_id=doc_id, text=text)
    out = [given.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if verify:
        out.append(T.StructField("lossless", T.BooleanType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = worker_model(path)
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            ids, lists = id_lists(m, texts)
            cols = [b.column(0), lists]
            if verify:
                cols.append(pa.array([None if t is None else m.decode(x.tolist()) == t
                                      for t, x in zip(texts, ids)], pa.bool_()))
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in out])

    return given.mapInArrow(run, T.StructType(out))


def decode(rows: DataFrame, doc_id: str = "doc_id", ids: str = "ids", model: str | None = None) -> DataFrame:
    """doc_id and ``text`` of every row; null ids give a null text."""
    path = model or model_path()
    given = only(rows, doc_id=doc_id, ids=ids)
    schema = T.StructType([given.schema["doc_id"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = worker_model(path)
        for b in slices(batches):
            texts = [None if x is None else m.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return given.mapInArrow(run, schema)
