"""Byte-level BPE with the tokenizers library, each different word encoded once
per worker.

The pre-tokenizer never puts white space behind other characters into one
pre-token, nor a punctuation mark behind a letter or digit.  So a text may be
cut there.  These cuts are found by plain string work, the segments between
them recur, and their ids are remembered up to a bound.  ``together`` does this
for many texts at once: Arrow finds their different segments, which are looked
up, and puts the ids in place.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from codecs import charmap_decode

import numpy as np
import pyarrow as pa

from clipmart.llm.common import per_worker

#: Segments of a generation (about 200 bytes each; a worker keeps two) and the
#: characters of the longest that is kept.
REMEMBERED, LONGEST = 500_000, 40
#: Unicode's White_Space, which the pre-tokenizer's \s means (fixed values).
WHITE = "\t\n\v\f\r \x85\xa0  -     　"
SEGMENT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
ODD_RUNS = re.compile(f"[{WHITE.replace(chr(10), '').replace(' ', '')}][ \n]")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """A tokenizer file and the memory of one worker."""

    def __init__(self, path: str):
        import json

        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            about = json.load(f)
        if about["pre_tokenizer"].get("type") != "ByteLevel" or about["pre_tokenizer"].get("add_prefix_space") \
                or about.get("normalizer"):
            raise ValueError("the tokenizer must be byte-level, without a normalizer or a prefix space")
        self.special = [t["content"] for t in about["added_tokens"]]
        self.pretokens = regex.compile(PATTERN).findall
        # the byte alphabet of such files: printable Latin-1 stands for itself, the rest follows from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.letters = "".join(chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256))
        self.size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2") if self.size <= 2**16 else np.dtype("<u4")
        #: letters and digits among the first 2**16 characters; others count as neither
        self.plain = np.array([unicodedata.category(chr(c))[0] in "LN" for c in range(2**16)])
        self.plain[-1] = False
        self.segments: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the generation before; what is used again moves on

    def word(self, text: str) -> list[int]:
        """Ids of one pre-token."""
        spelt = charmap_decode(text.encode("utf-8", "surrogatepass"), "strict", self.letters)[0]
        return [t.id for t in self.model.tokenize(spelt)]

    def segment(self, text: str) -> bytes:
        """Ids of a text, not looked up among the segments."""
        body = text[1:] if text[:1] == " " else text
        if body.isalpha():  # one pre-token, as most are
            ids = self.word(text)
        elif any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = [i for p in self.pretokens(text) for i in self.word(p)]
        return array(self.kind.char, ids).tobytes()

    def marks_follow_words(self, text: str) -> bool:
        """Whether a letter or digit precedes every full stop and comma."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        at = np.flatnonzero((raw == 46) | (raw == 44))
        if not len(at) or at[0] == 0:
            return not len(at)
        before = raw[at - 1]
        if not self.plain[before[before < 128]].all():
            return False
        at = at[before >= 128]
        first = raw[at - 2]  # of two bytes, as a rule
        if ((first >= 0xC2) & (first < 0xE0)).all():
            return bool(self.plain[(first & 31).astype(int) << 6 | raw[at - 1] & 63].all())
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        at = np.flatnonzero((chars == 46) | (chars == 44))
        return bool(self.plain[np.minimum(chars[at - 1], 2**16 - 1)].all())

    def cut(self, text: str) -> str | None:
        """A text with a zero character at every place where ``split`` cuts
        it; None if that takes a search."""
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\0" in text or ODD_RUNS.search(text):
            return None
        cut = text.replace(" ", "\0 ").replace("\n", "\0\n")
        if self.marks_follow_words(text):
            cut = cut.replace(".", "\0.").replace(",", "\0,")
        return cut

    def split(self, text: str) -> list[str]:
        """A text, cut before runs of white space behind other characters and,
        if all of them are such, before full stops and commas behind words."""
        cut = self.cut(text)
        return SEGMENT.findall(text) if cut is None else cut.split("\0")

    def known(self, parts: list[str]) -> list[bytes]:
        """The ids (``kind``, as bytes) of segments."""
        got = list(map(self.segments.get, parts))
        missing = [i for i, ids in enumerate(got) if ids is None]
        if missing:
            if len(self.segments) > REMEMBERED:
                self.segments, self.older = {}, self.segments
            older, segment, new = self.older, self.segment, {}
            for i in missing:
                p = parts[i]
                if p not in new:
                    new[p] = older[p] if p in older else segment(p)
                got[i] = new[p]
            self.segments.update((p, ids) for p, ids in new.items() if len(p) <= LONGEST)
        return got

    def encode(self, text: str) -> tuple[list[str], list[bytes]]:
        """The segments of a text and their ids (``kind``, as bytes)."""
        parts = self.split(text)
        return parts, self.known(parts)

    def together(self, cuts: list[str], end: bytes = b"") -> pa.Array:
        """The ids (``kind``, as bytes) and ``end`` of every text, from what
        ``cut`` gives for it: each different segment is looked up once."""
        raw = "\0".join([*cuts, ""]).encode("utf-8")
        stops = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0) + 1  # segments have the zero behind them
        offsets = np.concatenate([[0], stops]).astype(np.int32)
        segments = pa.StringArray.from_buffers(len(stops), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
        got = self.known(segments.dictionary.buffers()[2].to_pybytes().decode("utf-8").split("\0")[:-1])
        last = np.cumsum(np.fromiter((c.count("\0") + 1 for c in cuts), np.int64, len(cuts)))
        which = np.insert(segments.indices.to_numpy(), last, len(got))
        each = pa.array([*got, end], pa.binary()).take(pa.array(which))
        at = np.frombuffer(each.buffers()[1], np.int32, len(each) + 1, 4 * each.offset)
        stop = at[np.concatenate([[0], last + np.arange(1, len(cuts) + 1)])]
        return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(stop), each.buffers()[2]])

    def ids(self, text: str) -> bytes:
        return b"".join(self.encode(text)[1]) if text else b""


def worker_encoder(path: str) -> Encoder:
    return per_worker(f"bpe:{path}", lambda: Encoder(path))
