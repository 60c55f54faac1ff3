"""Byte-level BPE by forced boundaries.

Two bytes that stand side by side inside no token of the vocabulary can never be merged
into one, so every such pair is a certain cut. A text is split into pieces by the
tokenizer's pattern and each piece at its certain cuts; the fragments are merged on
their own and their ids are concatenated. Most fragments come again and are looked up.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable
from weakref import WeakValueDictionary

import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from hazardlens.llm.common import add_columns, whole_text

#: Fragments whose ids one task remembers before it starts afresh; bounds memory only.
REMEMBERED = 150_000

# Fixed value: the pieces of byte-level tokenizers of this kind.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable ones for themselves,
    all others by the code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def latin_pieces() -> re.Pattern:
    """``PIECES`` for texts of code points below 256, where the classes can be spelled out."""
    kinds: dict[str, list[str]] = {"L": [], "N": [], "s": []}
    for c in map(chr, range(256)):
        # Fixed value: the white space below 256.
        kind = "s" if c in "\t\n\x0b\x0c\r \x85\xa0" else unicodedata.category(c)[0]
        kinds.setdefault(kind, []).append(re.escape(c))
    letters, numbers, spaces = ("".join(kinds[k]) for k in "LNs")
    spelled = PIECES.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    spelled = spelled.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
    return re.compile(spelled.replace(r"\s", f"[{spaces}]").replace(r"\S", f"[^{spaces}]"))


class Codec:
    """Encodes and decodes texts with one vocabulary file."""

    def __init__(self, spec: str) -> None:
        data = json.loads(spec)
        letters = byte_letters()
        added = {t["content"]: t["id"] for t in data["added_tokens"]}
        names = {name: i for name, i in data["model"]["vocab"].items() if name not in added}
        self.token = {bytes(map(letters.__getitem__, n)): i for n, i in names.items()}
        by_id = {i: b for b, i in self.token.items()}
        by_id |= {i: text.encode() for text, i in added.items()}
        # All tokens behind one another, with the place and length of each id.
        self.length = np.zeros(max(by_id) + 1, np.int64)
        self.length[list(by_id)] = [len(b) for b in by_id.values()]
        self.place = np.cumsum(self.length) - self.length
        joined = b"".join(by_id[i] for i in sorted(by_id))
        self.letters = np.frombuffer(joined, np.uint8)
        self.added = {text: np.uint32(i).tobytes() for text, i in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self.split_added = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        self.pieces = regex.compile(PIECES)
        self.latin_pieces = latin_pieces()
        self.unassigned = regex.compile(r"\p{Cn}")
        self.spec, self.library = spec, None
        self.cut = certain_cuts(self.token)
        # Merging inside a fragment: ids are merge ranks in this kind of vocabulary.
        self.merger = tiktoken.Encoding(
            "fragments", pat_str=r"[\s\S]+", mergeable_ranks=self.token, special_tokens={}
        )._core_bpe
        self.known: dict[str, bytes] = {}

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, cut wherever a pair of bytes occurs inside no token."""
        if not pieces:
            return []
        raw = [p.encode() for p in pieces]
        joined = b"".join(raw)
        letters = np.frombuffer(joined, np.uint8)
        is_end = np.zeros(len(joined) + 1, bool)
        is_end[1:-1] = self.cut[letters[:-1], letters[1:]]
        piece_ends = np.cumsum([len(r) for r in raw])
        is_end[piece_ends] = True
        ends = np.flatnonzero(is_end)
        last = np.searchsorted(ends, piece_ends, "right").tolist()
        ends = ends.tolist()
        merge, packed, at, first = self.merger.encode_single_piece, [], 0, 0
        for stop in last:
            ids: list[int] = []
            for end in ends[first:stop]:
                ids += merge(joined[at:end])
                at = end
            packed.append(array("I", ids).tobytes())
            first = stop
        return packed

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
            return self.latin_pieces.findall(text)
        except UnicodeEncodeError:
            pass
        # Letters newer than one of the two Unicode tables: leave these texts to the library.
        if self.unassigned.search(text):
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_str(self.spec).pre_tokenizer
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.pieces.findall(text)

    def encode_plain(self, text: str) -> bytes:
        pieces, known = self.split(text), self.known
        new = [p for p in set(pieces) if p not in known]
        if new:
            ids = dict(zip(new, self.encode_pieces(new), strict=True))
            if len(known) >= REMEMBERED:
                known.clear()
                ids = dict(zip(pieces, self.encode_pieces(pieces), strict=True))
            known |= {p: i for p, i in ids.items() if len(p) <= 64}
            if any(len(p) > 64 for p in new):
                return b"".join([known.get(p) or ids[p] for p in pieces])
        return b"".join(map(known.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out, at = [], 0
        for match in self.split_added.finditer(text):
            out += [self.encode_plain(text[at : match.start()]), self.added[match.group()]]
            at = match.end()
        out.append(self.encode_plain(text[at:] if at else text))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        every, out = np.frombuffer(ids, "<u4"), []
        for at in range(0, len(every), 500_000):
            part = every[at : at + 500_000]
            length = self.length[part]
            ends = np.cumsum(length)
            shift = np.repeat(self.place[part] - (ends - length), length)
            out.append(self.letters[shift + np.arange(len(shift))].tobytes())
        return b"".join(out).decode("utf-8", "replace")


def certain_cuts(tokens: dict[bytes, int]) -> np.ndarray:
    """For each pair of bytes whether it occurs inside no token."""
    cut = np.ones((256, 256), bool)
    for token in tokens:
        raw = np.frombuffer(token, np.uint8)
        cut[raw[:-1], raw[1:]] = False
    return cut


_CODECS: WeakValueDictionary[str, Codec] = WeakValueDictionary()


def _codec(spec: str) -> Codec:
    """One codec per Python worker and vocabulary, while a task uses it: what the worker does next
    needs the memory."""
    codec = _CODECS.get(spec)
    if codec is None:
        codec = _CODECS[spec] = Codec(spec)
    return codec


def _loader(df: DataFrame, path: str) -> Callable[[], Codec]:
    """The vocabulary file is read once by the driver; its size is that of one vocabulary."""
    with open(path, encoding="utf-8") as file:
        sent = df.sparkSession.sparkContext.broadcast(file.read())
    return lambda: _codec(sent.value)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens``.

    Rows stay as they are, repeated ones too. A null text counts as empty and has no ids; an
    input column named ``ids`` or ``n_tokens`` is replaced. Added tokens that occur in a
    text become their own id. ``path`` names a byte-level BPE file of the tokenizers library.
    """
    load = _loader(docs, path)

    def make():
        codec = load()

        def row(value: str | None):
            ids = codec.encode(value or "")
            return ids, len(ids) // 4

        return row

    fields = [StructField("ids", BinaryType(), False), StructField("n_tokens", LongType(), False)]
    return add_columns(docs, [text], fields, make)


def decode(tokens: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``tokens`` with the text of ``ids`` in ``out``; null ids give an empty text."""
    load = _loader(tokens, path)

    def make():
        codec = load()
        return lambda value: (codec.decode(value or b""),)

    return add_columns(tokens, [ids], [StructField(out, StringType(), False)], make)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``encode`` and then ``decode`` in one pass: ``docs`` with ``ids``, ``n_tokens`` and
    ``decoded``. One Python worker per task does both."""
    load = _loader(docs, path)

    def make():
        codec = load()

        def row(value: str | None):
            ids = codec.encode(value or "")
            return ids, len(ids) // 4, codec.decode(ids)

        return row

    fields = [
        StructField("ids", BinaryType(), False),
        StructField("n_tokens", LongType(), False),
        StructField("decoded", StringType(), False),
    ]
    return add_columns(docs, [text], fields, make)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text, one row per row of ``docs``."""
    plain = docs.select("doc_id", whole_text().alias("text"))
    return round_trip(plain, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
