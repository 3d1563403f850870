"""Encoding of whole texts with a byte-level BPE, as a monoid tree reduction.

A text is halved until its pieces are at most ``LEAF`` characters; the pieces
are encoded and neighbours joined up the tree. At a join only a window around
the cut is encoded again. The window grows outwards until it ends, on either
side, between two characters between which the vocabulary's word pattern can
neither continue nor look: after a character that isn't white space where the
class changes (letter to other, digit to other, other mark to white space or
digit). No word of the pattern has characters from both sides of such a place,
whatever stands around it, so the tokens outside the window are those of the
whole text; that is the proof that they have stabilised. Where no such place
is near (a long run of one class) the window grows to the whole piece, which
is encoded at once. Decoding joins the tokens' bytes up the same tree.

A vocabulary file holds base64 tokens with their ranks; its folder is a
parameter (``CAIRNLAKE_TOKENIZERS``, default /opt/tokenizers). Text that looks
like a special token is ordinary text; none is ever added. An empty or null
text has the empty list. Rows keep their multiplicity; nothing is shuffled.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

FOLDER = os.environ.get("CAIRNLAKE_TOKENIZERS", "/opt/tokenizers")
#: Characters of the largest piece that is encoded at once where it can be cut.
LEAF = 4096
# Fixed value: the vocabulary's word pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SAFE = r"(?<=\p{L})(?=[^\p{L}])|(?<=\p{N})(?=[^\p{N}])|(?<=[^\s\p{L}\p{N}])(?=[\s\p{N}])"


class Encoder:
    """One vocabulary; made once per Python worker."""

    _made: dict[tuple[str, str], Encoder] = {}

    def __init__(self, name: str, folder: str = FOLDER):
        import regex
        import tiktoken

        with open(os.path.join(folder, name + ".tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bpe = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.safe = regex.compile(_SAFE)
        self.flat = self.bpe.encode_ordinary

    def encode(self, text: str | None, leaf: int = LEAF) -> list[int]:
        """The ids of a text."""
        if not text:
            return []
        return self.flat(text) if len(text) <= leaf else self._tree(text, 0, len(text), leaf)

    def _tree(self, text: str, a: int, b: int, leaf: int) -> list[int]:
        if b - a <= leaf:
            return self.flat(text[a:b])
        cut = (a + b) // 2
        return self._join(text, a, cut, b, self._tree(text, a, cut, leaf), self._tree(text, cut, b, leaf))

    def _join(self, text: str, a: int, cut: int, b: int, left: list[int], right: list[int]) -> list[int]:
        lo, hi = self._before(text, a, cut), self._after(text, cut, b)
        drop_left = len(self.flat(text[lo:cut])) if lo > a else len(left)
        drop_right = len(self.flat(text[cut:hi])) if hi < b else len(right)
        return left[: len(left) - drop_left] + self.flat(text[lo:hi]) + right[drop_right:]

    def _before(self, text: str, a: int, cut: int) -> int:
        """The last safe place before the cut, looked for in growing windows; ``a`` if there is none."""
        w = 64
        while True:
            at = max(a, cut - w)
            places = [m.start() for m in self.safe.finditer(text, at, cut) if at < m.start() < cut]
            if places:
                return places[-1]
            if at == a:
                return a
            w *= 4

    def _after(self, text: str, cut: int, b: int) -> int:
        """The first safe place after the cut; ``b`` if there is none."""
        w = 64
        while True:
            to = min(b, cut + w)
            for m in self.safe.finditer(text, cut, to):
                if cut < m.start() < to:
                    return m.start()
            if to == b:
                return b
            w *= 4

    def decode(self, ids: list[int]) -> str:
        """The text of ids: their bytes, joined up the tree."""

        def up(a: int, b: int) -> bytes:
            if b - a <= 4096:
                return self.bpe.decode_bytes(ids[a:b])
            return up(a, (a + b) // 2) + up((a + b) // 2, b)

        return up(0, len(ids)).decode("utf-8", "replace")


def encoder(name: str, folder: str = FOLDER) -> Encoder:
    made = Encoder._made
    if (name, folder) not in made:
        made[name, folder] = Encoder(name, folder)
    return made[name, folder]


def encoded(documents: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = FOLDER, leaf: int = LEAF) -> DataFrame:
    """``doc_id`` and ``ids`` of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        enc = encoder(tokenizer, folder)
        for b in batches:
            ids = [enc.encode(t, leaf) for t in b["text"].to_pylist()]
            ends = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=ends[1:])
            flat = np.fromiter((i for x in ids for i in x), np.int32, int(ends[-1]))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def sized(documents: DataFrame, tokenizers: list[str], folder: str = FOLDER) -> DataFrame:
    """``doc_id``, ``tokenizer`` and ``n_tokens`` of each document under each tokenizer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].to_pylist()
            for name in tokenizers:
                enc = encoder(name, folder)
                yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([name] * len(texts)), pa.array([len(enc.encode(t)) for t in texts], pa.int64())], names=["doc_id", "tokenizer", "n_tokens"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, tokenizer string, n_tokens bigint")
