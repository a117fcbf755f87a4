"""Operator 9, packing: sum-of-squares online packing into fixed windows."""
from __future__ import annotations

import base64
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import text_or_empty

END_ID = 1
ADDED = {"<|endoftext|>": 50256}
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@lru_cache(maxsize=4)
def encoder(ranks_path: str | None = None, added: bool = False):
    """Encoder of the byte-level vocabulary of 50,257 ids: the same ids as its tokenizers file gives, from the
    ranks of the same vocabulary, several times faster. With added, the added token of that file is one id wherever its
    string is met, as the file has it; else that string is ordinary text and its id is never given."""
    import public_tokenizers
    import tiktoken
    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bytes-50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(ADDED) if added else {})


class Piece:
    """Ids start .. start + len(ids) of a document."""
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start, ids, total):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def split(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:n], self.total), Piece(self.doc, self.start + n, self.ids[n:], self.total))


class Packer:
    """Sum-of-squares packing of one stream of documents.

    `counts[h]` is the number of open windows filled to h. A piece of s ids goes to the level h (0: a new
    window) for which the sum of squared counts is smallest afterwards; among equals, the fullest. A full
    window is given out at once. What is open at the end is cut anew into full windows; the last one is laid
    out in windows of powers of two, which need no padding.
    """

    def __init__(self, width: int = 2048):
        self.width, self.counts, self.open = width, np.zeros(width + 1, np.int64), {}

    def level(self, s: int) -> int:
        """The level at which a piece of s ids is best placed."""
        c, room = self.counts, self.width - s
        used = np.flatnonzero(c[1:room + 1]) + 1
        if not len(used):
            return 0
        after = np.where(used == room, 1, 2 * c[used + s] + 2) - 2 * c[used]
        best = len(used) - 1 - int(np.argmin(after[::-1]))
        return int(used[best]) if after[best] <= 2 * c[s] + 1 else 0

    def add(self, doc, ids: np.ndarray):
        """Windows (lists of pieces) that become full by this document."""
        total = len(ids)
        for at in range(0, total - self.width + 1, self.width):
            yield [Piece(doc, at, ids[at:at + self.width], total)]
        s = total % self.width
        if s:
            piece = Piece(doc, total - s, ids[total - s:].copy(), total)
            h = self.level(s)
            window = self.open[h].pop() if h else []
            if h:
                self.counts[h] -= 1
            window.append(piece)
            if h + s == self.width:
                yield window
            else:
                self.counts[h + s] += 1
                self.open.setdefault(h + s, deque()).append(window)

    def close(self):
        """Windows of what is still open."""
        left = [p for h in sorted(self.open, reverse=True) for w in self.open[h] for p in w]
        rest = sum(len(p.ids) for p in left)
        at, left = 0, deque(left)
        while rest:
            goal = self.width if rest >= self.width else 1 << (rest.bit_length() - 1)
            window, need = [], goal
            while need:
                p = left.popleft()
                if len(p.ids) > need:
                    p, more = p.split(need)
                    left.appendleft(more)
                window.append(p)
                need -= len(p.ids)
            rest -= goal
            yield window
        self.open, self.counts[:] = {}, at


def pack(docs: DataFrame, width: int = 2048, ranks_path: str | None = None, added: bool = False) -> DataFrame:
    """Pieces of all documents of docs (doc_id, text) in sequences of `width` ids: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    A document is the ids of its text (with added, those of the tokenizers file with its added token, see encoder) and one end id; null text counts as empty and is the end id alone. Every
    partition of docs is packed by itself, without a shuffle: sequences hold documents of one partition, and a
    task that is run again gives the same sequences for the same rows. Sequences are full, but for
    a few at the end of a partition whose lengths are powers of two. Rows that repeat are packed each; null ids are
    allowed; an empty table gives no rows; other columns are not looked at.
    """
    def run(batches):
        enc, packer, part = encoder(ranks_path, added), Packer(width), TaskContext.get().partitionId()
        number, out, allowed = 0, [[] for _ in FIELDS], set(ADDED) if added else set()

        def lay(window):
            nonlocal number
            seq, at = (part << 36) + number, 0
            number += 1
            for p in window:
                for col, v in zip(out, (p.doc, p.start, len(p.ids), zlib.crc32(p.ids), p.total, seq, at)):
                    col.append(v)
                at += len(p.ids)

        def batch():
            b = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], list(FIELDS))
            for c in out:
                c.clear()
            return b

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(enc.encode_to_numpy(text.as_py(), allowed_special=allowed, disallowed_special=()), END_ID).astype("<u4")
                for window in packer.add(doc, ids):
                    lay(window)
            yield batch()
        for window in packer.close():
            lay(window)
        yield batch()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text")).mapInArrow(run, SCHEMA)
