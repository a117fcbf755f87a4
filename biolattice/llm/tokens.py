"""Operator 11, token counts: two tiers of pre-token lengths beside the texts, no pre-token is shuffled."""
from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import text_or_empty

#: Characters for which the two libraries' tables of letters, digits and white space are the same (a test goes over all of
#: them): Latin, Greek, Cyrillic, punctuation, currency, kana, ideographs, Hangul, pictographs. A text with any other is left to the tokenizer whole.
SAFE = ("\\x00-\\u052F\\u1E00-\\u1FFF\\u2010-\\u2027\\u2030-\\u205E\\u20A0-\\u20AC\\u3041-\\u3096\\u30A1-\\u30FA\\u4E00-\\u9FA5\\uAC00-\\uD7A3"
        "\\U0001F300-\\U0001F5FF")
LONGEST = 64  # characters of a pre-token that the table or a cache may hold


class PreTokens:
    """The byte-level tokenizer of a file, as pre-tokens: a text's ids are the ids of its pre-tokens one after another."""

    def __init__(self, path: str | None = None, cached: int = 1 << 17):
        import public_tokenizers
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.other = regex.compile(f"[^{SAFE}]").search
        added = sorted((t.content for t in self.library.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.lengths = _Lengths(self.encoded, cached)

    def encoded(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def split(self, text: str) -> tuple[list[str], int] | None:
        """Pre-tokens of a text and how many added tokens stand between them; None if the library has to take the text whole."""
        if self.other(text):
            return None
        if self.added is None or not self.added.search(text):
            return self.find(text), 0
        parts = self.added.split(text)
        return list(chain.from_iterable(map(self.find, parts))), len(parts) - 1

    def count(self, text: str) -> int:
        got = self.split(text)
        return self.encoded(text) if got is None else sum(map(self.lengths.__getitem__, got[0])) + got[1]


class _Lengths(dict):
    """Lengths of pre-tokens: first the table that every worker gets, then what this worker has met, at most `cached` of them;
    a full cache starts anew. Long pre-tokens are encoded each time."""

    def __init__(self, encode, cached: int):
        super().__init__()
        self.encode, self.cached, self.met = encode, cached, {}

    def __missing__(self, t: str) -> int:
        n = self.met.get(t)
        if n is None:
            n = self.encode(t)
            if len(t) <= LONGEST:
                if len(self.met) >= self.cached:
                    self.met.clear()
                self.met[t] = n
        return n


@lru_cache(maxsize=2)
def pre_tokens(path: str | None) -> PreTokens:
    return PreTokens(path)


class Summary:
    """Counters of at most `size` pre-tokens (Misra-Gries): what stands more than N / (size + 1) times among N is always
    in it, and summaries add up without losing that."""

    def __init__(self, size: int):
        self.size, self.counts = size, {}

    def add(self, items, weights=None) -> None:
        c = self.counts
        if weights is None:
            for t in items:
                c[t] = c.get(t, 0) + 1
        else:
            for t, n in zip(items, weights):
                c[t] = c.get(t, 0) + n
        if len(c) > 4 * self.size:
            self.shrink()

    def shrink(self) -> None:
        c = self.counts
        if len(c) > self.size:
            n = np.fromiter(c.values(), np.int64, len(c))
            less = int(np.partition(n, len(n) - self.size - 1)[len(n) - self.size - 1])
            self.counts = {t: k - less for t, k in c.items() if k > less}

    def rows(self) -> tuple[list[str], list[int]]:
        self.shrink()
        return list(self.counts), list(self.counts.values())


SUMMARY = "part long, tokens array<string>, counts array<long>"


def _batch(part, tokens, counts):
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([tokens], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64()))],
                                      ["part", "tokens", "counts"])


def frequent(texts: DataFrame, size: int, path: str | None = None) -> tuple[list[str], list[int]]:
    """At most `size` frequent pre-tokens of all texts and their counts, less at most N / (size + 1) each.

    Every task reads whole texts and gives one summary of bounded size; summaries are merged by 32, in three steps of tasks and a
    last task, which gets 32 of them from a million tasks. No pre-token leaves its task but in a summary.
    """
    def read(batches):
        pre, s = pre_tokens(path), Summary(size)
        for b in batches:
            for text in b.column(0):
                got = pre.split(text.as_py())
                if got is not None:
                    s.add(t for t in got[0] if len(t) <= LONGEST)
        yield _batch(TaskContext.get().partitionId(), *s.rows())

    def merge(table: pa.Table) -> pa.Table:
        s = Summary(size)
        for tokens, counts in zip(table["tokens"], table["counts"]):
            s.add(tokens.as_py(), counts.as_py())
        return pa.Table.from_batches([_batch(table["part"][0].as_py() >> 5, *s.rows())])

    out = texts.mapInArrow(read, SUMMARY)
    for _ in range(3):
        out = out.groupBy(F.shiftright("part", 5)).applyInArrow(merge, SUMMARY)
    rows = out.groupBy(F.shiftright("part", 40)).applyInArrow(merge, SUMMARY).collect()
    return (rows[0].tokens, rows[0].counts) if rows else ([], [])


def count_tokens(docs: DataFrame, path: str | None = None, table: int = 1 << 15, limit: int = 1024) -> DataFrame:
    """Tokens of each text of docs (doc_id, text) as the library gives them for a byte-level tokenizers file: doc_id, n_bytes,
    n_tokens, over_limit (n_tokens > limit).

    The lengths of the `table` most frequent pre-tokens of the corpus are broadcast (at most 64 characters each, so at most 8 MB
    with the default); a task looks up its pre-tokens there, then in its worker's cache, and encodes what neither holds.
    What the table holds changes the speed alone. An added token's string in a text is one token, as in the library. Null and empty text: 0 tokens;
    null ids stay; repeated rows give a row each; an empty table gives no rows; other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    tokens, _ = frequent(rows.select("text"), table, path)
    lengths = np.fromiter(map(pre_tokens(path).encoded, tokens), np.uint16, len(tokens))
    sent = docs.sparkSession.sparkContext.broadcast((tokens, lengths))

    def run(batches):
        pre = pre_tokens(path)
        if getattr(pre, "held", None) is not sent.value:
            pre.held = sent.value
            pre.lengths.clear()
            pre.lengths.update(zip(pre.held[0], pre.held[1].tolist()))
        for b in batches:
            n = [pre.count(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    sized = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
