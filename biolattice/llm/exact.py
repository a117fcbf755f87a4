"""Operator 8, exact dedup: content-defined chunk recipes."""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage, text_or_empty

#: One random 32-bit value for each byte, from a fixed seed.
GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)
WINDOW_STEPS = (1, 2, 4, 8)  # doubling: the rolling value covers the last 16 bytes


def cut_points(data: bytes, mask_bits: int = 11, least: int = 256, most: int = 16384) -> list[int]:
    """Ends of the content-defined chunks of data.

    A chunk ends where the rolling value of the last 16 bytes has mask_bits zero bits, not before
    `least` bytes and at the latest after `most`. Empty data has no chunk.
    """
    n = len(data)
    if n <= least:
        return [n] if n else []
    roll = GEAR[np.frombuffer(data, np.uint8)]
    for s in WINDOW_STEPS:
        more = roll[s:] + (roll[:-s] << np.uint32(s))
        roll = np.concatenate([roll[:s], more])
    marks = np.flatnonzero((roll >> np.uint32(32 - 16)) & np.uint32((1 << mask_bits) - 1) == 0) + 1
    ends, at, i = [], 0, 0
    while n - at > least:
        i = int(np.searchsorted(marks, at + least))
        end = min(int(marks[i]) if i < len(marks) else n, at + most, n)
        ends.append(end)
        at = end
    if at < n:
        ends.append(n)
    return ends


def _chunks(text: str):
    data = text.encode()
    at = 0
    for end in cut_points(data):
        yield data[at:end]
        at = end


def _digest(chunk: bytes, seed: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed)


def chunk_table(docs: DataFrame, seed: int) -> DataFrame:
    """(digest, chunk) of every chunk of the texts; a chunk met again in the same batch is not repeated."""
    def cut(batches):
        for b in batches:
            seen = {}
            for text in b.column(0):
                for c in _chunks(text.as_py()):
                    seen.setdefault(c, None)
            found = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([_digest(c, seed) for c in found], pa.binary()), pa.array(found, pa.binary())],
                                             ["digest", "chunk"])
    return docs.select(text_or_empty(docs).alias("text")).mapInArrow(cut, "digest binary, chunk binary")


def recipes(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, recipe, text_sha256): recipe is the ordered list of the chunk identifiers."""
    def cut(batches):
        for b in batches:
            lists, shas = [], []
            for text in b.column(1):
                t = text.as_py()
                lists.append(b"".join(_digest(c, seed) for c in _chunks(t)))
                shas.append(hashlib.sha256(t.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lists, pa.binary()), pa.array(shas, pa.string())],
                                             ["doc_id", "recipe", "text_sha256"])
    return docs.select(F.col("doc_id").cast("long"), text_or_empty(docs).alias("text")).mapInArrow(
        cut, "doc_id long, recipe binary, text_sha256 string")


def verified_seed(docs: DataFrame, seed: int = 0) -> int:
    """The first seed from `seed` on under which no two different chunks of the corpus share a digest.

    Chunks are brought together once, equal ones combined before and after the shuffle; with the seed
    found, a digest is an identifier of its chunk and long texts need not move again.
    """
    while True:
        distinct = chunk_table(docs, seed).groupBy("digest", "chunk").agg(F.count(F.lit(1)).alias("n"))
        if distinct.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return seed
        seed += 1


def exact_duplicates(docs: DataFrame, salts: int = 16) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical; null counts as empty, and the empty text has the empty
    recipe. The largest doc_id of a group stays; a null doc_id is smaller than any other, so a group of
    null ids alone has keep_id null and nothing kept. Rows that repeat the kept doc_id with the same text
    are all kept. Other columns are not looked at; an empty table gives no rows.
    """
    rows = cut_lineage(recipes(docs, verified_seed(docs)))
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # a recipe may hold a third of all rows: its rows are dealt over salts, and repeated groups meet each salt
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    many = groups.filter("group_size > 1").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    out = salted.join(many, ["recipe", "_salt"], "left")
    return out.select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      (F.col("group_size").isNull() & F.col("doc_id").isNotNull() | F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False))).alias("kept"),
                      "text_sha256")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """docs without the rows whose text another row with a larger doc_id repeats."""
    gone = exact_duplicates(docs).filter(~F.col("kept")).select("doc_id", F.col("text_sha256").alias("_sha")).distinct()
    d = docs.withColumn("_sha", F.sha2(text_or_empty(docs), 256))
    return d.join(gone, d.doc_id.eqNullSafe(gone.doc_id) & (d._sha == gone._sha), "left_anti").select(*docs.columns)
