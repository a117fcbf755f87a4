"""Operator 10, SimHash near-dedup: byte-position inverted index with count filtering."""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import components, cut_lineage, text_or_empty

BITS, BYTES = 64, 8


def fingerprint(text: str, width: int = 3, block: int = 1 << 16) -> int:
    """SimHash of the word shingles of a text as a signed 64-bit integer; 0 without a word."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words))) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(width, len(words))
    starts, ends = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    total, hash64 = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), block):
        h = np.array([hash64(line[s:e], 42) for s, e in zip(starts[at:at + block], ends[at:at + block])], "<u8")
        total += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row of docs."""
    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])
    return docs.select(F.col("doc_id").cast("long"), text_or_empty(docs).alias("text")).mapInArrow(run, "doc_id long, fp long")


def position_sets(shared: int, size: int) -> list[tuple[int, ...]]:
    """Sets of `size` byte positions such that any `shared` positions contain one of them, few by a greedy
    choice."""
    open_, sets = set(combinations(range(BYTES), shared)), []
    while open_:
        best = max(combinations(range(BYTES), size), key=lambda s: sum(set(s) <= set(o) for o in open_))
        sets.append(best)
        open_ = {o for o in open_ if not set(best) <= set(o)}
    return sets


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints (column fp) that differ in at most `distance` bits,
    as far as they are needed to join every linked pair.

    At most `distance` of the 8 bytes differ, so linked fingerprints share at least 8 - distance
    bytes in place. Posting lists are kept for sets of byte positions that any such agreement must contain;
    the sets are as large as keeps lists short at the number of fingerprints met, which changes cost alone.
    A pair that meets in a list goes on only if its count of shared positional bytes reaches the minimum,
    and is then verified. In a list the smallest fingerprint is the leader: two members that are both linked
    to it are joined through it and not compared.
    """
    least = BYTES - distance
    n = fps.count()
    size = min(least, max(2, -(-max(n, 1).bit_length() // 8)))
    sets = position_sets(least, size)
    masks = [sum(0xFF << (8 * p) for p in s) for s in sets]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    post = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("s", "k"))
    lead = post.groupBy("s", "k").agg(F.min("fp").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("lead"))) <= distance
    post = cut_lineage(post.join(lead, ["s", "k"]).withColumn("hung", near))
    x, y = post.alias("x"), post.alias("y")
    diff = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    same = sum((F.when(diff.bitwiseAND(F.lit((0xFF << (8 * p)) - ((1 << 64) if p == 7 else 0)).cast("long")) == 0, 1).otherwise(0)
                for p in range(BYTES)), F.lit(0))
    pairs = x.filter("not hung").join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.k") == F.col("y.k"))
                                      & (F.col("y.hung") | (F.col("x.fp") < F.col("y.fp")))
                                      & (same >= least) & (F.bit_count(diff) <= distance))
    hung = post.filter("hung and fp <> lead").select(F.col("lead").alias("a"), F.col("fp").alias("b"))
    free = pairs.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b"))
    return hung.union(free).distinct()


def near_duplicates(docs: DataFrame, distance: int = 3) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    Null text counts as empty; texts without a word have fingerprint zero and are linked like any other.
    component_id is the smallest doc_id that links reach; null ids do not count, and a component of null ids
    alone has component_id null. Repeated rows share a component. Other columns are not looked at; an
    empty table gives no rows.
    """
    rows = cut_lineage(fingerprints(docs))
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    label = components(links(firsts.select("fp"), distance))
    member = (firsts.join(label.select(F.col("node").alias("fp"), "root"), "fp", "left")
                    .withColumn("root", F.coalesce("root", "fp")))
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(named, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, distance: int = 3) -> DataFrame:
    """docs with one document of each component: the one with the smallest doc_id. Rows that repeat
    that doc_id all stay, and so do rows without one."""
    gone = (near_duplicates(docs, distance).filter("doc_id <> component_id").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
