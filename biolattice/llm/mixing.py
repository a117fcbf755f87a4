"""Operator 7, mixing sources to target weights: entropy balancing."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.scale import ordered_index
from .common import count_words, cut_lineage

WEIGHTS = (3, 1, 2)


def targets(sources: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sources (_source, source, source_size) with target: `share` of all sizes by the weights 3, 1, 2, ... in code
    point order of source, null last; no target above `most` times the source's size, the excess shared
    again by weight until none is above.

    Sharing again ends where every source has the smaller of its limit and one level times its weight; the
    level is found from running sums over the sources in order of limit by weight.
    """
    n = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last(), "_source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("_n") % len(WEIGHTS) + 1).cast("int"))
    s = (sources.withColumn("_n", n).withColumn("_w", weight)
                .withColumn("_limit", F.lit(float(most)) * F.col("source_size")).withColumn("_r", F.col("_limit") / F.col("_w")))
    order = W.orderBy("_r", "_n")
    whole = W.orderBy("_r", "_n").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    past = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    s = (s.withColumn("_level", (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("_limit").over(past), F.lit(0.0)))
                      / F.sum("_w").over(rest))
          .withColumn("_full", F.col("_r") <= F.col("_level")))
    level = F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True).over(whole)
    return s.withColumn("target", F.when(F.col("_full"), F.col("_limit")).otherwise(level * F.col("_w"))).drop("_n", "_w", "_r", "_level", "_full")


def balance(classes: DataFrame, most: float = 2.0, tolerance: float = 1e-9, rounds: int = 100) -> DataFrame:
    """(_source, _tilt): the multiplier with sum(n * size * rate) = target in every source, where
    rate = most / (1 + exp(-_tilt * size / _scale)) and `classes` has _source, size, n, target, _limit, _scale.

    Rates nearest to `most`/2 in entropy under the word constraint tilt exponentially with the size. Each round of
    Newton's method on the convex dual is one grouped sum of gradient and curvature over the table of
    (source, size) counts; a bracket guards the step. A source at its limit has no finite multiplier and
    gets null: all of its documents take `most`.
    """
    classes = classes.withColumn("_x", F.col("size") / F.col("_scale"))
    state = cut_lineage(classes.filter("target < _limit").groupBy("_source")
                        .agg((F.max("target") / F.max("_scale")).alias("_t"))
                        .select("_source", "_t", F.lit(0.0).alias("_tilt"), F.lit(None).cast("double").alias("_lo"),
                                F.lit(None).cast("double").alias("_hi"), F.lit(False).alias("_done")))
    for _ in range(rounds):
        p = 1.0 / (1.0 + F.exp(-F.col("_tilt") * F.col("_x")))
        sums = (classes.join(state.filter("not _done"), "_source")
                .groupBy("_source").agg(F.sum(F.col("n") * F.col("_x") * p * most).alias("_g"),
                                        F.sum(F.col("n") * F.col("_x") * F.col("_x") * p * (1 - p) * most).alias("_h")))
        d = state.join(sums, "_source", "left").withColumn("_e", F.col("_g") - F.col("_t"))
        d = (d.withColumn("_lo", F.when(F.col("_e") < 0, F.col("_tilt")).otherwise(F.col("_lo")))
              .withColumn("_hi", F.when(F.col("_e") > 0, F.col("_tilt")).otherwise(F.col("_hi"))))
        step = F.col("_tilt") - F.col("_e") / F.col("_h")
        out = (F.col("_h") <= 0) | F.isnan(step) | (F.abs(step - F.col("_tilt")) > 8) | (step <= F.col("_lo")) | (step >= F.col("_hi"))
        middle = (F.when(F.col("_lo").isNull(), F.col("_hi") - 4 * (1 + F.abs("_hi")))
                  .when(F.col("_hi").isNull(), F.col("_lo") + 4 * (1 + F.abs("_lo"))).otherwise((F.col("_lo") + F.col("_hi")) / 2))
        done = F.col("_done") | (F.abs(F.col("_e")) <= tolerance * F.greatest("_t", F.lit(1e-300)))
        nxt = F.when(done, F.col("_tilt")).when(F.coalesce(out, F.lit(False)), middle).otherwise(step)
        state = cut_lineage(d.select("_source", "_t", nxt.alias("_tilt"), "_lo", "_hi", done.alias("_done")))
        if state.filter("not _done").isEmpty():
            break
    return state.select("_source", "_tilt")


def mix(docs: DataFrame, share: float = 1.5, most: int = 2, seed: int = 7) -> DataFrame:
    """One row per row of docs (doc_id, text, source): doc_id, size, source_size, target, copies, taken.

    size is the number of words (null text: 0). Rates from `balance` are rounded to copies by systematic
    rounding along the documents of a source in order of size, which keeps the words taken close to the
    target; documents of one size are ordered by a seeded hash of doc_id. Every document is taken 0 to `most`
    times. A null source is a source of its own. Rows that repeat are documents of their own; a source of empty
    texts has target 0. An empty table gives no rows. Reruns agree.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(count_words(F.col("text")), F.lit(0)).cast("long").alias("size"))
    return _mix_rows(cut_lineage(rows), share, most, seed).select("doc_id", "size", "source_size", "target", "copies", "taken")


def _mix_rows(rows: DataFrame, share: float, most: int, seed: int) -> DataFrame:
    rows = rows.withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    classes = rows.groupBy("_source", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    sources = classes.groupBy("_source", "source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum(F.col("n") * F.col("size").cast("double") * F.col("size")).alias("_sq"))
    aims = (targets(sources, share, most).withColumn("_scale", F.greatest(F.col("_sq") / F.greatest("source_size", F.lit(1)), F.lit(1.0)))
            .select("_source", "source_size", "target", "_limit", "_scale"))
    classes = cut_lineage(classes.drop("source").join(aims, "_source"))
    tilts = balance(classes, most)
    rate = F.when(F.col("_tilt").isNull(), F.lit(float(most))).otherwise(most / (1.0 + F.exp(-F.col("_tilt") * F.col("size") / F.col("_scale"))))
    before = W.partitionBy("_source").orderBy("size").rowsBetween(W.unboundedPreceding, -1)
    offset = F.pmod(F.xxhash64("_source", F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    classes = (classes.join(tilts, "_source", "left").withColumn("_rate", rate)
               .withColumn("_start", F.coalesce(F.sum(F.col("n") * F.col("_rate")).over(before), F.lit(0.0)) + offset)
               .select("_source", "size", "source_size", "target", "_rate", "_start"))
    key = F.xxhash64("doc_id", F.lit(seed))
    placed = ordered_index(rows.withColumn("_h", key), ["_source", "size"], ["_h", "doc_id"], F.shiftrightunsigned(F.col("_h"), 58), "_i")
    out = placed.join(classes, ["_source", "size"])
    at = F.col("_start") + F.col("_i") * F.col("_rate")
    drawn = F.least(F.floor(at + F.col("_rate")) - F.floor(at), F.lit(most))
    copies = F.when(F.col("_rate") >= most, F.lit(most)).otherwise(drawn).cast("long")
    return out.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, share: float = 1.5, most: int = 2, seed: int = 7) -> DataFrame:
    """docs with every row as often as the mix takes it: rows without a copy go, others are repeated.

    A row gets the copies of its doc_id, source and size; rows that agree in all three are dealt those of one of them. Null ids, null sources
    and null texts (size 0) are matched like others; an empty table gives no rows.
    """
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
           F.coalesce(count_words(F.col("text")), F.lit(0)).cast("long").alias("size")]
    taken = _mix_rows(cut_lineage(docs.select(*key)), share, most, seed).groupBy("doc_id", "source", "size").agg(F.max("copies").alias("_copies"))
    taken = taken.select(F.col("doc_id").alias("_doc"), F.col("source").alias("_from"), F.col("size").alias("_size"), "_copies")
    same = key[0].eqNullSafe(F.col("_doc")) & key[1].eqNullSafe(F.col("_from")) & (key[2] == F.col("_size"))
    return (docs.join(taken, same)
            .withColumn("_copy", F.explode(F.expr("CASE WHEN _copies > 0 THEN sequence(1L, _copies) ELSE array() END")))
            .select(*docs.columns))
