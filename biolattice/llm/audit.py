"""Operator 12, filter interaction audit: what each filter removes in every order of five filters."""
from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import WORD, cut_lineage, text_or_empty

LETTERS = "ABCDE"


def failures(text: Column) -> Column:
    """Bits of the filters that a text fails by itself: 1 A (under 200 words), 2 B (under half of the words are different), 4 C (over
    3 % of the code points are A-Z), 8 D (holds one of # $ % & * |)."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return (F.when(F.size(words) < 200, 1).otherwise(0)
            + F.when(100 * F.size(F.array_distinct(words)) < 50 * F.size(words), 2).otherwise(0)
            + F.when(100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text), 4).otherwise(0)
            + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, n_good, n_toxic): documents of a part by the set of filters they fail (bit of the filter's place), and how many
    of them are labelled good (quality 1) and toxic.

    Texts stay where they are: a row goes on as the digest of its text, its id, its part and the bits of A to D, equal rows
    counted. A row fails E unless its id is the smallest of its digest or null. The row with the smallest id is found by a
    join on (digest, id), so that a text that a third of all rows share is no hot key.
    """
    text = text_or_empty(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), failures(text).alias("mask"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = cut_lineage(rows.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n")))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    later = F.col("first").isNull() & F.col("doc_id").isNotNull()
    counted = F.col("n") * F.coalesce(F.col("good"), F.lit(0)), F.col("n") * F.coalesce(F.col("bad"), F.lit(0))
    return (rows.join(first, ["digest", "doc_id"], "left").withColumn("mask", F.col("mask") + F.when(later, 16).otherwise(0)).drop("digest")
                .join(marked, "doc_id", "left")
                .groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(counted[0]).alias("n_good"), F.sum(counted[1]).alias("n_toxic")))


def removal_intervals(spark: SparkSession, letters: str = LETTERS) -> DataFrame:
    """(mask, step, lo, hi): the orders of rank lo to hi - 1 in which documents that fail the filters of mask go at this step.

    Orders are ranked lexicographically (Lehmer code). All orders that begin with the same filters stand side by side: the digit of
    each place, times the factorial of the places after it, adds up to their first rank. A document goes at the step of the
    first filter that it fails, so each beginning that ends with its first failed filter is one interval.
    """
    size, out = len(letters), []
    for step in range(1, size + 1):
        for head in permutations(range(size), step):
            lo = sum((f - sum(g < f for g in head[:k])) * factorial(size - 1 - k) for k, f in enumerate(head))
            before = sum(1 << f for f in head[:-1])
            out += [(m, step, lo, lo + factorial(size - step)) for m in range(1, 1 << size) if m >> head[-1] & 1 and not m & before]
    return spark.createDataFrame(out, "mask int, step int, lo int, hi int")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Effect of the filters A to E in every order: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley; 600 rows for each value of lang in docs (doc_id, text, lang).

    Counts of masks (at most 32 a part) are laid at both ends of their intervals of ranks, added up over the 120 ranks, and all columns follow
    from these sums: at a filter, redundant is what fails it less what it removes. Null text is empty, null lang is part ''; a null id fails E never,
    makes no other row fail it and has no label; rows that repeat count each, and an id's own repeats are not earlier ones; an id with several label rows is
    good or toxic if one of them says so; an empty table gives no rows; other columns are not looked at.
    """
    spark, size = docs.sparkSession, len(LETTERS)
    counts = cut_lineage(mask_counts(docs, labels))
    sums = ["n", "n_good", "n_toxic"]
    ends = F.inline(F.array(F.struct(F.col("lo").alias("rank"), *[F.col(c) for c in sums]),
                            F.struct(F.col("hi").alias("rank"), *[(-F.col(c)).alias(c) for c in sums])))
    deltas = (counts.join(removal_intervals(spark), "mask").select("part", "step", ends)
                    .groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in sums]))
    orders = spark.createDataFrame([(r, "".join(p)) for r, p in enumerate(permutations(LETTERS))], "rank int, filter_order string")
    steps = F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step")
    one = [F.sum(F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.col("n")).otherwise(0)).alias(f"fails_{f}") for k, f in enumerate(LETTERS)]
    only = [F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)).alias(f"only_{f}") for k, f in enumerate(LETTERS)]
    parts = counts.groupBy("part").agg(F.sum("n").alias("all"), *one, *only)
    pick = lambda name: F.coalesce(*[F.when(F.col("letter") == f, F.col(f"{name}_{f}")) for f in LETTERS])
    along = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    down = W.partitionBy("part", "rank").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    every = W.partitionBy("part", "letter")
    grid = (parts.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(size) - 1)))).join(orders, "rank")
                 .select("*", steps).withColumn("letter", F.col("filter_order").substr(F.col("step"), F.lit(1))))
    out = grid.join(deltas, ["part", "step", "rank"], "left")
    for c in sums:
        out = out.withColumn(c, F.coalesce(F.sum(c).over(along), F.lit(0)))
    return out.select("part", "filter_order", "step", (F.col("all") - F.sum("n").over(down)).alias("kept"), F.col("n").alias("removed"),
                      (pick("fails") - F.col("n")).alias("redundant"), pick("only").alias("unique_fails"), F.col("n_good").alias("good_lost"),
                      F.col("n_toxic").alias("toxic_lost"), F.sum("n").over(every).alias("shapley"))


def audit_sql() -> str:
    """The same rows in SQL: every order is walked step by step over the counts of masks."""
    order = ", ".join(f"('{''.join(p)}')" for p in permutations(LETTERS))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') t, coalesce(lang, '') part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w, min(doc_id) OVER (PARTITION BY t) first_id FROM d),
f AS (SELECT doc_id, part, len(w) < 200 a, 100 * len(list_distinct(w)) < 50 * len(w) b,
             100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) c, regexp_matches(t, '[#$%&*|]') d, coalesce(doc_id > first_id, false) e FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) good, max((toxic = 1)::INT) bad FROM labels GROUP BY doc_id),
m AS (SELECT part, concat(if(a, 'A', ''), if(b, 'B', ''), if(c, 'C', ''), if(d, 'D', ''), if(e, 'E', '')) fails,
             count(*) n, sum(coalesce(good, 0)) ng, sum(coalesce(bad, 0)) nt FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
s AS (SELECT part, o.filter_order, s.step::INT step, substr(o.filter_order, s.step, 1) letter, fails, n, ng, nt,
             contains(fails, substr(o.filter_order, s.step, 1)) f,
             len(list_filter(string_split(substr(o.filter_order, 1, s.step - 1), ''), lambda x: x <> '' AND contains(fails, x))) > 0 gone
      FROM m, (VALUES {order}) o(filter_order), range(1, 6) s(step)),
r AS (SELECT part, filter_order, step, letter, sum(CASE WHEN NOT f AND NOT gone THEN n ELSE 0 END) kept,
             sum(CASE WHEN f AND NOT gone THEN n ELSE 0 END) removed, sum(CASE WHEN f AND gone THEN n ELSE 0 END) redundant,
             sum(CASE WHEN fails = letter THEN n ELSE 0 END) unique_fails, sum(CASE WHEN f AND NOT gone THEN ng ELSE 0 END) good_lost,
             sum(CASE WHEN f AND NOT gone THEN nt ELSE 0 END) toxic_lost FROM s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT kept, removed::BIGINT removed, redundant::BIGINT redundant, unique_fails::BIGINT unique_fails,
       good_lost::BIGINT good_lost, toxic_lost::BIGINT toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT shapley FROM r"""
