"""Operator 6, quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""
from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fold, released, text_or_empty

WORD_BITS = 16
STATS = 14
BINS = 12
FEATURES = (1 << WORD_BITS) + STATS * BINS


def statistics(text: str, words: list[bytes], n_chars) -> np.ndarray:
    """Structure of a text and its metadata: lengths, kinds of characters, repetition."""
    n, w = max(len(text), 1), max(len(words), 1)
    raw = np.frombuffer(text.encode(), np.uint8)
    kinds = np.bincount(raw, minlength=256)
    letters = kinds[65:91].sum() + kinds[97:123].sum()
    marks = kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()
    lines = text.split("\n")
    size = max(len(raw), 1)
    same = sum(a == b for a, b in zip(words, words[1:]))
    return np.array([
        np.log1p(len(words)), np.log1p(n_chars if n_chars is not None and n_chars == n_chars else -0.5), size / w,
        len(set(words)) / w, same / w, marks / size, kinds[65:91].sum() / max(letters, 1), kinds[48:58].sum() / size,
        kinds[128:].sum() / size, kinds[32] / size, np.log1p(len(lines)), len(set(lines)) / len(lines), (kinds[46] + kinds[44]) / w,
        kinds[[33, 35, 36, 37, 38, 42, 124]].sum() / w])


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of a text and their weights, of length one together."""
    crc, mask = zlib.crc32, (1 << WORD_BITS) - 1
    at, n = np.unique(np.fromiter((crc(w) & mask for w in words), np.int64, len(words)), return_counts=True)
    x = np.log1p(n)
    return at, x / max(float(np.sqrt((x * x).sum())), 1e-12)


@dataclass
class Machine:
    """score = sigmoid(bias + sum w x + sum of <v_i, v_j> x_i x_j over i < j)."""
    bias: float
    w: np.ndarray
    v: np.ndarray
    edges: np.ndarray  # of the bins of the statistics

    def bins(self, stats: np.ndarray) -> np.ndarray:
        """Feature numbers of the bins in which the statistics lie."""
        return (1 << WORD_BITS) + np.arange(STATS) * BINS + (stats[:, None] > self.edges).sum(1)

    def row(self, text: str, n_chars) -> tuple[np.ndarray, np.ndarray]:
        words = text.encode().lower().split()
        at, x = word_features(words)
        return np.concatenate([at, self.bins(statistics(text, words, n_chars))]), np.concatenate([x, np.full(STATS, STATS ** -0.5)])

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        # the pair sum in linear time: half of (square of the sum less the sum of the squares)
        vx = self.v[at] * x[:, None]
        s = vx.sum(0)
        z = self.bias + self.w[at] @ x + 0.5 * float(s @ s - (vx * vx).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(rows: list[tuple[str, float]], labels: np.ndarray, rank: int = 6, epochs: int = 6, rate: float = 0.1,
          decay: float = 2e-5, batch: int = 64, seed: int = 5) -> Machine:
    """Fit a machine by mini-batches with per-weight step sizes. rows: (text, n_chars)."""
    rng = np.random.default_rng(seed)
    parts = []
    for text, n_chars in rows:
        words = text.encode().lower().split()
        parts.append((*word_features(words), statistics(text, words, n_chars)))
    stats = np.array([p[2] for p in parts]).reshape(-1, STATS)
    grid = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(stats, grid, axis=0).T if len(stats) else np.zeros((STATS, BINS - 1))
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    m = Machine(float(np.log(share / (1 - share))), np.zeros(FEATURES), rng.normal(0, 0.05, (FEATURES, rank)), edges)
    data = [(np.concatenate([at, m.bins(s)]), np.concatenate([x, np.full(STATS, STATS ** -0.5)])) for at, x, s in parts]
    gw, gv, gb = np.full(FEATURES, 1e-8), np.full((FEATURES, rank), 1e-8), 1e-8
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for b in range(0, len(order), batch):
            pick = order[b:b + batch]
            at = np.concatenate([data[i][0] for i in pick])
            x = np.concatenate([data[i][1] for i in pick])
            starts = np.cumsum([0] + [len(data[i][0]) for i in pick[:-1]])
            sizes = [len(data[i][0]) for i in pick]
            vx = m.v[at] * x[:, None]
            s = np.add.reduceat(vx, starts)
            z = m.bias + np.add.reduceat(m.w[at] * x, starts) + 0.5 * (s * s - np.add.reduceat(vx * vx, starts)).sum(1)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]) / len(pick)
            each = np.repeat(g, sizes)[:, None] * x[:, None]
            dv = each * (np.repeat(s, sizes, 0) - vx)
            used, where = np.unique(at, return_inverse=True)
            tw = np.bincount(where, each[:, 0]) + decay * m.w[used]
            tv = np.stack([np.bincount(where, dv[:, k]) for k in range(rank)], 1) + decay * m.v[used]
            gw[used] += tw * tw
            gv[used] += tv * tv
            gb += g.sum() ** 2
            m.w[used] -= rate * tw / np.sqrt(gw[used])
            m.v[used] -= 0.3 * rate * tv / np.sqrt(gv[used])
            m.bias -= rate * g.sum() / np.sqrt(gb)
    return m


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12288) -> Machine:
    """A machine fitted to `labels.quality` of rows outside fold 0.

    At most `sample` labelled rows are used, those with the smallest hash of doc_id: the bound of the
    fit's memory, which one task holds. The list of ids is of that size too and is broadcast. Labels that are null
    or belong to no document are left out; a doc_id with several labels counts with each.
    """
    ids = (labels.filter((fold() != 0) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
                 .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
                 .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id", "y").limit(sample))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"), F.col("n_chars").cast("double").alias("n_chars"))
    picked = d.join(F.broadcast(ids), "doc_id").select(F.lit(0).alias("all"), "h", "doc_id", "text", "n_chars", "y")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values(["h", "doc_id", "text", "y"], kind="stable")
        m = train(list(zip(p.text, p.n_chars)), p.y.to_numpy(float))
        return pd.DataFrame({"bias": [m.bias], "w": [m.w.astype("<f4").tobytes()], "v": [m.v.astype("<f4").tobytes()], "edges": [m.edges.astype("<f8").tobytes()]})

    got = picked.groupBy("all").applyInPandas(one, "bias double, w binary, v binary, edges binary").collect()
    if not got:
        return train([], np.zeros(0))
    r = got[0]
    w = np.frombuffer(r.w, "<f4")
    return Machine(r.bias, w, np.frombuffer(r.v, "<f4").reshape(len(w), -1), np.frombuffer(r.edges, "<f8").reshape(STATS, -1))


def scored(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """docs with the probability of label 1 in column `name`; every whole text is scored, null counts as empty."""
    model = docs.sparkSession.sparkContext.broadcast(machine)
    cols = [c for c in docs.columns if c != name]
    src = docs.select(*[F.col(f"`{c}`") for c in cols])
    schema = T.StructType([*src.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        m = model.value
        for b in batches:
            text, n = b.column(b.schema.get_field_index("text")), b.column(b.schema.get_field_index("n_chars"))
            s = [m.score(*m.row(t.as_py() or "", c.as_py())) for t, c in zip(text, n)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*b.schema.names, name])
    return src.mapInArrow(released(run), schema)


def classify(docs: DataFrame, labels: DataFrame, least: float = 0.3, sample: int = 12288) -> DataFrame:
    """One row per row of docs (doc_id, text, n_chars): doc_id, held_out, score, predicted.

    held_out rows (fold 0; a null doc_id is in it) take no part in the fit. Labels, lang, source and doc_id are no
    inputs of the score. Without any usable label the score is near one half. Repeated rows get the same score;
    an empty table gives no rows.
    """
    d = scored(docs.select("doc_id", "text", "n_chars"), fit(docs, labels, sample))
    return d.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3, sample: int = 12288) -> DataFrame:
    """docs without the rows whose score is below `least`."""
    return scored(docs, fit(docs, labels, sample), "_quality").filter(F.col("_quality") >= least).select(*docs.columns)
