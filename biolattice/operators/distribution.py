"""Clustering and ordination on Spark ML (M-06, M-07, M-11, R-17, R-18)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import DataFrame, functions as F

from ..functions.scale import dense_index
from .community import bray_curtis, species_totals


def _assemble(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def cluster_sites(df: DataFrame, features: Sequence[str], k: int, seed: int = 1, out: str = "cluster") -> DataFrame:
    """M-06: clusters 1..k of grid points from their predictions."""
    d = _assemble(df, features, "_x")
    m = KMeans(featuresCol="_x", predictionCol="_c", k=k, seed=seed).fit(d)
    return m.transform(d).withColumn(out, F.col("_c") + 1).drop("_x", "_c")


def choose_k(df: DataFrame, features: Sequence[str], max_k: int, seed: int = 1) -> tuple[DataFrame, int]:
    """M-06: average silhouette for k = 2..max_k and the best k (the first of equal ones)."""
    d = _assemble(df, features, "_x").select("_x").persist()
    ev = ClusteringEvaluator(featuresCol="_x", predictionCol="_c")
    rows = [(k, float(ev.evaluate(KMeans(featuresCol="_x", predictionCol="_c", k=k, seed=seed).fit(d).transform(d))))
            for k in range(2, max_k + 1)]
    d.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double"), max(rows, key=lambda r: (r[1], -r[0]))[0]


def pca(df: DataFrame, cols: Sequence[str], k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M-07: (scores with cos2 per component, eigenvalues, loadings) of scaled columns."""
    d = _assemble(df, cols, "_raw")
    d = StandardScaler(inputCol="_raw", outputCol="_z", withMean=True, withStd=True).fit(d).transform(d)
    m = PCA(k=k, inputCol="_z", outputCol="_pc").fit(d)
    s = m.transform(d)
    z, pc = vector_to_array("_z"), vector_to_array("_pc")
    norm = F.aggregate(z, F.lit(0.0), lambda a, x: a + x * x)
    scores = s.select(*df.columns, *[pc[i].alias(f"pc{i + 1}") for i in range(k)],
                      *[F.try_divide(pc[i] * pc[i], norm).alias(f"cos2_{i + 1}") for i in range(k)])
    spark, ev = df.sparkSession, m.explainedVariance.toArray()
    eig = spark.createDataFrame([(i + 1, float(v * len(cols)), float(v)) for i, v in enumerate(ev)],
                                "component int, eigenvalue double, share double")
    load = spark.createDataFrame([(c, i + 1, float(v)) for c, row in zip(cols, m.pc.toArray()) for i, v in enumerate(row)],
                                 "variable string, component int, loading double")
    return scores, eig, load


def ks_normal(df: DataFrame, value: str, mean: float = 0.0, sd: float = 1.0) -> DataFrame:
    """M-11: one-sample Kolmogorov-Smirnov test against a normal distribution."""
    d = df.select(F.col(value).cast("double").alias("_v")).dropna()
    return KolmogorovSmirnovTest.test(d, "_v", "norm", float(mean), float(sd)).select(
        F.col("statistic"), F.col("pValue").alias("p_value"))


def spectral_species(df: DataFrame, cols: Sequence[str], k: int = 50, components: int = 3, seed: int = 1) -> DataFrame:
    """R-17: pixels in k spectral species, from k-means on principal components."""
    scores, _, _ = pca(df, cols, components)
    out = cluster_sites(scores, [f"pc{i + 1}" for i in range(components)], k, seed, "spectral_species")
    return out.select(*df.columns, "spectral_species")


def plot_diversity(df: DataFrame, plot: Sequence[str], species: str = "spectral_species") -> DataFrame:
    """R-17: richness, Shannon, Simpson and Fisher's alpha per plot or window.

    Fisher's alpha solves S = a ln(1 + N / a), by a fixed number of Newton steps in one expression.
    """
    t = df.withColumn("_one", F.lit(1.0))
    t = species_totals(t, list(plot), species, "_one")
    n = F.col("_n")
    g = t.groupBy(*plot).agg(F.count(F.lit(1)).alias("richness"), F.sum(n).alias("_t"),
                             (F.ln(F.sum(n)) - F.sum(n * F.ln(n)) / F.sum(n)).alias("shannon"),
                             (1 - F.sum(n * n) / (F.sum(n) * F.sum(n))).alias("simpson"))
    s, tot = F.col("richness").cast("double"), F.col("_t")

    def newton(a, _):
        f = a * F.ln(1 + tot / a) - s
        df_ = F.ln(1 + tot / a) - tot / (a + tot)
        return F.greatest(a - F.try_divide(f, df_), a / 10)

    fisher = F.aggregate(F.sequence(F.lit(1), F.lit(30)), s, newton)
    return g.select(*plot, "richness", "shannon", "simpson", F.when(s < tot, fisher).alias("fisher"))


def window_dissimilarity(df: DataFrame, tile: Sequence[str], window: str, species: str = "spectral_species") -> DataFrame:
    """R-17: Bray-Curtis between the windows or plots of one tile."""
    return bray_curtis(df.withColumn("_one", F.lit(1)), tile, window, species, "_one", transform="none")


def ordinate(distances: DataFrame, k: int = 3, a: str = "a", b: str = "b", distance: str = "distance") -> DataFrame:
    """R-18: principal coordinates of a distance table (each unordered pair once).

    Double centring by group means, then the leading vectors of the centred matrix. Meant for plots
    (one vector per plot, as long as the number of plots), not for pixels.
    """
    half = distances.select(F.col(a).alias("a"), F.col(b).alias("b"), F.pow(distance, F.lit(2.0)).alias("d"))
    pts = half.select("a").union(half.select("b")).distinct()
    full = (half.union(half.select("b", "a", "d")).union(pts.select("a", F.col("a").alias("b"), F.lit(0.0))))
    mean = full.groupBy("a").agg(F.avg("d").alias("m"))
    grand = full.agg(F.avg("d")).scalar()
    idx = dense_index(pts.withColumnRenamed("a", "p"), "p", "i")
    c = (full.join(mean.withColumnRenamed("m", "_ma"), "a")
             .join(mean.select(F.col("a").alias("b"), F.col("m").alias("_mb")), "b")
             .join(idx.select(F.col("p").alias("b"), "i"), "b")
             .select("a", "i", (-(F.col("d") - F.col("_ma") - F.col("_mb") + grand) / 2).alias("v")))
    rows = c.groupBy("a").agg(array_to_vector(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"])).alias("x"))
    m = PCA(k=k, inputCol="x", outputCol="pc").fit(rows)
    s = m.transform(rows).select("a", vector_to_array("pc").alias("pc"))
    norms = s.agg(*[F.sqrt(F.sum(F.col("pc")[i] * F.col("pc")[i])).alias(f"n{i}") for i in range(k)])
    out = [F.try_divide(F.col("pc")[i], F.sqrt(norms.select(f"n{i}").scalar())).alias(f"axis{i + 1}") for i in range(k)]
    return s.select(F.col("a").alias("plot"), *out)
