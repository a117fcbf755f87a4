"""Annotations, metadata coverage, barcodes and layer catalogues (O-27 .. O-33)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import ordered_index


def polygon_area(points: str | Column) -> Column:
    """Shoelace area of array<struct<x, y>>."""
    p = F.col(points) if isinstance(points, str) else points
    nxt = F.concat(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 1, 1))
    cross = F.zip_with(p, nxt, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def annotations_to_coco(df: DataFrame, image: str = "image", klass: str = "class_id", polygon: str = "polygon",
                        box: str = "bbox", order: str = "position", track: str | None = None) -> tuple[DataFrame, DataFrame]:
    """O-27: (images, annotations) with ids in input order, box as x, y, width, height and area.

    Ids come from bucketed ranks, so numbering does not pass through one task.
    """
    imgs = df.groupBy(image).agg(F.min(order).alias("_o"))
    bucket = F.floor(F.col("_o") / 65536)
    imgs = ordered_index(imgs, [], ["_o", image], bucket, "_i").select(image, (F.col("_i") + 1).alias("image_id"))
    ann = ordered_index(df.withColumn("_o", F.col(order)), [], ["_o"], bucket, "_a")
    b = F.col(box)
    flat = F.flatten(F.transform(polygon, lambda p: F.array(p["x"], p["y"])))
    out = ann.join(imgs, image).select(
        (F.col("_a") + 1).alias("id"), "image_id", (F.col(klass) + 1).alias("category_id"),
        (F.col(track) if track else F.lit(None).cast("long")).alias("track_id"), F.array(flat).alias("segmentation"),
        polygon_area(polygon).alias("area"), F.array(b[0], b[1], b[2] - b[0], b[3] - b[1]).alias("bbox"), F.lit(0).alias("iscrowd"))
    return imgs, out


def six(c: Column) -> Column:
    return F.format_string("%.6f", c.cast("double"))


def annotations_to_yolo(df: DataFrame, klass: str = "class_id", box: str = "bbox", polygon: str | None = None) -> DataFrame:
    """O-27: one text line per annotation: centre form of the box, or the outline."""
    b = F.col(box)
    line = F.concat_ws(" ", F.col(klass).cast("string"), six((b[0] + b[2]) / 2), six((b[1] + b[3]) / 2), six(b[2] - b[0]), six(b[3] - b[1]))
    if polygon:
        xy = F.flatten(F.transform(polygon, lambda p: F.array(six(p["x"]), six(p["y"]))))
        line = F.concat_ws(" ", F.col(klass).cast("string"), F.array_join(xy, " "))
    return df.withColumn("line", line)


def profile_codes(df: DataFrame) -> DataFrame:
    """O-28: the codes of every text column in long form: attribute, code, n; all of them."""
    text = [c for c, t in df.dtypes if t == "string"]
    if not text:
        return df.sparkSession.createDataFrame([], "attribute string, code string, n long")
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).alias("code")) for c in text])))
    return cells.filter("code IS NOT NULL").groupBy("attribute", "code").agg(F.count(F.lit(1)).alias("n"))


def profile_table(df: DataFrame) -> DataFrame:
    """O-28: per column name, class, number of values and of distinct values, and range. The codes of
    text columns are rows of their own, see profile_codes."""
    kinds = dict(df.dtypes)
    aggs = []
    for i, c in enumerate(df.columns):
        aggs += [F.count(c).alias(f"n{i}"), F.count_distinct(c).alias(f"d{i}"),
                 F.min(F.col(c).cast("string") if kinds[c] != "string" else F.col(c)).alias(f"a{i}"),
                 F.max(F.col(c).cast("string") if kinds[c] != "string" else F.col(c)).alias(f"z{i}")]
        if kinds[c] not in ("string", "date", "timestamp", "timestamp_ntz", "boolean") and not kinds[c].startswith(("array", "map", "struct")):
            aggs[-2] = F.min(c).cast("string").alias(f"a{i}")
            aggs[-1] = F.max(c).cast("string").alias(f"z{i}")
    klass = lambda k: ("numeric" if k in ("int", "bigint", "double", "float", "smallint", "tinyint") or k.startswith("decimal")
                       else "Date" if k in ("date", "timestamp", "timestamp_ntz") else "categorical" if k == "boolean" else "character")
    rows = F.array(*[F.struct(F.lit(c).alias("attribute"), F.lit(klass(kinds[c])).alias("class"), F.col(f"n{i}").alias("n"),
                              F.col(f"d{i}").alias("n_distinct"), F.col(f"a{i}").alias("min"), F.col(f"z{i}").alias("max"))
                     for i, c in enumerate(df.columns)])
    return df.agg(*aggs).select(F.inline(rows))


def geographic_coverage(df: DataFrame, lat: str = "lat", lon: str = "lon", site: str = "site") -> DataFrame:
    """O-29: one bounding box per site."""
    return df.groupBy(site).agg(F.max(lat).alias("north"), F.min(lat).alias("south"), F.max(lon).alias("east"), F.min(lon).alias("west"))


def taxonomic_coverage(df: DataFrame, authorities: Sequence[tuple[str, DataFrame]], taxon: str = "taxon") -> DataFrame:
    """O-30: distinct taxa matched against ordered authorities (name, table of taxon and id)."""
    d = df.select(F.trim(taxon).alias(taxon)).filter(F.col(taxon) != "").distinct()
    for i, (_, ref) in enumerate(authorities):
        one = ref.groupBy(taxon).agg(F.min("authority_id").alias(f"_i{i}"))
        d = d.join(one, taxon, "left")
    ids = [F.col(f"_i{i}").cast("string") for i in range(len(authorities))]
    name = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for (n, _), c in zip(authorities, ids)])
    return d.select(taxon, name.alias("authority"), F.coalesce(*ids).alias("authority_id"))


def metadata_coverage(df: DataFrame, xml: str = "xml", key: str | None = None) -> DataFrame:
    """O-31: places with west, east, north and south from XML documents; point or rectangle.

    Reading a document takes far longer than moving it, and a small file of them is one task, so the documents are dealt out first.
    """
    spark = df.sparkSession
    df = df.repartition(max(spark.sparkContext.defaultParallelism * 2, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    base = "//geographicCoverage"
    get = lambda p: F.xpath(xml, F.lit(f"{base}/{p}/text()"))
    parts = F.arrays_zip(get("geographicDescription").alias("name"),
                         *[get(f"boundingCoordinates/{s}BoundingCoordinate").alias(s) for s in ("west", "east", "north", "south")])
    d = df.select(*([key] if key else []), F.explode(parts).alias("g"))
    sides = [F.col(f"g.{s}").try_cast("double").alias(s) for s in ("west", "east", "north", "south")]
    d = d.select(*([key] if key else []), F.trim("g.name").alias("name"), *sides)
    point = (F.col("west") == F.col("east")) & (F.col("south") == F.col("north"))
    return d.withColumn("shape", F.when(point, "point").when((F.col("west") != F.col("east")) & (F.col("south") != F.col("north")), "rectangle"))


def barcode_records(df: DataFrame, markers: Sequence[str], marker: str = "marker", record: str = "record_id", accession: str = "accession",
                    ranks: Sequence[str] = ("species", "genus", "family", "order", "class", "phylum"), seq: str = "seq") -> DataFrame:
    """O-32: chosen markers with a header `id|taxon|marker|accession` at the finest rank known."""
    taxon = F.coalesce(*[F.nullif(F.trim(F.col(f"`{r}`")), F.lit("")) for r in ranks])
    return (df.filter(F.col(marker).isin(list(markers)))
              .select(F.concat_ws("|", F.col(record).cast("string"), taxon, marker, F.coalesce(F.col(accession), F.lit(""))).alias("name"), seq))


def layer_catalog(df: DataFrame, realm: str | None = "All", scenario: str | None = "All", year: int = 0, epoch: str | None = "All",
                  version: str | None = "All") -> DataFrame:
    """O-33: filter a catalogue of environmental layers; All or 0 filters nothing."""
    for c, v in (("realm", realm), ("scenario", scenario), ("epoch", epoch), ("version", version)):
        if v not in (None, "All"):
            df = df.filter(F.col(c) == v)
    return df.filter(F.col("year") == year) if year else df
