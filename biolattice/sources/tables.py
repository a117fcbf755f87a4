"""Delimited text in and out."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType)


def read_table(spark: SparkSession, path, sep: str = "\t", dec: str = ".", header: bool = True,
               na_values: Sequence[str] = ("NA", ""), schema: T.StructType | None = None,
               encoding: str = "UTF-8", position: str | None = None,
               infer: bool = False) -> DataFrame:
    """S-01: delimited text to a typed table.

    Every cell is read as text, missing-value tokens become NULL and decimal commas become
    points before the cast, so one pass over the file is enough when a schema is given. Short
    rows are filled with NULL. `position` names a column that grows with the place in the input.
    With infer=True a column in which every value is a number becomes double (one extra pass).
    """
    reader = (spark.read.option("sep", sep).option("header", header).option("encoding", encoding)
              .option("mode", "PERMISSIVE").option("ignoreLeadingWhiteSpace", sep == " ")
              .option("enforceSchema", False))
    df = reader.csv(path)
    if schema is not None and not header:
        df = df.toDF(*[f.name for f in schema][:len(df.columns)])
    have = df.columns
    cells = {c: F.col(f"`{c}`") for c in have}
    for c in have:
        if na_values:
            cells[c] = F.when(~cells[c].isin(list(na_values)), cells[c])
    point = (lambda c: F.regexp_replace(c, ",", ".")) if dec == "," else (lambda c: c)
    if schema is not None:
        out = [(point(cells[f.name]) if isinstance(f.dataType, NUMERIC) else cells[f.name])
               .try_cast(f.dataType).alias(f.name) if f.name in have
               else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    elif infer:
        good = df.select(*[F.bool_and(cells[c].isNull() | point(cells[c]).try_cast("double")
                                      .isNotNull()).alias(f"c{i}")
                           for i, c in enumerate(have)]).first()
        out = [(point(cells[c]).cast("double") if good[i] else cells[c]).alias(c)
               for i, c in enumerate(have)]
    else:
        out = [cells[c].alias(c) for c in have]
    if position:
        out.append(F.monotonically_increasing_id().alias(position))
    return df.select(*out)


def write_table(df: DataFrame, path: str, sep: str = "\t", header: bool = True,
                quote: bool = True, na: str = "NA", mode: str = "error") -> None:
    """S-02: tab-separated text, one file per partition."""
    w = (df.write.mode(mode).option("sep", sep).option("header", header)
         .option("nullValue", na).option("quoteAll", quote).option("emptyValue", ""))
    if not quote:
        w = w.option("quote", "")
    w.csv(path)
