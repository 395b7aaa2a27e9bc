"""Readers over landed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, text
from ..session import cut_lineage


def parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
            where: Column | None = None) -> DataFrame:
    """Column-pruned, filtered scan of one path, several paths or a glob."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    df = df if where is None else df.where(where)
    return df.select(*columns) if columns else df


def delimited(spark: SparkSession, path: str, schema: str, rename: dict[str, str] | None = None, sep: str = ",",
              encoding: str = "UTF-8") -> DataFrame:
    """Text table with a header row, plain or gzip; ``schema`` names every column of the file.

    A gzip file is one task; spread the rows with ``repartition`` before heavy work when files are few.
    ``ISO-8859-1`` reads any byte, so broken characters never stop a scan.
    """
    df = spark.read.csv(path, schema=schema, header=True, sep=sep, encoding=encoding, enforceSchema=True)
    if rename:
        df = df.withColumnsRenamed(rename).select(*rename.values())
    return df


def urban_area_blocks(spark: SparkSession, path: str, schema: str, rename: dict[str, str]) -> DataFrame:
    """Pipe-delimited block list with padded codes: geoid (15), code (5), name."""
    df = delimited(spark, path, schema, rename, sep="|", encoding="ISO-8859-1")
    return df.withColumns({"geoid": text.zero_pad(F.col("geoid"), 15), "code": text.zero_pad(F.col("code"), 5)})


def checked_delimited(
    spark: SparkSession, path: str, schema: str, header: bool = True, **options
) -> tuple[DataFrame, DataFrame]:
    """Rows of a text table, and the lines that do not fit its schema: file, line.

    A line goes to the second table if it has too few or too many fields or a value that is not of its column's type.
    """
    bad = "_line"
    df = spark.read.csv(
        path, schema=f"{schema}, {bad} string", header=header, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=bad, **options
    )
    # The parser skips columns that nobody asks for and then takes their bad values for good, so all are asked for.
    every = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns if c != bad])) >= 0
    rows = df.where(F.col(bad).isNull() & every).drop(bad)
    # A scan of the lines alone is not allowed, so the few that do not fit are written down with their parsed columns.
    rejects = cut_lineage(df.where(F.col(bad).isNotNull()).withColumn("_file", F.col("_metadata.file_path")))
    return rows, rejects.select(F.col("_file").alias("file"), F.col(bad).alias("line"))


def checked_header_first(df: DataFrame, col: str, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """JSON arrays whose first row is the header, read and looked at: keep..., _h (header), _rows, reason.

    ``reason`` is null for a good answer, and otherwise ``empty``, ``not JSON``, ``no header``, ``missing field`` or
    ``wrong shape`` (a row longer or shorter than the header).
    """
    rows = df.select(*keep, F.col(col).isNull().alias("_null"), F.from_json(col, "array<array<string>>").alias("_j"))
    missing = " or ".join(f"not array_contains(_h, '{f}')" for f in fields)
    reason = F.expr(
        "case when _null then 'empty' when _j is null then 'not JSON' when size(_j) = 0 or _h is null then 'no header'"
        f" when {missing} then 'missing field' when exists(_rows, r -> r is null or size(r) <> size(_h)) then 'wrong shape' end"
    )
    return (
        rows.select(*keep, "_null", "_j", F.get("_j", F.lit(0)).alias("_h"), F.expr("if(size(_j) > 0, slice(_j, 2, size(_j)), null)").alias("_rows"))
        .withColumn("reason", reason)
        .drop("_null", "_j")
    )


def header_first_rows(
    df: DataFrame, col: str, fields: Sequence[str], keep: Sequence[str] = (), on_bad: str = "fail"
) -> DataFrame:
    """JSON arrays whose first row is the header, one table row per further row; fields are found by name.

    An answer that cannot be read ends the job; with ``on_bad="skip"`` it is left to ``checked_header_first``.
    """
    if on_bad not in ("fail", "skip"):
        raise ValueError(f"on_bad must be 'fail' or 'skip', not {on_bad!r}")
    checked = checked_header_first(df, col, fields, keep)
    if on_bad == "fail":
        error = F.raise_error(F.concat(F.lit("an answer cannot be read: "), F.col("reason")))
        checked = checked.withColumn("reason", F.when(F.col("reason").isNull(), F.lit(None).cast("string")).otherwise(error.cast("string")))
    return (
        checked.where("reason is null")
        .select(*keep, "_h", F.explode("_rows").alias("_r"))
        .select(*keep, *[F.expr(f"_r[array_position(_h, '{f}') - 1]").alias(f) for f in fields])
    )


PARTS = ["state", "county", "tract", "block group"]


def census_population(df: DataFrame, col: str, rename: dict[str, str], on_bad: str = "fail") -> DataFrame:
    """Block-group rows from census answers: geoid and the renamed count columns as long."""
    parts = PARTS
    rows = header_first_rows(df, col, [*rename, *parts], on_bad=on_bad)
    return rows.select(
        F.concat(*parts).alias("geoid"), *[F.col(k).cast("long").alias(v) for k, v in rename.items()]
    )


def with_path_parts(df: DataFrame, pattern: str, names: Sequence[str]) -> DataFrame:
    """Attributes carried by the path, e.g. ``([^_/]+)_([^_/]+)_([^_/.]+)[.]`` for city, mode, level."""
    name = F.col("_metadata.file_path")
    return df.select(
        "*", *[F.regexp_extract(name, pattern, i + 1).alias(n) for i, n in enumerate(names)]
    )


def one_file_per_level(files: DataFrame, levels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """First file name (alphabetically) that contains each level's name. ``files``: by..., name."""
    level = F.explode(F.array(*[F.lit(x) for x in levels]))
    return (
        files.withColumn("level", level)
        .where(F.col("name").contains(F.col("level")))
        .groupBy(*by, "level")
        .agg(F.min("name").alias("name"))
    )


def latest_year_per_source(rows: DataFrame, source: str, year: int) -> DataFrame:
    """Rows of each source's latest year up to ``year``; sources without one drop out."""
    usable = rows.where(F.col("year") <= year)
    best = usable.groupBy(source).agg(F.max("year").alias("year"))
    return usable.join(best, [source, "year"])


def absent_sources(wanted: DataFrame, rows: DataFrame, source: str, year: int) -> DataFrame:
    """Sources that have no year up to ``year``."""
    return wanted.join(rows.where(F.col("year") <= year).select(source).distinct(), source, "left_anti")


def with_geometry(df: DataFrame, wkt: str = "wkt") -> DataFrame:
    return df.withColumn("geometry", geo.parse_wkt(F.col(wkt))).drop(wkt)
