"""Catalogs of event files: release, pos, url; simulation under `{release}_mc`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTING = T.StructType([T.StructField("index_files", T.StructType([T.StructField("files", T.ArrayType(T.StructType([T.StructField("files", T.ArrayType(T.StructType([T.StructField("uri", T.StringType())])))])))]))])


def kind(url: Column) -> Column:
    """`mc` or `data` by the name space in the path; null where it is both or neither."""
    mc, data = url.rlike(r"(?i)/mc\d+_"), url.rlike(r"(?i)/data\d+_")
    return F.when(mc & ~data, "mc").when(data & ~mc, "data")


def separated(catalog: DataFrame) -> DataFrame:
    """The catalog keyed by release, or release_mc for simulation; unclassified URLs have a null key (see unclassified)."""
    k = kind(F.col("url"))
    return catalog.withColumn("key", F.when(k == "mc", F.concat("release", F.lit("_mc"))).when(k == "data", F.col("release")))


def unclassified(catalog: DataFrame, most: int = 10) -> DataFrame:
    """The first URLs that are of neither kind or of both."""
    return catalog.filter(kind(F.col("url")).isNull()).orderBy("release", "url").limit(most)


def checked(catalog: DataFrame) -> DataFrame:
    """separated(), or an error that names the first URLs that can't be classified."""
    if bad := [r["url"] for r in unclassified(catalog).collect()]:
        raise ValueError("URLs that are neither data nor simulation, or both:\n" + "\n".join(bad))
    return separated(catalog)


def contaminated(keyed: DataFrame) -> DataFrame:
    """Rows whose key and kind disagree, or whose kind is unknown."""
    k = kind(F.col("url"))
    return keyed.filter(k.isNull() | (F.col("key").endswith("_mc") != (k == "mc")))


def without_simulation(keyed: DataFrame) -> DataFrame:
    return keyed.filter(~F.col("key").endswith("_mc"))


def chosen(catalog: DataFrame, records: list[int] | None = None, releases: list[str] | None = None) -> DataFrame:
    """Named records if there are any, else named releases, else all."""
    if records:
        return catalog.filter(F.col("release").isin([f"record_{r}" for r in records]))
    return catalog.filter(F.col("release").isin(list(releases))) if releases else catalog


def unknown_releases(requested: DataFrame, catalog: DataFrame) -> DataFrame:
    return requested.join(catalog.select("release").distinct(), "release", "left_anti")


def exploded_records(listings: DataFrame) -> DataFrame:
    """record_id, body (JSON) to release, url: a row for each file of each index."""
    body = F.from_json("body", LISTING)
    return listings.select(F.concat(F.lit("record_"), F.col("record_id").cast("string")).alias("release"), F.explode(body["index_files"]["files"]).alias("f")).select("release", F.explode("f.files.uri").alias("url"))


def release_meta(catalog: DataFrame, key: str = "key") -> DataFrame:
    """Number of files and of different ids for each key, and a digest of the ids that doesn't depend on their order."""
    ids = F.xxhash64("url")
    return catalog.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("files"), F.count_distinct(ids).alias("ids"), F.bit_xor(ids).alias("digest"))


def save_catalog(catalog: DataFrame, path: str) -> None:
    catalog.write.mode("overwrite").json(path)


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("release string, pos long, url string").json(path)


def batch_of(place: Column, n: Column, total: int) -> Column:
    """Number (from 0) of the batch that item `place` (from 0) of n falls in: n div total each, the last takes the rest, and all if there are fewer items than batches."""
    size = F.floor(n / total)
    return F.when(n < total, F.lit(total - 1)).otherwise(F.least(F.floor(place / F.greatest(size, F.lit(1))), F.lit(total - 1))).cast("long")
