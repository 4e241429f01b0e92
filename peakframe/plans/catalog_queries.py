"""Queries on the file catalog."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.operators.ordering import placed
from peakframe.operators.statistics import written_observed
from peakframe.registry import query
from peakframe.sources import catalog as C
from peakframe.sources import files as Z
from peakframe.sources import fixtures as X
from peakframe.sources.shared import scratch, written

_MC, _DATA = r"regexp_matches(url, '(?i)/mc\d+_')", r"regexp_matches(url, '(?i)/data\d+_')"
_KIND = f"CASE WHEN {_MC} AND NOT {_DATA} THEN 'mc' WHEN {_DATA} AND NOT {_MC} THEN 'data' END"
CAT = X.SQL_CATALOG
ALL = f"{CAT}, {X.SQL_ODD}, both0 AS (SELECT * FROM cat UNION ALL SELECT * FROM odd), al AS (SELECT *, {_KIND} AS kind FROM both0)"
KEYED = f"{CAT}, k AS (SELECT *, {_KIND} AS kind, CASE {_KIND} WHEN 'mc' THEN release || '_mc' WHEN 'data' THEN release END AS key FROM cat)"


def everything(spark, d):
    """The catalog with URLs that can't be classified."""
    return X.catalog(spark, d).unionByName(X.odd_urls(spark, d))


@query("url_classify", f"WITH {ALL} SELECT url, kind FROM al")
def url_classify(spark, d):
    return everything(spark, d).select("url", C.kind(F.col("url")).alias("kind"))


@query("url_separate", f"WITH {KEYED} SELECT key, pos, url FROM k")
def url_separate(spark, d):
    return C.checked(X.catalog(spark, d)).select("key", "pos", "url")


@query("first_violations", f"WITH {ALL} SELECT release, url FROM al WHERE kind IS NULL ORDER BY release, url LIMIT 10")
def first_violations(spark, d):
    return C.unclassified(everything(spark, d)).select("release", "url")


@query("url_contamination", f"WITH {ALL} SELECT release, count(*) AS n FROM al WHERE kind IS NULL OR (kind = 'mc') <> (pos % 3 = 0) GROUP BY release")
def url_contamination(spark, d):
    """The catalog keyed by a rule that mixes kinds up: every third file is filed as simulation."""
    keyed = everything(spark, d).withColumn("key", F.when(F.col("pos") % 3 == 0, F.concat("release", F.lit("_mc"))).otherwise(F.col("release")))
    return C.contaminated(keyed).groupBy("release").agg(F.count("*").alias("n"))


@query("cat_skip_mc", f"WITH {KEYED} SELECT key, pos FROM k WHERE NOT ends_with(key, '_mc')")
def cat_skip_mc(spark, d):
    return C.without_simulation(C.separated(X.catalog(spark, d))).select("key", "pos")


@query("cat_release_filter", f"WITH {CAT} SELECT release, pos FROM cat WHERE release IN ('1994r-pp', '1996r-pp')")
def cat_release_filter(spark, d):
    return C.chosen(X.catalog(spark, d), releases=["1994r-pp", "1996r-pp"]).select("release", "pos")


@query("cat_validate_release", f"WITH {CAT} SELECT release, n FROM (SELECT (1990 + c_custkey % 12) || 'r-pp' AS release, count(*) AS n FROM customer GROUP BY 1) WHERE release NOT IN (SELECT release FROM cat)")
def cat_validate_release(spark, d):
    asked = X.table(spark, d, "customer").groupBy(F.concat((F.col("c_custkey") % 12 + 1990).cast("string"), F.lit("r-pp")).alias("release")).agg(F.count("*").alias("n"))
    return C.unknown_releases(asked, X.catalog(spark, d))


@query("cat_explode_records", f"WITH {CAT} SELECT 'record_' || pos // 500 AS release, url FROM cat")
def cat_explode_records(spark, d):
    """Listings as the portal gives them, a JSON text for each record of at most 500 files, taken apart again."""
    files = X.catalog(spark, d).groupBy(F.floor(F.col("pos") / 500).alias("record_id"), (F.col("pos") % 3).alias("part")).agg(F.collect_list(F.struct(F.col("url").alias("uri"))).alias("files"))
    listing = files.groupBy("record_id").agg(F.to_json(F.struct(F.struct(F.collect_list(F.struct("files")).alias("files")).alias("index_files"))).alias("body"))
    return C.exploded_records(listing)


@query("cat_to_release_meta", f"WITH {KEYED} SELECT key, count(*) AS files, count(DISTINCT url) AS ids FROM k GROUP BY key")
def cat_to_release_meta(spark, d):
    return C.release_meta(C.separated(X.catalog(spark, d))).drop("digest")


@query("cat_cache", f"WITH {CAT} SELECT * FROM cat")
def cat_cache(spark, d):
    path = scratch(spark, "catalog")
    C.save_catalog(X.catalog(spark, d), path)
    return C.load_catalog(spark, path)


#: What is done to the files of some regions.
_DAMAGE = {"ASIA": "absent", "AFRICA": "truncated", "EUROPE": "footer"}
_ERROR = "CASE r_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _DAMAGE.items()) + " END"


def _region_files(spark, d):
    """part, path: the files of customers by region, some of them damaged."""
    first, second = scratch(spark, "regions"), scratch(spark, "region-files")
    nations = X.table(spark, d, "nation").join(X.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = X.table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("r_name").alias("part"), "c_custkey", "c_acctbal")
    rows.repartition("part").write.partitionBy("part").parquet(first)
    part = F.url_decode(F.regexp_extract("path", "part=([^/]*)", 1))
    listed = spark.read.format("binaryFile").load(f"{first}/*/*.parquet").select(F.col("path").alias("source"), part.alias("part"), F.concat(F.lit(f"{second}/"), F.hex(F.xxhash64("path")), F.lit(".parquet")).alias("target"))
    damage = F.create_map(*[F.lit(x) for kv in _DAMAGE.items() for x in kv])
    files = written(listed.withColumn("damage", damage[F.col("part")]))
    written(X.damaged_copies(files))
    return files.select("part", F.col("target").alias("path"))


@query("src_multi_file", f"SELECT r_name AS part, {_ERROR} IS NULL AS ok, {_ERROR} AS error, CASE WHEN {_ERROR} IS NULL THEN count(*) ELSE 0 END AS n, CASE WHEN {_ERROR} IS NULL THEN round(sum(c_acctbal), 2) ELSE 0 END AS total FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY r_name")
def src_multi_file(spark, d):
    """A file for each region, read in one pass: the rows of those that can be read, and what is wrong with the others."""
    files = _region_files(spark, d)
    read = Z.read_files(files, T.StructType([T.StructField("c_acctbal", T.DoubleType())]))
    by = read.groupBy("file").agg(F.max("outcome").alias("o"), F.coalesce(F.sum("row.c_acctbal"), F.lit(0.0)).alias("total"))
    found = by.join(files, by["file"] == files["path"]).groupBy("part").agg(F.bool_and("o.ok").alias("ok"), F.max("o.error").alias("error"), F.sum("o.rows").alias("n"), F.round(F.sum("total"), 2).alias("total"))
    return found


@query("src_failed_files", f"SELECT {_ERROR} AS error, count(*) AS parts FROM region WHERE {_ERROR} IS NOT NULL GROUP BY 1")
def src_failed_files(spark, d):
    """The files of which nothing was read, by kind of error; their rows don't leave the executors."""
    files = _region_files(spark, d)
    failed = Z.outcomes_of(Z.read_files(files, T.StructType([T.StructField("c_custkey", T.LongType())]))).filter("NOT ok")
    return failed.join(files, failed["file"] == files["path"]).groupBy("error").agg(F.count_distinct("part").alias("parts"))


_GOOD = f"FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE {_ERROR} IS NULL"


@query("src_read_observed", f"SELECT (SELECT count(*) FROM region) AS total_files, (SELECT count(*) FROM region WHERE {_ERROR} IS NULL) AS successful_files, (SELECT count(*) FROM region WHERE {_ERROR} IS NOT NULL) AS failed_files, count(*) AS total_events, count(*) AS written_events, round(sum(c_acctbal), 2) AS total {_GOOD}")
def src_read_observed(spark, d):
    """Files are read, their rows written, and successes and failures counted in one pass; what was written is read back."""
    files, path = _region_files(spark, d), scratch(spark, "read")
    read = Z.read_files(files, T.StructType([T.StructField("c_acctbal", T.DoubleType())]))
    seen = written_observed(read, path, Z.read_metrics(), keep=F.col("outcome").isNull())
    back = spark.read.parquet(path).agg(F.count("*").alias("written_events"), F.round(F.sum("row.c_acctbal"), 2).alias("total"))  # one row
    return seen.drop("total_size_mb", "average_time_sec").join(F.broadcast(back), F.lit(True))


_WANTED = "(SELECT 'root://store.example/data16_13TeV/DAOD.' || o_custkey || '.root' AS url, count(*) AS n FROM orders GROUP BY 1)"


def _wanted(spark, d):
    return X.table(spark, d, "orders").groupBy(F.concat(F.lit("root://store.example/data16_13TeV/DAOD."), F.col("o_custkey").cast("string"), F.lit(".root")).alias("url")).agg(F.count("*").alias("n"))


@query("requested_files_semi", f"WITH {CAT} SELECT w.url, n FROM {_WANTED} w WHERE url IN (SELECT url FROM cat)")
def requested_files_semi(spark, d):
    return _wanted(spark, d).join(X.catalog(spark, d), "url", "left_semi")


@query("missing_files_except", f"WITH {CAT} SELECT url FROM {_WANTED} EXCEPT SELECT url FROM cat")
def missing_files_except(spark, d):
    return _wanted(spark, d).select("url").exceptAll(X.catalog(spark, d).select("url")).distinct()


@query("batch_slice", f"WITH {CAT}, p AS (SELECT url, row_number() OVER (ORDER BY pos) - 1 AS place, count(*) OVER () AS n FROM cat) SELECT url, place, CASE WHEN n < 7 THEN 6 ELSE least(place // (n // 7), 6) END AS batch FROM p")
def batch_slice(spark, d):
    c = X.catalog(spark, d)
    n = c.count()
    return placed(c, ["pos"]).select("url", "place", C.batch_of(F.col("place"), F.lit(n), 7).alias("batch"))


@query("batch_slice_by_release", f"WITH {CAT}, p AS (SELECT release, row_number() OVER (ORDER BY release, pos) - 1 AS place, count(*) OVER () AS n FROM cat) SELECT CASE WHEN n < 7 THEN 6 ELSE least(place // (n // 7), 6) END AS batch, release, count(*) AS files FROM p GROUP BY ALL")
def batch_slice_by_release(spark, d):
    c = X.catalog(spark, d)
    n = c.count()
    return placed(c, ["release", "pos"]).groupBy(C.batch_of(F.col("place"), F.lit(n), 7).alias("batch"), "release").agg(F.count("*").alias("files"))


@query("first_n_per_release", f"WITH {CAT} SELECT release, pos, url FROM cat QUALIFY row_number() OVER (PARTITION BY release ORDER BY pos) <= 3")
def first_n_per_release(spark, d):
    w = Window.partitionBy("release").orderBy("pos")
    return X.catalog(spark, d).withColumn("r", F.row_number().over(w)).filter("r <= 3").drop("r")
