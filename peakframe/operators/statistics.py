"""Roll-ups of what the stages did: files, particles, masses, cleaning, histograms, batches, times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from peakframe.functions.labels import LETTERS, STAGE_LINES, fs_of, im_of, part_of, particle_types, rate, seconds_of
from peakframe.operators.quantiles import exact_quantiles


def parse_stats(files: DataFrame) -> DataFrame:
    """One row: files, ok, failed, events, MB, mean seconds, percent that succeeded, events per good file."""
    return files.agg(*parse_metrics())


def parse_metrics() -> list[Column]:
    """What parse_stats gives, as aggregates that a pass over the files can also observe on its way."""
    good = F.col("ok")
    n, ok = F.count("*"), F.count_if(good)
    events = F.coalesce(F.sum(F.when(good, F.col("n_events"))), F.lit(0))
    return [
        n.alias("total_files"), ok.alias("successful_files"), F.count_if(~good).alias("failed_files"), events.alias("total_events"), (F.coalesce(F.sum("size_bytes"), F.lit(0)) / (1024 * 1024)).alias("total_size_mb"),
        F.coalesce(F.avg("time_sec"), F.lit(0.0)).alias("average_time_sec"), (rate(ok.cast("double"), n) * 100).alias("success_rate"), rate(events.cast("double"), ok).alias("events_per_file"),
    ]


def written_observed(df: DataFrame, path: str, metrics: list[Column], keep: Column | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes the rows of df (those that `keep` chooses) to path, and gives one row of metrics over all of them, taken in the same pass: nothing is read twice.

    The metrics are there when the write has succeeded; of tasks that ran twice one counts.
    """
    seen = Observation()
    out = df.observe(seen, *metrics)
    (out if keep is None else out.filter(keep)).write.partitionBy(*partition_by).parquet(path)
    names = [f.name for f in df.limit(0).agg(*metrics).schema]
    return df.sparkSession.createDataFrame([tuple(seen.get[c] for c in names)], df.limit(0).agg(*metrics).schema)


def throughput(files: DataFrame) -> DataFrame:
    """One row: events of good files for each second that files took."""
    return files.agg(rate(F.coalesce(F.sum(F.when(F.col("ok"), F.col("n_events"))), F.lit(0)).cast("double"), F.sum("time_sec")).alias("events_per_sec"))


def first_errors(files: DataFrame, most: int) -> DataFrame:
    """metric, value: how many files failed in each of the kinds of error seen first."""
    kinds = files.filter(~F.col("ok")).groupBy("error_type").agg(F.count("*").alias("n"), F.min("file_id").alias("seen")).orderBy("seen").limit(most)
    short = F.when(F.length("error_type") > 30, F.concat(F.substring("error_type", 1, 30), F.lit("..."))).otherwise(F.col("error_type"))
    return kinds.select(F.concat(F.lit("error: "), short).alias("metric"), F.col("n").cast("double").alias("value"))


def violations(files: DataFrame) -> DataFrame:
    """file_id and rule for each rule that a row breaks."""
    rule = lambda c, name: F.when(c, name)
    broken = F.array_compact(F.array(rule(F.col("n_events") < 0, "negative events"), rule(F.col("time_sec") < 0, "negative time"), rule(F.col("size_bytes") < 0, "negative size"), rule(~F.col("ok") & F.col("error_type").isNull(), "failure without message"), rule(F.col("end_sec") < F.col("start_sec"), "end before start")))
    return files.select("file_id", F.explode(broken).alias("rule"))


def particle_totals(events: DataFrame, types: list[str]) -> DataFrame:
    """ptype, total in long form."""
    sums = events.agg(*[F.sum(F.size(t)).alias(t) for t in types])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(t).alias("ptype"), F.coalesce(F.col(t), F.lit(0)).alias("total")) for t in types])).alias("x")).select("x.*")


def events_per_file(events: DataFrame) -> DataFrame:
    return events.groupBy("source_file").agg(F.count("*").alias("events"))


def channels(values: DataFrame) -> DataFrame:
    """fs, im, entries of signatures that have both."""
    s = F.col("signature")
    parsed = values.groupBy("signature").agg(F.count("*").alias("k")).select(fs_of(s).alias("fs"), im_of(s).alias("im"), "k").filter("fs <> ''")
    return parsed.groupBy("fs", "im").agg(F.sum("k").alias("entries"))


def mass_totals(ch: DataFrame) -> DataFrame:
    return ch.agg(F.count_distinct("fs").alias("final_states"), F.count("*").alias("channels"), F.coalesce(F.sum("entries"), F.lit(0)).alias("values"))


def participation(ch: DataFrame) -> DataFrame:
    """ptype, channels that it takes part in, and their share of all participations."""
    names = F.create_map(*[F.lit(x) for t, k in LETTERS.items() for x in (k, t)])
    by = ch.select(F.explode(particle_types(F.col("im"))).alias("letter")).groupBy(F.element_at(names, F.col("letter")).alias("ptype")).agg(F.count("*").alias("channels"))
    whole = by.agg(F.sum("channels").alias("__all"))  # one row
    return by.join(F.broadcast(whole), F.lit(True)).select("ptype", "channels", (F.col("channels") / F.col("__all")).alias("share"))


def channel_sizes(ch: DataFrame) -> DataFrame:
    """How many channels have so many types of particles."""
    return ch.groupBy(F.size(particle_types(F.col("im"))).cast("long").alias("types")).agg(F.count("*").alias("channels"))


def post_stats(values: DataFrame) -> DataFrame:
    """One row: signatures and entries, main and outliers, and channels with outliers."""
    s = F.col("signature")
    sig = values.groupBy("signature").agg(F.count("*").alias("k")).withColumn("out", part_of(s) == "outliers")
    channel = F.when(F.col("out"), F.struct(fs_of(s), im_of(s)))
    entries = lambda c: F.coalesce(F.sum(F.when(c, F.col("k"))), F.lit(0))
    return sig.agg(F.count("*").alias("signatures"), F.count_if(~F.col("out")).alias("main_signatures"), F.count_if("out").alias("outlier_signatures"), F.coalesce(F.sum("k"), F.lit(0)).alias("entries"), entries(~F.col("out")).alias("main_entries"), entries(F.col("out")).alias("outlier_entries"), F.count_distinct(channel).alias("outlier_channels"))


def inside(hist: DataFrame) -> DataFrame:
    """hist_name, entries: content inside the range."""
    return hist.groupBy("hist_name").agg(F.coalesce(F.sum(F.when(F.col("bin").between(1, F.col("nbins")), F.col("content"))), F.lit(0)).alias("entries"))


def hist_fs(name: Column) -> Column:
    return F.regexp_extract(name, r"_cat_([\w_]+?)_width_", 1)


def hist_stats(entries: DataFrame) -> DataFrame:
    """One row over hist_name, entries (a written table: the median takes some passes, none of which holds the values)."""
    (median,) = exact_quantiles(entries, "entries", [0.5])
    out = F.contains(F.lower("hist_name"), F.lit("outlier"))
    return entries.agg(F.count("*").alias("histograms"), F.count_if(~out).alias("main_histograms"), F.count_if(out).alias("outlier_histograms"), F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"), F.count_distinct(hist_fs(F.col("hist_name"))).alias("final_states"), F.avg("entries").alias("mean_entries"), F.lit(median).cast("double").alias("median_entries"))


def stage_times(lines: DataFrame) -> DataFrame:
    """stage, seconds: sums of what the log lines say; 0 for stages without lines."""
    pairs = F.array(*[F.struct(F.lit(k).alias("stage"), F.coalesce(seconds_of(F.col("line"), head), F.lit(0.0)).alias("s")) for k, head in STAGE_LINES.items()])
    return lines.select(F.explode(pairs).alias("x")).groupBy("x.stage").agg(F.round(F.sum("x.s"), 1).alias("seconds"))


def batch_rollup(batches: DataFrame) -> DataFrame:
    """One row over batch_index, parsed_files, im_files (arrays), total_events, failed_files, size_mb (text), elapsed; a batch may have several rows."""
    whole = lambda c: F.coalesce(F.sum(F.floor(F.col(c).cast("double"))), F.lit(0)).cast("long")
    return batches.agg(
        F.count_distinct("batch_index").alias("num_batches"), F.array_join(F.transform(F.array_sort(F.collect_set("batch_index")), lambda x: x.cast("string")), ",").alias("batches"), F.sum(F.size("parsed_files")).alias("total_parsed_files"), F.sum(F.size("im_files")).alias("total_im_files"),
        whole("total_events").alias("total_events"), whole("failed_files").alias("failed_files"), whole("size_mb").alias("total_size_mb"), F.round(F.sum("elapsed"), 3).alias("total_batch_time_sec"),
    )


def spread(values: DataFrame, column: str, most: int) -> DataFrame:
    """bin, n: histogram of a column in at most `most` even bins, as many as there are rows if fewer, the last bin closed; and the mean."""
    v = F.col(column).cast("double")
    bounds = values.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.least(F.count("*"), F.lit(most)).alias("nb"), F.avg(v).alias("mean"))  # one row
    step = (F.col("hi") - F.col("lo")) / F.col("nb")
    place = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((v - F.col("lo")) / F.nullif(step, F.lit(0.0))), F.col("nb") - 1)).otherwise(0).cast("long")
    return values.join(F.broadcast(bounds), F.lit(True)).groupBy(place.alias("bin"), "mean").agg(F.count("*").alias("n"))


def long_form(row: DataFrame) -> DataFrame:
    """metric, value of a one-row table."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns])).alias("x")).select("x.*")
