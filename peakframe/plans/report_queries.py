"""Statistics of the stages, and the tables behind the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakframe.functions import labels as L
from peakframe.operators import histograms as H
from peakframe.operators import statistics as T
from peakframe.operators.capped import capped
from peakframe.operators.quantiles import exact_quantiles
from peakframe.plans import event_queries as EQ
from peakframe.plans import histogram_queries as HQ
from peakframe.registry import query
from peakframe.sources import fixtures as X
from peakframe.sources.shared import scratch, written
from peakframe.streaming.chunking import capped_stream, write_in_order

FILES, LOGS = X.SQL_FILES, X.SQL_LOGS
_PARSE = """count(*) AS total_files, count(*) FILTER (ok) AS successful_files, count(*) FILTER (NOT ok) AS failed_files, coalesce(sum(n_events) FILTER (ok), 0)::BIGINT AS total_events,
 round(sum(size_bytes) / 1048576.0::DOUBLE, 6) AS total_size_mb, round(avg(time_sec), 6) AS average_time_sec, round(count(*) FILTER (ok) / count(*)::DOUBLE * 100, 6) AS success_rate, round(coalesce(sum(n_events) FILTER (ok), 0) / count(*) FILTER (ok)::DOUBLE, 6) AS events_per_file"""
ROUNDED = ["total_size_mb", "average_time_sec", "success_rate", "events_per_file"]


def _unpivot(sql: str, cols: list[str]) -> str:
    return "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS metric, {c}::DOUBLE AS value FROM ({sql})" for c in cols) + ")"


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- stages ----------------------------------------------------------------------------------------------------------
@query("parse_stats", f"WITH {FILES} SELECT {_PARSE} FROM files")
def parse_stats(spark, d):
    return rounded(T.parse_stats(X.file_results(spark, d)), ROUNDED)


@query("rates", f"WITH {FILES} SELECT error_type, count(*) AS n, round(CASE WHEN sum(time_sec) > 0 THEN sum(n_events) / sum(time_sec) ELSE 0 END, 6) AS events_per_sec FROM files GROUP BY error_type")
def rates(spark, d):
    return X.file_results(spark, d).groupBy("error_type").agg(F.count("*").alias("n"), F.round(L.rate(F.sum("n_events"), F.sum("time_sec")), 6).alias("events_per_sec"))


_BROKEN = f"{FILES}, b AS (SELECT file_id, ok, CASE WHEN file_id % 11 = 0 THEN -n_events - 1 ELSE n_events END AS n_events, CASE WHEN file_id % 13 = 0 THEN -1.0 ELSE time_sec END AS time_sec, size_bytes, CASE WHEN file_id % 2 = 0 THEN error_type END AS error_type, 5.0 AS start_sec, CASE WHEN file_id % 17 = 0 THEN 4.0 ELSE 6.0 END AS end_sec FROM files)"
_RULES = {"n_events < 0": "negative events", "time_sec < 0": "negative time", "size_bytes < 0": "negative size", "NOT ok AND error_type IS NULL": "failure without message", "end_sec < start_sec": "end before start"}


@query("stats_violations", f"WITH {_BROKEN} " + " UNION ALL ".join(f"SELECT file_id, '{v}' AS rule FROM b WHERE {k}" for k, v in _RULES.items()))
def stats_violations(spark, d):
    """Some rows are broken on purpose."""
    i = F.col("file_id")
    b = X.file_results(spark, d).withColumns({"n_events": F.when(i % 11 == 0, -F.col("n_events") - 1).otherwise(F.col("n_events")), "time_sec": F.when(i % 13 == 0, -1.0).otherwise(F.col("time_sec")), "error_type": F.when(i % 2 == 0, F.col("error_type")), "start_sec": F.lit(5.0), "end_sec": F.when(i % 17 == 0, 4.0).otherwise(6.0)})
    return T.violations(b)


@query("parsed_data_stats", f"WITH {EQ.SQL_C} " + " UNION ALL ".join(f"SELECT '{t}' AS ptype, sum(c_{t})::BIGINT AS total FROM c" for t in L.FS_ORDER))
def parsed_data_stats(spark, d):
    return T.particle_totals(EQ.cut_events(spark, d), L.FS_ORDER)


CH = f"{HQ.V}, ch AS (SELECT fs, im, sum(k)::BIGINT AS entries FROM (SELECT {HQ._FS} AS fs, {HQ._IM} AS im, count(*) AS k FROM vals GROUP BY 1, 2) WHERE fs <> '' GROUP BY fs, im)"


@query("mass_stats", f"WITH {CH} SELECT fs, count(*) AS channels, sum(entries)::BIGINT AS entries FROM ch GROUP BY fs")
def mass_stats(spark, d):
    return T.channels(X.array_values(spark, d)).groupBy("fs").agg(F.count("*").alias("channels"), F.sum("entries").alias("entries"))


@query("mass_totals", f'WITH {CH} SELECT count(DISTINCT fs) AS final_states, count(*) AS channels, sum(entries)::BIGINT AS "values" FROM ch')
def mass_totals(spark, d):
    return T.mass_totals(T.channels(X.array_values(spark, d)))


@query(
    "post_stats",
    f"""WITH {HQ.V}, s AS (SELECT signature, count(*) AS k, signature LIKE '%\\_outliers' ESCAPE '\\' AS o, {HQ._FS} AS fs, {HQ._IM} AS im FROM vals GROUP BY ALL)
SELECT count(*) AS signatures, count(*) FILTER (NOT o) AS main_signatures, count(*) FILTER (o) AS outlier_signatures, sum(k)::BIGINT AS entries, coalesce(sum(k) FILTER (NOT o), 0)::BIGINT AS main_entries, coalesce(sum(k) FILTER (o), 0)::BIGINT AS outlier_entries, count(DISTINCT (fs, im)) FILTER (o) AS outlier_channels FROM s""",
)
def post_stats(spark, d):
    return T.post_stats(X.array_values(spark, d))


ENTRIES = f"{HQ.NAMED}, {HQ.sql_hist('nv', 'name', 10)}, en AS (SELECT hist_name, coalesce(sum(content) FILTER (bin BETWEEN 1 AND nbins), 0)::BIGINT AS entries FROM h GROUP BY hist_name)"
_HFS = "regexp_extract(hist_name, '_cat_([\\w_]+?)_width_', 1)"
_HSTATS = f"count(*) AS histograms, count(*) FILTER (NOT contains(lower(hist_name), 'outlier')) AS main_histograms, count(*) FILTER (contains(lower(hist_name), 'outlier')) AS outlier_histograms, sum(entries)::BIGINT AS entries, count(DISTINCT {_HFS}) AS final_states, round(avg(entries), 6) AS mean_entries, median(entries)::DOUBLE AS median_entries"


def entries(spark, d):
    return T.inside(H.created(X.array_values(spark, d)))


@query("hist_stats", f"WITH {ENTRIES} SELECT {_HSTATS} FROM en")
def hist_stats(spark, d):
    return rounded(T.hist_stats(written(entries(spark, d))), ["mean_entries"])


_AT = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


@query("hist_entry_quantiles", f"WITH {ENTRIES}, lp AS (SELECT l_extendedprice AS v FROM lineitem) " + " UNION ALL ".join(f"SELECT 'entries' AS item, {q}::DOUBLE AS q, round(quantile_cont(entries, {q}), 6)::DOUBLE AS value FROM en UNION ALL SELECT 'value', {q}, round(quantile_cont(v, {q}), 6) FROM lp" for q in _AT))
def hist_entry_quantiles(spark, d):
    """Exact quantiles of the histograms' entries and of all values."""
    en, values = written(entries(spark, d)), X.table(spark, d, "lineitem").select("l_extendedprice")
    found = [("entries", q, round(v, 6)) for q, v in zip(_AT, exact_quantiles(en, "entries", _AT), strict=True)] + [("value", q, round(v, 6)) for q, v in zip(_AT, exact_quantiles(values, "l_extendedprice", _AT), strict=True)]
    return spark.createDataFrame(found, "item string, q double, value double")


@query("hist_entries", f"WITH {ENTRIES} SELECT hist_name, entries FROM en")
def hist_entries(spark, d):
    return entries(spark, d)


def _batches(spark, d):
    """What batches of customers report, through JSON as they write it: a row for each part of a batch, of 1,000 customers at most."""
    c = X.table(spark, d, "customer")
    by = c.groupBy((F.col("c_custkey") % 9 + 1).cast("int").alias("batch_index"), F.floor(F.col("c_custkey") / 9000).alias("part")).agg(
        F.collect_list(F.when(F.col("c_custkey") % 2 == 0, F.col("c_name"))).alias("parsed_files"), F.collect_list(F.when(F.col("c_custkey") % 3 == 0, F.col("c_name"))).alias("im_files"), F.count("*").alias("total_events"),
        F.count_if(F.col("c_acctbal") < 0).alias("failed_files"), F.concat(F.count("*").cast("string"), F.lit(".5")).alias("size_mb"), F.sum(F.col("c_custkey") / 10.0).alias("elapsed"),
    )
    path = scratch(spark, "batches")
    by.write.partitionBy("batch_index").json(path)
    return spark.read.schema("batch_index int, part long, parsed_files array<string>, im_files array<string>, total_events long, failed_files long, size_mb string, elapsed double").json(path)


@query(
    "batch_stats_rollup",
    """WITH b AS (SELECT c_custkey % 9 + 1 AS i, count(*) FILTER (c_custkey % 2 = 0) AS p, count(*) FILTER (c_custkey % 3 = 0) AS im, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS f, sum(c_custkey / 10.0::DOUBLE) AS t FROM customer GROUP BY 1)
SELECT count(*) AS num_batches, string_agg(i::VARCHAR, ',' ORDER BY i) AS batches, sum(p)::BIGINT AS total_parsed_files, sum(im)::BIGINT AS total_im_files, sum(n)::BIGINT AS total_events, sum(f)::BIGINT AS failed_files, sum(n)::BIGINT AS total_size_mb, round(sum(t), 3) AS total_batch_time_sec FROM b""",
)
def batch_stats_rollup(spark, d):
    return T.batch_rollup(_batches(spark, d))


@query("stats_save", "SELECT c_custkey % 9 + 1 AS batch_index, count(*) AS total_events, count(*) FILTER (c_acctbal < 0) AS failed_files FROM customer GROUP BY 1")
def stats_save(spark, d):
    return _batches(spark, d).groupBy(F.col("batch_index").cast("long").alias("batch_index")).agg(F.sum("total_events").alias("total_events"), F.sum("failed_files").alias("failed_files"))


def _sec(head: str) -> str:
    return f"coalesce(try_cast(regexp_extract(line, '{head} in ([0-9.]+)s', 1) AS DOUBLE), 0)"


TIMES = f"{LOGS}, st AS (" + " UNION ALL ".join(f"SELECT '{k}' AS stage, round(sum({_sec(h)}), 1) AS seconds FROM logs" for k, h in L.STAGE_LINES.items()) + ")"


@query("stage_times", f"WITH {TIMES} SELECT * FROM st")
def stage_times(spark, d):
    return T.stage_times(X.log_lines(spark, d))


@query("log_duration", f"WITH {LOGS} SELECT event_id, coalesce({', '.join(f'''try_cast(regexp_extract(line, '{h} in ([0-9.]+)s', 1) AS DOUBLE)''' for h in L.STAGE_LINES.values())}) AS seconds FROM logs")
def log_duration(spark, d):
    return X.log_lines(spark, d).select("event_id", F.coalesce(*[L.seconds_of(F.col("line"), h) for h in L.STAGE_LINES.values()]).alias("seconds"))


@query("stage_time_attach", f"WITH {TIMES}, {CH.replace('WITH ', '')}, s(stage, n) AS (SELECT 'mass_calc_time_sec', (SELECT count(*) FROM ch) UNION ALL SELECT 'post_processing_time_sec', (SELECT count(*) FROM vals) UNION ALL SELECT 'unknown_sec', 0) SELECT s.stage, n, CASE WHEN seconds > 0 THEN seconds END AS seconds FROM s LEFT JOIN st ON st.stage = s.stage")
def stage_time_attach(spark, d):
    v = X.array_values(spark, d)
    rows = T.channels(v).agg(F.count("*").alias("n")).select(F.lit("mass_calc_time_sec").alias("stage"), "n").unionByName(v.agg(F.count("*").alias("n")).select(F.lit("post_processing_time_sec").alias("stage"), "n"))
    rows = rows.unionByName(v.limit(1).agg(F.lit(0).cast("long").alias("n")).select(F.lit("unknown_sec").alias("stage"), "n"))
    return rows.join(T.stage_times(X.log_lines(spark, d)), "stage", "left").select("stage", "n", F.when(F.col("seconds") > 0, F.col("seconds")).alias("seconds"))


# --- scalars ---------------------------------------------------------------------------------------------------------
@query("safe_float", "SELECT event_id, coalesce(try_cast(regexp_replace(t, '%$', '') AS DOUBLE), 0) AS v FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN user_id || '.5' WHEN 1 THEN user_id || '%' WHEN 2 THEN 'n/a' END AS t FROM events)")
def safe_float(spark, d):
    k, u = F.col("event_id") % 4, F.col("user_id").cast("string")
    t = F.when(k == 0, F.concat(u, F.lit(".5"))).when(k == 1, F.concat(u, F.lit("%"))).when(k == 2, "n/a")
    return X.table(spark, d, "events").select("event_id", L.safe_float(t).alias("v"))


@query("format_rate", "SELECT event_id, CASE WHEN r >= 100 THEN format('{:,}', r::BIGINT) WHEN r >= 1 THEN format('{:.2f}', r) WHEN r > 0 THEN format('{:.4f}', r) ELSE '0' END AS rate FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN user_id * 128 + 100 WHEN 1 THEN (user_id % 90) + 1.25::DOUBLE WHEN 2 THEN 0.0625 ELSE 0 END::DOUBLE AS r FROM events)")
def format_rate(spark, d):
    """Rates that two and four decimals hold exactly."""
    k, u = F.col("event_id") % 4, F.col("user_id")
    r = F.when(k == 0, (u * 128 + 100).cast("double")).when(k == 1, (u % 90) + 1.25).when(k == 2, 0.0625).otherwise(0.0)
    return X.table(spark, d, "events").select("event_id", L.format_rate(r).alias("rate"))


# --- top lists -------------------------------------------------------------------------------------------------------
@query("top_final_states", f"WITH {EQ.SQL_V} SELECT substr(fs, 1, 20) AS fs, n FROM (SELECT fs, count(*) AS n FROM v GROUP BY fs ORDER BY n DESC, fs LIMIT 10)")
def top_final_states(spark, d):
    base = EQ.M.labelled(EQ.cut_events(spark, d)).groupBy("fs").agg(F.count("*").alias("n"))
    return base.orderBy(F.desc("n"), "fs").limit(10).select(F.substring("fs", 1, 20).alias("fs"), "n")


@query("top_hist_final_states", f"WITH {ENTRIES} SELECT {_HFS} AS fs, count(*) AS n FROM en GROUP BY 1 ORDER BY n DESC, fs LIMIT 10")
def top_hist_final_states(spark, d):
    return entries(spark, d).groupBy(T.hist_fs(F.col("hist_name")).alias("fs")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "fs").limit(10)


@query("first_errors", f"WITH {FILES}, e AS (SELECT error_type || ': ' || repeat('x', 40) AS error, count(*) AS n, min(file_id) AS seen FROM files WHERE NOT ok GROUP BY 1) SELECT CASE WHEN length(error) > 30 THEN substr(error, 1, 30) || '...' ELSE error END AS error, n, seen FROM e ORDER BY seen LIMIT 5")
def first_errors(spark, d):
    e = X.file_results(spark, d).filter(~F.col("ok")).groupBy(F.concat("error_type", F.lit(": "), F.lit("x" * 40)).alias("error")).agg(F.count("*").alias("n"), F.min("file_id").alias("seen"))
    short = F.when(F.length("error") > 30, F.concat(F.substring("error", 1, 30), F.lit("..."))).otherwise(F.col("error"))
    return e.orderBy("seen").limit(5).select(short.alias("error"), "n", "seen")


# --- reports ---------------------------------------------------------------------------------------------------------
_PCOLS = ["total_files", "successful_files", "failed_files", "total_events", "total_size_mb", "average_time_sec", "success_rate", "events_per_file"]


_ERRORS = "SELECT 'error: ' || CASE WHEN length(error_type) > 30 THEN substr(error_type, 1, 30) || '...' ELSE error_type END, n::DOUBLE FROM (SELECT error_type, count(*) AS n, min(file_id) AS seen FROM files WHERE NOT ok GROUP BY 1 ORDER BY seen LIMIT 5)"
_THROUGHPUT = "SELECT 'events_per_sec' AS metric, round(coalesce(sum(n_events) FILTER (ok), 0) / sum(time_sec), 6) AS value FROM files"


@query("rep_performance", f"WITH {FILES}, {TIMES} {_unpivot(f'SELECT {_PARSE} FROM files', _PCOLS)} UNION ALL SELECT stage, seconds FROM st UNION ALL {_THROUGHPUT} UNION ALL {_ERRORS}")
def rep_performance(spark, d):
    """Stage times, success and files, size, throughput, and the first five kinds of error. Parsing logs neither memory nor timeouts here."""
    files = X.file_results(spark, d)
    stages = T.stage_times(X.log_lines(spark, d)).select(F.col("stage").alias("metric"), F.col("seconds").alias("value"))
    return T.long_form(parse_stats(spark, d)).unionByName(stages).unionByName(T.long_form(rounded(T.throughput(files), ["events_per_sec"]))).unionByName(T.first_errors(files, 5))


@query("rep_parsed", f"WITH {EQ.SQL_C}, {FILES} " + " UNION ALL ".join(f"SELECT '{t}' AS metric, sum(c_{t})::DOUBLE AS value FROM c" for t in L.FS_ORDER) + " UNION ALL SELECT 'events', count(*)::DOUBLE FROM c UNION ALL SELECT 'total_size_mb', round(sum(size_bytes) / 1048576.0::DOUBLE, 6) FROM files")
def rep_parsed(spark, d):
    ev = EQ.cut_events(spark, d)
    size = parse_stats(spark, d).select("total_size_mb")
    return T.long_form(ev.agg(F.count("*").alias("events"), *[F.sum(F.size(t)).alias(t) for t in L.FS_ORDER])).unionByName(T.long_form(size))


@query("rep_particles_per_event", f"WITH {EQ.SQL_C} " + " UNION ALL ".join(f"SELECT '{t}' AS ptype, c_{t} AS particles, count(*) AS events FROM c GROUP BY c_{t}" for t in L.FS_ORDER))
def rep_particles_per_event(spark, d):
    rows = EQ.cut_events(spark, d).select(F.explode(F.array(*[F.struct(F.lit(t).alias("ptype"), F.size(t).cast("long").alias("particles")) for t in L.FS_ORDER])).alias("x"))
    return rows.groupBy("x.ptype", "x.particles").agg(F.count("*").alias("events"))


def _spread_sql(source: str, column: str, most: int) -> str:
    return f"""b AS (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi, least(count(*), {most}) AS nb, avg({column}) AS mean FROM {source})
SELECT CASE WHEN hi > lo THEN least(floor(({column} - lo) / ((hi - lo) / nb)), nb - 1) ELSE 0 END::BIGINT AS bin, round(mean, 6) AS mean, count(*) AS n FROM {source}, b GROUP BY ALL"""


@query("rep_events_per_file", f"WITH e AS (SELECT o_custkey, count(*) AS events FROM orders GROUP BY o_custkey), {_spread_sql('e', 'events', 20)}")
def rep_events_per_file(spark, d):
    """A customer is a file here, its orders are the events."""
    files = X.table(spark, d, "orders").withColumnRenamed("o_custkey", "source_file")
    return rounded(T.spread(written(T.events_per_file(files)), "events", 20), ["mean"])


_LET = "CASE x " + " ".join(f"WHEN '{k}' THEN '{t}'" for t, k in L.LETTERS.items()) + " END"
_TYPES = "list_distinct(regexp_extract_all(im, '([emjgtb])(\\d+)', 1))"


_MASS_TOTALS = """tot AS (SELECT unnest(['final_states', 'channels', 'values']) AS item, unnest([count(DISTINCT fs), count(*), coalesce(sum(entries), 0)])::BIGINT AS n FROM ch)"""


@query(
    "rep_mass",
    f"""WITH {CH}, {TIMES}, {_MASS_TOTALS}, p AS (SELECT {_LET} AS ptype, count(*) AS channels FROM (SELECT unnest({_TYPES}) AS x FROM ch) GROUP BY 1)
SELECT 'type' AS panel, ptype AS item, channels AS n, round(channels / (sum(channels) OVER ())::DOUBLE, 6) AS ratio FROM p UNION ALL SELECT 'size', len({_TYPES})::VARCHAR, count(*), NULL FROM ch GROUP BY 2
UNION ALL SELECT 'total', item, n, NULL FROM tot UNION ALL SELECT 'rate', item, n, round(CASE WHEN seconds > 0 THEN n / seconds ELSE 0 END, 6) FROM tot, st WHERE stage = 'mass_calc_time_sec'
UNION ALL SELECT 'top', substr(fs, 1, 20), n, NULL FROM (SELECT fs, sum(entries)::BIGINT AS n FROM ch GROUP BY fs ORDER BY n DESC, fs LIMIT 10)""",
)
def rep_mass(spark, d):
    """Totals, rates by the logged time, types' participation, channels' sizes, and the ten final states with most values."""
    ch = written(T.channels(X.array_values(spark, d)))
    none = F.lit(None).cast("double").alias("ratio")
    types = T.participation(ch).select(F.lit("type").alias("panel"), F.col("ptype").alias("item"), F.col("channels").alias("n"), F.round("share", 6).alias("ratio"))
    sizes = T.channel_sizes(ch).select(F.lit("size").alias("panel"), F.col("types").cast("string").alias("item"), F.col("channels").alias("n"), none)
    totals = T.long_form(T.mass_totals(ch)).select(F.lit("total").alias("panel"), F.col("metric").alias("item"), F.col("value").cast("long").alias("n"), none)
    seconds = T.stage_times(X.log_lines(spark, d)).filter("stage = 'mass_calc_time_sec'").select("seconds")  # one row
    rates = totals.join(F.broadcast(seconds), F.lit(True)).select(F.lit("rate").alias("panel"), "item", "n", F.round(L.rate(F.col("n").cast("double"), F.col("seconds")), 6).alias("ratio"))
    top = ch.groupBy("fs").agg(F.sum("entries").alias("n")).orderBy(F.desc("n"), "fs").limit(10).select(F.lit("top").alias("panel"), F.substring("fs", 1, 20).alias("item"), "n", none)
    return types.unionByName(sizes).unionByName(totals).unionByName(rates).unionByName(top)


_POST = "SELECT count(*) FILTER (signature LIKE '%\\_outliers' ESCAPE '\\')::BIGINT AS outlier_entries, count(DISTINCT (fs, im)) FILTER (signature LIKE '%\\_outliers' ESCAPE '\\')::BIGINT AS outlier_channels FROM (SELECT signature, " + f"{HQ._FS} AS fs, {HQ._IM} AS im FROM vals)"


@query(
    "rep_hist",
    f"""WITH {ENTRIES}, hs AS (SELECT {_HSTATS} FROM en), po AS ({_POST}), sp AS (SELECT * FROM (WITH {_spread_sql('en', 'entries', 30)}))
SELECT 'bin' AS panel, bin::VARCHAR AS item, n::DOUBLE AS value FROM sp UNION ALL SELECT 'top', fs, n::DOUBLE FROM (SELECT {_HFS} AS fs, count(*) AS n FROM en GROUP BY 1 ORDER BY n DESC, fs LIMIT 10)
UNION ALL SELECT 'total', unnest(['histograms', 'main_histograms', 'outlier_histograms', 'mean_entries', 'median_entries', 'main_share']), unnest([histograms::DOUBLE, main_histograms::DOUBLE, outlier_histograms::DOUBLE, mean_entries, median_entries, round(main_histograms / histograms::DOUBLE, 6)]) FROM hs
UNION ALL SELECT 'outliers', unnest(['outlier_entries', 'outlier_channels']), unnest([outlier_entries, outlier_channels])::DOUBLE FROM po""",
)
def rep_hist(spark, d):
    """Totals with the share of main histograms, what was split off, entries of a histogram in at most 30 bins, and the ten final states with most histograms."""
    en = written(entries(spark, d))
    panel = lambda df, name, item, value: df.select(F.lit(name).alias("panel"), F.col(item).cast("string").alias("item"), F.col(value).cast("double").alias("value"))
    stats = rounded(T.hist_stats(en).withColumn("main_share", L.rate(F.col("main_histograms").cast("double"), F.col("histograms"))), ["mean_entries", "main_share"]).drop("entries", "final_states")
    top = en.groupBy(T.hist_fs(F.col("hist_name")).alias("fs")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "fs").limit(10)
    split = T.long_form(T.post_stats(X.array_values(spark, d)).select("outlier_entries", "outlier_channels"))
    bins, totals = panel(T.spread(en, "entries", 30), "bin", "bin", "n"), panel(T.long_form(stats), "total", "metric", "value")
    return bins.unionByName(panel(top, "top", "fs", "n")).unionByName(totals).unionByName(panel(split, "outliers", "metric", "value"))


@query("rep_hist_totals", f"WITH {ENTRIES} {_unpivot(f'SELECT {_HSTATS} FROM en', ['histograms', 'main_histograms', 'outlier_histograms', 'entries', 'final_states', 'mean_entries', 'median_entries'])}")
def rep_hist_totals(spark, d):
    return T.long_form(hist_stats(spark, d))


# --- hooks -----------------------------------------------------------------------------------------------------------
@query("parse_observed", f"WITH {FILES} SELECT {_PARSE} FROM files")
def parse_observed(spark, d):
    """The statistics of parsing, counted while its results are written."""
    return rounded(T.written_observed(X.file_results(spark, d), scratch(spark, "results"), T.parse_metrics()), ROUNDED)


_SELECTED = f"({' AND '.join(f'c_{t} <= 4' for t in L.FS_ORDER)})"


@query("events_observed", f"WITH {EQ.SQL_C} SELECT count(*) AS events, count(*) FILTER ({_SELECTED}) AS kept, count(*) FILTER (NOT {_SELECTED}) AS cut, coalesce(sum(c_Jets) FILTER ({_SELECTED}), 0)::BIGINT AS jets FROM c")
def events_observed(spark, d):
    """Events that the cuts keep are written; how many there were, and what went, is counted on the way."""
    counted = EQ.M.with_counts(EQ.cut_events(spark, d))
    few = F.lit(True)
    for t in L.FS_ORDER:
        few = few & (F.col(f"c_{t}") <= 4)
    metrics = [F.count("*").alias("events"), F.count_if(few).alias("kept"), F.count_if(~few).alias("cut"), F.coalesce(F.sum(F.when(few, F.col("c_Jets"))), F.lit(0)).alias("jets")]
    return T.written_observed(counted, scratch(spark, "kept"), metrics, keep=few)


# --- sinks -----------------------------------------------------------------------------------------------------------
@query("sink_parsed_events", f"WITH {EQ.SQL_C} SELECT year(o_orderdate) || 'r-pp' AS release, count(*) AS events, sum(c_Jets)::BIGINT AS jets FROM c JOIN orders ON o_orderkey = event_id WHERE {' AND '.join(f'c_{t} <= 4' for t in L.FS_ORDER)} GROUP BY 1")
def sink_parsed_events(spark, d):
    """Selected events in a folder for each release, in files of limited rows, read back."""
    path = scratch(spark, "parsed")
    release = X.catalog(spark, d).select(F.col("pos").alias("event_id"), "release")
    EQ.S.event_selection(EQ.split_events(spark, d)).join(release, "event_id").write.partitionBy("release").option("maxRecordsPerFile", 50_000).parquet(path)
    return spark.read.parquet(path).groupBy("release").agg(F.count("*").alias("events"), F.sum(F.size("Jets")).alias("jets"))


_CAPPED = """WITH RECURSIVE f AS (SELECT year(o_orderdate)::INT AS year, floor(o_totalprice)::BIGINT AS bytes, row_number() OVER w AS i, (sum(floor(o_totalprice)::BIGINT) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT AS upto FROM orders WINDOW w AS (PARTITION BY year(o_orderdate) ORDER BY o_orderkey)),
nx AS (SELECT *, greatest(i, count(*) OVER (PARTITION BY year ORDER BY upto RANGE BETWEEN UNBOUNDED PRECEDING AND 1000000 - bytes FOLLOWING)) + 1 AS j FROM f),
s AS (SELECT year, i, j FROM nx WHERE i = 1 UNION ALL SELECT nx.year, nx.i, nx.j FROM s JOIN nx ON nx.year = s.year AND nx.i = s.j),
c AS (SELECT f.year, bytes, count(s.i) OVER (PARTITION BY f.year ORDER BY f.i) - 1 AS chunk FROM f LEFT JOIN s ON f.year = s.year AND f.i = s.i)
SELECT year, chunk, count(*) AS files, sum(bytes)::BIGINT AS bytes FROM c GROUP BY ALL"""


@query("sink_size_capped_chunks", _CAPPED)
def sink_size_capped_chunks(spark, d):
    """Files of each release in chunks of limited size, and what each chunk holds. A year is a release, an order is a file, its price the size."""
    sizes = X.table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("file"), F.floor("o_totalprice").cast("long").alias("bytes"))
    return capped(sizes, ["year"], ["file"], "bytes", 1_000_000).groupBy("year", "chunk").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


@query("capped_stream", _CAPPED)
def capped_stream_(spark, d):
    """The same over a stream of files of a bounded number of rows each: what a release's open chunk holds is state."""
    folder = scratch(spark, "capped")
    sizes = X.table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("file"), F.floor("o_totalprice").cast("long").alias("bytes"))
    # files are named in the order of their ranges, and a stream reads older ones first: each range is a batch
    write_in_order(sizes, ["file"], f"{folder}/source")
    stream = spark.readStream.schema(sizes.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/source/*")
    run = capped_stream(stream, "year", "file", "bytes", 1_000_000).writeStream.format("parquet").option("path", f"{folder}/chunks").option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/chunks").groupBy("year", "chunk").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
