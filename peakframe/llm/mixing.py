"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

The whole part of a source's ratio of target to size is the number of certain copies of each of its documents. For the words still lacking, documents have inclusion probabilities in
proportion to their size, 1 at most; those at 1 are certain too. The others are ranked by random odds divided by inclusion odds, and in that order taken whole until the lacking words
are reached, as nearly as whole documents can. The sample is thus of fixed size in words. A source's last rank is all that rows need to know, so no row is shuffled with its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peakframe.llm.common import cut, documents

WEIGHTS, SHARE, MOST, SEED = (5, 2, 1), 1.5, 2.0, "mix-1"
#: Steps of the logarithm of the ranking key, by which sums are made: one step holds less than a ten-thousandth of a source's ranked documents.
STEPS = 1 << 12
#: Values of a step or a size that are summed in one window; the windows' own sums come after.
SPAN = 1 << 8
#: Sources (a row of 60 bytes each) that are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 100_000
BLANK = "\\x20\\x09-\\x0D"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANK}]+")), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of a digest: the same on every run."""
    return (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sources (source, source_size) with target: `share` of all sizes by weight (given to sources in code point order, null last), each at most `most` of its size.

    What the bounds leave over is shared by weight again until none is above: a source is at its bound exactly if the common level, at its own bound per weight, costs no more than there is.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(place, F.lit(len(weights))).cast("int") + 1)
    base = sources.withColumn("w", w).withColumn("bound", F.col("source_size") * F.lit(most)).withColumn("level", F.col("bound") / F.col("w"))
    all_, upto = Window.partitionBy(), Window.orderBy("level")  # ties of the level stand together
    base = base.withColumn("total", F.sum("source_size").over(all_) * F.lit(share)).withColumn("at", F.sum("bound").over(upto) + F.col("level") * (F.sum("w").over(all_) - F.sum("w").over(upto)))
    base = base.withColumn("full", F.col("at") <= F.col("total"))
    spent, free = F.sum(F.when(F.col("full"), F.col("bound")).otherwise(0.0)).over(all_), F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(all_)
    return base.withColumn("target", F.when(F.col("full"), F.col("bound")).otherwise(F.col("w") * F.try_divide(F.col("total") - spent, free))).select("source", "source_size", "target")


def chance(size: Column, rate: Column) -> Column:
    """Inclusion probability beyond the certain copies."""
    return F.least(F.coalesce(rate * size, F.lit(1.0)), F.lit(1.0))


def order_key(id_: Column, size: Column, rate: Column, seed: str) -> Column:
    """Random odds divided by inclusion odds; null for documents that aren't ranked: certain ones, empty ones and those with no chance."""
    u, p = uniform(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), size.cast("string")), seed), chance(size, rate)
    return F.when((p > 0) & (p < 1), u / (1 - u) * F.try_divide(1 - p, p))


def step_of(key: Column) -> Column:
    return F.floor(F.log(key) * STEPS)


def _rows(df: DataFrame, size: str, source: str, id_col: str) -> DataFrame:
    return df.select(F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`")), F.lit("")).alias("__s"), F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("long").alias("__n"), F.col(f"`{id_col}`").alias("__id"))


def hinted(goals: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(goals) if goals.limit(most + 1).count() <= most else goals


def running(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """df (checkpointed; __s, a whole number `order` and others) with before_{c}: the sum of column c over its source's rows of less `order`. Windows hold SPAN values at most, or a row for each span."""
    spans = df.groupBy("__s", F.floor(F.col(order) / SPAN).alias("__g")).agg(*[F.sum(c).alias(c) for c in columns])
    before = lambda c, *by: F.coalesce(F.sum(c).over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = spans.select("__s", "__g", *[before(c, "__s", "__g").alias(f"start_{c}") for c in columns])
    inside = df.withColumn("__g", F.floor(F.col(order) / SPAN)).withColumns({f"in_{c}": before(c, "__s", "__g", order) for c in columns})
    return inside.join(starts, ["__s", "__g"]).select(*df.columns, *[(F.col(f"start_{c}") + F.col(f"in_{c}")).alias(f"before_{c}") for c in columns])


def plan(sizes: DataFrame, size: str, source: str = "source", id_col: str = "doc_id", weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """A row for each source: __s, source_size, target, __whole (certain copies of each document), __rate (inclusion probability for a word), and __step and __last: taken are the
    keys of steps before __step, and those up to __last.

    sizes is read several times: pass a written or checkpointed table. Rows are summed by (source, size) and by (source, step of the key) before any window; the only rows that meet in one
    task are those of a source's step in which its lacking words are reached. Documents whose keys agree (equal id and size) are taken together.
    """
    rows = _rows(sizes, size, source, id_col)
    by_size = cut(rows.groupBy("__s", "__n").agg(F.count("*").alias("k")))
    total = by_size.groupBy("__s").agg(F.sum(F.col("__n") * F.col("k")).alias("source_size"))
    names = F.when(F.col("__s") != "", F.substring("__s", 2, 2**31 - 1))
    goals = targets(total.select(names.alias("source"), "source_size"), weights, share, most)
    goals = goals.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("__s"), "source_size", "target", F.coalesce(F.least(F.floor(F.try_divide("target", "source_size")), F.lit(int(most))), F.lit(0)).alias("__whole"))
    goals = cut(goals.withColumn("__lack", F.coalesce(F.floor(F.col("target") + 0.5), F.lit(0)) - F.col("__whole") * F.col("source_size")))
    # the rate at which documents up to this size have less than 1 and all greater ones are certain; the right one is that of the greatest size that it leaves below 1
    words = F.col("__n") * F.col("k")
    summed = cut(by_size.filter("__n > 0").select("__s", "__n", words.alias("words"), (F.col("__n").cast("decimal(19,0)") * words).cast("decimal(38,0)").alias("square")))
    tried = running(summed, "__n", ["words", "square"]).join(hinted(goals.select("__s", "source_size", "__lack")), "__s")
    above = F.col("source_size") - F.col("before_words") - F.col("words")
    tried = tried.withColumn("rate", F.greatest(F.col("__lack") - above, F.lit(0)).cast("double") / (F.col("before_square") + F.col("square")).cast("double"))
    rates = tried.filter(F.col("rate") * F.col("__n") < 1).groupBy("__s").agg(F.max_by("rate", "__n").alias("__rate"))
    goals = cut(goals.join(rates, "__s", "left"))
    sure = by_size.join(hinted(goals.select("__s", "__rate")), "__s").filter(chance(F.col("__n"), F.col("__rate")) >= 1).groupBy("__s").agg(F.sum(words).alias("sure"))
    ranked = rows.join(hinted(goals.select("__s", "__rate")), "__s").select("__s", "__n", order_key(F.col("__id"), F.col("__n"), F.col("__rate"), seed).alias("key")).filter("key is not null")
    ranked = cut(ranked.withColumn("step", step_of(F.col("key"))))
    lack = cut(goals.join(sure, "__s", "left").select("__s", (F.col("__lack") - F.coalesce("sure", F.lit(0))).alias("lack")))
    steps = running(cut(ranked.groupBy("__s", "step").agg(F.sum("__n").alias("words"))), "step", ["words"]).withColumnRenamed("before_words", "before")
    met = cut(steps.join(hinted(lack), "__s").filter((F.col("before") < F.col("lack")) & (F.col("lack") <= F.col("before") + F.col("words"))).select("__s", "step", "before", "lack"))
    near = ranked.join(hinted(met), ["__s", "step"]).groupBy("__s", "key", "before", "lack").agg(F.sum("__n").alias("words"))
    reached = F.col("before") + F.sum("words").over(Window.partitionBy("__s").orderBy("key"))
    last = near.withColumn("reached", reached).filter(2 * F.col("reached") - F.col("words") <= 2 * F.col("lack")).groupBy("__s").agg(F.max("key").alias("__last"))
    found = goals.join(lack, "__s").join(met.select("__s", "step"), "__s", "left").join(last, "__s", "left")
    # of a source that lacks more than its ranked documents have, all steps are taken
    return cut(found.select("__s", "source_size", "target", "__whole", "__rate", F.coalesce("step", F.when(F.col("lack") > 0, F.lit(1 << 40))).alias("__step"), "__last"))


def mix(df: DataFrame, size: str, source: str = "source", id_col: str = "doc_id", weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED, sizes: DataFrame | None = None) -> DataFrame:
    """df with source_size, target (of the row's source) and taken (its words in the mix, repeats counted: a multiple of its size, `most` times at most).

    Null sources are one source; null sizes count as 0; null ids are an id. Rows of equal id and size share their random number and are taken together, repeated rows too; others that
    share an id don't. An empty df gives no rows. Columns with the new names are replaced. Texts of any length may be in df: its rows aren't shuffled unless there are more than
    BROADCAST_ROWS sources. `sizes`, df's own size, source and id columns, written, spares their being computed several times.
    """
    new = ["source_size", "target", "taken"]
    goals = hinted(plan(cut(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys((size, source, id_col))])) if sizes is None else sizes, size, source, id_col, weights, share, most, seed))
    kept = df.drop(*new)
    n = F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("long")
    joined = kept.withColumns({"__s": F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`")), F.lit("")), "__n": n}).join(goals, "__s")
    key = order_key(F.col(f"`{id_col}`"), F.col("__n"), F.col("__rate"), seed)
    more = (chance(F.col("__n"), F.col("__rate")) >= 1) | F.coalesce(step_of(key) < F.col("__step"), F.lit(False)) | F.coalesce(key <= F.col("__last"), F.lit(False))
    taken = F.when(F.col("__n") > 0, (F.col("__whole") + F.when(more, 1).otherwise(0)) * F.col("__n")).otherwise(0).cast("long")
    return joined.withColumn("taken", taken).select(*[F.col(f"`{c}`") for c in kept.columns], *new)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, columns as they were: one row for each copy. Documents without words aren't in it; else nulls, ties and repeated rows are as in mix."""
    size, own = n_words(F.col("text")).alias("__size"), {c: f"__own{i}" for i, c in enumerate(docs.columns)}  # no name of docs clashes with those of the mix
    sizes = cut(docs.select(F.col("doc_id").alias(own["doc_id"]), F.col("source").alias(own["source"]), size))
    taken = mix(docs.select(*[F.col(f"`{c}`").alias(x) for c, x in own.items()], size), "__size", own["source"], own["doc_id"], sizes=sizes)
    copies = F.when(F.col("__size") > 0, F.floor(F.col("taken") / F.col("__size"))).otherwise(0).cast("int")
    return taken.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*[F.col(x).alias(c) for c, x in own.items()])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document. Null and empty texts have size 0 and nothing is taken of them; null sources are one source; see mix for ties and repeated rows."""
    sized = cut(documents(spark, sf_dir).select("doc_id", "source", n_words(F.col("text")).alias("size")))
    return mix(sized, "size", sizes=sized).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, source_size * 2.0::DOUBLE AS bound FROM s),
l AS (SELECT *, bound / w AS level FROM w),
a AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total,
             sum(bound) OVER (ORDER BY level) + level * (sum(w) OVER () - sum(w) OVER (ORDER BY level)) AS at_ FROM l),
t AS (SELECT source, source_size,
             CASE WHEN at_ <= total THEN bound
                  ELSE w * ((total - sum(CASE WHEN at_ <= total THEN bound ELSE 0 END) OVER ()) / sum(CASE WHEN at_ <= total THEN 0 ELSE w END) OVER ()) END AS target FROM a),
g AS (SELECT *, coalesce(least(floor(target / nullif(source_size, 0)), 2), 0)::BIGINT AS whole FROM t),
q AS (SELECT *, (coalesce(floor(target + 0.5), 0) - whole * source_size)::BIGINT AS lack FROM g),
z AS (SELECT d.source, d.size, q.lack, count(*) AS k FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source WHERE d.size > 0 GROUP BY ALL),
y AS (SELECT source, size, greatest(lack - (sum(size * k) OVER (PARTITION BY source ORDER BY size DESC) - size * k), 0)::DOUBLE
             / (sum(size::HUGEINT * size * k) OVER (PARTITION BY source ORDER BY size))::DOUBLE AS rate FROM z),
r AS (SELECT source, arg_max(rate, size) AS rate FROM y WHERE rate * size < 1 GROUP BY source),
j AS (SELECT d.*, q.source_size, q.target, q.whole, q.lack, least(coalesce(r.rate * d.size, 1.0::DOUBLE), 1.0::DOUBLE) AS p,
             (('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '') || ':' || d.size::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN r ON d.source IS NOT DISTINCT FROM r.source),
o AS (SELECT *, CASE WHEN p > 0 AND p < 1 THEN u / (1 - u) * ((1 - p) / p) END AS key, lack - sum(CASE WHEN p >= 1 THEN size ELSE 0 END) OVER (PARTITION BY source) AS rest FROM j),
e AS (SELECT *, sum(CASE WHEN key IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY key NULLS LAST) AS reached, sum(size) OVER (PARTITION BY source, key) AS words FROM o)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0 THEN (whole + CASE WHEN p >= 1 OR (key IS NOT NULL AND rest > 0 AND 2 * reached - words <= 2 * rest) THEN 1 ELSE 0 END) * size ELSE 0 END::BIGINT AS taken
FROM e
"""
