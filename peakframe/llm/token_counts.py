"""Token counts through a cache: normalised content and tokenizer digests are joined to stored counts, and only distinct misses are encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import cut, documents, joined_evenly, row_map, scratch
from peakframe.llm.words import tokenizer, version

TOKENIZER, LIMIT = "word_bpe_49k.json", 2048
#: Misses (a row of 60 bytes each) that are broadcast to the texts; beyond it texts are shuffled by digest and id.
FEW = 10_000
#: Setting of the session with the path of the lasting cache.
CACHE_SETTING = "spark.peakframe.tokenCache"
CACHE = T.StructType([T.StructField("content", T.BinaryType()), T.StructField("tokenizer", T.StringType()), T.StructField("n_tokens", T.LongType())])


def content_digest(text: Column, collapse: bool) -> Column:
    """Digest of the text; with `collapse`, for tokenizers that drop white space, runs of ASCII blanks count as one space."""
    form = F.trim(F.regexp_replace(text, "[ \t\r\n]+", " ")) if collapse else text
    return F.unhex(F.sha2(form, 256))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """Stored counts, a row for each key though appends may have met; empty where there is no cache yet."""
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE)
    return stored.groupBy("content", "tokenizer").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(df: DataFrame, cache: str, text: str = "text", name: str = TOKENIZER, limit: int = LIMIT, id_col: str = "doc_id") -> DataFrame:
    """df without its text but with n_bytes, n_tokens and over_limit; counts come from the cache at path `cache`, to which misses are appended.

    Null and empty texts have no tokens. Of all rows of a text that the cache lacks, that of the smallest id stands for it: digests alone are combined (before the shuffle), joined to the cache and
    to the rows again, by digest and id, so that copies of one text are not gathered; only the standing rows are encoded. Null ids are an id; rows that agree in text and id may be encoded each.
    An empty df gives no rows. Columns with the new names are replaced.
    """
    spark = df.sparkSession
    by = version(public_tokenizers.path(name) if "/" not in name else name)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = content_digest(body, collapse=tokenizer(name).__dict__.get("by_word", False))
    ref = F.xxhash64(F.col(f"`{id_col}`"))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    keyed = cut(df.select(*kept, F.octet_length(body).cast("long").alias("n_bytes"), digest.alias("__content"), ref.alias("__ref")))
    cached = read_cache(spark, cache).filter(F.col("tokenizer") == by)
    missing = keyed.groupBy(F.col("__content").alias("content")).agg(F.min("__ref").alias("ref")).join(cached, "content", "left_anti")
    missing = cut(missing)
    few = missing.limit(FEW + 1).count()
    if few:
        rows = df.select(digest.alias("content"), ref.alias("ref"), body.alias("body")).join(F.broadcast(missing) if few <= FEW else missing.hint("shuffle_hash"), ["content", "ref"], "left_semi")

        def make():
            t = tokenizer(name)
            return lambda values: [[len(x) // 4 for x in t.encode(values)]]

        counted = row_map(rows.select("content", "body"), "body", make, [T.StructField("n_tokens", T.LongType())], memo=True)
        counted.select("content", F.lit(by).alias("tokenizer"), "n_tokens").dropDuplicates(["content"]).write.mode("append").parquet(cache)
    stored = read_cache(spark, cache).filter(F.col("tokenizer") == by).select(F.col("content").alias("__content"), F.col("n_tokens").alias("__n"))
    return joined_evenly(keyed, stored, "__content").select(*kept, "n_bytes", F.col("__n").alias("n_tokens"), (F.col("__n") > limit).alias("over_limit"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document. Null and empty texts have no tokens; repeated rows each keep their row; texts count whole.

    Counts are kept at the path in the setting CACHE_SETTING, where later runs find them; where it is unset, in a new folder, so that a run does all its work.
    """
    return count_tokens(documents(spark, sf_dir).select("doc_id", "text"), spark.conf.get(CACHE_SETTING, None) or scratch(spark, "token-counts"))
