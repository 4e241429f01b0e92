"""Packed arrays of values: rows id, signature, n_entries, payload."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakframe.operators.ordering import placed

#: Values that one chunk holds at most, so that no signature, however common, becomes one row.
CHUNK = 100_000
#: Bytes of a row group of stored chunks: what a lookup reads at least.
GROUP_BYTES = 8 << 20
#: Distinct signatures to a row group that its Bloom filter is made for.
GROUP_SIGNATURES = 10_000


def pack(values: DataFrame, keys: list[str], chunk: int = CHUNK) -> DataFrame:
    """Values of each key in ascending arrays with their number, at most about `chunk` to an array; keys without values have none.

    A common key is dealt to several arrays by a digest of the value; its number is counted first.
    """
    values = values.filter("m is not null")
    sizes = values.groupBy(*keys).agg(F.ceil(F.count("*") / chunk).alias("__parts"))
    dealt = values.join(sizes, keys).withColumn("part", F.pmod(F.xxhash64("m"), "__parts"))
    return dealt.groupBy(*keys, "part").agg(F.count("*").alias("n_entries"), F.sort_array(F.collect_list("m")).alias("payload"))


def unpack(chunks: DataFrame) -> DataFrame:
    """One row for each value; empty arrays have none."""
    return chunks.filter(F.size("payload") > 0).select(*[c for c in chunks.columns if c not in ("payload", "n_entries")], F.explode("payload").alias("m"))


def with_ids(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Ids from 1 in the order of the keys."""
    return placed(chunks, keys, "__place").withColumn("id", F.col("__place") + 1).drop("__place")


def store(chunks: DataFrame, path: str, key: str = "signature", group_bytes: int = GROUP_BYTES, files: int | None = None) -> None:
    """Writes chunks so that a lookup by key reads little: in ranges of the key, each sorted, in small row groups with the key's bounds and a Bloom filter of its values.

    A key with more chunks than others is cut by the parts' numbers, so no range grows with it. `files` is the number of ranges; by default Spark sizes them.
    """
    order = [key, *[c for c in ("shard", "part", "id") if c in chunks.columns]]
    ranged = chunks.repartitionByRange(files, *order) if files else chunks.repartitionByRange(*order)
    options = {"parquet.block.size": group_bytes, f"parquet.bloom.filter.enabled#{key}": True, f"parquet.bloom.filter.expected.ndv#{key}": GROUP_SIGNATURES, "parquet.page.size": 1 << 16, "parquet.page.size.row.check.min": 10, "parquet.block.size.row.check.min": 10, "parquet.enable.dictionary": False}
    ranged.sortWithinPartitions(*order).write.options(**{k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}).parquet(path)


def lookup(spark: SparkSession, path: str, keys: Iterable[str] | None = None, prefix: str | None = None, key: str = "signature") -> DataFrame:
    """Stored chunks of some keys, or of those that begin with a prefix. The predicate goes down to the row groups: bounds rule out those of other ranges, Bloom filters those between without the key.

    Each of several keys is asked for by an equality, as only these use the filters.
    """
    found = spark.read.parquet(path)
    if prefix is not None:
        found = found.filter(F.startswith(F.col(key), F.lit(prefix)))
    if keys is not None:
        wanted = F.lit(False)
        for k in keys:
            wanted = wanted | (F.col(key) == k)
        found = found.filter(wanted)
    return found
