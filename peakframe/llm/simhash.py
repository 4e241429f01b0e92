"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared exactly in tiles with numpy.

Distinct fingerprints that share enough bit blocks meet in a unit (if at most r bits differ, m - r of m blocks are equal); m grows with their number so that units stay small.
In a unit, tiles in order of population count are compared by exclusive-or and bit counts; pairs of tiles whose counts differ by more than r are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import cut, documents, joined_evenly, row_map
from peakframe.llm.components import components

WORDS, RADIUS, SEED = 4, 4, 42
#: Rows of a tile in numpy, and most rows of a unit; a larger one is split into pairs of tiles that go to different tasks.
TILE, UNIT = 256, 4096


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """XXH64 of each shingle of `words` words, repeats included; one of the whole sequence where there are fewer, none where there are no words. Only A-Z is lowered."""
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: 1 - words or None].tolist()
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)], dtype=np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint", words: int = WORDS) -> DataFrame:
    """df with a signed 64-bit SimHash of `text` in `out` (replaced if there); null, empty and blank texts have 0. Equal texts have equal fingerprints. Whole texts count."""

    def make():
        return lambda values: [[simhash(shingle_hashes(v or "", words)) for v in values]]

    return row_map(df, text, make, [T.StructField(out, T.LongType())])


def tiled_links(x: np.ndarray, radius: int, tile: int = TILE) -> list[tuple[int, int]]:
    """Pairs of positions in x (unsigned 64-bit) that span the same components as all pairs within the radius."""
    count = np.bitwise_count(x).astype(np.int16)
    order = np.argsort(count, kind="stable")
    x, count, label, links = x[order], count[order], list(range(len(x))), []

    def find(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(0, len(x), tile):
        for j in range(i, len(x), tile):
            if count[j] - count[min(i + tile, len(x)) - 1] > radius:
                break
            a, b = np.nonzero(np.bitwise_count(x[i : i + tile, None] ^ x[None, j : j + tile]) <= radius)
            keep = a + i < b + j
            if not keep.any():
                continue
            a, b = (a[keep] + i).tolist(), (b[keep] + j).tolist()
            for p, q in zip(a, b, strict=True):
                r, s = find(p), find(q)
                if r != s:
                    label[max(r, s)] = min(r, s)
                    links.append((int(order[p]), int(order[q])))
    return links


def blocks_for(n: int, radius: int, unit: int = UNIT) -> int:
    """The least number of bit blocks at which an even spread of n fingerprints has units of a quarter of `unit` rows at most."""
    m = radius + 1
    while m < 12 and n / 2 ** (64 * (m - radius) / m) > unit / 4:
        m += 1
    return m


def block_masks(m: int, keep: int) -> list[int]:
    """Signed masks of each choice of `keep` of m bit blocks."""
    edges = [round(64 * i / m) for i in range(m + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    whole = [sum(c) for c in combinations(blocks, keep)]
    return [x - (1 << 64) if x >> 63 else x for x in whole]


def near_links(prints: DataFrame, radius: int = RADIUS, unit: int = UNIT, blocks: int | None = None) -> DataFrame:
    """(a, b, a_id, b_id): links that span the components of all pairs of `prints` (distinct longs in column fingerprint, and a long id of each) within `radius` bits. Pass a written or checkpointed table.

    In each unit only spanning links come out, at most one a row, so thousands of near copies do not make millions of pairs; no link between components is lost.
    """
    m = blocks or blocks_for(prints.count(), radius, unit)
    masks = block_masks(m, m - radius)
    fp = F.col("fingerprint")
    keyed = prints.select(fp, "id", F.bit_count(fp).alias("ones"), F.posexplode(F.array(*[fp.bitwiseAND(F.lit(x).cast("long")) for x in masks])).alias("choice", "key"))
    size = keyed.groupBy("choice", "key", "ones").agg(F.count("*").alias("n"))
    large = cut(size.groupBy("choice", "key").agg(F.sum("n").alias("n"), F.collect_list(F.struct("ones", F.ceil(F.col("n") * 2 / unit).alias("parts"))).alias("tiles")).filter(F.col("n") > unit).drop("n"))
    if large.isEmpty():
        dealt = keyed.select("fingerprint", "id", F.xxhash64("choice", "key").alias("unit"))
    else:
        # a unit that is too large: tiles of one population count each; a row goes to every pair of tiles within the radius that its own tile is part of
        joined = keyed.join(large, ["choice", "key"], "left")
        mine = F.filter("tiles", lambda t: t["ones"] == F.col("ones"))[0]["parts"]
        tile = F.struct(F.col("ones").cast("long").alias("ones"), F.pmod(F.xxhash64(fp), mine).cast("long").alias("part"))
        near = F.filter("tiles", lambda t: F.abs(t["ones"] - F.col("ones")) <= radius)
        others = F.flatten(F.transform(near, lambda t: F.transform(F.sequence(F.lit(0).cast("long"), t["parts"] - 1), lambda k: F.struct(t["ones"].cast("long").alias("ones"), k.alias("part")))))
        pairs = F.transform(others, lambda o: F.xxhash64("choice", "key", F.least(o, F.col("tile")), F.greatest(o, F.col("tile"))))
        units = F.when(F.col("tiles").isNull(), F.array(F.xxhash64("choice", "key"))).otherwise(pairs)
        dealt = joined.withColumn("tile", F.when(F.col("tiles").isNotNull(), tile)).select("fingerprint", "id", F.explode(units).alias("unit"))

    names = ["a", "b", "a_id", "b_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def linked() -> list[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            x = table.column(0).to_numpy()
            links = tiled_links(x.view(np.uint64), radius) if len(x) > 1 else []
            if not links:
                return []
            i, j = np.array(links).T
            return [pa.RecordBatch.from_arrays([pa.array(x[i]), pa.array(x[j]), *(table.column(1).take(pa.array(k)).combine_chunks() for k in (i, j))], names=names)]

        for batch in batches:  # rows come unit by unit
            marks = batch.column(2).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and marks[a] != at:
                    yield from linked()
                    held = []
                at = marks[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from linked()

    return dealt.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long, a_id long, b_id long")


def near_components(printed: DataFrame, id_col: str = "doc_id", radius: int = RADIUS, unit: int = UNIT) -> DataFrame:
    """(fingerprint, root, component_id) for each distinct fingerprint of `printed`: component_id is the smallest id of any fingerprint that it reaches by steps of at most `radius` bits, root is one that has it.

    Nodes are (id is null, smallest id, fingerprint), so the least node of a component has its id and nothing is gathered by component. Null ids count only where there is no other.
    """
    first = cut(printed.groupBy("fingerprint").agg(F.min(id_col).cast("long").alias("id")))
    node = lambda fp, id_: F.struct(F.col(id_).isNull().alias("void"), F.col(id_).alias("id"), F.col(fp).alias("print"))
    links = near_links(first, radius, unit).select(node("a", "a_id").alias("u"), node("b", "b_id").alias("v"))
    roots = components(links, "u", "v").select(F.col("node.print").alias("fingerprint"), "root")
    linked = first.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", node("fingerprint", "id")))
    return linked.select("fingerprint", F.col("root.print").alias("root"), F.col("root.id").alias("component_id"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document. Null, empty and blank texts have fingerprint 0, which links like any other; equal texts have equal fingerprints; repeated rows each keep their row."""
    printed = cut(fingerprints(documents(spark, sf_dir).select("doc_id", "text")))
    found = joined_evenly(printed, cut(near_components(printed).drop("root")), "fingerprint")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
