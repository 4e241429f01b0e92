"""Near copies by the Jaccard similarity of word shingles: candidates by min-hash keys and SimHash tiles, each link checked on the whole sets of shingles.

Texts with equal sets are one node. Nodes that share a key of BAND min-hashes meet in a unit, where those whose SimHashes (of the sets, as repeats do not count in the similarity) differ in RADIUS bits at most are candidates. Keys take the place
of bit blocks, for at such a radius equal blocks have few bits and units would grow with the input. Nodes that candidates join make a group; only its members' sets are gathered,
and all its candidates are checked, save those whose ends are joined by checked links already. A group that is too large is split into pairs of tiles that go to different tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import cut, row_map
from peakframe.llm.components import components
from peakframe.llm.simhash import TILE, UNIT, shingle_hashes, simhash, tiled_links

WORDS, SIMILARITY, RADIUS = 5, 0.8, 28
#: Keys of a text and the min-hashes in each: two texts at the least similarity share no key once in 40,000 times.
BANDS, BAND = 20, 4
#: Rows that are broadcast to the documents; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
FACTORS = np.random.default_rng(7).integers(1 << 62, 1 << 63, BANDS * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """BANDS signed keys of a set of hashes; texts without words have the same ones."""
    least = np.full(BANDS * BAND, (1 << 64) - 1, dtype=np.uint64)
    for i in range(0, len(hashes), 512):
        np.minimum(least, (hashes[i : i + 512, None] * FACTORS).min(axis=0), out=least)
    keys = np.arange(BANDS, dtype=np.uint64)
    for c in least.reshape(BANDS, BAND).T:
        keys = mixed(keys ^ c)
    return keys.view(np.int64)


def node(hashes: np.ndarray) -> int:
    """A signed digest of a sorted set of hashes."""
    from xxhash import xxh64_intdigest

    x = xxh64_intdigest(hashes.tobytes())
    return x - (1 << 64) if x >> 63 else x


def nodes(df: DataFrame, text: str, keys: bool = False, sets: bool = False, words: int = WORDS) -> DataFrame:
    """df with node; with `keys`, also the SimHash and the keys of its set; with `sets`, also its set of shingle hashes (sorted, 8 bytes each). Null, empty and blank texts have the empty set."""

    def make():
        def f(values):
            unique = [np.unique(shingle_hashes(v or "", words)) for v in values]
            out = [[node(u) for u in unique]]
            if keys:
                out += [[simhash(u) for u in unique], [band_keys(u).tolist() for u in unique]]
            return out + ([[u.tobytes() for u in unique]] if sets else [])

        return f

    fields = [T.StructField("__node", T.LongType())]
    fields += [T.StructField("__print", T.LongType()), T.StructField("__keys", T.ArrayType(T.LongType()))] if keys else []
    return row_map(df, text, make, fields + ([T.StructField("__set", T.BinaryType())] if sets else []))


def by_unit(df: DataFrame, unit: str, columns: list[str], linked) -> DataFrame:
    """(a, b): what linked(table) gives, as positions in it, for the rows of each unit, as nodes; columns[0] is the node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def links():
            table = pa.Table.from_batches(held).combine_chunks()
            x = table.column(0).to_numpy()
            return [(x[i], x[j]) for i, j in linked(table)] if len(x) > 1 else []

        for batch in batches:  # rows come unit by unit
            marks, out = batch.column(len(columns)).to_numpy(), []
            edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and marks[a] != at:
                    out += links()
                    held = []
                at = marks[a]
                held.append(batch.slice(a, b - a))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])
        if held and (out := links()):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    return df.select(*columns, F.col(unit).alias("__unit")).repartition("__unit").sortWithinPartitions("__unit").mapInArrow(run, "a long, b long")


def dealt(df: DataFrame, group: list[str], most: int) -> DataFrame:
    """df with __unit: rows of a group are in one unit, or, of one with more than `most` rows, in a unit for each pair of its tiles that has theirs. Rows alone in their group are left out."""
    sized = df.join(df.groupBy(*group).agg(F.count("*").alias("__n")).filter("__n > 1"), group)
    tiles = F.ceil(F.col("__n") * 2 / most).cast("long")
    mine = F.pmod(F.xxhash64("__node"), tiles).cast("long")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), tiles - 1), lambda k: F.xxhash64(*group, F.least(k, mine), F.greatest(k, mine)))
    return sized.withColumn("__unit", F.explode(F.when(F.col("__n") > most, pairs).otherwise(F.array(F.xxhash64(*group))))).drop("__n")


def checked_links(prints: np.ndarray, keys: np.ndarray, sets: list[np.ndarray], radius: int, least: float) -> list[tuple[int, int]]:
    """Pairs of positions that span the components of all candidates (a key in common, SimHashes within the radius) whose sets have a Jaccard similarity of `least` or more."""
    label, links, n = list(range(len(sets))), [], np.array([len(s) for s in sets])

    def find(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(0, len(sets), TILE):
        for j in range(i, len(sets), TILE):
            a, b = np.nonzero(np.bitwise_count(prints[i : i + TILE, None] ^ prints[None, j : j + TILE]) <= radius)
            a, b = a + i, b + j
            near = (a < b) & (np.minimum(n[a], n[b]) >= least * np.maximum(n[a], n[b]))
            a, b = a[near], b[near]
            near = (keys[a] == keys[b]).any(axis=1)
            for p, q in zip(a[near].tolist(), b[near].tolist(), strict=True):
                if (r := find(p)) == (s := find(q)):
                    continue
                both = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
                if both >= least * (n[p] + n[q] - both):
                    label[max(r, s)] = min(r, s)
                    links.append((p, q))
    return links


def near_roots(docs: DataFrame, prints: DataFrame, id_col: str, text: str, words: int = WORDS, radius: int = RADIUS, least: float = SIMILARITY, unit: int = UNIT) -> DataFrame:
    """(node, root): the least node that each node of `prints` (a row for each __node and __print, with __keys and the __first id; checkpointed) with a near copy reaches by links of `least` similarity or more."""
    keyed = prints.select("__node", "__print", F.posexplode("__keys").alias("__choice", "__key"))
    near = by_unit(dealt(keyed, ["__choice", "__key"], unit), "__unit", ["__node", "__print"], lambda t: tiled_links(t.column(1).to_numpy().view(np.uint64), radius))
    groups = cut(components(near, "a", "b"))
    ids = cut(prints.join(groups, prints["__node"] == groups["node"], "left_semi").groupBy("__node").agg(F.min("__first").alias("f")).select(F.col("f.id").alias("__id")).distinct())
    small = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    own = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    members = nodes(own.join(F.broadcast(ids) if small else ids, own["__id"].eqNullSafe(ids["__id"]), "left_semi").drop("__id"), "__text", True, True, words)
    # other texts of the same id come along: the join keeps those of the groups, and each node once
    grouped = cut(members.join(groups, members["__node"] == groups["node"]).drop("node").dropDuplicates(["__node", "__print"]))

    def linked(t: pa.Table):
        keys = np.array(t.column(2).to_pylist(), dtype=np.int64).reshape(-1, BANDS)
        return checked_links(t.column(1).to_numpy().view(np.uint64), keys, [np.frombuffer(s, dtype=np.uint64) for s in t.column(3).to_pylist()], radius, least)

    return components(by_unit(dealt(grouped, ["root"], max(2, unit // 4)), "__unit", ["__node", "__print", "__keys", "__set"], linked), "a", "b")


def one_of_each(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = WORDS, radius: int = RADIUS, least: float = SIMILARITY, unit: int = UNIT) -> DataFrame:
    """The rows of docs without near copies: of each component the row of the smallest id stays (of equal ids, the least node; of repeated rows, one). Null ids come last.

    Texts are hashed again rather than stored; only the rows that may stay, and the sets of those with near copies, are shuffled.
    """
    printed = nodes(docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").alias("__text")), "__text", True, words=words).drop("__text")
    # copies are combined here, before anything is joined
    earliest = F.min(F.struct(F.col("__id").isNull().alias("void"), F.col("__id").alias("id"))).alias("__first")
    prints = cut(printed.groupBy("__node", "__print").agg(F.first("__keys").alias("__keys"), earliest))
    roots = near_roots(docs, prints, id_col, text, words, radius, least, unit)
    rooted = prints.select("__first", "__node").join(roots, prints["__node"] == roots["node"], "left").withColumn("root", F.coalesce("root", "__node"))
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("__first.void").alias("void"), F.col("__first.id").alias("id"), F.col("__node").alias("kept"))).alias("k")).select("k.id", "k.kept")
    marked = nodes(docs, text, words=words)
    kept = marked.join(first, marked[id_col].eqNullSafe(first["id"]) & (marked["__node"] == first["kept"]), "left_semi")
    return kept.dropDuplicates([id_col, "__node"]).drop("__node")
