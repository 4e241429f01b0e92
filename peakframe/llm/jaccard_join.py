"""Jaccard join of documents as a metric-space join: pivots, Voronoi regions, windows by the triangle inequality, recursion.

The Jaccard distance of two documents that share nothing is 1, so among unrelated documents no pivot tells one from another. Spaces are therefore opened first, exactly: two sets at the least
similarity differ in at most D shingles, so of D + 1 slices of the hash range one is equal in both. Documents that equal slices join make a space. In a space, pivots are chosen; a document belongs
to the region of its nearest pivot, and is replicated to each other region whose pivot is no more than twice the radius farther (a partner of it may be there). Regions are joined in the same way
until they are small, or no longer fall apart. Documents within the radius of a pivot are linked to it, so those of one linked class need no comparison with each other. Every link is of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import cut, documents, joined_evenly, row_map, scratch, ship
from peakframe.llm.components import components
from peakframe.llm.near_copies import mixed, node
from peakframe.llm.simhash import shingle_hashes

#: Words of a shingle, and least similarity in percent.
WORDS, PERCENT = 3, 90
#: Sizes of sets go in bands, each this much wider than the one before; a set meets others in its band and, if a partner may be there, in the next.
WIDER = 1.3
#: Pivots of a region, and documents of a region that are compared without pivots.
PIVOTS, LEAF = 16, 24
#: What a task holds of a region at once: shingles, each document counting as some more.
UNIT, EACH = 1_500_000, 1500
#: A region is split while its parts are at most this share of it, and together at most so many times it.
LARGEST, TOGETHER = 0.8, 2.0
#: Rows that are broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 500_000


def band_edges(percent: int, most: int = 1 << 40) -> np.ndarray:
    """The least size of each band. The first is of the smallest set that is near another one."""
    edges = [-(-percent // (100 - percent))]
    while edges[-1] < most:
        edges.append(max(edges[-1] + 2, int(edges[-1] * max(WIDER, 1.1 * 100 / percent))))
    return np.array(edges)


EDGES = {PERCENT: band_edges(PERCENT)}


def slices_of(least_above: int, percent: int) -> tuple[int, int]:
    """(slices, spare) of a band whose sets are smaller than `least_above`: near sets are equal in more than `spare` slices."""
    differ = 2 * (least_above - 1) * (100 - percent) // (100 + percent)
    spare = 2 + differ // 256
    return differ + 1 + spare, spare


def slice_keys(hashes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signed keys of a sorted set of hashes: two sets of at least the similarity, not equal, have one in common.

    A band's slices are parts of the hash range. Empty slices get no key, unless a set has more of them than slices are spare.
    """
    edges = EDGES.get(percent) if percent in EDGES else EDGES.setdefault(percent, band_edges(percent))
    n = len(hashes)
    own = int(np.searchsorted(edges, n, side="right")) - 1
    bands = [own] if own >= 0 else []
    if n * 100 // percent >= edges[own + 1]:
        bands.append(own + 1)  # a larger partner may be there
    sums, keys = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed(hashes), dtype=np.uint64)]), []
    for band in bands:
        m, spare = slices_of(int(edges[band + 1]), percent)
        starts = (np.arange(m, dtype=np.float64) * 2.0**64 / m).astype(np.uint64)
        at = np.append(np.searchsorted(hashes, starts), n)
        x = mixed(sums[at[1:]] - sums[at[:-1]] + mixed(starts ^ np.uint64(band + 1)))
        full = at[1:] > at[:-1]
        keys.append(x[full] if m - full.sum() <= spare else x)
    return np.concatenate(keys).view(np.int64) if keys else np.empty(0, dtype=np.int64)


def hashed(df: DataFrame, text: str, words: int, percent: int, keys: bool) -> DataFrame:
    """df without `text`, with __node and __n of its set of shingles, and its __keys or, else, its __set (sorted, 8 bytes each)."""

    def make():
        def f(values):
            sets = [np.unique(shingle_hashes(v or "", words)) for v in values]
            return [[node(s) for s in sets], [len(s) for s in sets], [slice_keys(s, percent) for s in sets] if keys else [s.tobytes() for s in sets]]

        return f

    fields = [T.StructField("__node", T.LongType()), T.StructField("__n", T.LongType()), T.StructField("__keys", T.ArrayType(T.LongType())) if keys else T.StructField("__set", T.BinaryType())]
    return row_map(df, text, make, fields).drop(text)


class Space:
    """Sets of a unit. Distances from one of them to many are found in one pass over their shingles, which are numbered."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.n, self.percent, self.links = np.array([len(s) for s in sets], dtype=np.int64), percent, []
        self.starts = np.concatenate([[0], np.cumsum(self.n)])
        values, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat, self.mark = flat.astype(np.int32), np.zeros(len(values), dtype=bool)
        self.label = list(range(len(sets)))

    def find(self, i: int) -> int:
        while self.label[i] != i:
            self.label[i] = self.label[self.label[i]]
            i = self.label[i]
        return i

    def union(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        self.label[max(a, b)] = min(a, b)
        return a != b

    def row(self, i: int, ids: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distance, whether it is a link) of i to each of ids, whose shingles are in flat."""
        mine = self.flat[self.starts[i] : self.starts[i + 1]]
        self.mark[mine] = True
        both = np.add.reduceat(self.mark[flat], starts, dtype=np.int64)
        self.mark[mine] = False
        either = self.n[ids] + self.n[i] - both
        return 1 - both / either, 100 * both >= self.percent * either

    def laid(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate([self.flat[self.starts[i] : self.starts[i + 1]] for i in ids])
        return flat, np.concatenate([[0], np.cumsum(self.n[ids])[:-1]])

    def linked(self, i: int, ids: np.ndarray, links: np.ndarray) -> None:
        for j in ids[links].tolist():
            if self.union(i, j):
                self.links.append((i, j))

    def direct(self, ids: np.ndarray) -> None:
        """Links all of ids: those outside of the largest class found so far are compared with all."""
        roots = np.array([self.find(i) for i in ids.tolist()])
        classes, count = np.unique(roots, return_counts=True)
        flat, starts = self.laid(ids)
        for i in ids[roots != classes[count.argmax()]].tolist() if count.max() > 1 else ids[1:].tolist():
            self.linked(i, ids, self.row(i, ids, flat, starts)[1])

    def join(self, ids: np.ndarray) -> None:
        """Links all of ids by regions."""
        if len(ids) <= LEAF:
            if len(ids) > 1:
                self.direct(ids)
            return
        flat, starts = self.laid(ids)
        far = np.empty((PIVOTS, len(ids)))
        for k, i in enumerate(ids[np.linspace(0, len(ids) - 1, PIVOTS).astype(int)].tolist()):
            far[k], links = self.row(i, ids, flat, starts)
            self.linked(i, ids, links)
        regions = [ids[x] for x in windows(far, self.percent)]
        sizes = [len(x) for x in regions]
        if max(sizes) > LARGEST * len(ids) or sum(sizes) > TOGETHER * len(ids):
            self.direct(ids)
        else:
            for x in regions:
                self.join(x)


def windows(far: np.ndarray, percent: int) -> np.ndarray:
    """For distances of pivots (rows) to documents: which regions a document is in, its own and those within the window; two near documents are both in the region of either one's nearest pivot."""
    home = far.argmin(axis=0)
    inside = far <= far.min(axis=0) + 2 * (100 - percent) / 100 + 1e-9
    # of the pivots at the least distance only the first is home; a partner's window reaches it
    inside[home, np.arange(far.shape[1])] = True
    return inside


def by_group(df: DataFrame, key: str, order: list, columns: list[str], found, schema: str) -> DataFrame:
    """What found(table) gives, as a list of columns, for the rows of each value of `key` (a long), which come in order."""
    fields = [x.split()[0] for x in schema.split(", ")]
    types = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}[x.split()[1]] for x in schema.split(", ")]

    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        out = found(pa.Table.from_batches(held).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types, strict=True)], names=fields) if out is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            marks = batch.column(len(columns)).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and marks[a] != at:
                    if (out := made(held)) is not None:
                        yield out
                    held = []
                at = marks[a]
                held.append(batch.slice(a, b - a))
        if held and (out := made(held)) is not None:
            yield out

    return df.select(*columns, F.col(key).alias("__by")).repartition("__by").sortWithinPartitions("__by", *order).mapInArrow(run, schema)


def sets_of(column) -> list[np.ndarray]:
    return [np.frombuffer(s.as_buffer(), dtype="<u8") for s in column]


def unit_links(percent: int, direct: bool = False):
    """(a, b) that span the links of a unit's documents; those with one label from 0 on are linked already."""

    def found(t: pa.Table):
        nodes, first = np.unique(t.column("__node").to_numpy(), return_index=True)
        if len(nodes) < 2:
            return None
        space = Space(sets_of(t.column("__set").take(pa.array(first))), percent)
        for label in np.unique(labels := t.column("__label").to_numpy()[first]).tolist():
            if label >= 0:
                same = np.flatnonzero(labels == label).tolist()
                for i in same[1:]:
                    space.union(same[0], i)
        (space.direct if direct else space.join)(np.arange(len(nodes)))
        if not space.links:
            return None
        a, b = np.array(space.links).T
        return [nodes[a], nodes[b]]

    return found


def pivoted(percent: int):
    """For a part of a region and all of its pivots: the links of the part with pivots, and for each document its label (the class of pivots that it is linked to, or -1) and the regions that it is in."""

    def found(t: pa.Table):
        pivot = t.column("__pivot").to_numpy() > 0
        k = int(pivot.sum())  # pivots come first
        nodes = t.column("__node").to_numpy()
        space = Space(sets_of(t.column("__set")), percent)
        ids = np.arange(len(nodes))
        flat, starts = space.laid(ids)
        far, near = np.empty((k, len(ids))), np.zeros((k, len(ids)), dtype=bool)
        for p in range(k):
            far[p], near[p] = space.row(p, ids, flat, starts)
        for p in range(k):
            for q in np.flatnonzero(near[p, :k]).tolist():
                space.union(p, q)
        inside, members, out = windows(far, percent), ids[k:].tolist(), [[] for _ in range(6)]
        classes = np.array([space.find(p) for p in range(k)])
        for i in members:
            to = np.flatnonzero(near[:, i])
            row = [nodes[i], int(space.n[i]), t.column("__set")[i].as_py(), int(classes[to[0]]) if len(to) else -1, np.flatnonzero(inside[:, i]).astype(np.int32), nodes[to][nodes[to] != nodes[i]]]
            for c, x in zip(out, row, strict=True):
                c.append(x)
        return [np.full(len(members), t.column("__group")[0].as_py()), *out]

    return found


def small(df: DataFrame) -> DataFrame:
    """df, for a broadcast if it has few rows. Pass a checkpointed table."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


COLUMNS, LINK = ["__group", "__node", "__n", "__set", "__label"], "a long, b long"
PLACED = "__group long, __node long, __n long, __set binary, __label int, __inside array<int>, __links array<long>"


def weight():
    return F.col("__n") + EACH


def parts_of(w, unit: int):
    return F.ceil(2 * w / unit).cast("long")


def upto(n):
    return F.sequence(F.lit(0).cast("long"), n - 1)


def placed_by_pivots(held: DataFrame, percent: int, unit: int) -> DataFrame:
    """PLACED for the documents of regions that are too large (held, with the region's weight __w): parts of a region meet all of its pivots, its documents of the least hashes."""
    order = Window.partitionBy("__group").orderBy(F.xxhash64("__node", "__group"), "__node")
    pivots = cut(held.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= PIVOTS).drop("__rank"))
    n = parts_of(F.col("__w"), unit)
    members = held.select(*COLUMNS, F.lit(0).alias("__pivot"), F.xxhash64("__group", F.pmod(F.xxhash64("__node"), n)).alias("__unit"))
    sent = pivots.select(*COLUMNS, F.lit(1).alias("__pivot"), F.explode(F.transform(upto(n), lambda k: F.xxhash64("__group", k))).alias("__unit"))
    return cut(by_group(members.unionByName(sent), "__unit", [F.desc("__pivot"), F.col("__node")], [*COLUMNS, "__pivot"], pivoted(percent), PLACED))


def tiled_units(judged: DataFrame, unit: int) -> DataFrame:
    """Regions that don't fall apart: each document outside of the largest class of linked ones meets all others, in units of a tile with a tile."""
    main_weight = F.coalesce(F.col("__main.__lw"), F.lit(0).cast("long"))
    rest, others = parts_of(F.greatest(F.lit(1).cast("long"), F.col("__w") - main_weight), unit), parts_of(main_weight, unit)
    mine = lambda n: F.pmod(F.xxhash64("__node"), n).cast("long")
    among = F.transform(upto(rest), lambda k: F.xxhash64("__group", F.least(k, mine(rest)), F.greatest(k, mine(rest))))
    across = F.transform(F.filter(upto(others + 1), lambda k: k < others), lambda k: F.xxhash64("__group", mine(rest), -1 - k))
    of_main = F.transform(upto(rest), lambda k: F.xxhash64("__group", k, -1 - mine(others)))
    is_main = F.coalesce(F.col("__label") == F.col("__main.__label"), F.lit(False))
    apart = judged.filter(~F.col("__split") & (main_weight < F.col("__w")))
    return apart.select(*COLUMNS, F.explode(F.when(is_main, of_main).otherwise(F.concat(among, across))).alias("__unit"))


def space_links(members: DataFrame, percent: int = PERCENT, unit: int = UNIT) -> DataFrame:
    """(a, b) that span the links among the documents of each __group of `members` (__group, __node, __n, __set; checkpointed). What is too large for a task is split by pivots, each part in a task of its own."""
    out, space = [], members.select("__group", "__node", "__n", "__set", F.lit(-1).alias("__label"))
    while True:
        sized = cut(space.groupBy("__group").agg(F.sum(weight()).alias("__w"), F.count("*").alias("__c")).filter("__c > 1"))
        fits = sized.filter(F.col("__w") <= unit)
        out.append(by_group(space.join(small(fits.select("__group")), "__group"), "__group", ["__node"], COLUMNS, unit_links(percent), LINK))
        large = sized.filter(F.col("__w") > unit)
        if large.isEmpty():
            break
        placed = placed_by_pivots(cut(space.join(small(large), "__group")), percent, unit)
        out.append(placed.select(F.col("__node").alias("a"), F.explode("__links").alias("b")))
        regions = placed.select("__group", F.explode("__inside").alias("__region")).groupBy("__group", "__region").agg(F.count("*").alias("__k"))
        classes = placed.groupBy("__group", "__label").agg(F.count("*").alias("__k"), F.sum(weight()).alias("__lw"))
        plan = regions.groupBy("__group").agg(F.sum("__k").alias("__all"), F.max("__k").alias("__most")).join(classes.groupBy("__group").agg(F.max(F.when(F.col("__label") >= 0, F.struct("__k", "__label", "__lw"))).alias("__main")), "__group")
        falls = (F.col("__most") <= LARGEST * F.col("__c")) & (F.col("__all") <= TOGETHER * F.col("__c"))
        judged = placed.join(small(cut(large.join(plan, "__group").select("__group", "__w", "__main", falls.alias("__split")))), "__group")
        out.append(by_group(tiled_units(judged, unit), "__unit", ["__node"], COLUMNS, unit_links(percent, direct=True), LINK))
        space = cut(judged.filter("__split").select("__group", F.explode("__inside").alias("__region"), "__node", "__n", "__set").select(F.xxhash64("__group", "__region").alias("__group"), "__node", "__n", "__set", F.lit(-1).alias("__label")))
    links = out[0]
    for x in out[1:]:
        links = links.unionAll(x)
    return links


def jaccard_components(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = WORDS, percent: int = PERCENT, unit: int = UNIT) -> DataFrame:
    """(id_col, n_shingles, component_id) of each row of docs: how many different shingles of `words` words its text has, and the least id that it reaches by links of at least `percent` similarity.

    Null, empty and blank texts have no shingles and reach themselves alone; texts of fewer words have one, the whole sequence. Null ids are reached, but name a class only where there is no other.
    Texts with equal sets are linked; repeated rows each keep their row. Texts count whole; an empty table gives no rows; other columns are left aside.
    """
    spark = docs.sparkSession
    ship(spark)
    own, path = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").alias("__text")), scratch(spark, "jaccard")
    hashed(own, "__text", words, percent, True).write.parquet(path)
    printed = spark.read.parquet(path)
    some = printed.filter("__n > 0")
    first = cut(some.groupBy("__node").agg(F.min(F.struct(F.col("__id").isNull().alias("void"), F.col("__id").alias("id"))).alias("__first")))
    # documents that equal slices join make a space
    keyed = some.select("__node", F.explode("__keys").alias("__key"))
    hubs = cut(keyed.groupBy("__key").agg(F.min("__node").alias("__hub"), F.max("__node").alias("__last")).filter("__hub < __last").drop("__last"))
    stars = keyed.join(small(hubs), "__key").filter("__node != __hub").select("__node", "__hub")
    spaces = cut(components(stars, "__node", "__hub").withColumnsRenamed({"node": "__node", "root": "__group"}))
    ids = cut(first.join(small(spaces), "__node", "left_semi").select(F.col("__first.id").alias("__id")).distinct())
    sets = hashed(own.join(small(ids), own["__id"].eqNullSafe(ids["__id"]), "left_semi").drop("__id"), "__text", words, percent, False)
    members = cut(sets.join(small(spaces), "__node").dropDuplicates(["__node"]))
    # the least id of each class
    linked = cut(components(space_links(members, percent, unit), "a", "b").withColumnRenamed("node", "__node").join(first, "__node"))
    least = joined_evenly(linked.drop("__first"), cut(linked.groupBy("root").agg(F.min("__first").alias("__least"))), "root").select("__node", "__least")
    named = cut(first.join(least, "__node", "left").select("__node", F.coalesce("__least.id", "__first.id").alias("component_id")))
    out = joined_evenly(some.select("__id", "__node", "__n"), named, "__node").select("__id", "__n", "component_id")
    out = out.unionAll(printed.filter("__n = 0").select("__id", "__n", F.col("__id").alias("component_id")))
    return out.select(F.col("__id").alias(id_col), F.col("__n").alias("n_shingles"), "component_id")


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document. Odd rows as `jaccard_components` says."""
    return jaccard_components(documents(spark, sf_dir))
