"""Ranked lexical search: the impacts of documents on the terms of items, multiplied in dense tiles, with the best of each tile merged.

Items come in blocks of bounded size. For a block, every document is read once: its length and its counts of the block's terms are kept (a few bytes a term), from which the statistics of the
corpus come. Then tiles of documents, dense over the vocabulary of a tile of items, are multiplied by the items' weights in float64. A product of a vocabulary tile stays below 2^53, so that it
is a whole number exactly; products are added as 64-bit integers. What a task sends on are the best of each item, ties with the last of them resolved by id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import cut, documents, row_map, ship

TOP = 50
#: Rows of a tile of documents, items of a tile, and terms of a vocabulary tile.
DOC_TILE, ITEM_TILE, TERM_TILE = 256, 32, 2048
#: Items of a block, and bytes of their distinct terms: what the driver and a worker hold of them.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 2_000_000
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
#: An impact is below this whatever the document, and a weight below that.
MOST_IMPACT, MOST_WEIGHT = 1_000_000, 46_000
assert TERM_TILE * MOST_IMPACT * MOST_WEIGHT < 1 << 53

#: ASCII letters and digits, and every byte of other characters, make terms; the rest separates them. Only A-Z is lowered.
TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def term_pieces(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about PIECE bytes."""
    data = text.encode("utf-8", "surrogatepass").translate(TABLE)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def item_terms(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, block, terms) for each distinct item that has a term; blocks have about BLOCK_ITEMS items or BLOCK_BYTES bytes at most."""

    def make():
        def f(values):
            found = [sorted({w for p in term_pieces(v or "") for w in p}) for v in values]
            return [found, [sum(map(len, t)) for t in found]]

        return f

    fields = [T.StructField("terms", T.ArrayType(T.BinaryType())), T.StructField("bytes", T.LongType())]
    one = items.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("__text")).distinct()
    found = cut(row_map(one, "__text", make, fields).filter(F.size("terms") > 0))
    n, size = found.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    blocks = max(1, math.ceil(n / BLOCK_ITEMS), math.ceil(size / BLOCK_BYTES))
    return found.select("id", "terms", F.pmod(F.xxhash64("id", "terms"), F.lit(blocks)).alias("block")), blocks if n else 0


def counted_terms(docs: DataFrame, id_col: str, text: str, place: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts) of the documents that have a term: n counts all of them; terms and counts are of those in `place`, as 32-bit numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(place)

    def make():
        get = sent.value.get

        def f(values):
            out: list[list] = [[], [], []]
            for v in values:
                found, n = Counter(), 0
                for words in term_pieces(v or ""):
                    n += len(words)
                    found.update(map(get, words))
                found.pop(None, None)
                out[0].append(n)
                out[1].append(np.fromiter(found.keys(), dtype="<i4", count=len(found)).tobytes())
                out[2].append(np.fromiter(found.values(), dtype="<i4", count=len(found)).tobytes())
            return out

        return f

    fields = [T.StructField("n", T.LongType()), T.StructField("terms", T.BinaryType()), T.StructField("counts", T.BinaryType())]
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("__text"))
    return cut(row_map(own, "__text", make, fields).filter("n > 0"))


def corpus_statistics(counted: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """(documents, terms in them, documents that hold each of the `terms` terms)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, words = np.zeros(terms, dtype=np.int64), 0, 0
        for b in batches:
            docs, words = docs + b.num_rows, words + int(b.column(0).to_numpy().sum())
            for x in b.column(1).to_pylist():
                held[np.frombuffer(x, dtype="<i4")] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *at.tolist()]), pa.array([docs, words, *held[at].tolist()])], names=["term", "n"])

    got = counted.select("n", "terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    by = dict(zip(got["term"].to_pylist(), got["n"].to_pylist(), strict=True))
    return by.pop(-2, 0), by.pop(-1, 0), np.array([by.get(k, 0) for k in range(terms)], dtype=np.int64)


def weight(documents_: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * documents_ + 2) / (2 * held + 1)))


class Best:
    """The `top` highest scores of each item, of equal ones the least ids (null ids last)."""

    def __init__(self, items: int, top: int):
        self.top, self.floor = top, np.ones(items, dtype=np.int64)
        self.item, self.score, self.id, self.void = (np.empty(0, dtype=t) for t in (np.int64, np.int64, np.int64, bool))
        self.parts: list[tuple] = []
        self.waiting = 0

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray, void: np.ndarray) -> None:
        """scores: a row for each document, a column for each of the items."""
        rows, cols = np.nonzero(scores >= self.floor[items])
        if len(rows):
            self.parts.append((items[cols], scores[rows, cols], ids[rows], void[rows]))
            self.waiting += len(rows)
            if self.waiting > max(50_000, len(self.item)):
                self.settle()

    def settle(self) -> None:
        self.item, self.score, self.id, self.void = (np.concatenate(x) for x in zip((self.item, self.score, self.id, self.void), *self.parts, strict=True))
        order = np.lexsort((self.id, self.void, -self.score, self.item))
        sorted_ = self.item[order]
        rank = np.arange(len(order)) - np.searchsorted(sorted_, sorted_)
        last = order[rank == self.top - 1]
        self.floor[self.item[last]] = self.score[last]  # an equal score may still have a smaller id
        order = order[rank < self.top]
        self.item, self.score, self.id, self.void = self.item[order], self.score[order], self.id[order], self.void[order]
        self.parts, self.waiting = [], 0


def item_tiles(items: list[list[int]], held: np.ndarray, weights: np.ndarray) -> list[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """(numbers of the items, [(terms of the vocabulary tile in order, weights by term and item)]): items whose commonest terms are alike are together, so that they share terms."""
    order = sorted(range(len(items)), key=lambda i: max((int(held[t]), t) for t in items[i]))
    tiles = []
    for a in range(0, len(order), ITEM_TILE):
        mine = order[a : a + ITEM_TILE]
        vocabulary = sorted({t for i in mine for t in items[i]})
        parts = []
        for b in range(0, len(vocabulary), TERM_TILE):
            terms = np.array(vocabulary[b : b + TERM_TILE])
            table = np.zeros((len(terms), len(mine)))
            for k, i in enumerate(mine):
                at = np.flatnonzero(np.isin(terms, items[i]))
                table[at, k] = weights[terms[at]]
            parts.append((terms, table))
        tiles.append((np.array(mine), parts))
    return tiles


def tile_scores(docs: int, owner: np.ndarray, terms: np.ndarray, impacts: np.ndarray, parts: list) -> np.ndarray:
    """Scores of a tile of documents (rows) for a tile of items (columns)."""
    total = 0
    for vocabulary, table in parts:
        at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
        there = vocabulary[at] == terms
        dense = np.zeros((docs, len(table)))
        dense[owner[there], at[there]] = impacts[there]
        total = total + (dense @ table).astype(np.int64)  # exact: below 2^53
    return total


def best_of_tasks(counted: DataFrame, items: list[list[int]], documents_: int, words: int, held: np.ndarray, top: int) -> DataFrame:
    """(item, id, score): the best of each item in each task."""
    weights = np.array([weight(documents_, int(h)) for h in held], dtype=np.int64)
    sent = counted.sparkSession.sparkContext.broadcast((items, held, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, held, weights = sent.value
        tiles, best = item_tiles(items, held, weights), Best(len(items), top)
        for batch in batches:
            for a in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(a, DOC_TILE)
                void = part.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = part.column(0).fill_null(0).to_numpy()
                size = np.array([50 + 50 * n * documents_ // words for n in part.column(1).to_pylist()], dtype=np.int64)
                lists = [np.frombuffer(x, dtype="<i4") for x in part.column(2).to_pylist()]
                owner = np.repeat(np.arange(part.num_rows), [len(x) for x in lists])
                terms = np.concatenate(lists)
                tf = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype="<i4").astype(np.int64)
                impacts = (1_000_000_000 * tf // (1000 * tf + 20 * size[owner])).astype(np.float64)
                for numbers, parts in tiles:
                    best.add(numbers, tile_scores(part.num_rows, owner, terms, impacts, parts), ids, void)
        best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.id, mask=best.void), pa.array(best.score)], names=["item", "id", "score"])

    return counted.filter(F.length("terms") > 0).select("id", "n", "terms", "counts").mapInArrow(run, "item long, id long, score long")


def ranked(items: DataFrame, docs: DataFrame, item_id: str = "item_id", item_text: str = "text", doc_id: str = "doc_id", doc_text: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of the highest score above 0 for each item; of equal scores the least id goes first, null ids last.

    Null, empty and termless texts have no terms: such items get no rows, such documents none and count nowhere. Repeated items count once; items of one id with different texts are ranked
    each. Repeated documents are ranked each, in any order. Texts count whole, in pieces of PIECE bytes. Empty tables give no rows; other columns are left aside.
    """
    spark = docs.sparkSession
    ship(spark)
    found, blocks = item_terms(items, item_id, item_text)
    out = spark.createDataFrame([], T.StructType([T.StructField("item_id", items.schema[item_id].dataType), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for k in range(blocks):
        block = found.filter(F.col("block") == k).select("id", "terms").orderBy("id", "terms").collect()
        if not block:
            continue
        place = {bytes(t): i for i, t in enumerate(sorted({bytes(t) for r in block for t in r["terms"]}))}
        counted = counted_terms(docs, doc_id, doc_text, place)
        documents_, words, held = corpus_statistics(counted, len(place))
        if not documents_:
            break
        best = best_of_tasks(counted, [[place[bytes(t)] for t in r["terms"]] for r in block], documents_, words, held, top)
        order = [F.desc("score"), F.col("id").isNull(), F.col("id")]
        for group in (["item", "salt"], ["item"]):  # tasks are many: their lists are merged in two steps
            best = (best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64))) if "salt" in group else best).withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(block)], T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", items.schema[item_id].dataType)]))
        out = out.unionAll(best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int"), F.col("id").alias("doc_id"), "score"))
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score: the 50 best documents of every benchmark item. Odd rows as `ranked` says."""
    return ranked(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), documents(spark, sf_dir))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (SELECT DISTINCT item_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
q AS (SELECT DISTINCT item_id, text, unnest(t) AS term FROM i),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 50 + (50 * len(t)::BIGINT * n_docs) // n_terms AS m FROM d, c WHERE len(t) > 0),
s AS (SELECT item_id, text, p.r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM q JOIN p USING (term) JOIN w USING (term) JOIN m ON m.r = p.r GROUP BY item_id, text, p.r, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id, r) AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""
