"""Best-fit-decreasing packing of token sequences, with a segment tree over the remaining capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import cut, documents, row_map
from peakframe.llm.words import tokenizer

TOKENIZER, CAPACITY, END_ID = "word_bpe_49k.json", 4096, 1
#: Pieces that one task packs; a bin holds pieces of one task, so each task may leave one bin that is not full.
SHARD_PIECES = 100_000

PIECES = T.ArrayType(T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]))


class OpenBins:
    """Open bins by remaining capacity, in a segment tree that counts them: finding the tightest that fits takes logarithmic time."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, bin_id: int) -> None:
        self.bins[room].append(bin_id)
        i = room + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The bin with least room of at least `need`, removed: (room, id), or None."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):  # up, to the first subtree on the right that has a bin
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        while i:
            self.count[i] -= 1
            i >>= 1
        return room, self.bins[room].pop()


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in it) for each length, which must be in descending order. Lengths of 0 go to the first bin at the place reached there."""
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    tree, opened = OpenBins(capacity), 0
    for i, n in enumerate(lengths.tolist()):
        got = tree.take(n)
        if got is None:
            got, opened = (capacity, opened), opened + 1
        room, b = got
        bins[i], offsets[i] = b, capacity - room
        tree.add(room - n, b)
    return bins, offsets


def pieces_of(ids: bytes, capacity: int) -> list[dict]:
    """Pieces of a document's ids (4 bytes each), cut only where it is longer than the capacity."""
    step = 4 * capacity
    return [{"piece": k, "start": k * capacity, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)} for k, part in enumerate(ids[i : i + step] for i in range(0, len(ids), step))]


def tokenized_pieces(df: DataFrame, text: str = "text", name: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece of each row of df: its columns but `text`, and piece, start, length, ids_crc32. Null and empty texts are the end id alone."""

    def make():
        t, end = tokenizer(name), np.array([end_id], dtype="<u4").tobytes()
        return lambda values: [[pieces_of(ids + end, capacity) for ids in t.encode([v or "" for v in values])]]

    cols = [c for c in df.columns if c not in (text, "piece", "start", "length", "ids_crc32")]
    return row_map(df, text, make, [T.StructField("__pieces", PIECES)], memo=True).select(*[F.col(f"`{c}`") for c in cols], F.explode("__pieces").alias("__p")).select(*[F.col(f"`{c}`") for c in cols], "__p.*")


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length", shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """`pieces` with sequence_id and offset: each row's place in sequences of at most `capacity`, gapless from 0.

    Rows of full length are sequences of their own and are not shuffled. The others are dealt at random by their values to shards of about `shard_pieces` rows, whatever
    document they are of; a task packs one shard, longest first, ties in the order of the other columns. Repeated rows are packed each. Null lengths get null places.
    A length above the capacity is an error. Reads `pieces` twice: pass a written or checkpointed table.
    """
    pieces = pieces.drop("sequence_id", "offset")
    size = F.col(f"`{length}`")
    rest = pieces.filter(size < capacity)
    n = rest.count()
    shards = max(1, -(-n // shard_pieces))
    if pieces.filter(size > capacity).limit(1).count():
        raise ValueError(f"a length is above {capacity}")
    # a full row is a sequence of its own: an odd number from its place in the table
    full = pieces.filter(size == capacity).select("*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    void = pieces.filter(size.isNull()).select("*", F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    values = [F.col(f"`{c}`") for c in pieces.columns]
    dealt = rest.withColumn("__shard", F.pmod(F.xxhash64(*values), F.lit(shards)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def packed():
            table = pa.Table.from_batches(held)
            bins, offsets = best_fit(table.column(length).to_numpy(), capacity)
            ids = (bins * shards + at) * 2  # even, and different in each shard
            yield from table.drop_columns("__shard").append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets)).to_batches()

        for batch in batches:  # rows come by shard, longest first
            marks = batch.column("__shard").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and marks[a] != at:
                    yield from packed()
                    held = []
                at = int(marks[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from packed()

    ordered = dealt.repartition(shards, "__shard").sortWithinPartitions("__shard", F.desc(length), *values)
    return ordered.mapInArrow(run, schema).unionByName(full).unionByName(void)


def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places; see pack_documents."""
    return pack_documents(documents(spark, sf_dir))


def pack_documents(docs: DataFrame) -> DataFrame:
    """A row for each piece of the documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece, the end id; null ids stay null; repeated rows are packed each; texts of any length are cut only where they exceed a sequence; an empty table gives no rows.
    """
    return pack(cut(tokenized_pieces(docs.select("doc_id", "text"))))
