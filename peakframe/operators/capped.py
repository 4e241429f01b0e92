"""Runs of files, in order, of limited total size: a running sum that starts anew with each run."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.operators.ordering import placed
from peakframe.sources.shared import ship, written

#: Files that one task looks at together, and stretches that one task composes.
SPAN, BRANCH = 50_000, 16


def _sums(sizes: pd.Series) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes.to_numpy(np.int64))])


def _following(sums: np.ndarray, most: int) -> np.ndarray:
    """For a chunk that starts at each file, where the next one starts; the number of files if none does."""
    start = np.arange(len(sums) - 1)
    return np.maximum(start + 1, np.searchsorted(sums, sums[:-1] + most, side="right") - 1)


def _first(sums: np.ndarray, held: int, most: int) -> int:
    """The first file that a chunk of `held` bytes, open from before, has no room for."""
    return int(np.searchsorted(sums[1:], most - held, side="right"))


class Steps:
    """What a stretch of files makes of the chunk that reaches it: a step function of the bytes held in it.

    With `held` bytes, the first i with held + reach[i] > most says which file has no room; behind the stretch then left[i] bytes are held and opened[i] chunks were started. If none has, total is added.
    Without an open chunk, none_left and none_opened hold.
    """

    __slots__ = ("left", "none", "opened", "reach", "total")

    def __init__(self, reach, left, opened, total: int, none: tuple[int, int]):
        self.reach, self.left, self.opened, self.total, self.none = (*(np.asarray(x, dtype=np.int64) for x in (reach, left, opened)), total, none)

    def at(self, held: int, most: int) -> tuple[int, int]:
        """(bytes held, chunks started) behind; held is -1 without an open chunk."""
        if held < 0:
            return self.none
        i = int(np.searchsorted(self.reach, most - held, side="right"))
        return (int(self.left[i]), int(self.opened[i])) if i < len(self.reach) else (held + self.total, 0)

    def then(self, other: Steps, most: int) -> Steps:
        """This stretch and the one behind it. Steps that lead to the same are one, and those that no chunk of 0 bytes or more can reach are left out, so there are no more than a chunk has files."""
        ends = [other.at(h, most) for h in self.left.tolist()]
        left, opened, reach = [x for x, _ in ends], (self.opened + [n for _, n in ends]).tolist(), self.reach
        if self.total <= most:
            reach = np.concatenate([reach, self.total + other.reach])
            left, opened = left + other.left.tolist(), opened + other.opened.tolist()
        h, n = other.at(self.none[0], most)
        return Steps(reach, left, opened, min(self.total + other.total, most + 1), (h, self.none[1] + n)).pruned(most)

    def pruned(self, most: int) -> Steps:
        last = int(np.searchsorted(self.reach, most, side="right")) + 1  # a chunk of 0 bytes goes no farther
        reach, left, opened = self.reach[:last], self.left[:last], self.opened[:last]
        keep = np.ones(len(reach), dtype=bool)
        keep[:-1] = (left[1:] != left[:-1]) | (opened[1:] != opened[:-1])
        return Steps(reach[keep], left[keep], opened[keep], self.total, self.none)

    def only(self, held: int, most: int) -> Steps:
        """The same for one state that alone can reach the stretch: a single step."""
        end = self.at(held, most)
        return Steps([most + 1], [end[0]], [end[1]], most + 1, end)


def _steps(sums: np.ndarray, most: int) -> Steps:
    n, after = len(sums) - 1, _following(sums, most)
    last, started = np.arange(n), np.ones(n, np.int64)
    for s in range(n - 1, -1, -1):
        if (j := after[s]) < n:
            last[s], started[s] = last[j], started[j] + 1
    p = np.arange(min(n, _first(sums, 0, most) + 1))
    p = p[(p == 0) | (sums[p + 1] != sums[p])]  # an empty file has room wherever the one before it has
    total = int(sums[n])
    return Steps(sums[p + 1], total - sums[last[p]], started[p], min(total, most + 1), (total - int(sums[last[0]]), int(started[0]))).pruned(most)


FIELDS = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("__reach", "__left", "__opened")] + [T.StructField(c, T.LongType()) for c in ("__total", "__none_left", "__none_opened")]


def _row(s: Steps) -> list:
    return [s.reach.tolist(), s.left.tolist(), s.opened.tolist(), s.total, *s.none]


def _read(r) -> Steps:
    return Steps(r["__reach"], r["__left"], r["__opened"], int(r["__total"]), (int(r["__none_left"]), int(r["__none_opened"])))


def capped(files: DataFrame, keys: list[str], order: list[str], size: str, most: int, span: int = SPAN, branch: int = BRANCH) -> DataFrame:
    """files with the number (from 0) of the chunk each falls in: in the order given, a chunk of a key takes files as long as their sizes sum to `most` or less; its first file always fits.

    Spans of at most `span` files are looked at side by side. Each tells what it makes of a chunk that reaches it as a step function, a row; `branch` neighbours at a time are composed to one, up to a
    whole key, and on the way down each gets the state that it really starts with. A step function has no more steps than a chunk has files, however many files there are, and one where no
    chunk can have ended before. Sizes are whole numbers from 0; null counts as 0. Files that agree in keys and order are in no particular order among each other. Null keys are a key; an empty
    table gives an empty one.
    """
    ship(files.sparkSession)
    rows = placed(files, [*keys, *order], "__place").withColumns({"__span": F.floor(F.col("__place") / span), "__size": F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long"))})
    unit = [*keys, "__span"]
    key_fields = [files.schema[k] for k in keys]
    level = T.StructType([*key_fields, T.StructField("__span", T.LongType()), *FIELDS])
    state = T.StructType([*key_fields, T.StructField("__span", T.LongType()), T.StructField("__held", T.LongType()), T.StructField("__started", T.LongType())])
    # bytes before each span of its key: while they fit into one chunk, they are the only state that reaches it
    totals = rows.groupBy(*unit).agg(F.sum("__size").alias("__bytes"))
    before = F.sum("__bytes").over(Window.partitionBy(*keys).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1))
    reached = written(totals.withColumn("__before", F.coalesce(before, F.lit(-1))).drop("__bytes")).toDF(*unit, "__before")

    def leaf(pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        steps, known_ = _steps(_sums(pdf.sort_values("__place")["__size"]), most), int(known["__before"].iloc[0])
        if known_ <= most:
            steps = steps.only(known_, most)
        return pd.DataFrame([[*pdf[unit].iloc[0], *_row(steps)]], columns=level.names)

    def up(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_read(r) for _, r in pdf.sort_values("__span").iterrows()]
        whole = parts[0]
        for x in parts[1:]:
            whole = whole.then(x, most)
        return pd.DataFrame([[*pdf[keys].iloc[0], int(pdf["__span"].iloc[0]) // branch, *_row(whole)]], columns=level.names)

    def down(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        held, opened, out = int(above["__held"].iloc[0]), int(above["__started"].iloc[0]), []
        for _, r in pdf.sort_values("__span").iterrows():
            out.append([*r[unit], held, opened])
            held, more = _read(r).at(held, most)
            opened += more
        return pd.DataFrame(out, columns=state.names)

    names = files.columns

    def numbered(pdf: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__place", ignore_index=True)
        held, opened = int(state["__held"].iloc[0]), int(state["__started"].iloc[0])
        sums = _sums(pdf["__size"])
        after, starts = _following(sums, most), np.zeros(len(pdf), np.int64)
        at = 0 if held < 0 else _first(sums, held, most)
        while at < len(pdf):
            starts[at] = 1
            at = after[at]
        return pdf[names].assign(chunk=opened + np.cumsum(starts) - 1)

    parent = F.floor(F.col("__span") / branch).alias("__parent")
    tree = [written(rows.select(*unit, "__place", "__size").groupBy(*unit).cogroup(reached.groupBy(*unit)).applyInPandas(leaf, level))]
    # spans are numbered over all keys; the tree is done when each key has one
    while not tree[-1].groupBy(*keys).count().filter("count > 1").isEmpty():
        tree.append(written(tree[-1].groupBy(*keys, parent).applyInPandas(up, level)))
    states = tree[-1].select(*unit, F.lit(-1).cast("long").alias("__held"), F.lit(0).cast("long").alias("__started"))
    for below in reversed(tree[:-1]):
        found = below.groupBy(*keys, parent).cogroup(states.withColumnRenamed("__span", "__parent").groupBy(*keys, "__parent"))
        states = written(found.applyInPandas(down, state))
    return rows.groupBy(*unit).cogroup(states.groupBy(*unit)).applyInPandas(numbered, T.StructType([*files.schema.fields, T.StructField("chunk", T.LongType())]))
