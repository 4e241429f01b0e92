"""Toxicity by class-conditional Kneser-Ney models of words' spelling, compared by length-normalised log-likelihoods.

In each class the probability of a character given the four before it (from the word's start to its end) is its count there less a discount, and for the mass so freed a backoff that both
classes share: Kneser-Ney continuation counts of orders 4 to 1 over both. Rare expressions are thus alike in both classes unless a class has evidence of its own. Ordinary words make
up most of a toxic text, so its words are a mixture of the two models with a share of TOXIC_SHARE of the toxic one; the score compares the mean log-likelihood of a text's words as toxic and as ordinary.

The shared backoff cancels out of the ratio of a character that was not counted after its context, so a word's log-ratio is a sum of weights: one for each context, one for each counted 5-gram.
The table of weights grows with the corpus. Its most common rows, a bounded number, are broadcast; words with other rows of the table are completed by a join.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import SLICE_BYTES, code_points, cut, documents, kept, mixed_hash, row_map, ship, slices

#: Characters of the longest n-gram, and the discount of every count.
ORDER, DISCOUNT = 5, 0.75
#: The toxic model's share of a toxic text's words, and the most that one word's log-ratio counts, so that strings of no language can't decide.
TOXIC_SHARE, MOST_EVIDENCE = 0.01, 6.0
#: Rows of the weight table that are broadcast at most (12 bytes each), and most bits of the filter that tells which others there are.
HOT_ROWS, FILTER_BITS = 1 << 20, 1 << 26
#: Most labelled texts, about, on which the two parameters that turn a likelihood ratio into a score are fitted, and their largest share of all.
CALIBRATION_ROWS, CALIBRATION_SHARE = 20_000, 0.25
#: Most label rows (12 bytes each) that are broadcast to the texts; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Words that a worker remembers; when full it starts anew.
MEMO = 400_000
WORD = re.compile(r"\w+")
#: What stands before and behind a word, so that each of its characters, and its end, has four before it.
PAD, STOP = "\x02" * (ORDER - 1), "\x03"

UNSURE = T.ArrayType(T.StructType([T.StructField("n", T.LongType()), T.StructField("known", T.DoubleType()), T.StructField("keys", T.ArrayType(T.LongType()))]))


def spelled(words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """The code points of all 5-grams of the words, a column for each of the five, and where each word's begin."""
    codes = code_points("".join([f"{PAD}{w}{STOP}" for w in words]))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + ORDER
    stop = np.repeat(np.cumsum(sizes), sizes)
    p = np.flatnonzero(np.arange(len(codes)) + ORDER <= stop)
    return [codes[p + k] for k in range(ORDER)], np.concatenate([[0], np.cumsum(sizes - ORDER + 1)[:-1]])


def counted_grams(df: DataFrame, text: str, label: str) -> DataFrame:
    """(g, toxic, ordinary): how often each 5-gram of characters stands in words of texts of either label, summed in tasks before the shuffle (where 64-bit hashes tell them apart)."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, 0, 4 * SLICE_BYTES) for b in batches):
            sums = (Counter(), Counter())
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[int(y)].update(WORD.findall((t or "").lower()))
            words = list({**sums[0], **sums[1]})
            if not words:
                continue
            columns, starts = spelled(words)
            _, first, place = np.unique(mixed_hash(columns), return_index=True, return_inverse=True)
            each = np.diff(np.append(starts, len(columns[0])))
            counts = [np.bincount(place, weights=np.repeat(np.array([s[w] for w in words], dtype=np.float64), each)).astype(np.int64) for s in (sums[1], sums[0])]
            joined = np.stack([c[first] for c in columns], axis=1).astype("<u4").tobytes().decode("utf-32-le")
            yield pa.RecordBatch.from_arrays([pa.array([joined[i : i + ORDER] for i in range(0, len(joined), ORDER)], type=pa.string()), *map(pa.array, counts)], names=["g", "toxic", "ordinary"])

    counted = df.select(F.col(f"`{text}`"), F.col(f"`{label}`").cast("int")).mapInArrow(run, "g string, toxic long, ordinary long")
    return counted.groupBy("g").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def weights(grams: DataFrame) -> DataFrame:
    """(g, weight, n): the log-ratio that each context of four characters adds, and what each counted 5-gram adds to its context's; n is how often it was counted. Pass a checkpointed table."""
    less = lambda c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))
    freed = lambda c: F.least(F.col(c).cast("double"), F.lit(DISCOUNT))
    # continuation counts: how many different longer n-grams end in each shorter one
    levels = {ORDER: grams.select("g")}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = levels[k + 1].groupBy(F.substring("g", 2, k).alias("g")).agg(F.count("*").alias("c"))
        if k == ORDER - 1:
            levels[k] = cut(levels[k])
    sums = levels[1].agg(F.count("*").alias("kinds"), F.sum("c").alias("total"), F.sum(freed("c")).alias("freed")).first()
    total, even = float(sums["total"] or 1), float(sums["freed"] or 0) / ((sums["kinds"] or 0) + 1)
    shared = levels[1].select("g", ((less("c") + even) / total).alias("p"))
    for k in range(2, ORDER):
        same = Window.partitionBy(F.substring("g", 1, k - 1))  # as many rows as there are characters, at most
        level = levels[k].select("g", F.substring("g", 2, k - 1).alias("low"), less("c").alias("left"), F.sum(freed("c")).over(same).alias("freed"), F.sum("c").over(same).alias("total"))
        shared = level.join(shared.select(F.col("g").alias("low"), "p"), "low").select("g", ((F.col("left") + F.col("freed") * F.col("p")) / F.col("total")).alias("p"))
    contexts = grams.groupBy(F.substring("g", 1, ORDER - 1).alias("h")).agg(*[f(c).alias(f"{n}_{c}") for c in ("toxic", "ordinary") for n, f in (("sum", lambda c: F.sum(c)), ("freed", lambda c: F.sum(freed(c))))])
    # a context that a class lacks leaves all to the backoff
    part = lambda c: F.when(F.col(f"sum_{c}") > 0, F.col(f"freed_{c}") / F.col(f"sum_{c}")).otherwise(1.0)
    base = (F.log(part("toxic")) - F.log(part("ordinary"))).alias("base")
    p = lambda c: F.when(F.col(f"sum_{c}") > 0, less(c) / F.col(f"sum_{c}")).otherwise(0.0) + part(c) * F.col("p")
    long = grams.withColumns({"h": F.substring("g", 1, ORDER - 1), "low": F.substring("g", 2, ORDER - 1)}).join(contexts, "h").join(shared.select(F.col("g").alias("low"), "p"), "low")
    own = long.select("g", (F.log(p("toxic")) - F.log(p("ordinary")) - base).alias("weight"), (F.col("toxic") + F.col("ordinary")).alias("n"))
    return own.unionAll(contexts.select(F.col("h").alias("g"), base.alias("weight"), (F.col("sum_toxic") + F.col("sum_ordinary")).alias("n")))


def keyed(table: DataFrame) -> DataFrame:
    """The table with a 64-bit hash of g in its place, `key`."""
    ship(table.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, keys = batch.column(0).to_pylist(), np.zeros(batch.num_rows, dtype=np.uint64)
            for width in (ORDER - 1, ORDER):
                at = np.flatnonzero(np.fromiter(map(len, grams), dtype=np.int64, count=len(grams)) == width)
                if len(at):
                    codes = code_points("".join([grams[i] for i in at.tolist()])).reshape(-1, width)
                    keys[at] = mixed_hash([codes[:, k] for k in range(width)])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *batch.columns[1:]], names=["key", "weight", "n"])

    return table.select("g", F.col("weight").cast("double"), "n").mapInArrow(run, "key long, weight double, n long")


class Model:
    """The broadcast part of the weights (hot), the others as a table (cold, or None), and slope and offset of the curve that makes scores of ratios."""

    def __init__(self, spark: SparkSession, table: DataFrame, hot_rows: int = HOT_ROWS, filter_bits: int = FILTER_BITS):
        """table: key, weight, n; checkpointed. Rows are hot by how often they were counted, in steps of a sixteenth of a power of two, as many as fit."""
        step = F.floor(F.log2(F.col("n")) * 16).cast("int")
        sizes = sorted(((r["s"], r["count"]) for r in table.groupBy(step.alias("s")).count().collect()), reverse=True)  # a few hundred rows
        held, least = 0, 1 << 20
        for s, n in sizes:
            if held + n > hot_rows:
                break
            held, least = held + n, s
        got = table.filter(step >= least).select("key", "weight").toArrow()
        keys, values = got["key"].to_numpy().view(np.uint64), got["weight"].to_numpy().astype(np.float32)
        order = np.argsort(keys, kind="stable")
        n_cold = sum(n for _, n in sizes) - held
        self.cold = cut(table.filter(step < least).select("key", "weight")) if n_cold else None
        bits = None
        if n_cold:
            width = min(filter_bits, 1 << (16 * n_cold).bit_length())
            at = F.pmod(F.col("key"), F.lit(width))
            words = self.cold.groupBy(F.floor(at / 64).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))).alias("b")).toArrow()
            bits = np.zeros(width // 64, dtype=np.uint64)
            bits[words["w"].to_numpy()] = words["b"].to_numpy().view(np.uint64)
        self.hot = spark.sparkContext.broadcast((keys[order], values[order], bits))
        self.key, self.slope, self.offset = f"toxicity-{uuid.uuid4().hex}", 1.0, 0.0


class Evidence:
    """Log-ratios of words by the broadcast weights, remembered; of words that have cold weights, only what is known and the keys to be joined."""

    def __init__(self, hot):
        self.keys, self.values, self.bits = hot
        self.memo: dict[str, float] = {}
        self.unsure: dict[str, tuple[float, list[int]]] = {}

    def weigh(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each key, and whether it may be a cold one."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        hit = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        weight = np.where(hit, self.values[at], np.float32(0)).astype(np.float64) if len(self.keys) else np.zeros(len(keys))
        if self.bits is None:
            return weight, np.zeros(len(keys), dtype=bool)
        place = keys & np.uint64(64 * len(self.bits) - 1)
        return weight, ~hit & ((self.bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)) > 0)

    def learn(self, words: list[str]) -> None:
        columns, starts = spelled(words)
        both = [mixed_hash(columns[: ORDER - 1]), mixed_hash(columns)]
        found = [self.weigh(k) for k in both]
        known = np.add.reduceat(found[0][0] + found[1][0], starts)
        self.memo.update(zip(words, evidence(known).tolist(), strict=True))
        cold = np.flatnonzero(found[0][1] | found[1][1])
        if len(cold):
            owner = np.searchsorted(starts, cold, side="right") - 1
            for i in np.unique(owner).tolist():
                mine = cold[owner == i]
                self.unsure[words[i]] = (float(known[i]), [int(x) for k, f in zip(both, found, strict=True) for x in k[mine[f[1][mine]]].view(np.int64)])

    def know(self, words: set[str]) -> None:
        missing = words.difference(self.memo)
        if len(self.memo) + len(missing) > MEMO:
            self.memo, self.unsure, missing = {}, {}, words
        new = sorted(missing)
        for i in range(0, len(new), 20_000):
            self.learn(new[i : i + 20_000])


def evidence(ratio: np.ndarray) -> np.ndarray:
    """Log-likelihood of a word as one of a toxic text less that as one of an ordinary text, given the log-ratio of the two models."""
    return np.log(1 - TOXIC_SHARE + TOXIC_SHARE * np.exp(np.minimum(ratio, MOST_EVIDENCE)))


def likelihoods(df: DataFrame, model: Model, text: str, out: str) -> DataFrame:
    """df without `text`, with the mean evidence of its words in `out`; 0 without words."""
    sent, key = model.hot, model.key

    def make():
        held: Evidence = kept(key, lambda: Evidence(sent.value))

        def f(values):
            split = [WORD.findall((v or "").lower()) for v in values]
            held.know(set(chain.from_iterable(split)))
            memo, unsure, rows = held.memo, held.unsure, [[], [], [], []]
            for v, ws in zip(values, split, strict=True):
                open_ = Counter([w for w in ws if w in unsure]) if unsure else {}
                rows[0].append(sum([memo[w] for w in ws if w not in open_]) if open_ else sum([memo[w] for w in ws]))
                rows[1].append(len(ws))
                rows[2].append(hashlib.blake2b(v.encode(), digest_size=16).hexdigest() if open_ else None)
                rows[3].append([{"n": n, "known": unsure[w][0], "keys": unsure[w][1]} for w, n in open_.items()] if open_ else None)
            return rows

        return f

    fields = [T.StructField("__sum", T.DoubleType()), T.StructField("__n", T.LongType()), T.StructField("__text_key", T.StringType()), T.StructField("__unsure", UNSURE)]
    found = row_map(df, text, make, fields, memo=True).drop(text)
    if model.cold is None:
        rest = F.lit(0.0)
    else:
        # each text once, whatever its copies; then its open words' keys, of which none is common
        found = cut(found)
        texts = found.filter("__text_key is not null").groupBy("__text_key").agg(F.first("__unsure").alias("u"))
        open_ = texts.select("__text_key", F.posexplode("u").alias("word", "w")).select("__text_key", "word", "w.n", "w.known", F.explode("w.keys").alias("key"))
        ratios = open_.join(model.cold, "key", "left").groupBy("__text_key", "word").agg(F.first("n").alias("n"), (F.first("known") + F.coalesce(F.sum("weight"), F.lit(0.0))).alias("ratio"))
        logs = F.log(1 - TOXIC_SHARE + TOXIC_SHARE * F.exp(F.least("ratio", F.lit(MOST_EVIDENCE))))
        found = found.join(ratios.groupBy("__text_key").agg(F.sum(F.col("n") * logs).alias("__rest")), "__text_key", "left")
        rest = F.coalesce("__rest", F.lit(0.0))
    cols = [F.col(f"`{c}`") for c in df.columns if c not in (text, out)]
    return found.select(*cols, F.when(F.col("__n") > 0, (F.col("__sum") + rest) / F.col("__n")).otherwise(0.0).alias(out))


def fitted_line(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through (x, y) by Newton's method, on standardised x with a slight pull to 0; without rows of both kinds, no slope and their share."""
    if len(x) == 0 or y.min() == y.max():
        return 0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 1)))
    mean, sd = x.mean(), x.std() or 1.0
    a = np.stack([(x - mean) / sd, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (p - y) + 1e-3 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / sd), float(w[1] - w[0] * mean / sd)


def calibrating(labels: DataFrame, id_col: str = "doc_id", rows: int = CALIBRATION_ROWS) -> Column:
    """Whether a row of `labels` is one of about `rows` that fit the curve of the scores, by a digest of its id: no more than the curve needs are kept out of the counts."""
    share = min(CALIBRATION_SHARE, rows / max(1, labels.count()))
    return F.pmod(F.xxhash64(F.lit("calibration"), F.col(id_col)), F.lit(1 << 40)) < int(share * (1 << 40))


def fit(labelled: DataFrame, text: str = "text", label: str = "label", held: str = "held", hot_rows: int = HOT_ROWS, filter_bits: int = FILTER_BITS) -> Model:
    """A model of texts labelled 1 or 0. Rows where `held` is true are kept out of the counts and fit the curve of the scores; they should be no more than that needs (see calibrating).

    All other rows are counted whole. Null labels are left out, null texts are empty. Without rows the model says the same of every text.
    """
    rows_ = labelled.filter(F.col(label).isNotNull())
    grams = cut(counted_grams(rows_.filter(~F.col(held)), text, label))
    model = Model(labelled.sparkSession, cut(keyed(weights(grams))), hot_rows, filter_bits)
    scored = likelihoods(rows_.filter(held).select(text, F.col(label).cast("double").alias("y")), model, text, "x").select("x", "y").toArrow()
    model.slope, model.offset = fitted_line(scored["x"].to_numpy(), scored["y"].to_numpy())
    return model


def score_toxicity(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """df without its text but with score (0 to 1) and predicted (1 if the score is 0.5 or more, else 0).

    Null, empty and wordless texts have a likelihood ratio of 0, and the score that goes with it; equal texts have equal scores; repeated rows each keep their row; an empty df gives no rows.
    Very long texts count whole. Columns of df with the new names are replaced.
    """
    z = F.col("__ratio") * model.slope + model.offset
    scored = likelihoods(df.drop("score", "predicted"), model, text, "__ratio").withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z)))))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).drop("__ratio")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. Null and empty texts have the score of a text without evidence; null ids are not held out and have no label; repeated rows are scored each."""
    docs, labels = documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    labels = labels.filter((fold != 0) & F.col("toxic").isNotNull())
    small = labels.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    labelled = docs.filter(fold != 0).join(F.broadcast(labels) if small else labels, "doc_id").select("text", F.col("toxic").alias("label"), calibrating(labels).alias("held"))
    model = fit(labelled)
    return score_toxicity(docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text"), model)
