"""Language identification: the script of a word narrows its candidates, hashed character n-grams score it, and Viterbi with a switching penalty labels spans of a text."""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import SLICE_BYTES, code_points, documents, kept, mixed_hash, row_map, ship, slices

#: Hash buckets of n-grams: the model is a table of this many rows (fewer for hundreds of languages) and a column for each language, whatever the corpus.
BUCKETS = 1 << 16
#: Most rows of a language that the model is fitted on, chosen by a digest of their id; a language with fewer gives all.
FIT_ROWS = 10_000
#: Cells of the model and of a worker's table of words: with more languages than fit beside BUCKETS rows, there are fewer rows, a power of two.
CELLS = 1 << 25
#: What a change of language costs, in the units of a word's score, and what an n-gram weighs in it.
SWITCH, WEIGHT = 20.0, 0.3
#: Texts whose words are looked up together.
GROUP = 256
#: Words that a worker remembers; when full it starts anew.
MEMO = 150_000

#: Start of each range of code points, in order, and its script.
RANGES = [(0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, "other"), (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "other"), (0x31F0, "kana"), (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han")]
STARTS, SCRIPTS = [a for a, _ in RANGES], sorted({s for _, s in RANGES})
NUMBER = [SCRIPTS.index(s) for _, s in RANGES]


def core(word: str) -> str:
    """The word in lower case without what stands before its first letter and what is no letter or digit at its end; empty where it has no letter."""
    if word.isalpha():
        return word.lower()
    for start, c in enumerate(word):
        if c.isalpha():
            break
    else:
        return ""
    end = len(word)
    while not word[end - 1].isalnum():
        end -= 1
    return word[start:end].lower()


def scripts(words: list[str]) -> np.ndarray:
    """Number of the script of each word's first character."""
    first = code_points("".join([w[0] for w in words]))
    return np.array(NUMBER)[np.searchsorted(STARTS, first, side="right") - 1]


def rows_for(languages: int) -> int:
    """Rows of the table of n-grams."""
    rows = BUCKETS
    while rows > 1 and rows * languages > CELLS:
        rows //= 2
    return rows


def features(words: list[str], rows: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, place of the word) of the n-grams of 1 to 4 characters of each word between spaces, and of the whole word."""
    codes = code_points(" " + " ".join(words) + " ")
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])  # the space before each word
    owner = np.repeat(np.arange(len(words)), sizes + 1)
    end = (begin + sizes + 1)[owner]  # the space behind the word of each position
    at = np.arange(len(owner))
    buckets, places = [], []
    for n in (1, 2, 3, 4):
        p = at[(at + n - 1 <= end) & ((n > 1) | (at != begin[owner]))]
        buckets.append(mixed_hash([codes[p + k] for k in range(n)]) % np.uint64(rows))
        places.append(owner[p])
    buckets.append(np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % rows for w in words), dtype=np.uint64, count=len(words)))
    places.append(np.arange(len(words)))
    return np.concatenate(buckets).astype(np.int64), np.concatenate(places)


def fold(id_col: str, n: int):
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string")), F.lit(n))


class Model:
    """languages, and log-probabilities by bucket and language; allowed by script and language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.rows = len(counts) - len(SCRIPTS)
        grams, scripts = counts[: self.rows], counts[self.rows :]
        logs = np.log(grams + 0.5) - np.log(grams.sum(axis=0) + 0.5 * self.rows)
        self.logs = (WEIGHT * (logs - logs.sum(axis=1, keepdims=True) / max(1, len(languages)))).astype(np.float32)
        self.allowed = scripts > 1e-3 * scripts.sum(axis=0)


def fit(df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", rows: int = FIT_ROWS) -> Model:
    """A model of the rows whose language isn't null, at most about `rows` of each language. Null and blank texts add nothing; without any language the model has none."""
    spark = df.sparkSession
    ship(spark)
    base = df.select(F.col(f"`{text}`").alias("t"), F.col(f"`{lang}`").alias("l"), F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(1 << 20)).alias("h")).filter(F.col("l").isNotNull())
    sizes = {r["l"]: r["count"] for r in base.groupBy("l").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS + len(SCRIPTS), 0)))
    most = spark.createDataFrame([(k, int(min(1.0, rows / sizes[k]) * (1 << 20))) for k in languages], "l string, most long")
    buckets_ = rows_for(len(languages))
    width = buckets_ + len(SCRIPTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in chain.from_iterable(slices(b, 0, 4 * SLICE_BYTES) for b in batches):
            words: dict[str, Counter] = {}
            for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.setdefault(k, Counter()).update((t or "").split())
            for k, counted in words.items():
                cores: Counter = Counter()
                for w, n in counted.items():
                    cores[core(w)] += n
                cores.pop("", None)
                names, weights = list(cores), np.fromiter(cores.values(), dtype=np.float64)
                for a in range(0, len(names), 20_000):
                    part, w = names[a : a + 20_000], weights[a : a + 20_000]
                    buckets, places = features(part, buckets_)
                    x = np.bincount(buckets, weights=w[places], minlength=width)
                    x[buckets_:] += np.bincount(scripts(part), weights=w, minlength=len(SCRIPTS))
                    sums[k] = sums.get(k, 0) + x
        for k, x in sums.items():
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at)), pa.array(at), pa.array(x[at].astype(np.int64))], names=["l", "bucket", "n"])

    chosen = base.join(F.broadcast(most), "l").filter("h < most").select("t", "l")
    table = chosen.mapInArrow(run, "l string, bucket long, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((width, len(languages)))
    place = {k: i for i, k in enumerate(languages)}
    counts[table["bucket"].to_numpy(), [place[k] for k in table["l"].to_pylist()]] = table["n"].to_numpy()
    return Model(languages, counts)


class Labeller:
    """Labels whole texts by a model. Scores of words are kept in a table that grows with the words met."""

    def __init__(self, model: Model):
        self.model, self.n = model, len(model.languages)
        self.reset()

    def reset(self) -> None:
        self.raw: dict[str, int] = {}
        self.cores: dict[str, int] = {"": 0}
        self.table = np.zeros((1024, self.n), dtype=np.float32)
        self.lettered = np.zeros(1024, dtype=bool)

    def know(self, words) -> None:
        """Put all of the words into the memo. If it would be too full it starts anew, with all of them, however many they are."""
        distinct = set(words)
        missing = distinct.difference(self.raw)
        if missing and len(self.raw) + len(missing) > min(MEMO, CELLS // max(1, self.n)):
            self.reset()
            missing = distinct
        if missing:
            self.learn(missing)

    def learn(self, words: set[str]) -> None:
        new: dict[str, int] = {}
        for w in words:
            c = core(w)
            at = self.cores.get(c)
            if at is None:
                at = self.cores[c] = new[c] = len(self.cores)
            self.raw[w] = at
        if not new:
            return
        while len(self.table) < len(self.cores):
            self.table, self.lettered = np.concatenate([self.table, np.zeros_like(self.table)]), np.concatenate([self.lettered, np.zeros_like(self.lettered)])
        names = list(new)
        buckets, places = features(names, self.model.rows)
        scores = np.stack([np.bincount(places, weights=self.model.logs[buckets, k], minlength=len(names)) for k in range(self.n)], axis=1)
        allowed = self.model.allowed[scripts(names)]
        scores = np.where(allowed.any(axis=1, keepdims=True), np.where(allowed, scores, scores.min(axis=1, keepdims=True) - 30), 0)
        first = len(self.cores) - len(new)
        self.table[first : first + len(new)] = scores
        self.lettered[first : first + len(new)] = True

    def path(self, s: np.ndarray) -> np.ndarray:
        """The best sequence of languages for the words' scores, each change of language costing SWITCH.

        Gains are over the language of the best sum. A path of m changes has a first and a last stretch and m - 1 between them; it can only win if the most that a first and a last stretch
        gain exceeds one change, or a stretch between exceeds one. Where neither holds, one language is best throughout; else Viterbi decides, among the languages that gain in some stretch.
        """
        total = s.sum(axis=0, dtype=np.float64)
        best = int(total.argmax())
        gain = np.concatenate([np.zeros((1, s.shape[1])), np.cumsum(s - s[:, best : best + 1], axis=0, dtype=np.float64)])
        stretch = (gain - np.minimum.accumulate(gain, axis=0)).max(axis=0)
        if stretch.max() <= SWITCH and gain.max() + (gain[-1] - gain).max() <= SWITCH:
            return np.full(len(s), best)
        kept = sorted({best, *np.flatnonzero(stretch > 0).tolist()})
        score, back, rows = [float(x) for x in s[0, kept]], [], range(len(kept))
        for row in s[1:, kept].tolist():
            top = max(score)
            j = score.index(top)
            fresh = top - SWITCH
            back.append([i if score[i] >= fresh else j for i in rows])
            score = [max(score[i], fresh) + row[i] for i in rows]
        state = score.index(max(score))
        out = [state]
        for b in reversed(back):
            state = b[state]
            out.append(state)
        return np.array(kept)[out[::-1]]

    def label(self, text: str, words: list[str] | None = None):
        """(language, score, indexes of languages by word, sizes of words) or None where no word has a letter."""
        if not self.n:
            return None
        words = text.split() if words is None else words
        try:
            at = np.array([self.raw[w] for w in words], dtype=np.int64)
        except KeyError:
            self.know(words)
            at = np.array([self.raw[w] for w in words], dtype=np.int64)
        lettered = self.lettered[at] if len(at) else np.zeros(0, dtype=bool)
        if not lettered.any():
            return None
        s = self.table[at]
        path = self.path(s)
        sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) * lettered
        by = np.bincount(path, weights=sizes, minlength=self.n)
        best = int(by.argmax())
        total = s.sum(axis=0, dtype=np.float64) if by[best] == by.sum() else s[path == best].sum(axis=0, dtype=np.float64)
        sure = 1 / np.exp(np.minimum(total - total[best], 50)).sum()
        return self.model.languages[best], float(by[best] / by.sum() * min(1.0, sure)), path, words


def spans_of(text: str, path: np.ndarray, languages: list[str]) -> list[dict]:
    """Runs of one language: start and end (exclusive) in code points, from a run's first word to its last."""
    out: list[dict] = []
    for m, k in zip(re.finditer(r"\S+", text), path.tolist(), strict=False):
        if out and out[-1]["lang"] == languages[k]:
            out[-1]["end"] = m.end()
        else:
            out.append({"start": m.start(), "end": m.end(), "lang": languages[k]})
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())]))


def identify(df: DataFrame, model: Model, text: str = "text", spans: str | None = None) -> DataFrame:
    """df with lang_pred, the language of most of the text's letters, and score: its share of them times how sure its words are of it. With `spans`, that column has the runs of each language.

    Null, empty and letterless texts are `und` with score 0 and no runs; so are all if the model has no language. Columns with the new names are replaced.
    Very long texts count whole; repeated rows are labelled each. The model, a table of at most CELLS cells, is broadcast.
    """
    sent, key = df.sparkSession.sparkContext.broadcast(model), f"langid-{uuid.uuid4().hex}"

    def make():
        labeller = kept(key, lambda: Labeller(sent.value))

        def f(values):
            out: list[list] = [[], [], []]
            for i, v in enumerate(values):
                if i % GROUP == 0:
                    split = [(x or "").split() for x in values[i : i + GROUP]]
                    if labeller.n:
                        labeller.know(chain.from_iterable(split))
                got = labeller.label(v, split[i % GROUP]) if v else None
                out[0].append(got[0] if got else "und")
                out[1].append(got[1] if got else 0.0)
                if spans:
                    out[2].append(spans_of(v, got[2], labeller.model.languages) if got else [])
            return out if spans else out[:2]

        return f

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return row_map(df, text, make, fields + ([T.StructField(spans, SPANS)] if spans else []), memo=True)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document. Null, empty and letterless texts are `und` with score 0; null ids aren't held out and teach nothing; repeated rows are labelled each."""
    docs = documents(spark, sf_dir)
    model = fit(docs.filter(fold("doc_id", 4) != 2))
    return identify(docs.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text"), model).drop("text")
