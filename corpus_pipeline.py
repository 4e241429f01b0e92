"""From documents to packed training sequences: language, near-duplicates, secrets, mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakframe.llm import langid, mixing, near_copies, packing, secrets
from peakframe.llm.common import documents, scratch

#: A document stays if its language is known and its score is at least this; a text half in one language, half in another has about 0.5.
LEAST_SCORE = 0.3


def apart(docs: DataFrame) -> tuple[DataFrame, list]:
    """docs with names of its columns that no stage makes, doc_id, text, lang and n_chars apart, and what gives them back."""
    plain = ("doc_id", "text", "lang", "n_chars")
    names = {c: c if c in plain else f"__own{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(x) for c, x in names.items()]), [F.col(x).alias(c) for c, x in names.items()]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of no language (null, empty or letterless texts) and those that no language fits. The model learns from the documents that have a lang.

    Very long texts count whole; repeated rows are judged each, alike; columns named like those of the model keep their values; an empty table stays empty.
    """
    model = langid.fit(docs.filter(langid.fold("doc_id", 4) != 2))
    named, back = apart(docs)
    marked = langid.identify(named.withColumn("__text", F.col("text")), model, "__text")
    return marked.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group linked by a Jaccard similarity of 0.8 or more of five-word shingles.

    Null, empty and blank texts are copies of each other; null ids come last; of repeated rows one stays; texts count whole; an empty table stays empty.
    """
    named, back = apart(docs)
    return near_copies.one_of_each(named).select(*back)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each secret, or the encoded stretch that hides it or is too long to be opened whole, by a mark; n_chars follows. No document goes.

    Null and empty texts stay as they are; repeated rows change alike; very long texts are scanned whole; columns named like those of the scan keep their values; an empty table stays empty.
    """
    named, back = apart(docs)
    clean = secrets.scan_secrets(named.withColumn("__text", F.col("text")), "__text", redacted="__clean")
    changed = (F.size("secret_spans") > 0) | F.col("truncated")
    new = {"text": F.col("__clean")} | ({"n_chars": F.when(changed, F.char_length("__clean").cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
    return clean.withColumns(new).select(*back)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the documents of the mix: none, one or two whole copies of each. Documents without words aren't in it; null sources are one source; repeated rows are taken together; an empty table stays empty."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in the training sequences. Null and empty texts are the end id alone; repeated rows are packed each; an empty table gives no rows."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_to_target_weights", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Character models, SimHash, decoding and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over `documents`; each stage before it is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
