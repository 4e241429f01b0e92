"""Canonical exact digests of documents, in DataFrame functions only.

Canonical form: compatibility composition, full case folding, composition again, runs of white space as one space, none at the ends.
The fingerprint is 128 bits of xxhash of that form. Texts that share one are compared byte by byte; a second text in a bucket would get a suffix.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peakframe.llm.common import cut, documents

#: Most keys of shared buckets that are broadcast (16 bytes each); beyond it the join shuffles.
BROADCAST_KEYS = 100_000
#: Rows of a range of ids, in which neighbours are found.
RANGE_ROWS = 20_000
#: Most quantiles, and most ranges in each.
CELLS, CUTS = 256, 512


def canonical(text: Column) -> Column:
    compose = lambda x: F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(True))
    folded = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), compose(text), F.lit(True))
    plain = F.lower(text)
    # ASCII text is its own composition, and folds as it is lowered
    form = F.when(F.octet_length(text) == F.char_length(text), plain).otherwise(compose(folded))
    return F.trim(F.regexp_replace(form, r"(?U)[\s\x1c-\x1f]+", " "))


def wide_hash(form: Column) -> list[Column]:
    """Two words: the second hashes the form again from another seed."""
    return [F.xxhash64(form), F.xxhash64(F.lit("second"), form)]


def digest(high: Column, low: Column, rank: Column | None = None) -> Column:
    """32 hexadecimal digits, and the rank among different texts of the bucket unless it is the first."""
    word = F.concat(F.lpad(F.lower(F.hex(high)), 16, "0"), F.lpad(F.lower(F.hex(low)), 16, "0"))
    return word if rank is None else F.concat(word, F.when(rank > 0, F.concat(F.lit("-"), rank.cast("string"))).otherwise(""))


def hinted(keys: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """keys, to be broadcast if they are few; they must be written or checkpointed."""
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys


def collisions(forms, keys: DataFrame) -> DataFrame:
    """(h1, h2, form, rank) of all forms in buckets that hold different ones; hardly ever a row.

    forms: a function that gives h1, h2, form of the rows whose bucket is in the table it gets. keys: h1, h2 of any rows, from which buckets with more than one row are taken.
    Each bucket's least and greatest forms are compared byte by byte, combined before they are shuffled.
    """
    shared = cut(keys.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2"))
    held = forms(shared)
    bounds = held.groupBy("h1", "h2").agg(F.min("form").alias("least"), F.max("form").alias("most")).filter(F.col("least") != F.col("most"))
    clash = cut(bounds.select("h1", "h2"))
    if clash.isEmpty():
        return clash.select("h1", "h2", F.lit("").alias("form"), F.lit(0).alias("rank"))
    different = held.join(clash, ["h1", "h2"], "left_semi").distinct()
    return different.withColumn("rank", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("form")) - 1)


def fingerprint_documents(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """df with the exact fingerprint of `text` in column `out`; null texts count as empty. Rows with equal canonical texts, repeated rows too, get the same, others never do.

    Columns of df stay, but one named `out` is replaced. No bucket is gathered: copies are combined before the shuffle.
    """
    form = canonical(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    hashed = df.drop(out).withColumn("__form", form)
    a, b = wide_hash(F.col("__form"))
    hashed = hashed.withColumn("__h1", a).withColumn("__h2", b)
    forms = hashed.select(F.col("__h1").alias("h1"), F.col("__h2").alias("h2"), F.col("__form").alias("form"))
    clash = collisions(lambda shared: forms.join(hinted(shared), ["h1", "h2"], "left_semi"), forms.select("h1", "h2"))
    if clash.isEmpty():
        return hashed.withColumn(out, digest(F.col("__h1"), F.col("__h2"))).drop("__form", "__h1", "__h2")
    named = clash.select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.col("form").alias("__form"), F.col("rank").alias("__rank"))
    return hashed.join(named, ["__h1", "__h2", "__form"], "left").withColumn(out, digest(F.col("__h1"), F.col("__h2"), F.coalesce("__rank", F.lit(0)))).select(*df.drop(out).columns, out)


def with_next(df: DataFrame, id_col: str, tie: str, columns: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """df with `next`, a struct of `columns` of the row that follows in descending order of (id, tie); after the last comes the first.

    Null ids come last; `tie` is a long that spreads evenly, such as a hash. Rows are dealt by ranges: quantiles of the ids, each cut evenly, CELLS * CUTS ranges at most; an id that is a
    quantile by itself, and the null ids, are cut by their tie. The first rows of each range are also sent to the range before it, so no task sees all rows; what is collected or broadcast is a row
    for each quantile or range.
    """
    id_, tied = F.col(id_col), F.coalesce(F.col(tie), F.lit(0))
    ids = df.select(id_.alias("__k"), tied.alias("__t"))
    n, known = ids.agg(F.count("*"), F.count("__k")).first()
    if not n:
        return df.withColumn("next", F.lit(None).cast(df.select(F.struct(*columns).alias("s")).schema["s"].dataType))
    cells = min(CELLS, -(-n // range_rows))
    found = ids.agg(F.percentile_approx("__k", [i / cells for i in range(1, cells)], 20 * cells)).first()[0] if cells > 1 and known else []
    often = {x for x, y in pairwise(sorted(found)) if x == y}
    bounds = sorted(set(found) | often | {x + 1 for x in often if x < 2**63 - 1})
    # cell 0 has the greatest ids: a row's cell is how many bounds exceed its id; behind the last come nulls
    cell_of = lambda k: F.when(k.isNull(), len(bounds) + 1).otherwise(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b > k)) if bounds else F.lit(0))
    held = {r["c"]: r for r in ids.groupBy(cell_of(F.col("__k")).alias("c")).agg(F.min("__k").alias("lo"), F.max("__k").alias("hi"), F.count("*").alias("n")).collect()}
    each = [held.get(c) for c in range(len(bounds) + 2)]
    cuts = [min(CUTS, -(-r["n"] // range_rows)) if r else 1 for r in each]
    by_tie = [r is None or r["lo"] is None or r["lo"] == r["hi"] for r in each]
    tops = F.array(*[F.lit(2.0**63 if t else float(r["hi"])) for r, t in zip(each, by_tie, strict=True)])
    steps = F.array(*[F.lit((2.0**64 if t else float(r["hi"]) - float(r["lo"])) / m) for r, t, m in zip(each, by_tie, cuts, strict=True)])
    last, tie_kept = F.array(*[F.lit(m - 1) for m in cuts]), F.array(*map(F.lit, by_tie))
    at = F.col("__c") + 1

    def ranged(d: DataFrame, k, t) -> DataFrame:
        """d with its range __r, and __o, the id or the tie, by which rows of the range are told apart."""
        placed = d.withColumn("__c", cell_of(k)).withColumn("__o", F.when(F.element_at(tie_kept, at), t).otherwise(k))
        place = F.greatest(F.lit(0), F.least(F.floor((F.element_at(tops, at) - F.col("__o").cast("double")) / F.element_at(steps, at)), F.element_at(last, at)))
        return placed.withColumn("__r", (F.col("__c") * CUTS + place).cast("int")).drop("__c")

    heads = cut(ranged(ids, F.col("__k"), F.col("__t")).groupBy("__r").agg(F.max("__o").alias("__o")))  # a row for each range
    before = F.coalesce(F.lag("__r").over(Window.orderBy("__r")), F.max("__r").over(Window.partitionBy()))  # the first head goes to the last range
    marked = ranged(df, id_, tied).join(F.broadcast(heads.withColumn("__b", before)), ["__r", "__o"], "left")
    # in a range: its own rows, then the copies of the next range's head
    own = F.struct(F.lit(0).alias("copy"), F.col("__r").alias("r"))
    copies = F.when(F.col("__b").isNotNull(), F.array(own, F.struct(F.lit(1).alias("copy"), F.col("__b").alias("r")))).otherwise(F.array(own))
    dealt = marked.withColumn("__d", F.explode(copies)).repartition(F.col("__d.r"))
    w = Window.partitionBy("__d.r").orderBy("__d.copy", F.desc("__o"), F.desc_nulls_last(tie))
    return dealt.withColumn("next", F.lead(F.struct(*columns)).over(w)).filter("__d.copy = 0").drop("__o", "__r", "__b", "__d")


def edited_form(text: Column, following: Column) -> Column:
    """The text with the last half of its code points replaced by the first as many (or all) of the following one."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the fingerprints of every document and of its edited text. Null texts are empty; null ids come last; rows of one id follow by a hash of their text; repeated rows each keep their row; an empty table gives no rows."""
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = with_next(docs, "doc_id", "tie", ["doc_id", "tie", "text"])
    rows = rows.select("doc_id", "tie", "text", edited_form(F.col("text"), F.col("next.text")).alias("edited"), F.col("next.doc_id").alias("next_id"), F.col("next.tie").alias("next_tie"))
    own, new = wide_hash(F.col("form")), wide_hash(F.col("edited_form"))
    formed = rows.select("*", canonical(F.col("text")).alias("form"), canonical(F.col("edited")).alias("edited_form"))
    narrow = cut(
        formed.select(
            "doc_id", "tie", "next_id", "next_tie", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
            own[0].alias("h1"), own[1].alias("h2"), new[0].alias("e1"), new[1].alias("e2"), F.sha2("form", 256).alias("s"), F.sha2("edited_form", 256).alias("es"),
        )
    )
    keys = narrow.select("h1", "h2").unionAll(narrow.select("e1", "e2"))
    clash = collisions(lambda shared: shared_forms(docs, narrow, shared), keys)
    if clash.isEmpty():
        prints = narrow.select("*", digest(F.col("h1"), F.col("h2")).alias("fingerprint"), digest(F.col("e1"), F.col("e2")).alias("edited_fingerprint"))
    else:
        ranks = clash.select("h1", "h2", F.sha2("form", 256).alias("s"), "rank")
        prints = narrow.join(ranks, ["h1", "h2", "s"], "left").join(ranks.toDF("e1", "e2", "es", "edited_rank"), ["e1", "e2", "es"], "left")
        zero = lambda x: F.coalesce(x, F.lit(0))
        prints = prints.select("*", digest(F.col("h1"), F.col("h2"), zero("rank")).alias("fingerprint"), digest(F.col("e1"), F.col("e2"), zero("edited_rank")).alias("edited_fingerprint"))
    prints = prints.select("doc_id", "tie", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
    same = lambda other: (F.col("fingerprint") == F.col(other)).cast("double")
    return with_next(prints, "doc_id", "tie", ["fingerprint"]).select("*", same("edited_fingerprint").alias("near_edited"), same("next.fingerprint").alias("near_next")).drop("next", "tie")


def shared_forms(docs: DataFrame, narrow: DataFrame, shared: DataFrame) -> DataFrame:
    """h1, h2 and form of the documents and edited texts whose hashes are in `shared`. Only texts that these are made of are moved."""
    owners = narrow.join(hinted(shared), ["h1", "h2"], "left_semi").select("doc_id", "tie").distinct()
    edits = narrow.join(hinted(shared.toDF("e1", "e2")), ["e1", "e2"], "left_semi").select("doc_id", "tie", "next_id", "next_tie").distinct()
    wanted = cut(owners.unionAll(edits.select("doc_id", "tie")).unionAll(edits.select("next_id", "next_tie")).distinct())
    texts = cut(docs.join(hinted(wanted), ["doc_id", "tie"], "left_semi").dropDuplicates(["doc_id", "tie"]))
    after = texts.select(F.col("doc_id").alias("next_id"), F.col("tie").alias("next_tie"), F.col("text").alias("next_text"))
    bodies = owners.join(texts, ["doc_id", "tie"]).select("text").unionAll(edits.join(texts, ["doc_id", "tie"]).join(after, ["next_id", "next_tie"]).select(edited_form(F.col("text"), F.col("next_text"))))
    a, b = wide_hash(F.col("form"))
    return bodies.select(canonical(F.col("text")).alias("form")).select(a.alias("h1"), b.alias("h2"), "form")
