"""Column layouts of event files: release schemas, their look-up, and the nested form. Layouts are resolved for many files at once, on a column inventory (file, release, table, column_name)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The schemas of the releases. (pattern, prefix, suffix, {type: (object, fields)})
_ISO = "ptvarcone30_Nonprompt_All_MaxWeightTTVALooseCone_pt1000"
_PHYS = ("dotted", "Analysis", "AuxDyn", {"Electrons": ("Electrons", f"pt eta phi mass {_ISO}"), "Muons": ("Muons", "pt eta phi mass"), "Jets": ("Jets", "pt eta phi mass"), "Photons": ("Photons", "pt eta phi"), "Taus": ("TauJets", "pt eta phi mass")})
SCHEMAS = {
    "2024r-pp": _PHYS,
    "cms-nanoaod": ("flat", "", "", {"Electrons": ("Electron", "pt eta phi mass"), "Muons": ("Muon", "pt eta phi mass"), "Jets": ("Jet", "pt eta phi mass btagDeepFlavB"), "Photons": ("Photon", "pt eta phi mass"), "Taus": ("Tau", "pt eta phi mass charge decayMode idDeepTau2017v2p1VSjet")}),
    "2024r-hi": ("dotted", "", "AuxDyn", {"Muons": ("Muons", "pt eta phi mass")}),
    "2020e-13tev": _PHYS,
    "2016e-8tev": ("flat", "", "", {"Electrons": ("lep", "pt eta phi"), "Muons": ("lep", "pt eta phi"), "Jets": ("jet", "pt eta phi mass")}),
    "2025e-13tev-beta": ("flat", "", "", {"Electrons": ("lep", "pt eta phi"), "Muons": ("lep", "pt eta phi"), "Jets": ("jet", "pt eta phi"), "Photons": ("photon", "pt eta phi"), "Taus": ("tau", "pt eta phi")}),
    "2025r-evgen-13tev": _PHYS,
    "2025r-evgen-13p6tev": _PHYS,
}
RECORDS = {30529: "cms-nanoaod", 30562: "cms-nanoaod", 30530: "cms-nanoaod", 30563: "cms-nanoaod"}
REQUIRED = ["pt", "eta", "phi"]
INDICATORS = {"pt": "fPt", "eta": "fEta", "phi": "fPhi", "mass": "fM"}
PATH = "m_state.p4Polar_.fCoordinates."
PATTERNS = {"Electrons": ["electron", "el"], "Muons": ["muon", "mu"], "Jets": ["jet"], "Photons": ["photon", "gamma"], "Taus": ["tau"]}
PREFIXES = {"lep": ["Electrons", "Muons"], "electron": ["Electrons"], "muon": ["Muons"], "jet": ["Jets"], "photon": ["Photons"], "tau": ["Taus"]}
WORDS = ["Electron", "Muon", "Jet", "Photon", "Tau"]
WORDS_NESTED = ["Electron", "Muon", "Photon", "Jet", "Tau"]


def release_schema(spark: SparkSession) -> DataFrame:
    """release, ptype, field, column_name, fallback: a row for each column that a release asks for."""
    rows = []
    for release, (pattern, prefix, suffix, objects) in SCHEMAS.items():
        for t, (obj, fields) in objects.items():
            for f in fields.split():
                base = f"{prefix}{obj}{suffix}"
                rows.append((release, t, f, f"{base}.{f}" if pattern == "dotted" else f"{obj}_{f}", f"{base}.m" if pattern == "dotted" and f == "mass" else None))
    return spark.createDataFrame(rows, "release string, ptype string, field string, column_name string, fallback string")


def schema_name(release: Column) -> Column:
    """The schema that a release goes by: `_mc` is cut off, `record_N` is looked up (null if unknown)."""
    known = F.create_map(*[F.lit(x) for r, s in RECORDS.items() for x in (f"record_{r}", s)])
    return F.when(release.startswith("record_"), F.element_at(known, F.regexp_extract(release, r"^(record_\d+)", 1))).otherwise(F.regexp_replace(release, "_mc$", ""))


def releases_known(spark: SparkSession) -> DataFrame:
    return release_schema(spark).select("release").distinct()


def complete(found: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of collections that have all of pt, eta and phi. A collection has a bounded number of rows, which come together once; there is no join that the planner could take for a small one."""
    rest = [c for c in found.columns if c not in keys]
    held = found.dropna(subset=keys).groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("__rows"))
    whole = F.forall(F.array(*map(F.lit, REQUIRED)), lambda f: F.exists("__rows", lambda r: r["field"] == f))
    return held.filter(whole).select(*keys, F.inline("__rows")).select(*found.columns)


def projected(inventory: DataFrame) -> DataFrame:
    """file, ptype, field, column_name that each file's release schema finds in it; mass may be named m in dotted layouts.

    The columns of a file, of which there are a bounded number, come together in one row, and schemas are broadcast: nothing else is joined.
    """
    spark = inventory.sparkSession
    asked = release_schema(spark).groupBy("release").agg(F.collect_list(F.struct("ptype", "field", "column_name", "fallback")).alias("asked"))
    files = inventory.filter("file IS NOT NULL").groupBy("file").agg(F.collect_set(schema_name(F.col("release"))).alias("releases"), F.collect_set("column_name").alias("have"))
    each = files.select("file", "have", F.explode("releases").alias("release")).join(F.broadcast(asked), "release").select("file", "have", F.inline("asked"))
    name = F.when(F.array_contains("have", F.col("column_name")), F.col("column_name")).when(F.array_contains("have", F.col("fallback")), F.col("fallback"))
    return complete(each.select("file", "ptype", "field", name.alias("column_name")).filter("column_name IS NOT NULL"), ["file", "ptype"])


def nested_paths(inventory: DataFrame, objects: dict[str, str]) -> DataFrame:
    """file, ptype, field, column_name for nested layouts; objects: type to base name. The exact path, else the longest column of the object that has the field's mark, else a made-up one."""
    spark = inventory.sparkSession
    rows = [(t, b, f, i, f"{b}/{b}obj/{b}obj.{PATH}{i}", f"{b}obj.{PATH}{i}") for t, b in objects.items() for f, i in INDICATORS.items()]
    asked = F.broadcast(spark.createDataFrame(rows, "ptype string, base string, field string, mark string, exact string, made string"))
    have = inventory.select("file", "column_name").distinct()
    near = have.join(asked, F.contains("column_name", F.concat("base", F.lit("obj"))))
    exact = F.col("column_name") == F.col("exact")
    fit = exact | (F.startswith("column_name", "base") & F.contains("column_name", F.concat("base", F.lit("obj/"))) & F.contains("column_name", "mark"))
    best = F.max_by(F.when(fit, F.col("column_name")), F.when(fit, F.struct(exact.cast("int"), F.length("column_name"), F.col("column_name"))))
    return complete(near.groupBy("file", "ptype", "field", "made").agg(best.alias("best")).select("file", "ptype", "field", F.coalesce("best", "made").alias("column_name")), ["file", "ptype"])


def autodetected(inventory: DataFrame) -> DataFrame:
    """file, ptype, base, fields of unknown layouts: the first pattern of a type that names a base `x` with x.pt, x.eta and x.phi; of several bases the first by name."""
    spark = inventory.sparkSession
    parts = F.split("column_name", "\\.")
    two = inventory.filter(F.size(parts) == 2).select("file", parts[0].alias("base"), parts[1].alias("field")).distinct()
    bases = two.groupBy("file", "base").agg(F.array_sort(F.collect_set("field")).alias("fields")).filter(F.forall(F.array(*map(F.lit, REQUIRED)), lambda r: F.array_contains("fields", r)))
    patterns = F.broadcast(spark.createDataFrame([(t, i, p) for t, ps in PATTERNS.items() for i, p in enumerate(ps)], "ptype string, rank int, pattern string"))
    hits = bases.join(patterns, F.contains(F.lower("base"), F.col("pattern")))
    first = hits.groupBy("file", "ptype").agg(F.min(F.struct("rank", "base", "fields")).alias("b"))
    return first.select("file", "ptype", F.col("b.base").alias("base"), F.array_join(F.array_intersect(F.array(*map(F.lit, [*REQUIRED, "mass"])), "b.fields"), ",").alias("fields"))


def first_word(text: Column, words: list[str], plural: str = "s") -> Column:
    """Type of the first word that stands in the text, whatever the case."""
    out = F.when(F.lit(False), "")
    for w in words:
        out = out.when(F.contains(F.lower(text), F.lit(w.lower())), w + plural)
    return out


def inferred(inventory: DataFrame) -> DataFrame:
    """file, pattern, prefix, suffix, ptype, object, fields from column names alone. Of several objects the least name counts, a nested one without Puppi first. The columns of a file come together once; all that follows is by file."""
    col = F.col("column_name")
    files = inventory.filter("file IS NOT NULL").groupBy("file").agg(F.collect_set("column_name").alias("have"))
    flags = files.select("file", "have", F.exists("have", lambda c: F.contains(c, F.lit("."))).alias("dotted"), F.exists("have", lambda c: c.startswith("pat") & F.contains(c, F.lit("__PAT."))).alias("nested"))
    rows = flags.select("file", "dotted", "nested", F.explode("have").alias("column_name"))
    relevant = lambda f: F.array_join(F.array_intersect(F.array(*[F.lit(x) for x in (*REQUIRED, "mass")]), f), ",")
    # nested: pat{object}__PAT.
    inner = F.regexp_extract(col, r"^pat(.*?)__PAT\.", 1)
    nested = rows.filter(F.col("nested") & F.contains(col, F.lit("__PAT."))).select("file", inner.alias("object"), first_word(inner, WORDS_NESTED).alias("ptype"), col.alias("c"))
    marks = F.array_compact(F.array(*[F.when(F.contains("c", F.lit(i)), f) for f, i in INDICATORS.items()]))
    objects = nested.filter("ptype is not null").groupBy("file", "ptype", "object").agg(F.array_distinct(F.flatten(F.collect_set(marks))).alias("fs"))
    best = objects.groupBy("file", "ptype").agg(F.min(F.struct(F.contains("object", F.lit("Puppi")).alias("p"), "object", "fs")).alias("b"))
    got = best.select("file", "ptype", "b.object", "b.fs").filter(F.size("fs") > 0)
    a = got.select("file", F.lit("dotted").alias("pattern"), F.lit("pat").alias("prefix"), F.lit("__PAT.").alias("suffix"), "ptype", "object", relevant("fs").alias("fields"))
    # dotted: {Analysis}{object}{AuxDyn}.{field}
    base, field = F.regexp_extract(col, r"^(.*)\.[^.]*$", 1), F.regexp_extract(col, r"\.([^.]*)$", 1)
    dotted = rows.filter(F.col("dotted") & ~F.col("nested") & F.contains(col, F.lit("."))).select("file", base.alias("base"), field.alias("f")).withColumn("ptype", first_word(F.col("base"), WORDS)).filter("ptype is not null")
    each = dotted.groupBy("file", "ptype", "base").agg(F.collect_set("f").alias("fs"))
    each = each.groupBy("file", "ptype").agg(F.min(F.struct("base", "fs")).alias("b")).select("file", "ptype", "b.*")
    obj = F.regexp_replace(F.regexp_replace("base", "^Analysis", ""), "AuxDyn$", "")
    b = each.select("file", F.lit("dotted").alias("pattern"), F.when(F.col("base").startswith("Analysis"), "Analysis").otherwise("").alias("prefix"), F.when(F.col("base").endswith("AuxDyn"), "AuxDyn").otherwise("").alias("suffix"), "ptype", obj.alias("object"), relevant("fs").alias("fields")).filter("fields <> ''")
    # flat: {object}_{field}
    parts = F.split(col, "_")
    flat = rows.filter(~F.col("dotted") & F.contains(col, F.lit("_"))).select("file", parts[0].alias("object"), parts[1].alias("f"))
    types = F.when(F.lit(False), F.array().cast("array<string>"))
    for p, ts in PREFIXES.items():
        types = types.when(F.contains(F.lower("object"), F.lit(p)), F.array(*map(F.lit, ts)))
    flat = flat.groupBy("file", "object").agg(F.collect_set("f").alias("fs")).withColumn("ptype", F.explode(types)).filter(relevant("fs") != "")
    flat = flat.groupBy("file", "ptype").agg(F.min(F.struct("object", "fs")).alias("b")).select("file", "ptype", "b.*")
    c = flat.select("file", F.lit("flat").alias("pattern"), F.lit("").alias("prefix"), F.lit("").alias("suffix"), "ptype", "object", relevant("fs").alias("fields"))
    return a.unionByName(b).unionByName(c)


def picked_table(available: DataFrame, candidates: list[str], default: str = "CollectionTree") -> DataFrame:
    """file, table: the first candidate that the file has (names may end in `;1`), else the default."""
    spark = available.sparkSession
    asked = F.broadcast(spark.createDataFrame(list(enumerate(candidates)), "ordinal int, t string"))
    names = available.select("file", F.regexp_replace("table", ";1$", "").alias("t")).distinct()
    return names.join(asked, "t", "left").groupBy("file").agg(F.coalesce(F.min_by("t", F.col("ordinal")), F.lit(default)).alias("table"))


def accessible(wanted: DataFrame, readable: DataFrame) -> DataFrame:
    """Rows of wanted (file, ptype, field, column_name) that are readable (file, column_name) and whose collection is still complete."""
    return complete(wanted.join(readable.hint("merge"), ["file", "column_name"], "left_semi"), ["file", "ptype"])


def object_types(inventory: DataFrame) -> DataFrame:
    """file, object: names before the first underscore, without counters (n...)."""
    return inventory.filter(~F.col("column_name").startswith("n")).select("file", F.split("column_name", "_")[0].alias("object")).distinct()


def flat_to_nested(df: DataFrame, keep: list[str]) -> DataFrame:
    """Columns n{T}, {T}_{field} to arrays of structs {T}; which there are is read off the names."""
    types = [c[1:] for c in df.columns if c.startswith("n") and any(x.startswith(f"{c[1:]}_") for x in df.columns)]
    return df.select(*keep, *[zipped(df, t, f"{t}_", sep="_") for t in types])


def zipped(df: DataFrame, out: str, prefix: str, sep: str) -> Column:
    fields = [c[len(prefix) :] for c in df.columns if c.startswith(prefix)]
    arrays = F.arrays_zip(*[F.col(f"`{prefix}{f}`").alias(f) for f in fields])
    names = [f"{prefix}{f}" for f in fields]
    return F.transform(arrays, lambda p: F.struct(*[p[f].alias(f) for f in fields])).alias(out) if names else F.lit(None).alias(out)


def dotted_to_nested(df: DataFrame, keep: list[str], release: str = "2024r-pp") -> DataFrame:
    """Columns like `AnalysisElectronsAuxDyn.pt` to arrays of structs of pt, eta and phi."""
    _, prefix, suffix, objects = SCHEMAS[release]
    out = []
    for t, (obj, _) in objects.items():
        base = f"{prefix}{obj}{suffix}"
        if all(f"{base}.{f}" in df.columns for f in REQUIRED):
            out.append(F.transform(F.arrays_zip(*[F.col(f"`{base}.{f}`").alias(f) for f in REQUIRED]), lambda p: F.struct(*[p[f].alias(f) for f in REQUIRED])).alias(t))
    return df.select(*keep, *out)


