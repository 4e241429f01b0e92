"""Queries on column layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakframe.registry import query
from peakframe.sources import files as Z
from peakframe.sources import fixtures as X
from peakframe.sources import layouts as Y
from peakframe.sources.shared import scratch, written

COLS = X.SQL_COLUMNS
_REG = ", ".join(f"('{r}', '{t}', '{f}', '{(p + o + s + '.' + f) if k == 'dotted' else (o + '_' + f)}', {repr(p + o + s + '.m') if k == 'dotted' and f == 'mass' else 'NULL'})" for r, (k, p, s, objs) in Y.SCHEMAS.items() for t, (o, fs) in objs.items() for f in fs.split())
REG = f"reg(release, ptype, field, column_name, fallback) AS (VALUES {_REG})"
_RECORDS = " ".join(f"WHEN 'record_{k}' THEN '{v}'" for k, v in Y.RECORDS.items())
_SCHEMA = f"CASE WHEN starts_with(release, 'record_') THEN CASE release {_RECORDS} END ELSE regexp_replace(release, '_mc$', '') END"
PROJ = f"""{COLS}, {REG}, fl AS (SELECT DISTINCT file, {_SCHEMA} AS release FROM cols), hv AS (SELECT DISTINCT file, column_name FROM cols),
pj0 AS (SELECT f.file, ptype, field, coalesce(h1.column_name, h2.column_name) AS column_name FROM fl f JOIN reg r ON r.release = f.release LEFT JOIN hv h1 ON h1.file = f.file AND h1.column_name = r.column_name LEFT JOIN hv h2 ON h2.file = f.file AND h2.column_name = r.fallback),
pj1 AS (SELECT * FROM pj0 WHERE column_name IS NOT NULL),
pj AS (SELECT * FROM pj1 WHERE (file, ptype) IN (SELECT (file, ptype) FROM pj1 WHERE field IN ('pt', 'eta', 'phi') GROUP BY file, ptype HAVING count(DISTINCT field) = 3))"""


@query("src_schema_project", f"WITH {PROJ} SELECT file, ptype, field, column_name FROM pj")
def src_schema_project(spark, d):
    return Y.projected(X.columns(spark, d))


@query("src_release_lookup", f"WITH {COLS}, {REG} SELECT file, f.release, {_SCHEMA.replace('release', 'f.release')} AS schema, (SELECT count(*) FROM reg WHERE reg.release = {_SCHEMA.replace('release', 'f.release')}) AS columns FROM (SELECT DISTINCT file, release FROM cols) f")
def src_release_lookup(spark, d):
    """Unknown releases have 0 columns."""
    files = X.columns(spark, d).select("file", "release").distinct().withColumn("schema", Y.schema_name(F.col("release")))
    sizes = Y.release_schema(spark).groupBy(F.col("release").alias("schema")).agg(F.count("*").alias("columns"))
    return files.join(sizes, "schema", "left").select("file", "release", "schema", F.coalesce("columns", F.lit(0)).alias("columns"))


@query("schema_join", f"WITH {COLS}, {REG} SELECT f.file, r.ptype, count(*) AS fields FROM (SELECT DISTINCT file, {_SCHEMA} AS release FROM cols) f JOIN reg r ON r.release = f.release GROUP BY ALL")
def schema_join(spark, d):
    files = X.columns(spark, d).select("file", Y.schema_name(F.col("release")).alias("release")).distinct()
    return files.join(F.broadcast(Y.release_schema(spark)), "release").groupBy("file", "ptype").agg(F.count("*").alias("fields"))


BASES = {"Jets": "patJets_slimmedJets__PAT.", "Muons": "patMuons_slimmedMuons__PAT."}
_ASKED = ", ".join(f"('{t}', '{b}', '{f}', '{i}')" for t, b in BASES.items() for f, i in Y.INDICATORS.items())


@query(
    "src_cms_paths",
    f"""WITH {COLS}, a(ptype, base, field, mark) AS (VALUES {_ASKED}),
n AS (SELECT file, ptype, field, base, mark, column_name, base || '/' || base || 'obj/' || base || 'obj.{Y.PATH}' || mark AS exact FROM cols JOIN a ON contains(column_name, base || 'obj')),
b AS (SELECT file, ptype, field, base, mark, list(column_name ORDER BY (column_name = exact)::INT DESC, length(column_name) DESC, column_name DESC) FILTER (column_name = exact OR (starts_with(column_name, base) AND contains(column_name, base || 'obj/') AND contains(column_name, mark))) AS l FROM n GROUP BY ALL),
f AS (SELECT file, ptype, field, coalesce(l[1], base || 'obj.{Y.PATH}' || mark) AS column_name FROM b)
SELECT * FROM f WHERE (file, ptype) IN (SELECT (file, ptype) FROM f WHERE field IN ('pt', 'eta', 'phi') GROUP BY file, ptype HAVING count(DISTINCT field) = 3)""",
)
def src_cms_paths(spark, d):
    return Y.nested_paths(X.columns(spark, d), BASES)


_PAT = ", ".join(f"('{t}', {i}, '{p}')" for t, ps in Y.PATTERNS.items() for i, p in enumerate(ps))


@query(
    "src_autodetect",
    f"""WITH {COLS}, pat(ptype, rank, pattern) AS (VALUES {_PAT}),
t AS (SELECT DISTINCT file, split_part(column_name, '.', 1) AS base, split_part(column_name, '.', 2) AS field FROM cols WHERE len(string_split(column_name, '.')) = 2),
b AS (SELECT file, base, list(field) AS fs FROM t GROUP BY ALL HAVING list_has_all(list(field), ['pt', 'eta', 'phi'])),
h AS (SELECT file, ptype, base, fs, row_number() OVER (PARTITION BY file, ptype ORDER BY rank, base) AS k FROM b JOIN pat ON contains(lower(base), pattern))
SELECT file, ptype, base, array_to_string(list_filter(['pt', 'eta', 'phi', 'mass'], lambda x: list_contains(fs, x)), ',') AS fields FROM h WHERE k = 1""",
)
def src_autodetect(spark, d):
    return Y.autodetected(X.columns(spark, d))


def _first_word(text: str, words: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({text}), '{w.lower()}') THEN '{w}s'" for w in words) + " END"


_RELEVANT = "array_to_string(list_filter(['pt', 'eta', 'phi', 'mass'], lambda x: list_contains(fs, x)), ',')"
_MARKS = " UNION ALL ".join(f"SELECT '{f}' AS f, '{i}' AS mark" for f, i in Y.INDICATORS.items())
_PREFIX = "CASE " + " ".join(f"WHEN contains(lower(object), '{p}') THEN {ts!r}" for p, ts in Y.PREFIXES.items()) + " END"


@query(
    "src_infer_schema",
    f"""WITH {COLS}, fg AS (SELECT file, bool_or(contains(column_name, '.')) AS dotted, bool_or(starts_with(column_name, 'pat') AND contains(column_name, '__PAT.')) AS nested FROM cols GROUP BY file),
rw AS (SELECT DISTINCT cols.file, column_name, dotted, nested FROM cols JOIN fg ON fg.file = cols.file),
n0 AS (SELECT file, column_name, regexp_extract(column_name, '^pat(.*?)__PAT\\.', 1) AS object FROM rw WHERE nested AND contains(column_name, '__PAT.')),
n1 AS (SELECT *, {_first_word('object', Y.WORDS_NESTED)} AS ptype FROM n0),
n2 AS (SELECT file, ptype, object FROM (SELECT DISTINCT file, ptype, object FROM n1 WHERE ptype IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY file, ptype ORDER BY contains(object, 'Puppi'), object) = 1),
n3 AS (SELECT n1.file, n1.ptype, n1.object, list(DISTINCT f) AS fs FROM n1 JOIN n2 ON n1.file = n2.file AND n1.ptype = n2.ptype AND n1.object = n2.object JOIN ({_MARKS}) mk ON contains(column_name, mark) GROUP BY ALL),
d0 AS (SELECT file, regexp_extract(column_name, '^(.*)\\.[^.]*$', 1) AS base, regexp_extract(column_name, '\\.([^.]*)$', 1) AS f FROM rw WHERE dotted AND NOT nested AND contains(column_name, '.')),
d1 AS (SELECT file, base, {_first_word('base', Y.WORDS)} AS ptype, list(DISTINCT f) AS fs FROM d0 GROUP BY ALL),
d2 AS (SELECT * FROM d1 WHERE ptype IS NOT NULL QUALIFY row_number() OVER (PARTITION BY file, ptype ORDER BY base) = 1),
f0 AS (SELECT file, split_part(column_name, '_', 1) AS object, list(DISTINCT split_part(column_name, '_', 2)) AS fs FROM rw WHERE NOT dotted AND contains(column_name, '_') GROUP BY ALL),
f1 AS (SELECT file, object, fs, unnest({_PREFIX}) AS ptype FROM f0 WHERE {_RELEVANT} <> ''),
f2 AS (SELECT * FROM f1 QUALIFY row_number() OVER (PARTITION BY file, ptype ORDER BY object) = 1)
SELECT file, 'dotted' AS pattern, 'pat' AS prefix, '__PAT.' AS suffix, ptype, object, {_RELEVANT} AS fields FROM n3
UNION ALL SELECT file, 'dotted', CASE WHEN starts_with(base, 'Analysis') THEN 'Analysis' ELSE '' END, CASE WHEN ends_with(base, 'AuxDyn') THEN 'AuxDyn' ELSE '' END, ptype, regexp_replace(regexp_replace(base, '^Analysis', ''), 'AuxDyn$', ''), {_RELEVANT} FROM d2 WHERE {_RELEVANT} <> ''
UNION ALL SELECT file, 'flat', '', '', ptype, object, {_RELEVANT} FROM f2""",
)
def src_infer_schema(spark, d):
    return Y.inferred(X.columns(spark, d))


@query("src_pick_table", f"""WITH {COLS}, a AS (SELECT DISTINCT file, "table" AS t FROM cols) SELECT file, coalesce(min_by(t, o), 'CollectionTree') AS "table" FROM a LEFT JOIN (VALUES ('mini', 0), ('Events', 1)) c(n, o) ON n = t GROUP BY file""")
def src_pick_table(spark, d):
    have = X.columns(spark, d).select("file", F.concat("table", F.lit(";1")).alias("table")).distinct()
    return Y.picked_table(have, ["mini", "Events"])


@query("src_accessible_cols", f"WITH {PROJ}, ok AS (SELECT * FROM pj WHERE NOT (file LIKE '%1' AND column_name LIKE '%\\_eta' ESCAPE '\\')) SELECT * FROM ok WHERE (file, ptype) IN (SELECT (file, ptype) FROM ok WHERE field IN ('pt', 'eta', 'phi') GROUP BY file, ptype HAVING count(DISTINCT field) = 3)")
def src_accessible_cols(spark, d):
    """By trial reads of a file for each customer: those whose number ends in 1 have eta columns that can't be read."""
    inventory = X.columns(spark, d)
    files = written(X.layout_files(spark, d, scratch(spark, "layouts")))
    wanted = written(Y.projected(inventory))
    # a row for each file, of a size that the planner doesn't know: never broadcast
    readable = Z.readable_columns(wanted.select("file", "column_name").distinct().join(files.hint("merge"), "file"))
    return Y.accessible(wanted, readable.join(files.hint("merge"), "path").select("file", "column_name"))


@query("required_fields_subset", f"WITH {PROJ} SELECT DISTINCT file, ptype FROM pj")
def required_fields_subset(spark, d):
    return Y.projected(X.columns(spark, d)).select("file", "ptype").distinct()


@query("object_types", f"WITH {COLS} SELECT DISTINCT file, split_part(column_name, '_', 1) AS object FROM cols WHERE NOT starts_with(column_name, 'n')")
def object_types(spark, d):
    return Y.object_types(X.columns(spark, d))


_KINDS = ["Electrons", "Muons", "Jets", "Photons", "Taus"]


def _sums(df, types):
    return df.select("event_id", *[F.size(t).cast("long").alias(f"n_{t}") for t in types], *[F.round(F.aggregate(t, F.lit(0.0), lambda a, p: a + p["pt"] + p["eta"] + p["phi"]), 3).alias(f"sum_{t}") for t in types])


def _sums_sql(types) -> str:
    return f"WITH {X.SQL_P0} SELECT event_id, " + ", ".join(f"count(*) FILTER (ptype = '{t}') AS n_{t}, round(coalesce(sum(pt + eta + phi) FILTER (ptype = '{t}'), 0), 3) AS sum_{t}" for t in types) + " FROM p0 GROUP BY event_id"


@query("src_flat_to_nested", _sums_sql(_KINDS))
def src_flat_to_nested(spark, d):
    """Through a table in the flat layout, written and read back."""
    path = scratch(spark, "flat")
    X.flat_events(spark, d).write.parquet(path)
    return _sums(Y.flat_to_nested(spark.read.parquet(path), ["event_id"]), _KINDS)


@query("src_dotted_to_nested", _sums_sql(_KINDS))
def src_dotted_to_nested(spark, d):
    objects = Y.SCHEMAS["2024r-pp"][3]
    flat = X.flat_events(spark, d)
    dotted = flat.select("event_id", *[F.col(f"{t}_{f}").alias(f"Analysis{objects[t][0]}AuxDyn.{f}") for t in _KINDS for f in Y.REQUIRED])
    return _sums(Y.dotted_to_nested(dotted, ["event_id"]), _KINDS)
