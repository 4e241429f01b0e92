"""Queries on events: cuts, final states, combinations, masses and their cleaning. The SQL works on exploded particles, another way to the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peakframe.functions import labels as L
from peakframe.operators import mass as M
from peakframe.operators import selection as S
from peakframe.operators import spectra as P
from peakframe.operators.matching import at_least, matching
from peakframe.registry import query
from peakframe.sources import fixtures as X
from peakframe.sources.shared import written

TYPES = L.FS_ORDER
COMBO = {"Electrons": (1, 0), "Muons": (1, 0)}


# --- SQL parts -------------------------------------------------------------------------------------------------------
def _cut(alias: str = "") -> str:
    cases = " ".join(f"WHEN '{t}' THEN pt >= {c['pt_min']} AND eta BETWEEN -{c['eta_max']}::DOUBLE AND {c['eta_max']}::DOUBLE" for t, c in S.DEFAULT_CUTS.items())
    return f"CASE ptype {cases} END AND phi BETWEEN -pi() AND pi()"


SQL_P = X.SQL_P0 + ",\np AS (SELECT * REPLACE (CASE WHEN ptype = 'Jets' AND btag >= 0.5 THEN 'BJets' ELSE ptype END AS ptype) FROM p0)"
SQL_K = SQL_P + f",\nk AS (SELECT * FROM p WHERE {_cut()})"
_COUNTS = ", ".join(f"count(*) FILTER (k.ptype = '{t}') AS c_{t}" for t in TYPES)
SQL_C = SQL_K + f",\nc AS (SELECT e.event_id, {_COUNTS} FROM (SELECT DISTINCT event_id FROM p) e LEFT JOIN k ON k.event_id = e.event_id GROUP BY e.event_id)"
_LABEL = " || '_' || ".join(f"least(c_{t}, 4) || '{L.LETTERS[t]}'" for t in TYPES)
_RAW_LABEL = " || '_' || ".join(f"c_{t} || '{L.LETTERS[t]}'" for t in TYPES)
_PRESENT = " + ".join(f"(c_{t} > 0)::INT" for t in TYPES)
SQL_V = SQL_C + f",\nv AS (SELECT *, {_LABEL} AS fs, 'f' || (event_id % 4) AS source_file FROM c WHERE ({_PRESENT}) BETWEEN 2 AND 4 AND {' AND '.join(f'c_{t} <= 4' for t in TYPES)})"
SQL_F = SQL_V + f",\nf AS (SELECT fs, count(*) AS n FROM v GROUP BY fs HAVING count(*) >= {M.MIN_EVENTS})"


def sql_combos(types=TYPES, types_range=(1, 4), count_range=(1, 4), most=4, subleading=None) -> str:
    """CTEs g (n_T) and combos (n_T, s_T, im)."""
    counts = ", ".join(f"(SELECT unnest([0, {', '.join(map(str, range(count_range[0], count_range[1] + 1)))}]) AS n_{t}) q{t}" for t in types)
    size, present = " + ".join(f"n_{t}" for t in types), " + ".join(f"(n_{t} > 0)::INT" for t in types)
    g = f"g AS (SELECT * FROM {counts} WHERE ({size}) BETWEEN 2 AND {most} AND ({present}) BETWEEN {types_range[0]} AND {types_range[1]})"
    if subleading is None:
        starts = "g0 AS (SELECT *, " + ", ".join(f"0 AS s_{t}" for t in types) + " FROM g)"
    else:
        starts = "g0 AS (SELECT * FROM g" + "".join(f", LATERAL (SELECT unnest(range(0, CASE WHEN n_{t} > 0 THEN greatest(0, {subleading} - n_{t} + 1) ELSE 0 END + 1)) AS s_{t}) u{t}" for t in types) + ")"
    im = " || ".join(f"array_to_string(list_transform(range(s_{t}, s_{t} + n_{t}), lambda i: '{L.LETTERS[t]}' || i), '')" for t in L.IM_ORDER if t in types)
    return f"{g},\n{starts},\ncombos AS (SELECT *, {im} AS im FROM g0)"


_FITS = " AND ".join(f"(n_{t} = 0 OR CASE WHEN s_{t} = 0 THEN c_{t} = n_{t} ELSE c_{t} >= s_{t} + n_{t} END)" for t in TYPES)
_CONTAINS = " AND ".join(f"(n_{t} = 0 OR c_{t} >= s_{t} + n_{t})" for t in TYPES)
_N = "CASE r.ptype " + " ".join(f"WHEN '{t}' THEN n_{t}" for t in TYPES) + " END"
_S = "CASE r.ptype " + " ".join(f"WHEN '{t}' THEN s_{t}" for t in TYPES) + " END"
_M0 = "CASE ptype " + " ".join(f"WHEN '{t}' THEN {m}::DOUBLE" for t, m in L.REST_MASS.items()) + " END"
SQL_R = f",\nr AS (SELECT *, row_number() OVER (PARTITION BY event_id, ptype ORDER BY pt DESC, eta DESC, phi DESC) - 1 AS rk, pt*cos(phi) AS px, pt*sin(phi) AS py, pt*sinh(eta) AS pz, sqrt(power(pt*cosh(eta), 2) + power({_M0}, 2)) AS e FROM k)"
_SQUARE = "power(sum(e),2)-power(sum(px),2)-power(sum(py),2)-power(sum(pz),2)"


def sql_masses(subleading=None) -> str:
    """CTEs up to mass(fs, im, source_file, event_id, m)."""
    return (
        SQL_F + SQL_R + ",\n" + sql_combos(types_range=(2, 4), subleading=subleading) + f",\nec AS (SELECT v.*, combos.* FROM v SEMI JOIN f ON f.fs = v.fs JOIN combos ON {_FITS})"
        + f",\nmass0 AS (SELECT ec.fs, ec.im, ec.source_file, ec.event_id, round(sign({_SQUARE})*sqrt(abs({_SQUARE}))*0.001::DOUBLE, 6) + 0.0 AS m FROM ec JOIN r ON r.event_id = ec.event_id AND r.rk >= {_S} AND r.rk < {_S} + {_N} GROUP BY ALL)"
        + ",\nmass AS (SELECT * FROM mass0 WHERE (fs, im) IN (SELECT (fs, im) FROM mass0 WHERE m <> 0))"
    )


def sql_bins(name: str, source: str, width: float = P.WIDTH) -> str:
    """CTEs {name}r (lo, hi, nb by fs, im) and {name}b (fs, im, lo, hi, nb, bin, cnt)."""
    edge = lambda i: f"CASE WHEN ({i}) >= nb THEN hi ELSE lo + ({i}) * ((hi - lo) / nb) END"
    return f"""{name}r AS (SELECT fs, im, min(m) AS lo, max(m) AS hi, ceil((max(m) - min(m)) / {width}::DOUBLE)::BIGINT AS nb FROM {source} GROUP BY fs, im),
{name}g AS (SELECT s.fs, s.im, lo, hi, nb, m, least(floor((m - lo) / ((hi - lo) / nb)), nb - 1)::BIGINT AS g FROM {source} s JOIN {name}r USING (fs, im) WHERE nb > 0 AND hi > lo),
{name}b AS (SELECT fs, im, lo, hi, nb, CASE WHEN m < {edge("g")} THEN g - 1 WHEN g < nb - 1 AND m >= {edge("g + 1")} THEN g + 1 ELSE g END AS bin, count(*) AS cnt FROM {name}g GROUP BY ALL)"""


_EDGE = "CASE WHEN {i} >= nb THEN hi ELSE lo + {i} * ((hi - lo) / nb) END"
SQL_PEAK = "pk AS (SELECT fs, im, peak_bin, peak_cnt, " + _EDGE.format(i="peak_bin") + " AS peak FROM (SELECT fs, im, lo, hi, nb, max(ROW(cnt, bin)) AS t, t[2] AS peak_bin, t[1] AS peak_cnt FROM ab GROUP BY fs, im, lo, hi, nb))"
SQL_CUT = sql_masses() + ",\n" + sql_bins("a", "mass") + ",\n" + SQL_PEAK + ",\nkept AS (SELECT mass.* FROM mass LEFT JOIN pk USING (fs, im) WHERE peak IS NULL OR m >= peak)"
SQL_GAP = sql_bins("b", "kept") + ",\nst AS (SELECT *, lead(bin) OVER (PARTITION BY fs, im ORDER BY bin) - bin AS step FROM bb),\ngp AS (SELECT fs, im, gap_bin, " + _EDGE.format(i="gap_bin") + " AS gap FROM (SELECT fs, im, lo, hi, nb, min(bin) + 1 AS gap_bin FROM st WHERE step > 1 GROUP BY ALL))"
SQL_SPLIT = SQL_CUT + ",\n" + SQL_GAP + ",\nparts AS (SELECT kept.*, CASE WHEN m >= gap THEN 'outliers' ELSE 'main' END AS part FROM kept LEFT JOIN (SELECT * FROM gp WHERE gap_bin > 1) gg USING (fs, im))"


# --- shared plans ----------------------------------------------------------------------------------------------------
def split_events(spark: SparkSession, d: str) -> DataFrame:
    return S.btag_split(X.events(spark, d))


def cut_events(spark: SparkSession, d: str) -> DataFrame:
    return S.kinematic_cuts(split_events(spark, d), S.DEFAULT_CUTS)


def combos(spark: SparkSession, **more) -> DataFrame:
    """Two to four types, as in the default settings."""
    return M.combinations(spark, TYPES, **({"types_range": (2, 4)} | more))


def masses(spark: SparkSession, d: str) -> DataFrame:
    """The mass table, which most queries read several times: mass_spectrum has written it."""
    return M.mass_spectrum(cut_events(spark, d), combos(spark))


def counted(df: DataFrame) -> DataFrame:
    """Numbers of particles and their momentum by event, the form in which selections are compared."""
    there = [t for t in TYPES if t in df.columns]
    sums = [F.round(F.aggregate(t, F.lit(0.0), lambda a, p: a + p["pt"]), 2).alias(f"pt_{t}") for t in there]
    return df.select("event_id", *[F.size(t).cast("long").alias(f"c_{t}") for t in there], *sums)


def typed(df: DataFrame, value) -> DataFrame:
    """A row x(ptype, value(particle, type)) for each particle."""

    def of(t: str):
        return lambda p: F.struct(F.lit(t).alias("ptype"), value(p, t))

    return df.select(F.explode(F.concat(*[F.transform(t, of(t)) for t in TYPES])).alias("x"))


def _counted_sql(source: str, where: str = "", types=TYPES, base: str = "p") -> str:
    cols = ", ".join(f"count(*) FILTER (s.ptype = '{t}') AS c_{t}" for t in types) + ", " + ", ".join(f"round(coalesce(sum(s.pt) FILTER (s.ptype = '{t}'), 0), 2) AS pt_{t}" for t in types)
    return f"SELECT e.event_id, {cols} FROM (SELECT DISTINCT event_id FROM {base}) e LEFT JOIN {source} s ON s.event_id = e.event_id GROUP BY e.event_id {where}"


# --- cuts ------------------------------------------------------------------------------------------------------------
@query("btag_split", f"WITH {SQL_P} {_counted_sql('p')}")
def btag_split(spark, d):
    return counted(split_events(spark, d))


@query("kin_cuts", f"WITH {SQL_K} {_counted_sql('k')}")
def kin_cuts(spark, d):
    return counted(cut_events(spark, d))


@query("kin_cuts_uniform", f"WITH {SQL_P}, k AS (SELECT * FROM p WHERE pt >= 30000 AND eta BETWEEN -2.5::DOUBLE AND 2.5::DOUBLE AND phi BETWEEN -pi() AND pi()) {_counted_sql('k')}")
def kin_cuts_uniform(spark, d):
    return counted(S.uniform_cuts(split_events(spark, d), {"pt_min": 30000, "eta_max": 2.5}, TYPES))


@query("rel_isolation", f"WITH {SQL_P}, k AS (SELECT * FROM p WHERE ptype = 'Electrons' AND CASE WHEN pt > 0 THEN iso / pt ELSE 0 END < 0.06::DOUBLE AND phi BETWEEN -pi() AND pi()) {_counted_sql('k', types=['Electrons'])}")
def rel_isolation(spark, d):
    return counted(S.kinematic_cuts(split_events(spark, d), {"Electrons": {"rel_isolation_max": 0.06}}).select("event_id", "Electrons"))




@query(
    "cuts_normalize",
    f"""WITH {X.SQL_P0}, u AS (SELECT lower(ptype) AS k, ptype, min(pt) FILTER (event_id % 2 = 0) AS pt_min, max(eta) AS eta_max, min(phi) FILTER (pt > 1e9) AS phi_min, max(phi) AS phi_max FROM p0 GROUP BY ptype)
SELECT ptype, coalesce(pt_min, 0.0) AS pt_min, -eta_max AS eta_min, eta_max, coalesce(phi_min, -pi()) AS phi_min, coalesce(phi_max, pi()) AS phi_max FROM u""",
)
def cuts_normalize(spark, d):
    raw = X.particles(spark, d).groupBy(F.lower("ptype").alias("ptype")).agg(F.min(F.when(F.col("event_id") % 2 == 0, F.col("pt"))).alias("pt_min"), F.max("eta").alias("eta_max"), F.min(F.when(F.col("pt") > 1e9, F.col("phi"))).alias("phi_min"), F.max("phi").alias("phi_max"))
    return S.cuts_normalized(raw)


_RANGE = " AND ".join(f"count(*) FILTER (s.ptype = '{t}') <= 4" for t in TYPES)


@query("count_range", f"WITH {SQL_P} {_counted_sql('p', 'HAVING ' + _RANGE)}")
def count_range(spark, d):
    return counted(S.counts_between(split_events(spark, d), S.DEFAULT_COUNTS))


@query("event_selection", f"WITH {SQL_K} {_counted_sql('k', 'HAVING ' + _RANGE)}")
def event_selection(spark, d):
    return counted(S.event_selection(split_events(spark, d)))


_EM = "HAVING count(*) FILTER (s.ptype = 'Electrons') {} 1 AND count(*) FILTER (s.ptype = 'Muons') {} 1"


@query("count_exact", f"WITH {SQL_P} {_counted_sql('p', _EM.format('=', '='), ['Electrons', 'Muons'])}")
def count_exact(spark, d):
    return counted(S.counts_exact(split_events(spark, d), COMBO, ["event_id"]))


@query("count_at_least", f"WITH {SQL_P} {_counted_sql('p', _EM.format('>=', '>='))}")
def count_at_least(spark, d):
    return counted(S.counts_at_least(split_events(spark, d), COMBO))


_RANKED = ",\nr AS (SELECT *, row_number() OVER (PARTITION BY event_id, ptype ORDER BY pt DESC) - 1 AS rk FROM p)"


@query("rank_slice", f"WITH {SQL_P}{_RANKED}, s1 AS (SELECT * FROM r WHERE (ptype = 'Electrons' AND rk = 1) OR (ptype = 'Jets' AND rk = 0)) {_counted_sql('s1', types=['Electrons', 'Jets'])}")
def rank_slice(spark, d):
    return counted(S.rank_slice(split_events(spark, d), {"Electrons": (1, 1), "Jets": (1, 0)}).select("event_id", "Electrons", "Jets"))


@query("rank_particles", f"WITH {SQL_P}{_RANKED} SELECT event_id, ptype, pt, rk AS rank FROM r")
def rank_particles(spark, d):
    flat = X.particles(spark, d).withColumn("ptype", F.when((F.col("ptype") == "Jets") & (F.col("btag") >= S.BTAG), "BJets").otherwise(F.col("ptype")))
    return flat.select("event_id", "ptype", "pt", (F.row_number().over(Window.partitionBy("event_id", "ptype").orderBy(F.desc("pt"))) - 1).cast("long").alias("rank"))


# --- final states ----------------------------------------------------------------------------------------------------
@query("fs_label", f"WITH {SQL_C} SELECT event_id, {_RAW_LABEL} AS fs FROM c")
def fs_label(spark, d):
    return M.with_counts(cut_events(spark, d)).select("event_id", L.fs_label(M.counts_of()).alias("fs"))


@query("fs_cap", f"WITH {SQL_P}, c AS (SELECT event_id, {', '.join(f"count(*) FILTER (ptype = '{t}') AS c_{t}" for t in TYPES)} FROM p GROUP BY event_id) SELECT event_id, {_LABEL} AS fs FROM c")
def fs_cap(spark, d):
    return M.with_counts(split_events(spark, d)).select("event_id", L.fs_cap(L.fs_label(M.counts_of())).alias("fs"))


@query("fs_valid", f"WITH {SQL_V} SELECT event_id, fs FROM v")
def fs_valid(spark, d):
    return M.labelled(cut_events(spark, d)).select("event_id", "fs")


@query("fs_counts", f"WITH {SQL_F} SELECT * FROM f")
def fs_counts(spark, d):
    return M.populous(M.labelled(cut_events(spark, d))).orderBy(F.desc("n"), "fs")


@query("fs_counts_per_file", f"WITH {SQL_V} SELECT source_file, fs, count(*) AS n FROM v GROUP BY ALL HAVING count(*) >= {M.MIN_EVENTS}")
def fs_counts_per_file(spark, d):
    return M.populous(M.labelled(cut_events(spark, d)), scope="file")


@query("fs_most_common", f"WITH {SQL_V} SELECT fs, count(*) AS n FROM v GROUP BY fs")
def fs_most_common(spark, d):
    return M.labelled(cut_events(spark, d)).groupBy("fs").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "fs")


@query("fs_group_capped", f"WITH {SQL_C} SELECT {_LABEL} AS fs, count(*) AS n, count(DISTINCT {_RAW_LABEL}) AS states FROM c GROUP BY 1")
def fs_group_capped(spark, d):
    df = M.with_counts(cut_events(spark, d))
    raw = df.groupBy(L.fs_label(M.counts_of()).alias("raw"), L.fs_label(M.counts_of(), 4).alias("fs")).agg(F.count("*").alias("k"))
    return raw.groupBy("fs").agg(F.sum("k").alias("n"), F.count("*").alias("states"))


@query("fs_events", f"WITH {SQL_V} SELECT event_id, source_file FROM v WHERE fs = '1e_0m_1j_0g_0t_0b'")
def fs_events(spark, d):
    return M.labelled(cut_events(spark, d)).filter(F.col("fs") == "1e_0m_1j_0g_0t_0b").select("event_id", "source_file")


@query("fs_semi_join", f"WITH {SQL_F} SELECT event_id, fs FROM v WHERE fs IN (SELECT fs FROM f)")
def fs_semi_join(spark, d):
    df = M.labelled(cut_events(spark, d)).select("event_id", "fs")
    return df.join(M.populous(df), "fs", "left_semi").select("event_id", "fs")


# --- combinations ----------------------------------------------------------------------------------------------------
FOUR = ["Electrons", "Muons", "Jets", "Photons"]
_COLS = [f"{k}_{t}" for t in FOUR for k in ("n", "s")]


def _generated(spark, d, **more):
    """Generated combinations, and how many events could hold each: the work follows the events."""
    c = M.combinations(spark, FOUR, **more)
    states = M.with_counts(split_events(spark, d)).groupBy(*[f"c_{t}" for t in FOUR]).agg(F.count("*").alias("k"))
    able = matching(states, c.select("im", *_COLS, "seq"), at_least, FOUR).groupBy("im").agg(F.sum("k").alias("events"))
    return c.join(able, "im", "left").select("im", *[F.col(x).cast("long").alias(x) for x in _COLS], F.coalesce("events", F.lit(0)).alias("events"))


def _generated_sql(**more) -> str:
    holds = " AND ".join(f"(n_{t} = 0 OR c_{t} >= s_{t} + n_{t})" for t in FOUR)
    cnt = ", ".join(f"count(*) FILTER (ptype = '{t}') AS c_{t}" for t in FOUR)
    return f"WITH {SQL_P}, c AS (SELECT event_id, {cnt} FROM p GROUP BY event_id), {sql_combos(FOUR, **more)} SELECT im, {', '.join(f'{x}::BIGINT AS {x}' for x in _COLS)}, (SELECT count(*) FROM c WHERE {holds}) AS events FROM combos"


@query("gen_combos", _generated_sql())
def gen_combos(spark, d):
    return _generated(spark, d)


@query("gen_combos_subleading", _generated_sql(subleading=1))
def gen_combos_subleading(spark, d):
    return _generated(spark, d, subleading=1)


@query("combo_dedupe", _generated_sql())
def combo_dedupe(spark, d):
    """Combinations listed twice, as a union of overlapping settings, are kept once."""
    twice = M.combinations(spark, FOUR, types_range=(1, 2)).unionByName(M.combinations(spark, FOUR)).drop("seq").dropDuplicates(_COLS)
    states = M.with_counts(split_events(spark, d)).groupBy(*[f"c_{t}" for t in FOUR]).agg(F.count("*").alias("k"))
    able = matching(states, twice.select("im", *_COLS), at_least, FOUR).groupBy("im").agg(F.sum("k").alias("events"))
    return twice.join(able, "im", "left").select("im", *[F.col(x).cast("long").alias(x) for x in _COLS], F.coalesce("events", F.lit(0)).alias("events"))


_SEQ = ", ".join([f"(n_{t} = 0)::INT" for t in FOUR] + [f"n_{t}" for t in FOUR])


@query("limit_combos", f"SELECT im, seq, events FROM (SELECT *, row_number() OVER (ORDER BY {' + '.join(f'(n_{t} > 0)::INT' for t in FOUR)}, {_SEQ}) - 1 AS seq FROM ({_generated_sql()})) WHERE seq < 10")
def limit_combos(spark, d):
    first = M.combinations(spark, FOUR, limit=10)
    states = M.with_counts(split_events(spark, d)).groupBy(*[f"c_{t}" for t in FOUR]).agg(F.count("*").alias("k"))
    able = matching(states, first.select("im", *_COLS, "seq"), at_least, FOUR).groupBy("im").agg(F.sum("k").alias("events"))
    return first.join(able, "im", "left").select("im", F.col("seq").cast("long").alias("seq"), F.coalesce("events", F.lit(0)).alias("events"))


@query("fs_contains_combo", f"WITH {SQL_F}, {sql_combos(types_range=(2, 4), subleading=1)}, s AS (SELECT DISTINCT v.fs, {', '.join(f'c_{t}' for t in TYPES)} FROM v JOIN f ON f.fs = v.fs) SELECT fs, im FROM s JOIN combos ON {_CONTAINS}")
def fs_contains_combo(spark, d):
    base = M.labelled(cut_events(spark, d)).select("fs", *[f"c_{t}" for t in TYPES])
    states = base.join(M.populous(base), "fs", "left_semi").distinct()
    return matching(states, combos(spark, subleading=1), at_least).select("fs", "im")


@query("events_x_combos", f"WITH {SQL_F}, {sql_combos(types_range=(2, 4))} SELECT v.fs, im, count(*) AS n FROM v SEMI JOIN f ON f.fs = v.fs JOIN combos ON {_FITS} GROUP BY v.fs, im")
def events_x_combos(spark, d):
    counts = [f"c_{t}" for t in TYPES]
    base = M.labelled(cut_events(spark, d)).select("source_file", "fs", *counts)
    return base.join(M.channels(base, combos(spark)), ["fs", *counts]).groupBy("fs", "im").agg(F.count("*").alias("n"))


@query("im_label", f"WITH {SQL_F}, {sql_combos(types_range=(2, 4), subleading=1)} SELECT v.fs, im, count(*) AS n FROM v SEMI JOIN f ON f.fs = v.fs JOIN combos ON {_FITS} GROUP BY v.fs, im")
def im_label(spark, d):
    counts = [f"c_{t}" for t in TYPES]
    base = M.labelled(cut_events(spark, d)).select("source_file", "fs", *counts)
    return base.join(M.channels(base, combos(spark, subleading=1)), ["fs", *counts]).groupBy("fs", "im").agg(F.count("*").alias("n"))


# --- masses ----------------------------------------------------------------------------------------------------------
@query("four_vector", f"WITH {SQL_K}{SQL_R} SELECT ptype, count(*) AS n, round(sum(px)/1e3, 3) AS px, round(sum(py)/1e3, 3) AS py, round(sum(pz)/1e3, 3) AS pz, round(sum(e)/1e3, 3) AS e FROM r GROUP BY ptype")
def four_vector(spark, d):
    v = M.vectors(cut_events(spark, d))
    rows = v.select(F.explode(F.array(*[F.struct(F.lit(t).alias("ptype"), F.col(f"v_{t}").alias("v")) for t in TYPES])).alias("x")).select("x.ptype", F.explode("x.v").alias("v"))
    return rows.groupBy("ptype").agg(F.count("*").alias("n"), *[F.round(F.sum(f"v.{k}") / 1e3, 3).alias(k) for k in ("px", "py", "pz", "e")])


_ALL = f"WITH {SQL_K}{SQL_R}, t AS (SELECT event_id, {_SQUARE} AS q FROM r GROUP BY event_id)"


@query("invariant_mass", f"{_ALL} SELECT event_id, round(sign(q)*sqrt(abs(q))*0.001, 4) + 0.0 AS m FROM t")
def invariant_mass(spark, d):
    """Mass of all selected particles of an event together."""
    v = M.vectors(cut_events(spark, d)).withColumn("all", F.concat(*[f"v_{t}" for t in TYPES])).filter(F.size("all") > 0)
    return v.select("event_id", (F.round(L.mev_to_gev(L.signed_mass(L.total(F.col("all")))), 4) + 0.0).alias("m"))


@query("signed_mass", f"{_ALL} SELECT event_id, round(sign(q)*sqrt(abs(q)), 1) + 0.0 AS m_mev FROM t WHERE abs(q) > 1")
def signed_mass(spark, d):
    v = M.vectors(cut_events(spark, d)).withColumn("all", F.concat(*[f"v_{t}" for t in TYPES])).filter(F.size("all") > 0)
    return v.select("event_id", L.signed_mass(L.total(F.col("all"))).alias("q")).filter(F.abs("q") > 1).select("event_id", (F.round("q", 1) + 0.0).alias("m_mev"))


@query("particle_mass_assign", f"WITH {SQL_K} SELECT ptype, count(*) AS n, round(sum(CASE WHEN event_id % 2 = 0 THEN mass ELSE {_M0} END), 6) AS total FROM k GROUP BY ptype")
def particle_mass_assign(spark, d):
    stored = lambda p: F.when(F.col("event_id") % 2 == 0, p["mass"])
    rows = typed(cut_events(spark, d), lambda p, t: L.particle_mass(stored(p), t).alias("m"))
    return rows.groupBy("x.ptype").agg(F.count("*").alias("n"), F.round(F.sum("x.m"), 6).alias("total"))


@query("mev_to_gev", f"WITH {SQL_K} SELECT ptype, round(sum(pt * 1e-3), 5) AS gev FROM k GROUP BY ptype")
def mev_to_gev(spark, d):
    rows = typed(cut_events(spark, d), lambda p, t: L.mev_to_gev(p["pt"]).alias("gev"))
    return rows.groupBy("x.ptype").agg(F.round(F.sum("x.gev"), 5).alias("gev"))


@query("mass_spectrum", f"WITH {sql_masses()} SELECT fs, im, source_file, event_id, m FROM mass")
def mass_spectrum(spark, d):
    return M.mass_spectrum(cut_events(spark, d), combos(spark))


@query("mass_spectrum_subleading", f"WITH {sql_masses(1)} SELECT fs, im, count(*) AS n, round(sum(m), 6) AS total FROM mass GROUP BY fs, im")
def mass_spectrum_subleading(spark, d):
    found = M.mass_spectrum(cut_events(spark, d), combos(spark, subleading=1))
    return found.groupBy("fs", "im").agg(F.count("*").alias("n"), F.round(F.sum("m"), 6).alias("total"))


@query("mass_nonempty", f"WITH {sql_masses()}, t AS (SELECT fs, im, CASE WHEN length(im) > 4 THEN m ELSE 0 END AS m FROM mass) SELECT fs, im, count(*) AS n FROM t GROUP BY fs, im HAVING bool_or(m <> 0)")
def mass_nonempty(spark, d):
    """Channels with some mass: those of two particles are set to 0 first, and so go."""
    some = masses(spark, d).withColumn("m", F.when(F.length("im") > 4, F.col("m")).otherwise(0.0))
    return M.drop_empty(some).groupBy("fs", "im").agg(F.count("*").alias("n"))


@query(
    "combo_stats",
    f"""WITH {sql_masses()}, s AS (SELECT DISTINCT v.fs, {', '.join(f'c_{t}' for t in TYPES)} FROM v JOIN f ON f.fs = v.fs),
x AS (SELECT fs, combos.im, {_CONTAINS} AS has, {_FITS} AS fit FROM s, combos),
y AS (SELECT x.*, z.im IS NOT NULL AS got FROM x LEFT JOIN (SELECT DISTINCT fs, im FROM mass) z ON z.fs = x.fs AND z.im = x.im)
SELECT fs, count(*) FILTER (got) AS calculated, count(*) FILTER (NOT got) AS skipped, count(*) FILTER (NOT has) AS no_matching_combination, count(*) FILTER (has AND NOT fit) AS no_events_after_filter,
 0::BIGINT AS no_events_after_slice, count(*) FILTER (fit AND NOT got) AS empty_inv_mass FROM y GROUP BY fs""",
)
def combo_stats(spark, d):
    c, states = combos(spark), written(M.populous_states(M.labelled(cut_events(spark, d))))
    got = written(masses(spark, d).select("fs", "im").distinct().withColumn("got", F.lit(True)))
    # pairs that fit are among those that a state contains; the pairs of no match are what is left of all
    has = matching(states, c, at_least).groupBy("fs").agg(F.count("*").alias("has"))
    fit = matching(states, c).select("fs", "im").join(got, ["fs", "im"], "left").groupBy("fs").agg(F.count("*").alias("fit"), F.count("got").alias("fit_got"))
    of = states.groupBy("fs").agg((F.count("*") * c.count()).alias("pairs"), F.count("*").alias("states"))
    calculated = got.groupBy("fs").agg(F.count("*").alias("channels"))
    none = lambda x: F.coalesce(F.col(x), F.lit(0))
    y = of.join(has, "fs", "left").join(fit, "fs", "left").join(calculated, "fs", "left").withColumn("calculated", F.col("states") * none("channels"))
    return y.select(
        "fs", "calculated", (F.col("pairs") - F.col("calculated")).alias("skipped"), (F.col("pairs") - none("has")).alias("no_matching_combination"), (none("has") - none("fit")).alias("no_events_after_filter"),
        F.lit(0).cast("long").alias("no_events_after_slice"), (none("fit") - none("fit_got")).alias("empty_inv_mass"),
    )


@query("mass_concat", f"WITH {sql_masses()} SELECT fs, im, count(*) AS n, count(DISTINCT source_file) AS files, min(m) AS lo, max(m) AS hi FROM mass GROUP BY fs, im")
def mass_concat(spark, d):
    return masses(spark, d).groupBy("fs", "im").agg(F.count("*").alias("n"), F.count_distinct("source_file").alias("files"), F.min("m").alias("lo"), F.max("m").alias("hi"))


# --- cleaning --------------------------------------------------------------------------------------------------------
@query("n_bins", f"WITH {sql_masses()}, {sql_bins('a', 'mass')} SELECT fs, im, lo, hi, nb FROM ar")
def n_bins(spark, d):
    return P.ranges(masses(spark, d))


@query("bin_index", f"WITH {sql_masses()}, {sql_bins('a', 'mass')} SELECT bin, sum(cnt)::BIGINT AS n FROM ab GROUP BY bin")
def bin_index(spark, d):
    return P.binned(masses(spark, d)).filter("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))


@query("hist_counts", f"WITH {sql_masses()}, {sql_bins('a', 'mass')} SELECT fs, im, bin, cnt FROM ab")
def hist_counts(spark, d):
    return P.bin_counts(masses(spark, d)).select("fs", "im", "bin", "cnt")


@query("gen_edges", f"WITH {sql_masses()}, {sql_bins('a', 'mass')}, i AS (SELECT *, unnest(range(0, nb + 1)) AS i FROM ar) SELECT fs, im, i, {_EDGE.format(i='i')} AS edge FROM i WHERE nb > 0")
def gen_edges(spark, d):
    r = P.ranges(masses(spark, d)).filter("nb > 0").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb"))))
    return r.select("fs", "im", "i", L.edge(F.col("lo"), F.col("hi"), F.col("nb"), F.col("i")).alias("edge"))


@query("rightmost_peak_bin", f"WITH {sql_masses()}, {sql_bins('a', 'mass')}, {SQL_PEAK} SELECT fs, im, peak_bin, peak_cnt, peak FROM pk")
def rightmost_peak_bin(spark, d):
    return P.peaks(P.bin_counts(masses(spark, d)))


@query("peak_cut", f"WITH {SQL_CUT} SELECT fs, im, event_id, m FROM kept")
def peak_cut(spark, d):
    return P.peak_cut(masses(spark, d)).select("fs", "im", "event_id", "m")


@query("first_empty_bin", f"WITH {SQL_CUT}, {SQL_GAP} SELECT fs, im, gap_bin, gap FROM gp")
def first_empty_bin(spark, d):
    return P.first_gaps(P.bin_counts(P.peak_cut(masses(spark, d))))


@query("tail_split", f"WITH {SQL_SPLIT} SELECT fs, im, part, count(*) AS n, min(m) AS lo, max(m) AS hi FROM parts GROUP BY fs, im, part")
def tail_split(spark, d):
    return P.tail_split(P.peak_cut(masses(spark, d))).groupBy("fs", "im", "part").agg(F.count("*").alias("n"), F.min("m").alias("lo"), F.max("m").alias("hi"))


@query("post_process", f"WITH {SQL_SPLIT} SELECT fs, im, event_id, part, m FROM parts")
def post_process(spark, d):
    return P.post_process(masses(spark, d)).select("fs", "im", "event_id", "part", "m")


@query(
    "flagship_spectrum",
    f"WITH {SQL_C}{SQL_R}, t AS (SELECT r.event_id, {_SQUARE} AS q FROM r JOIN c ON c.event_id = r.event_id WHERE c_Electrons = 1 AND c_Muons = 1 AND ptype IN ('Electrons', 'Muons') GROUP BY r.event_id) SELECT floor((round(sign(q)*sqrt(abs(q))*0.001, 6) + 0.0) / 10)::BIGINT AS bin, count(*) AS n FROM t GROUP BY 1",
)
def flagship_spectrum(spark, d):
    """10 GeV histogram of the mass of the electron and the muon of events with exactly one of each."""
    return _flagship(spark, d)


def _flagship(spark, d):
    v = M.vectors(M.with_counts(cut_events(spark, d)).filter((F.col("c_Electrons") == 1) & (F.col("c_Muons") == 1)))
    m = F.round(L.mev_to_gev(L.signed_mass(L.total(F.concat("v_Electrons", "v_Muons")))), 6) + 0.0
    return v.select(F.floor(m / 10).cast("long").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
