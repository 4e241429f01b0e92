"""Event, catalog, chunk and log tables as views of the given star-schema tables, and the same views in SQL."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakframe.sources.files import dealt, located
from peakframe.sources.shared import ship

TYPES = ["Electrons", "Muons", "Jets", "BJets", "Photons", "Taus"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each line of an order: the order is the event. Momenta are in MeV."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    kind = F.when((flag == "R") & (status == "F"), "Electrons").when((flag == "A") & (status == "F"), "Muons").when(flag.isin("N", "R") & (status == "O"), "Jets").when((flag == "N") & (status == "F"), "Photons").otherwise("Taus")
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("event_id"), kind.alias("ptype"), F.col("l_extendedprice").alias("pt"), ((F.col("l_tax") - 0.04) / 0.04 * 3).alias("eta"), ((days % 628) / 100.0 - 3.14).alias("phi"),
        F.col("l_quantity").alias("mass"), (F.col("l_discount") * 10).alias("btag"), (F.col("l_quantity") * 100).alias("iso"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each event with an array of particles for each type, greatest momentum first. Jets aren't split by flavour yet."""
    body = F.struct("pt", "eta", "phi", "mass", "btag", "iso")
    lists = [F.sort_array(F.collect_list(F.when(F.col("ptype") == t, body)), asc=False).alias(t) for t in TYPES if t != "BJets"]
    return particles(spark, sf_dir).groupBy("event_id").agg(*lists).withColumn("source_file", F.concat(F.lit("f"), (F.col("event_id") % 4).cast("string")))


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the flat layout: n{T}, {T}_pt, {T}_eta, {T}_phi."""
    nested = events(spark, sf_dir)
    kinds = [t for t in TYPES if t != "BJets"]
    return nested.select("event_id", *[F.size(t).alias(f"n{t}") for t in kinds], *[F.col(f"{t}.{f}").alias(f"{t}_{f}") for t in kinds for f in ("pt", "eta", "phi")])


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """release, pos, url for each order."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    name = F.when(status == "F", "data16_13TeV").when(status == "O", "mc20_13TeV").when(key % 2 == 0, "data15_13TeV").otherwise("MC16_13TeV")
    return table(spark, sf_dir, "orders").select(F.concat(F.year("o_orderdate").cast("string"), F.lit("r-pp")).alias("release"), key.alias("pos"), F.concat(F.lit("root://store.example/"), name, F.lit("/DAOD."), key.cast("string"), F.lit(".root")).alias("url"))


def odd_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows whose URLs are of neither kind, or of both: one of each for each nation."""
    shapes = F.explode(F.array(F.lit("root://store.example/opendata/x"), F.lit("root://store.example/mc20_a/data16_b/x")))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", shapes.alias("shape"))
    return nations.select(F.lit("1995r-pp").alias("release"), (-F.col("n_nationkey").cast("long") - 1).alias("pos"), F.concat("shape", F.col("n_nationkey").cast("string"), F.lit(".root")).alias("url"))


def array_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """signature, shard and value m for each line."""
    part = F.col("l_linestatus")
    im = F.when(F.col("l_returnflag") == "A", "m0").when(F.col("l_returnflag") == "N", "m0j0").otherwise("e0m0")
    s = lambda c: c.cast("string")
    signature = F.concat(
        F.lit("parsed_"), s(F.year("l_shipdate")), F.lit("_chunk"), s(F.col("l_suppkey") % 4), F.lit("_FS_"), s(F.col("l_linenumber") % 3), F.lit("e_1m_"), s(F.col("l_partkey") % 3), F.lit("j_0g_0t_0b_IM_"), im, F.when(part == "O", "_main").otherwise("_outliers"),
    )
    return table(spark, sf_dir, "lineitem").select(signature.alias("signature"), (F.col("l_suppkey") % 4).alias("shard"), (F.col("l_extendedprice") / 1000.0).alias("m"))


def tenths(v) -> F.Column:
    """A number's text with one decimal, cut."""
    return F.concat(F.floor(v).cast("long").cast("string"), F.lit("."), (F.floor(v * 10).cast("long") % 10).cast("string"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, user, sec = F.col("event_type"), F.col("user_id").cast("string"), tenths(F.col("value"))
    line = (
        F.when(kind == "view", F.concat(F.lit("Mass calculation complete: "), user, F.lit(" IM chunks/signatures in "), sec, F.lit("s; shard=x")))
        .when(kind == "click", F.concat(F.lit("Post-processing complete: "), user, F.lit(" processed arrays in "), sec, F.lit("s")))
        .when(kind == "purchase", F.concat(F.lit("Histogram creation complete in "), sec, F.lit("s")))
        .otherwise(F.concat(F.lit("Entering state: "), kind))
    )
    return table(spark, sf_dir, "events").select("event_id", line.alias("line"))


def file_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What parsing made of each file."""
    ok = F.col("event_type") != "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("file_id"), ok.alias("ok"), F.floor(F.col("value") * 10).cast("long").alias("n_events"), (F.col("user_id") / 10.0).alias("time_sec"), (F.col("user_id") * 1000 + 500).alias("size_bytes"),
        F.when(~ok, F.concat(F.lit("E"), (F.col("user_id") % 7).cast("string"))).alias("error_type"),
    )


#: Column names of the four layouts. A customer is a file here; its key modulo 4 says which.
INVENTORY = {
    0: ["AnalysisElectronsAuxDyn.pt", "AnalysisElectronsAuxDyn.eta", "AnalysisElectronsAuxDyn.phi", "AnalysisElectronsAuxDyn.mass", "AnalysisMuonsAuxDyn.pt", "AnalysisMuonsAuxDyn.eta", "AnalysisMuonsAuxDyn.phi", "AnalysisMuonsAuxDyn.m", "AnalysisJetsAuxDyn.pt", "AnalysisJetsAuxDyn.eta", "AnalysisTauJetsAuxDyn.pt", "AnalysisTauJetsAuxDyn.eta", "AnalysisTauJetsAuxDyn.phi"],
    1: ["nElectron", "Electron_pt", "Electron_eta", "Electron_phi", "Electron_mass", "Muon_pt", "Muon_eta", "Muon_phi", "Jet_pt", "Jet_eta", "Jet_phi", "Jet_mass", "Jet_btagDeepFlavB", "Photon_pt", "Photon_eta", "Tau_pt", "Tau_eta", "Tau_phi", "Tau_charge"],
    2: ["lep_pt", "lep_eta", "lep_phi", "jet_pt", "jet_eta", "jet_phi", "jet_m", "photon_pt", "photon_eta", "photon_phi", "tau_pt", "tau_phi"],
    3: ["patJets_slimmedJets__PAT./patJets_slimmedJets__PAT.obj/patJets_slimmedJets__PAT.obj.m_state.p4Polar_.fCoordinates.fPt", "patJets_slimmedJets__PAT./patJets_slimmedJets__PAT.obj/patJets_slimmedJets__PAT.obj.m_state.p4Polar_.fCoordinates.fEta", "patJets_slimmedJets__PAT./patJets_slimmedJets__PAT.obj/patJets_slimmedJets__PAT.obj.x.fPhi", "patJets_slimmedJetsPuppi__PAT./patJets_slimmedJetsPuppi__PAT.obj/patJets_slimmedJetsPuppi__PAT.obj.m_state.p4Polar_.fCoordinates.fPt", "patMuons_slimmedMuons__PAT./patMuons_slimmedMuons__PAT.obj/patMuons_slimmedMuons__PAT.obj.m_state.p4Polar_.fCoordinates.fPt", "patMuons_slimmedMuons__PAT./patMuons_slimmedMuons__PAT.obj/patMuons_slimmedMuons__PAT.obj.m_state.p4Polar_.fCoordinates.fEta"],
}
TABLES = {0: "CollectionTree", 1: "Events", 2: "mini", 3: "Events"}
RELEASES = {0: "2024r-pp_mc", 1: "record_30529", 2: "2025e-13tev-beta", 3: "unknown"}


#: Files of the inventory in a partition.
INVENTORY_FILES = 20_000


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column inventory: file, release, table, column_name. Files are dealt by name, a bounded number to a task, before their columns are listed: a few megabytes of customers are many rows, and what is done by file needs no other shuffle."""
    customers = table(spark, sf_dir, "customer")
    n = max(spark.sparkContext.defaultParallelism, -(-customers.count() // INVENTORY_FILES))
    k = F.col("k")
    by = lambda d: F.element_at(F.create_map(*[F.lit(x) for kv in d.items() for x in kv]), k)
    names = F.when(k == 0, F.array(*map(F.lit, INVENTORY[0])))
    for i in (1, 2, 3):
        names = names.when(k == i, F.array(*map(F.lit, INVENTORY[i])))
    files = customers.select(F.concat(F.lit("file"), F.col("c_custkey").cast("string")).alias("file"), (F.col("c_custkey") % 4).cast("int").alias("k")).repartition(n, "file")
    return files.select("file", by(RELEASES).alias("release"), by(TABLES).alias("table"), F.explode(names).alias("column_name"))


def layout_files(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """file, path: a small Parquet file with the columns of each file of the inventory, written by executors. In files whose number ends in 1, the data of every column that ends in _eta is spoilt."""
    ship(spark)
    wanted = columns(spark, sf_dir).groupBy("file").agg(F.sort_array(F.collect_list("column_name")).alias("columns"), F.endswith(F.first("file"), F.lit("1")).alias("bad"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                out.append((r["file"], f"{folder}/{r['file']}.parquet"))
                table_ = pa.table({c: [float(i), i + 0.5, i - 0.5] for i, c in enumerate(r["columns"])})
                put_file(out[-1][1], spoilt(table_, [c for c in r["columns"] if r["bad"] and c.endswith("_eta")]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in list(zip(*out, strict=True)) or [[], []]], names=["file", "path"])

    return dealt(wanted).mapInArrow(run, "file string, path string")


def spoilt(table_: pa.Table, bad: list[str]) -> bytes:
    """A Parquet file in which the pages of some columns can't be read."""
    import pyarrow.parquet as pq

    sink = pa.BufferOutputStream()
    pq.write_table(table_, sink)
    data = bytearray(sink.getvalue().to_pybytes())
    meta = pq.ParquetFile(pa.BufferReader(bytes(data))).metadata
    for g in range(meta.num_row_groups):
        for c in map(meta.row_group(g).column, range(meta.num_columns)):
            if c.path_in_schema.split(".list.")[0] in bad:
                at = min(x for x in (c.dictionary_page_offset, c.data_page_offset) if x)
                data[at : at + c.total_compressed_size] = b"\xff" * c.total_compressed_size
    return bytes(data)


def put_file(path: str, data: bytes) -> None:
    system, inside = located(path)
    system.create_dir(inside.rpartition("/")[0], recursive=True)
    with system.open_output_stream(inside) as out:
        out.write(data)


def damaged_copies(files: DataFrame, block: int = 1 << 20) -> DataFrame:
    """Copies each file of (source, target, damage) in blocks, on executors: `absent` ones not at all, `truncated` ones to their half, `footer` ones with other bytes where the footer begins. Gives targets."""

    ship(files.sparkSession)

    def copy(source: str, target: str, damage: str | None) -> None:
        system, inside = located(source)
        there, at = located(target)
        there.create_dir(at.rpartition("/")[0], recursive=True)
        with system.open_input_file(inside) as f, there.open_output_stream(at) as out:
            size = f.size()
            end = size // 2 if damage == "truncated" else size
            footer = size - 8 - int.from_bytes(f.read_at(4, size - 8), "little")
            for pos in range(0, end, block):
                data = bytearray(f.read_at(min(block, end - pos), pos))
                if damage == "footer" and pos <= footer < pos + len(data):
                    data[footer - pos : footer - pos + 4] = b"\xff" * len(data[footer - pos : footer - pos + 4])
                out.write(bytes(data))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if r["damage"] != "absent":
                    copy(r["source"], r["target"], r["damage"])
            yield batch.select(["target"])

    return dealt(files.select("source", "target", "damage"), "target").mapInArrow(run, "target string")


# The same views as SQL, each the body of a WITH clause.
SQL_P0 = """p0 AS (SELECT l_orderkey AS event_id,
  CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN 'Electrons' WHEN l_returnflag='A' AND l_linestatus='F' THEN 'Muons'
       WHEN l_returnflag IN ('N','R') AND l_linestatus='O' THEN 'Jets' WHEN l_returnflag='N' AND l_linestatus='F' THEN 'Photons' ELSE 'Taus' END AS ptype,
  l_extendedprice AS pt, (l_tax-0.04::DOUBLE)/0.04::DOUBLE*3 AS eta, (date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 628)/100.0::DOUBLE - 3.14::DOUBLE AS phi,
  l_quantity AS mass, l_discount*10 AS btag, l_quantity*100 AS iso FROM lineitem)"""
SQL_CATALOG = """cat AS (SELECT CAST(year(o_orderdate) AS VARCHAR)||'r-pp' AS release, o_orderkey AS pos,
  'root://store.example/'||CASE o_orderstatus WHEN 'F' THEN 'data16_13TeV' WHEN 'O' THEN 'mc20_13TeV' ELSE CASE WHEN o_orderkey%2=0 THEN 'data15_13TeV' ELSE 'MC16_13TeV' END END
  ||'/DAOD.'||o_orderkey||'.root' AS url FROM orders)"""
SQL_ODD = """odd AS (SELECT '1995r-pp' AS release, -n_nationkey::BIGINT - 1 AS pos, s||n_nationkey||'.root' AS url
  FROM nation, (VALUES ('root://store.example/opendata/x'), ('root://store.example/mc20_a/data16_b/x')) v(s))"""
SQL_VALUES = """vals AS (SELECT 'parsed_'||year(l_shipdate)||'_chunk'||(l_suppkey%4)||'_FS_'||(l_linenumber%3)||'e_1m_'||(l_partkey%3)||'j_0g_0t_0b_IM_'
  ||CASE l_returnflag WHEN 'A' THEN 'm0' WHEN 'N' THEN 'm0j0' ELSE 'e0m0' END||CASE l_linestatus WHEN 'O' THEN '_main' ELSE '_outliers' END AS signature,
  l_suppkey%4 AS shard, l_extendedprice/1000.0::DOUBLE AS m FROM lineitem)"""
SQL_TENTHS = "CAST(floor(value) AS BIGINT)||'.'||(CAST(floor(value*10) AS BIGINT)%10)"
SQL_LOGS = f"""logs AS (SELECT event_id, CASE event_type
  WHEN 'view' THEN 'Mass calculation complete: '||user_id||' IM chunks/signatures in '||{SQL_TENTHS}||'s; shard=x'
  WHEN 'click' THEN 'Post-processing complete: '||user_id||' processed arrays in '||{SQL_TENTHS}||'s'
  WHEN 'purchase' THEN 'Histogram creation complete in '||{SQL_TENTHS}||'s' ELSE 'Entering state: '||event_type END AS line FROM events)"""
SQL_FILES = """files AS (SELECT event_id AS file_id, event_type <> 'error' AS ok, CAST(floor(value*10) AS BIGINT) AS n_events, user_id/10.0::DOUBLE AS time_sec, user_id*1000+500 AS size_bytes,
  CASE WHEN event_type = 'error' THEN 'E'||(user_id%7) END AS error_type FROM events)"""
_LAYOUT = " UNION ALL ".join(f"SELECT {k} AS k, '{RELEASES[k]}' AS release, '{TABLES[k]}' AS \"table\", unnest({names!r}) AS column_name" for k, names in INVENTORY.items())
SQL_COLUMNS = f"""layout AS ({_LAYOUT}),
cols AS (SELECT 'file'||c_custkey AS file, release, "table", column_name FROM customer JOIN layout ON c_custkey % 4 = k)"""
