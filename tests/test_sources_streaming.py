"""Scans, sinks, yearly binds and the incremental (streaming) landing."""

import os
import tempfile

from pyspark.sql import functions as F

from civic_spark.plans import raw, votes
from civic_spark.sources import readers, schemas, sinks
from civic_spark.streaming import ingest


def _write(path, text, enc="latin-1"):
    with open(path, "w", encoding=enc) as f:
        f.write(text)


def test_latin1_headerless_bind_with_status(spark):
    d = tempfile.mkdtemp(prefix="civic-raw-")
    _write(os.path.join(d, "a_2012.txt"), '"SP";"JOSÉ";"12"\n"RJ";"SÃO";""\n')
    _write(os.path.join(d, "b_2016.txt"), '"MG";"ÁGUA";"7";"extra"\n')
    table, status = raw.bind_yearly(spark, {2012: os.path.join(d, "a_2012.txt"), 2016: os.path.join(d, "b_2016.txt")},
                                    {2012: ["UF", "NOME", "N"], 2016: ["UF", "NOME", "N", "X"]})
    rows = sorted(tuple(r) for r in table.select("UF", "NOME", "N", "ANO_ARQUIVO").collect())
    assert rows == [("MG", "ÁGUA", "7", 2016), ("RJ", "SÃO", None, 2012), ("SP", "JOSÉ", "12", 2012)]
    assert sorted(r["rows"] for r in status.collect()) == [1, 2]


def test_gzip_decimal_comma_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="civic-sink-")
    df = spark.createDataFrame([(1, 1.5, "Ação"), (2, None, "x")], "id int, v double, t string")
    sinks.write_delimited(df, d + "/out", sep=";", gzip=True, encoding=readers.LATIN1, decimal_comma=True)
    assert any(f.endswith(".gz") for f in os.listdir(d + "/out"))
    back = readers.scan_delimited(spark, d + "/out", schemas.struct("id string, v string, t string"), sep=";",
                                  encoding=readers.LATIN1)
    got = sorted((r["id"], r["v"], r["t"]) for r in back.collect())
    assert got == [("1", "1,5", "Ação"), ("2", None, "x")]


def test_coverage_grid(spark):
    parties = spark.createDataFrame([("pt",), ("psdb",)], "party string")
    states = spark.createDataFrame([("sp",), ("rj",)], "state string")
    loaded = spark.createDataFrame([("pt", "sp"), ("psdb", "rj")], "party string, state string")
    got = sorted(tuple(r) for r in raw.missing_membership_files(parties, states, loaded).collect())
    assert got == [("psdb", "sp"), ("pt", "rj")]


def test_streaming_landing_is_incremental(spark):
    src = tempfile.mkdtemp(prefix="civic-stream-src-")
    out = tempfile.mkdtemp(prefix="civic-stream-out-") + "/election"
    ck = tempfile.mkdtemp(prefix="civic-stream-ck-")
    header = ";".join(f.name for f in schemas.ELECTION_RAW.fields)
    row = "2016;RO;ELEIÇÃO;00001;{z};A;13;DEFERIDO;1;11;PREFEITO;PT;X;PT;#NULO#;ELEITO;{v}"
    _write(os.path.join(src, "z1.csv"), header + "\n" + row.format(z=1, v=350) + "\n")

    def clean(df):
        return df.withColumn("election_year", F.col("ano_eleicao"))

    stream = ingest.stream_feed(spark, src, schemas.ELECTION_RAW)
    ingest.land(stream, out, transform=clean, checkpoint=ck).awaitTermination()
    _write(os.path.join(src, "z2.csv"), header + "\n" + row.format(z=2, v=250) + "\n")
    ingest.land(ingest.stream_feed(spark, src, schemas.ELECTION_RAW), out, transform=clean,
                checkpoint=ck).awaitTermination()
    landed = spark.read.parquet(out)
    assert landed.count() == 2                        # second run read only the new file
    dim = spark.createDataFrame([("00001", "1100015", "ro", "x")], schemas.MUNICIPALITY_DIM)
    coal = spark.createDataFrame([], schemas.struct(
        "election_year int, state string, election_type string, cod_tse string, round int, position_code int, "
        "party string, coalition string, coalition_name string, coalition_type string"))
    v = votes.build(landed.drop("_source_file", "election_year"), coal, dim, level="local").collect()
    assert v[0]["vote"] == 600


def test_bind_yearly_with_a_header_year(spark):
    d = tempfile.mkdtemp(prefix="civic-raw-")
    _write(os.path.join(d, "c_2008.txt"), '"SP";"ANA"\n')
    _write(os.path.join(d, "c_2016.txt"), 'UF;NOME;EXTRA\n"RJ";"BIA";"1"\n')
    table, status = raw.bind_yearly(spark, {2008: os.path.join(d, "c_2008.txt"), 2016: os.path.join(d, "c_2016.txt")},
                                    {2008: ["UF", "NOME"], 2016: None})
    got = sorted(tuple(r) for r in table.select("UF", "NOME", "EXTRA", "ANO_ARQUIVO").collect())
    assert got == [("RJ", "BIA", "1", 2016), ("SP", "ANA", None, 2008)]


def test_split_sink_writes_all_outputs_in_one_pass(spark):
    d = tempfile.mkdtemp(prefix="civic-split-")
    df = spark.createDataFrame([(2014, "a"), (2016, "b"), (2012, "c"), (None, "d")], "election_year int, v string")
    paths = sinks.write_split(df, {"fed_state": F.col("election_year") % 4 == 2, "local": F.col("election_year") % 4 == 0,
                                   "recent": F.col("election_year") > 2012}, d + "/out")
    got = {name: sorted(r.v for r in spark.read.parquet(path).collect()) for name, path in paths.items()}
    assert got == {"fed_state": ["a"], "local": ["b", "c"], "recent": ["a", "b"]}
    paths = sinks.write_split(df, {"local": F.col("election_year") % 4 == 0}, d + "/csv", fmt="csv", compression="gzip", header=True)
    assert any(f.endswith(".csv.gz") for f in os.listdir(paths["local"]))
    assert spark.read.csv(paths["local"], header=True).columns == ["election_year", "v"]


def test_unreadable_gzip_is_skipped(spark):
    d = tempfile.mkdtemp(prefix="civic-gz-")
    import gzip
    with gzip.open(os.path.join(d, "good_2012.csv.gz"), "wt", encoding="latin-1") as f:
        f.write("SP;ANA\n")
    with open(os.path.join(d, "bad_2016.csv.gz"), "wb") as f:
        f.write(b"\x1f\x8b\x08\x00not really gzip")
    df = readers.scan_delimited(spark, d, schemas.struct("uf string, nome string"), sep=";", header=False,
                                encoding=readers.LATIN1, skip_unreadable_files=True, path_column="_source_file")
    rows = df.collect()
    assert [(r.uf, r.nome) for r in rows] == [("SP", "ANA")]


def test_bind_candidates_by_year(spark):
    d = tempfile.mkdtemp(prefix="civic-cand-")
    _write(os.path.join(d, "c_2008.txt"), ";".join(f'"{i}"' for i in range(43)) + "\n")
    _write(os.path.join(d, "c_2012.txt"), ";".join(f'"{i}"' for i in range(58)) + "\n")
    table, _ = raw.bind_candidates(spark, {2008: os.path.join(d, "c_2008.txt"), 2012: os.path.join(d, "c_2012.txt")})
    rows = {r["ANO_ARQUIVO"]: r for r in table.collect()}
    assert rows[2008]["DESC_SIT_TOT_TURNO"] == "42" and rows[2012]["NR_PROCESSO"] == "57"
    assert rows[2008]["NR_PROCESSO"] is None


def test_2012_candidates_reach_the_common_layout(spark, tmp_path):
    from civic_spark.plans import raw
    from civic_spark.sources import schemas

    def line(names, values):
        return ";".join(f'"{values.get(n, "")}"' for n in names) + "\n"

    _write(str(tmp_path / "c_2008.txt"), line(schemas.CANDIDATE_NAMES_BEFORE_2012, {
        "ANO_ELEICAO": "2008", "NOME_CANDIDATO": "ANA", "SIGLA_UE": "00001", "DESPESA_MAX_CAMPANHA": "10,5"}))
    _write(str(tmp_path / "c_2012.txt"), line(schemas.CANDIDATE_NAMES_2012, {
        "ANO_ELEICAO": "2012", "NM_CANDIDATO": "BIA", "SG_UE": "00002", "NM_EMAIL": "b@x", "DS_COR_RACA": "PARDA", "NR_TURNO": "1"}))
    table, _ = raw.bind_candidates(spark, {y: str(tmp_path / f"c_{y}.txt") for y in (2008, 2012)})
    assert table.columns[:len(schemas.CANDIDATE_RAW.fields)] == schemas.CANDIDATE_RAW.fieldNames()
    assert set(table.columns) >= {*schemas.CANDIDATE_NAMES_BEFORE_2012, *schemas.CANDIDATE_NAMES_2012, "ANO_ARQUIVO"}
    got = {r.ANO_ELEICAO: r for r in table.collect()}
    assert (got["2008"].NOME_CANDIDATO, got["2008"].SIGLA_UE, float(got["2008"].DESPESA_MAX_CAMPANHA), got["2008"].EMAIL_CANDIDATO) == ("ANA", "00001", 10.5, None)
    r = got["2012"]
    assert (r.NOME_CANDIDATO, r.SIGLA_UE, r.EMAIL_CANDIDATO, r.DESCRICAO_COR_RACA, r.NUM_TURNO) == ("BIA", "00002", "b@x", "PARDA", 1)


def test_yearly_layouts_keep_orders_without_a_date(spark, monkeypatch):
    from civic_spark.plans import driver_queries
    rows = [(1, "1996-02-03", "O", "1-URGENT", 10.5), (2, "1997-02-03", "F", "5-LOW", 20.25), (3, None, "P", "5-LOW", 30.0)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_orderdate string, o_orderstatus string, o_orderpriority string, o_totalprice double")
    monkeypatch.setattr(driver_queries, "_t", lambda *_: orders.withColumn("o_orderdate", F.to_date("o_orderdate")))
    got = {r.order_id: (r.order_year, r.status, r.priority, float(r.total)) for r in driver_queries.yearly_layouts(spark, "").collect()}
    assert got == {1: (1996, "O", "1-URGENT", 10.5), 2: (1997, "F", None, 20.25), 3: (None, "P", None, 30.0)}
