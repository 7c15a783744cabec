"""From landed text and gzip files to datasets."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from civic_spark.plans import coalition, landing, votes
from civic_spark.sources import schemas


def _put(path, text, truncate=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = text.encode("latin-1")
    if path.endswith(".gz"):
        data = gzip.compress(data)
    with open(path, "wb") as f:
        f.write(data[:truncate])


def _line(names, values):
    return ";".join(f'"{values.get(n, "")}"' for n in names) + "\n"


def _candidates(base):
    early, y2012 = schemas.CANDIDATE_NAMES_BEFORE_2012, schemas.CANDIDATE_NAMES_2012
    _put(f"{base}/candidate_local/2008/cand_2008_SP.txt.gz", _line(early, {
        "ANO_ELEICAO": "2008", "NOME_CANDIDATO": "JOSÉ", "SIGLA_UE": "00001", "DESPESA_MAX_CAMPANHA": "10,5", "NUMERO_PARTIDO": "13"}) * 3)
    _put(f"{base}/candidate_local/2012/cand_2012_SP.txt", _line(y2012, {
        "ANO_ELEICAO": "2012", "NM_CANDIDATO": "BIA", "SG_UE": "00002", "NR_PROCESSO": "77", "ST_REELEICAO": "S"}))
    _put(f"{base}/candidate_local/2016/cand_2016.csv", "SIGLA_UE;NOME_CANDIDATO;NUM_TURNO;NEW_FIELD\n00003;CAIO;1;x\n")
    for y in (2000, 2004):
        _put(f"{base}/candidate_local/{y}/cand_{y}.txt", _line(early, {"ANO_ELEICAO": str(y), "NOME_CANDIDATO": f"C{y}"}))


def test_good_malformed_and_truncated_files(spark, tmp_path):
    names = ["ANO", "UF", "NOME"]
    feed = landing.Feed(schemas.struct("ANO int, UF string, NOME string"), (2008,), lambda y: names)
    base = f"{tmp_path}/in"
    _put(f"{base}/f/2008/good_2008.txt", '"2008";"SP";"ANA"\n"2008";"RJ";"BIA"\n')
    _put(f"{base}/f/2008/odd_2008.txt", '"2008";"MG"\n"2008";"SP";"LIA"\n')
    _put(f"{base}/f/2008/cut_2008.txt.gz", '"2008";"SP";"NOT READ"\n' * 3, truncate=15)
    status = {os.path.basename(r._source_file): r for r in landing.land_feed(spark, base, "f", f"{tmp_path}/out", feed=feed).collect()}
    assert {k: (r["rows"], r.malformed_rows) for k, r in status.items()} == {"good_2008.txt": (2, 0), "odd_2008.txt": (2, 1), "cut_2008.txt.gz": (0, 0)}
    assert all(r.bytes > 0 for r in status.values())
    got = sorted((r.NOME or "", r.UF, r.ANO, r.ANO_ARQUIVO) for r in landing.dataset(spark, f"{tmp_path}/out", "f").collect())
    assert got == [("", "MG", 2008, 2008), ("ANA", "SP", 2008, 2008), ("BIA", "RJ", 2008, 2008), ("LIA", "SP", 2008, 2008)]


def _files(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_candidates_keep_all_columns_and_years_land_alone(spark, tmp_path):
    base, out = f"{tmp_path}/in", f"{tmp_path}/out"
    _candidates(base)
    landing.land_feed(spark, base, "candidate_local", out)
    t = landing.dataset(spark, out, "candidate_local")
    assert t.columns[:len(schemas.CANDIDATE_RAW.fields)] == schemas.CANDIDATE_RAW.fieldNames()
    rows = {r.ANO_ARQUIVO: r for r in t.collect()}
    assert t.groupBy("ANO_ARQUIVO").count().filter("ANO_ARQUIVO = 2008").first()["count"] == 3
    assert (rows[2008].NOME_CANDIDATO, rows[2008].SIGLA_UE, float(rows[2008].DESPESA_MAX_CAMPANHA), rows[2008].NUMERO_PARTIDO) == ("JOSÉ", "00001", 10.5, "13")
    assert (rows[2012].NOME_CANDIDATO, rows[2012].SIGLA_UE, rows[2012].NR_PROCESSO, rows[2012].ST_REELEICAO) == ("BIA", "00002", "77", "S")
    assert (rows[2016].NOME_CANDIDATO, rows[2016].NUM_TURNO, rows[2016].NEW_FIELD, rows[2016].NR_PROCESSO) == ("CAIO", 1, "x", None)

    before = _files(f"{out}/candidate_local")
    _put(f"{base}/candidate_local/2012/cand_2012_RJ.txt", _line(schemas.CANDIDATE_NAMES_2012, {"NM_CANDIDATO": "EVA", "SG_UE": "00009"}))
    status = landing.land_feed(spark, base, "candidate_local", out, years=[2012])
    assert sorted(os.path.basename(r._source_file) for r in status.collect()) == ["cand_2012_RJ.txt", "cand_2012_SP.txt"]
    after = _files(f"{out}/candidate_local")
    assert {f: t for f, t in before.items() if "=2012" not in f} == {f: t for f, t in after.items() if "=2012" not in f}
    assert {f for f in before if "=2012" in f}.isdisjoint(after)
    again = landing.dataset(spark, out, "candidate_local")
    assert sorted(r.NOME_CANDIDATO for r in again.filter("ANO_ARQUIVO = 2012").collect()) == ["BIA", "EVA"]
    assert again.count() == 8
    with pytest.raises(ValueError):
        landing.land_feed(spark, base, "candidate_local", out, years=[2010])


def test_membership_by_party_and_state(spark, tmp_path):
    base, out = f"{tmp_path}/in", f"{tmp_path}/out"
    header = ";".join(schemas.MEMBERSHIP_RAW.fieldNames()) + "\n"
    row = {"uf": "SP", "nome_do_filiado": "ANA", "sigla_do_partido": "PC do B"}
    _put(f"{base}/membership/filiados_pc_do_b_sp.csv.gz", header + _line(schemas.MEMBERSHIP_RAW.fieldNames(), row) * 2)
    _put(f"{base}/membership/filiados_pt_rj.csv", header + _line(schemas.MEMBERSHIP_RAW.fieldNames(), {**row, "uf": "RJ"}))
    _put(f"{base}/membership/filiados_pt_sp.csv.gz", header * 50, truncate=12)
    status = landing.land_feed(spark, base, "membership", out)
    assert sorted((os.path.basename(r._source_file), r["rows"]) for r in status.collect()) == [
        ("filiados_pc_do_b_sp.csv.gz", 2), ("filiados_pt_rj.csv", 1), ("filiados_pt_sp.csv.gz", 0)]
    got = landing.dataset(spark, out, "membership")
    assert {(r.file_party, r.file_state, r.uf) for r in got.collect()} == {("pc_do_b", "sp", "SP"), ("pt", "rj", "RJ")}
    parties = spark.createDataFrame([("pt",), ("pc_do_b",)], "party string")
    states = spark.createDataFrame([("sp",), ("rj",)], "state string")
    missing = landing.missing_membership_files(parties, states, status)
    assert sorted(tuple(r) for r in missing.collect()) == [("pc_do_b", "rj"), ("pt", "sp")]


def test_feeds_to_datasets(spark, tmp_path):
    """Written CSV and gzip files of the feeds, landed, and datasets built from them."""
    from tools.synth_election import generate
    base, out = f"{tmp_path}/in", f"{tmp_path}/out"
    made = generate(spark, 3)
    year = {"candidate": "ANO_ELEICAO", "details": "ANO_ELEICAO"}
    level = lambda y: F.col(y).cast("int") % 4 == 0
    feeds = [n for n in landing.FEEDS if not n.startswith(("party", "membership"))]
    for kind in ("votes_local", "votes_fed_state", "details", "candidate", "coalition"):
        df, y = made[kind], year.get(kind, "ano_eleicao")
        for name in [n for n in landing.FEEDS if n.startswith(kind)]:
            part = df if name in ("votes_local", "votes_fed_state", "coalition") else df.filter(level(y) if name.endswith("local") else ~level(y))
            feed = landing.FEEDS[name]
            for one in feed.years:
                names = feed.names(one)
                if names:
                    sources = {schemas.CANDIDATE_2012_SOURCES.get(c, c): c for c in df.columns} if one == 2012 else {c: c for c in df.columns}
                    # these layouts have no such column: it is added at the end, as the header years have it
                    cols = [F.col(sources[n]).alias(n) if n in sources else F.lit("").alias(n) for n in names]
                else:
                    cols = df.columns
                rows = part.filter(F.col(y).cast("int") == one).select(*cols)
                w = rows.coalesce(1).write.option("sep", ";").option("encoding", "ISO-8859-1").option("header", str(names is None).lower())
                w.option("compression", "gzip" if one % 8 == 0 else "none").csv(f"{base}/{name}/{one}")
    status = landing.land_all(spark, base, out, feeds)
    assert list(status) == feeds and all(s.agg(F.sum("malformed_rows")).first()[0] == 0 for s in status.values())
    raw = landing.raw_tables(spark, out, made["municipality_dim"], feeds)
    want = {"votes_local": made["votes_local"], "votes_fed_state": made["votes_fed_state"], "coalition": made["coalition"], "candidate": made["candidate"]}
    assert {k: raw[k].count() for k in want} == {k: v.count() for k, v in want.items()}
    level = {k: votes.build(t["votes_local"], coalition.build(t["coalition"]), t["municipality_dim"], level="local") for k, t in (("made", made), ("raw", raw))}
    a, b = level["made"], level["raw"].select(*level["made"].columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    cols = [c for c in made["candidate"].columns if c in raw["candidate"].columns]
    # empty texts land as NULL
    same = [x.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in cols]) for x in (made["candidate"], raw["candidate"])]
    assert same[0].exceptAll(same[1]).isEmpty() and same[1].exceptAll(same[0]).isEmpty()
