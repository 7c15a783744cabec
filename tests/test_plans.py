"""End-to-end dataset builders on the micro election (tests/election_world.py)."""

import pytest
from pyspark.sql import functions as F

from civic_spark.plans import chamber, coalition, election, marginal_seat, notebook, turnout, votes
from civic_spark.plans import candidate as cand_plan
from tests import election_world as W


@pytest.fixture(scope="module")
def world(spark):
    from civic_spark.session import cut_lineage
    f = W.frames(spark)
    # each stage materialised, as the runner does (plans downstream start from a table)
    coal = cut_lineage(coalition.build(f["coalition"]))
    local = cut_lineage(votes.build(f["votes"], coal, f["dim"], level="local"))
    cand = cut_lineage(cand_plan.build(f["candidate"], coal, f["dim"], supplementary_max_rows=1))
    elec = cut_lineage(election.build([local], cand))
    return {**f, "coal": coal, "local": local, "cand": cand, "elec": elec}


def by(df, **eq):
    cond = F.lit(True)
    for k, v in eq.items():
        cond = cond & (F.col(k) == v)
    return [r.asDict() for r in df.filter(cond).collect()]


def test_d1_coalition(world):
    c = world["coal"]
    pt = by(c, election_year=2016, party="pt")
    assert len(pt) == 1 and pt[0]["cod_tse"] == "00001" and pt[0]["coalition"] == "  pt /   pmdb"
    assert pt[0]["coalition_type"] == "coligacao"
    psdb = by(c, election_year=2016, party="psdb")[0]
    assert psdb["coalition"] == "psdb" and psdb["coalition_type"] == "partido isolado"
    ro = by(c, election_year=2010, state="ro", position_code=6)
    assert sorted(r["coalition"] for r in ro) == ["pdt / pt", "pdt / pt"]
    pres = c.filter(F.col("position_code") == 1)
    assert pres.count() == 18                                   # 9 inline rows × 2 state codes
    assert {r["cod_tse"] for r in pres.collect()} == {"ro", "sp"}
    assert c.count() == 24


def test_d3_votes_collapse_and_filters(world):
    v = world["local"]
    assert by(v, candidate_name="a")[0]["vote"] == 600
    assert by(v, candidate_name="v4")[0]["vote"] == 120
    assert by(v, candidate_name="x")[0]["vote"] is None           # NA-poisoned zone sum
    assert by(v, candidate_name="z") == []                        # 2014 zero votes dropped
    a = by(v, candidate_name="a")[0]
    assert a["cod_ibge_6"] == "110001" and a["coalition_name"] == "unidos" and a["coalition_type"] == "coligacao"
    assert a["outcome"] == "eleito" and a["election_type"] == "eleicao ordinaria"


def test_d4_candidate_careers_and_incumbency(world):
    c = world["cand"]
    assert c.count() == 15                                        # duplicate candidacy removed
    a16 = by(c, candidate_name="a", election_year=2016)[0]
    a12 = by(c, candidate_name="a", election_year=2012)[0]
    assert (a16["incumbent"], a12["incumbent"]) == (1, None)
    assert (a16["times_run"], a16["times_office"], a12["times_run"]) == (2, 2, 1)
    assert a16["outcome_previous"] == "eleito" and a16["position_code_previous"] == 11
    assert by(c, candidate_name="b")[0]["incumbent"] == 0
    cc = by(c, candidate_name="c")[0]
    assert cc["outcome"] == "indeferido" and cc["elected"] == 0 and cc["birthyear"] == "19na"
    assert by(c, candidate_name="d")[0]["outcome"] == cand_plan.NO_OUTCOME_TEXT
    assert c.columns[:3] == ["cpf_candidate", "cod_ibge_6", "election_year"]


def test_d5_d6_election(world):
    e = world["elec"]
    a = by(e, candidate_name="a")[0]
    assert a["reelected"] == 1 and a["elected"] == 1 and a["cpf_candidate"] == "00000000001"
    assert by(e, candidate_name="b")[0]["reelected"] == 0
    assert election.elected_only(e).filter("candidate_name = 'v7'").count() == 0
    assert "outcome" not in election.elected_only(e).columns


def test_d7_chamber(world):
    out = chamber.build(world["elec"])
    rows = out.collect()
    assert len(rows) == 1                                         # 00002 has a second round
    r = rows[0].asDict()
    assert r["cod_ibge_6"] == "110001" and r["candidate_name"] == "a"
    assert r["chamber_size"] == 9
    assert r["mayor_party_share"] == pytest.approx(3 / 9)
    assert r["coalition_share"] == pytest.approx(5 / 9) and r["coalition_majority"] == 1
    assert r["effective_parties"] == pytest.approx(81 / 23)
    assert (r["total_vote_mayor"], r["total_vote_legislative"]) == (1000, 675)
    assert r["mayor_party_vote"] == 215 and r["mayor_party_edu"] == pytest.approx(23 / 3)
    assert r["mayor_coalition_size"] == 2 and r["mayor_male"] == 1 and r["mayor_age"] == 56
    assert (r["mayor_incumbent"], r["mayor_reelected"], r["time_office"]) == (1, 1, 0)
    assert r["opposition_party_ideology_mean"] is None
    full = chamber.build(world["elec"], full=True).collect()[0].asDict()
    assert full["opposition_share"] == pytest.approx(4 / 9)
    assert full["vote_margin"] == pytest.approx((600 - 400) / 400)


def test_d8_marginal_seat(world):
    r = marginal_seat.build(world["elec"]).collect()
    assert len(r) == 1
    r = r[0].asDict()
    assert r["mayor_opposition_flip"] == 0 and r["total_vote"] == 2090
    assert r["quotient_margin"] == pytest.approx((140 / 3 - 245 / 4) / 2090)
    h = marginal_seat.build(world["elec"], order="highest_average").collect()[0].asDict()
    assert h["mayor_opposition_flip"] == 1 and h["total_vote"] == 2180
    assert h["quotient_margin"] == pytest.approx(3.75 / 2180)


def test_d9_turnout_and_d13(world, spark):
    vc = turnout.build(world["details"], world["dim"], world["elec"])
    p = by(vc, position="prefeito")[0]
    assert (p["vote_nominal"], p["vote_turnout"], p["registered_voters"]) == (1000, 1090, 1590)
    v = by(vc, position="vereador")[0]
    assert (v["vote_nominal"], v["vote_turnout"], v["registered_voters"]) == (700, 700, 700)
    assert vc.filter("state = 'zz'").count() == 0
    compare, per_mun = turnout.diagnostics(world["elec"], vc)
    assert by(compare, position="prefeito", cod_ibge_6="110001")[0]["vote_nominal_2"] == 1000
    assert per_mun.count() == 2


def test_notebook_queries_run(world):
    e, c = world["elec"], world["cand"]
    assert notebook.n1_mayor_candidates_per_year(e).collect()[0]["n"] == 3
    assert {r["coalition_size"] for r in notebook.n2_coalition_size_distribution(e).collect()} == {1, 2}
    m = notebook.candidate_mayor(c)
    assert notebook.n13_unique_mayors(m).collect()[0][0] == 3
    rr = notebook.n14_reelection_rate(m).collect()[0]
    assert rr["reelect"] == 1
    for fn in (notebook.n3_win_probability_by_size, notebook.n4_party_share_of_coalitions):
        assert fn(e).count() > 0
    for fn in (notebook.n10_missing_person_ids, notebook.n11_position_codes, notebook.n22_education_mix,
               notebook.n23_top_occupations, notebook.n24_top_occupations_position,
               notebook.n25_municipal_servants_elected, notebook.n9_duplicate_persons):
        assert fn(c).count() >= 0
    top = notebook.n25_municipal_servants_elected(c).collect()
    assert top[0]["prop"] == pytest.approx(100.0)
    loc = notebook.election_local(c, e)
    for fn in (notebook.n5_campaign_by_coalition_size, notebook.n6_missing_campaign_share,
               notebook.n7_education_codes, notebook.n8_education_distribution):
        assert fn(loc).count() >= 0


def test_d2_party(world):
    from civic_spark.plans import party
    out = party.build(world["party"], world["coal"], world["dim"])
    pt = by(out, party="pt")[0]
    assert (pt["vote_nominal"], pt["vote_legend"], pt["cod_tse"], pt["cod_ibge_6"]) == (150, 15, "00001", "110001")
    assert pt["coalition"] == "  pt /   pmdb" and pt["coalition_type"] == "coligacao"
    psdb = by(out, party="psdb")
    assert len(psdb) == 1 and psdb[0]["vote_nominal"] == 30 and psdb[0]["coalition_type"] == "partido isolado"
    assert psdb[0]["coalition"] == "psdb"
    pv = by(out, party="pv")
    assert len(pv) == 1 and (pv[0]["vote_nominal"], pv[0]["vote_legend"]) == (7, 0)


def test_d3_state_level_second_round_filter(spark, world):
    from civic_spark.sources import schemas
    rows = [W._vote(2002, "00001", "P", 13, 1, "PRESIDENTE", "PT", "PT", "2º TURNO", 1, 100, rnd=2),
            W._vote(2002, "00001", "P", 13, 1, "PRESIDENTE", "PT", "PT", "ELEITO", 1, 100, rnd=1)]
    raw = spark.createDataFrame([tuple(r[f.name] for f in schemas.ELECTION_RAW.fields) for r in rows],
                                schemas.ELECTION_RAW)
    out = votes.build(raw, world["coal"], world["dim"], level="fed_state").collect()
    assert [r["round"] for r in out] == [1]


def test_runner_materialises_every_dataset(spark):
    import tempfile

    from civic_spark.plans import runner
    f = W.frames(spark)
    raw = {"municipality_dim": f["dim"], "coalition": f["coalition"], "party": f["party"],
           "votes_local": f["votes"], "candidate": f["candidate"], "details": f["details"]}
    out = tempfile.mkdtemp(prefix="civic-run-")
    paths = runner.build_all(spark, raw, out)
    assert set(paths) >= {"coalition", "party", "election_local", "candidate", "election", "elected",
                          "election_chamber", "election_coalition", "vote_count", "diagnostics_tally"}
    ch = spark.read.parquet(paths["election_chamber"]).collect()
    # the candidate table was built with the default supplementary threshold (1,000 rows):
    # every type of the tiny fixture is "supplementary", so there is no incumbency match
    assert len(ch) == 1 and ch[0]["chamber_size"] == 9 and ch[0]["mayor_incumbent"] == 0
    mc = spark.read.parquet(paths["election_coalition"]).collect()
    assert len(mc) == 1 and mc[0]["total_vote"] == 2090
