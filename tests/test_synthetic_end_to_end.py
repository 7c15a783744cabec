"""End to end on synthetic feeds: the runner builds every dataset, then the
SURVEY §5 invariants are checked and the notebook queries N1–N25 run on the
built tables."""

import tempfile

import pytest
from pyspark.sql import functions as F

from civic_spark.plans import notebook as N
from civic_spark.plans import runner


@pytest.fixture(scope="module")
def built(spark):
    from tools.synth_election import generate
    raw = generate(spark, 60)
    out = tempfile.mkdtemp(prefix="civic-nb-")
    paths = runner.build_all(spark, raw, out)
    return {"raw": raw, "paths": paths, "cand": spark.read.parquet(paths["candidate"]),
            "elec": spark.read.parquet(paths["election"])}


def test_invariants(spark, built):
    from civic_spark.plans import chamber
    raw, paths = built["raw"], built["paths"]
    t = {k: spark.read.parquet(v) for k, v in paths.items()}
    # votes are conserved by the zone collapse
    for level in ("local", "fed_state"):
        assert (raw[f"votes_{level}"].agg(F.sum("total_votos")).collect()[0][0]
                == t[f"election_{level}"].agg(F.sum("vote")).collect()[0][0])
    # the level joins keep every vote row (no fan-out, no loss)
    assert t["election"].count() == t["election_local"].count() + t["election_fed_state"].count()
    # one chamber row and one marginal-seat row per municipality and cycle
    assert t["election_chamber"].count() == 60 * 5 and t["election_coalition"].count() == 60 * 5
    full = chamber.build(t["election"], full=True)
    bad = full.filter((F.col("chamber_size") > 0)
                      & (F.abs(F.col("coalition_share") + F.col("opposition_share") - 1) > 1e-12)).count()
    assert bad == 0
    eff = t["election_chamber"].agg(F.min("effective_parties"), F.max("effective_parties")).collect()[0]
    assert 1 <= eff[0] and eff[1] <= 6
    m = t["election_coalition"].agg(F.min("quotient_margin"), F.max("mayor_opposition_flip")).collect()[0]
    assert m[0] is not None and m[1] in (0, 1)


def test_notebook_queries_on_built_datasets(built):
    cand, elec = built["cand"], built["elec"]
    assert N.n1_mayor_candidates_per_year(elec).agg(F.sum("n")).collect()[0][0] == 60 * 5 * 3
    assert {r.coalition_size for r in N.n2_coalition_size_distribution(elec).collect()} == {2}
    p = N.n3_win_probability_by_size(elec).collect()
    assert all(0 <= r.prob_win <= 1 for r in p)
    shares = N.n4_party_share_of_coalitions(elec).groupBy("election_year").agg(F.sum("coalition_prop")).collect()
    assert all(r[1] == pytest.approx(100.0) for r in shares)
    local = N.election_local(cand, elec)
    assert local.count() == 60 * 5 * 3
    assert N.n5_campaign_by_coalition_size(local).count() == 1
    assert all(r.prop == 0 for r in N.n6_missing_campaign_share(local).collect())
    assert N.n7_education_codes(local).count() > 0
    assert N.n8_education_distribution(local).groupBy("election_year").agg(F.sum("prop")).count() == 5
    dup = N.n9_duplicate_persons(cand)          # the same person runs every cycle here
    assert dup.count() > 0 and dup.filter("n < 2").count() == 0
    assert N.n10_missing_person_ids(cand).count() == 0
    assert N.n11_position_codes(cand).count() == 3
    m = N.candidate_mayor(cand).cache()
    # mayors and governors-to-be: every mayor candidacy has the governor of its state two years later
    assert m.filter("position_code = 11 and party_governor is null and election_year < 2016").count() == 0
    assert N.n13_unique_mayors(m).collect()[0][0] == 60 * 3
    rr = N.n14_reelection_rate(m).collect()[0]
    assert rr["previous_mayor"] == 60 * 5 and rr["reelect"] >= 0
    for freq in (N.n12_offices_per_politician(cand), N.n12_offices_per_politician(cand, mayors_only=True)):
        assert sum(r.prop for r in freq.collect()) == pytest.approx(1.0)
    models = N.n17_logits(m)
    assert {r.term for r in models["reelection"].collect()} == {"(Intercept)", "coalition_size_previous", "edu",
                                                                 "gender"}
    lame = N.n18_lame_duck_promotion(m).collect()
    assert lame and lame[0].term == "(Intercept)"
    model, freq = N.n19_career_length(m)
    assert model.count() == 2 and freq.count() > 0
    assert N.n21_age_density(cand).count() > 0
    assert N.n22_education_mix(cand).count() > 0 and N.n22_education_mix(cand, local=False).count() > 0
    assert N.n23_top_occupations(cand).count() == 1 and N.n23_top_occupations(cand, local=False).count() == 1
    assert N.n24_top_occupations_position(cand).count() == 0         # every occupation is "outros"
    top = N.n25_municipal_servants_elected(cand).collect()
    assert {r.position for r in top} == {"prefeito", "vereador", "governador"}
