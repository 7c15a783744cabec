"""D7 / D8 edge cases (FIXTURES.md §3) on an election table built directly."""

import random

import pytest
from pyspark.sql import functions as F

from civic_spark.plans import chamber, marginal_seat

COLS = ("cpf_candidate string, elec_title string, candidate_name string, cod_ibge_6 string, cod_tse string, "
        "round int, mun_name string, election_year int, birthyear string, candidate_status string, party string, "
        "campaign double, edu int, age int, gender int, edu_desc string, coalition string, coalition_name string, "
        "position string, position_code int, position_previous string, occupation string, election_type string, "
        "outcome string, outcome_previous string, incumbent int, elected int, reelected int, vote long")


def row(mun, name, position, party, coalition, outcome, vote, etype="eleicao ordinaria"):
    elected = 1 if outcome in ("eleito", "eleito por qp", "media") else 0
    code = 11 if position == "prefeito" else 13
    return (f"c-{mun}-{name}", f"t-{mun}-{name}", name, mun, "c" + mun, 1, "m", 2016, "1970", "deferido", party,
            100.0, 5, 40, 2, "x", coalition, None, position, code, None, "o", etype, outcome, None, 0, elected, 0,
            vote)


def council(mun, n_elected, lists, extra=()):
    rows = [row(mun, f"mayor-{mun}", "prefeito", "pt", "pt / pv", "eleito", 500)]
    i = 0
    for party, votes in lists:
        for v in votes:
            outcome = "eleito por qp" if i < n_elected else "suplente"
            rows.append(row(mun, f"v{i}-{mun}", "vereador", party, party, outcome, v))
            i += 1
    return rows + list(extra)


@pytest.fixture(scope="module")
def elections(spark):
    rows = []
    rows += council("100001", 8, [("pt", [50, 40, 30, 20]), ("psdb", [45, 35, 25, 15])])          # 8 seats
    rows += council("100002", 9, [("pt", [50] * 5), ("psdb", [40] * 5)],
                    extra=[row("100002", "z", "vereador", "pv", "pv", "suplente", 1, etype="eleicao suplementar")])
    rows += council("100003", 9, [("pt", [50] * 5), ("psdb", [40] * 5)],
                    extra=[row("100003", "m2", "prefeito", "psdb", "psdb", "eleito", 400)])              # two mayors
    rows += council("221040", 9, [("pt", [50] * 5), ("psdb", [40] * 5)])                              # excluded
    rows += council("100005", 0, [("pt", [50] * 3), ("psdb", [40] * 3)])                              # nobody elected
    rows += council("100006", 9, [("pt", [1000] * 9 + [0]), ("psdb", [10]), ("dem", [10])])          # one list over quota
    return spark.createDataFrame(rows, COLS)


def test_chamber_edges(elections):
    out = {r["cod_ibge_6"]: r.asDict() for r in chamber.build(elections).collect()}
    assert set(out) == {"100001", "100005", "100006"}
    assert out["100001"]["chamber_size"] == 8 and out["100001"]["mayor_party_share"] == pytest.approx(0.5)
    e = out["100005"]
    assert e["chamber_size"] == 0 and e["mayor_party_share"] is None and e["effective_parties"] is None
    assert e["mayor_party_edu"] is None and e["mayor_party_vote"] == 0


def test_marginal_seat_edges(elections):
    out = {r["cod_ibge_6"]: r.asDict() for r in marginal_seat.build(elections).collect()}
    assert set(out) == {"100006"}                    # 8 seats, type / mayor / exclusion / nobody elected all out
    r = out["100006"]
    # pt (9000 votes, side 1) is the only list over the quota: nine quotient rows for ten places
    assert r["mayor_opposition_flip"] == 0 and r["total_vote"] == 9 * 9000
    assert r["quotient_margin"] == pytest.approx((9000 / 8 - 9000 / 9) / (9 * 9000))


def _same(a, b):
    assert a.columns == b.columns and [f.dataType for f in a.schema] == [f.dataType for f in b.schema]
    norm = lambda df: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)
    assert norm(a) == norm(b)


@pytest.fixture(scope="module")
def odd_elections(spark, elections):
    """Random chambers with missing parties, coalitions, outcomes, votes and rounds, and decimal campaigns."""
    rng = random.Random(8)
    rows = []
    for m in range(60):
        mun = str(200000 + m)
        rows.append(row(mun, "mayor", "prefeito", rng.choice(["pt", "pv", None]), rng.choice(["pt / pv", "pv", "", None]), "eleito", 500))
        for i in range(rng.randint(0, 30)):
            party = rng.choice(["pt", "pv", "psdb", "dem"] if m % 3 else ["pt", "pv", None])
            r = list(row(mun, f"v{i}", rng.choice(["vereador"] * 9 + ["vice"]), party, rng.choice([party, "psdb / dem", "", None]),
                         rng.choice(["eleito por qp", "media", "suplente", None]), rng.choice([rng.randint(1, 900)] * 20 + [None])))
            r[5] = rng.choice([1] * 200 + [None, 2])
            r[8], r[11], r[12], r[13] = rng.choice(["1970", "19na", "1988"]), rng.choice([None, 10.25, 99.5]), rng.choice([None, 3, 7]), rng.choice([None, 20, 63])
            r[26] = rng.choice([r[26]] * 30 + [None])
            rows.append(tuple(r))
    ideology = F.when(F.col("party") == "pt", F.length("candidate_name") / 7.0).when(F.col("party") == "dem", 0.75)
    return (spark.createDataFrame(rows, COLS).unionByName(elections).withColumn("ideology", ideology)
            .withColumn("campaign", F.col("campaign").cast("decimal(18,2)")))


@pytest.mark.parametrize("full", [False, True])
def test_chamber_strategies_agree(elections, odd_elections, full):
    for table in (elections, odd_elections):
        first = chamber.build(table, strategy="partials", full=full)
        _same(first, chamber.build(table, strategy="aggregate", full=full))
    _same(first, chamber.build(table, strategy="window", full=full))
    assert first.count() > 10


def test_marginal_seat_strategies_agree(elections, odd_elections):
    for table in (elections, odd_elections):
        first = marginal_seat.coalition_table(table, strategy="partials")
        other = marginal_seat.coalition_table(table, strategy="aggregate")
        _same(first.select(sorted(first.columns)), other.select(sorted(other.columns)))
        a = marginal_seat.build(table, strategy="partials").collect()
        b = marginal_seat.build(table, strategy="window").collect()
        assert sorted(tuple(r) for r in a) == sorted(tuple(r) for r in b)


def test_partials_read_the_election_table_once(spark, elections, tmp_path):
    """One aggregate of the table and one filtered read of the mayors' rows."""
    elections.withColumn("ideology", F.lit(0.5)).write.parquet(f"{tmp_path}/e")
    e = spark.read.parquet(f"{tmp_path}/e")
    text = chamber.build(e)._jdf.queryExecution().optimizedPlan().toString()
    # the partials are a written table; only the mayors are read from the election table here
    assert text.count("parquet") == 1 and "prefeito" in text
    assert "parquet" not in marginal_seat.coalition_table(e)._jdf.queryExecution().optimizedPlan().toString()
