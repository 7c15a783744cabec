"""D5 ``election`` (votes ⋈ candidate attributes) and D6 ``elected``.

The vote tables of both levels are bound, foreign / transit rows dropped
(F14), then joined to the candidate table on a level-specific key (J7):

* local years (``year % 4 == 0``): year, municipality, type, round, position,
  number, name;
* state / federal years, positions other than president: state instead of
  municipality;
* president: neither municipality nor state.

Candidates are de-duplicated on the person × candidacy key (A15, Q28: NULL
ids group together), ``elected`` / ``reelected`` derived (X16), columns
ordered (P6).  D6 keeps elected rows without the outcome column (F4, P4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, logic
from ..operators.aggregates import keep_first
from ..operators.joins import split_join_union
from ..operators.unions import bind_rows
from .common import ELECTED_PATTERN, elected_flag

VOTE_COLUMNS = ["election_year", "cod_tse", "party", "cod_ibge_6", "mun_name", "state", "election_type", "round",
                "position", "position_code", "candidate_num", "candidate_name", "candidate_status", "coalition",
                "coalition_name", "coalition_type", "outcome", "vote"]
CANDIDATE_DROP = ["tse_name", "cod_ibge_6", "outcome", "elected", "position", "party", "mun_name",
                  "candidate_status"]
DEDUPE_KEYS = ["cpf_candidate", "elec_title", "birthyear", "candidate_name", "round", "election_type", "cod_tse",
               "position"]
MIN_YEAR = 2000


def build(votes: list[DataFrame], candidate: DataFrame) -> DataFrame:
    """``votes``: the D3 tables (local and state / federal); ``candidate``: D4."""
    ev = bind_rows(*[v.select(*VOTE_COLUMNS) for v in votes]).filter(F.col("election_year") >= MIN_YEAR)
    cand = clean.drop_matching(candidate.drop(*CANDIDATE_DROP), starts="coalition") \
        .filter(F.col("election_year") >= MIN_YEAR)
    ev = ev.filter((F.col("cod_tse") != "zz") & (F.col("state") != "zz") & (F.col("state") != "vt"))
    y, pc = F.col("election_year"), F.col("position_code")
    local_keys = ["election_year", "cod_tse", "election_type", "round", "position_code", "candidate_num",
                  "candidate_name"]
    state_keys = ["election_year", "state", "election_type", "round", "position_code", "candidate_num",
                  "candidate_name"]
    pres_keys = ["election_year", "election_type", "position_code", "candidate_num", "candidate_name", "round"]
    # each branch joins only the candidacies of its own level, so every
    # candidate row is shuffled for one branch, not three
    local = y % 4 == 0
    state_level = (y % 4 == 2) & (pc != 1)
    president = (y % 4 == 2) & (pc == 1)
    out = split_join_union(ev, [
        (local, cand.filter(local).drop("state"), local_keys),
        (state_level, cand.filter(state_level).drop("cod_tse"), state_keys),
        (president, cand.filter(president).drop("cod_tse", "state"), pres_keys),
    ])
    out = keep_first(out, DEDUPE_KEYS, ["election_year", "state", "position_code", "candidate_num", "vote"])
    out = out.withColumn("elected", elected_flag())
    out = out.withColumn("reelected", logic.flag((F.col("incumbent") == 1) & (F.col("elected") == 1)))
    return clean.leading_then_sorted(out, "cpf_candidate", "cod_ibge_6", "election_year")


def elected_only(election: DataFrame) -> DataFrame:
    """Rows whose outcome marks an elected candidate, without ``outcome``."""
    return election.filter(F.col("outcome").rlike(ELECTED_PATTERN)).drop("outcome")
