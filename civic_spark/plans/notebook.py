"""Notebook queries N1–N25 over the candidate (D4) and election (D5) tables.

Each query is a function returning a (small, aggregated) DataFrame; plots of
the reference become the tables they plot.  Q16 fix: the notebooks' column
names are aliases of the dataset columns (``year`` = ``election_year``,
``cpf`` = ``cpf_candidate``, ``candidate_id`` = the person key of the career
counts, ``position_time`` = ``times_run``) and the previous position is
compared through its code (``position_code_previous``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import logic, text
from ..functions.logic import in_seq
from ..operators import aggregates as A
from ..operators import groups, sorting, stats, windows
from ..operators.aggregates import keep_first
from ..operators.joins import shifted_key_join
from .common import LOCAL_YEARS

# --- fixed values ---
MAYOR_CODE, COUNCIL_CODE, GOVERNOR_CODE = 11, 13, 3
SUPPLEMENTARY_CODE = 91
MUNICIPAL_SERVANT_CODE = 298
SAMPLE_SEED, SAMPLE_FRACTION = 1789, 0.25
LOCAL_POSITIONS = ("prefeito", "vereador")
STATE_POSITIONS = ("governador", "deputado estadual", "senador")
FEDERAL_POSITIONS = ("deputado estadual", "governador", "senador", "deputado federal")
NO_OCCUPATION_CODES = (-1, 999)
NO_OCCUPATION_TEXT = ("#ne#", "outros")
# --- end of fixed values ---


def person_id() -> Column:
    """``candidate_id``: the person key used for careers (id, title, name)."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in
                              ("cpf_candidate", "elec_title", "candidate_name")])


def coalition_size(c: str = "coalition") -> Column:
    """X11 + X12: ``sapply(str_split(coalition, '/'), length)``."""
    return text.list_length(c)


def _avg_poison(p: Column) -> Column:
    """R ``mean(p)`` without ``na.rm``: NA when any value is NA."""
    return F.when(F.count(F.lit(1)) == F.count(p), F.avg(p.cast("double")))


def election_mayor(election: DataFrame) -> DataFrame:
    return (election.filter(in_seq(F.col("election_year"), *LOCAL_YEARS))
            .filter((F.col("position") == "prefeito") & (F.col("election_year") > 1996))
            .withColumn("coalition_size", coalition_size()))


def n1_mayor_candidates_per_year(election: DataFrame) -> DataFrame:
    return A.count_by(election_mayor(election), ["election_year"])


def n2_coalition_size_distribution(election: DataFrame) -> DataFrame:
    return A.count_by(election_mayor(election), ["election_year", "coalition_size"])


def n3_win_probability_by_size(election: DataFrame) -> DataFrame:
    return election_mayor(election).groupBy("coalition_size").agg(
        _avg_poison(F.col("outcome") == "eleito").alias("prob_win"), F.count(F.lit(1)).alias("size"))


def n4_party_share_of_coalitions(election: DataFrame) -> DataFrame:
    em = election_mayor(election).filter(F.col("coalition") != "")
    em = groups.with_group_values(em, ["election_year"], {"total_year": F.count(F.lit(1))})
    out = em.groupBy("election_year", "party").agg(
        (F.count(F.lit(1)) / F.avg("total_year") * 100).alias("coalition_prop"))
    return sorting.arrange(out, "election_year", "-coalition_prop")                    # X25


def election_local(candidate: DataFrame, election: DataFrame) -> DataFrame:
    """Deferred mayor candidacies merged with their election rows."""
    cand = (candidate.filter((F.col("candidate_status") == "deferido") & (F.col("position") == "prefeito"))
            .select("election_year", logic.try_int("cod_tse").alias("cod_tse"), "election_type", "candidate_num",
                    "round", "cpf_candidate", "occupation", "birthyear", "edu", "edu_desc", "mun_birth_code",
                    "campaign"))
    em = (election_mayor(election).filter(F.col("candidate_status") == "deferido")
          .drop("cpf_candidate", "edu", "edu_desc", "mun_birth_code", "campaign", "occupation", "birthyear")
          .withColumn("cod_tse", logic.try_int("cod_tse")))
    from ..operators.joins import left_join
    if "round" not in em.columns:
        em = em.withColumn("round", F.lit(None).cast("int"))
    out = left_join(em, cand, ["election_year", "cod_tse", "election_type", "candidate_num", "round"])
    return out.withColumn("coalition_size", coalition_size())


def n5_campaign_by_coalition_size(local: DataFrame) -> DataFrame:
    return local.groupBy("coalition_size").agg(F.avg(logic.sentinel_to_null("campaign", -1)).alias("campaign"))


def n6_missing_campaign_share(local: DataFrame) -> DataFrame:
    return local.groupBy("election_year").agg(_avg_poison(F.col("campaign") == -1).alias("prop"))


def n7_education_codes(local: DataFrame) -> DataFrame:
    d = local.select("edu", "edu_desc").distinct()
    return sorting.arrange(keep_first(d, ["edu"], ["edu_desc"]), "edu")


def n8_education_distribution(local: DataFrame) -> DataFrame:
    return stats.relative_frequency(local, ["election_year"], "edu")


def n9_duplicate_persons(candidate: DataFrame) -> DataFrame:
    t = F.col("election_type")
    c = candidate.filter((F.col("cpf_candidate") != "#nulo#") & (F.col("candidate_status") == "deferido")
                         & ~t.rlike("sup|maj|nova") & t.rlike("^eleic"))
    keys = ["cpf_candidate", "elec_title", "candidate_name", "mun_birth_name", "birthyear"]
    c = groups.with_group_values(c, keys, {"n": F.count(F.lit(1))})
    return c.filter(F.col("n") > 1)


def n10_missing_person_ids(candidate: DataFrame) -> DataFrame:
    cpf = F.col("cpf_candidate")
    return A.count_by(candidate.filter(cpf.isNull() | (cpf == "#nulo#")), ["election_year"])


def n11_position_codes(candidate: DataFrame) -> DataFrame:
    d = keep_first(candidate.select("position_code", "position"), ["position_code"], ["position"])
    return sorting.arrange(d, "position_code")


def candidate_mayor(candidate: DataFrame) -> DataFrame:
    """N15 + N16: mayor career panel with coalition sizes, re-election,
    promotion and governor alignment."""
    c = candidate.filter((F.col("election_year") > 1996) & (F.col("position_code") != SUPPLEMENTARY_CODE))
    c = c.withColumns({"candidate_id": person_id(), "position_time": F.col("times_run")})
    m = c.filter((F.col("position") == "prefeito") | (F.col("position_code_previous") == MAYOR_CODE))
    m = m.withColumn("coalition_size", coalition_size())
    order = ["election_year", "round", "position_code"]
    m = windows.lag_lead(m, ["candidate_id"], order, {"coalition_size_previous": ("coalition_size", 1),
                                                      "__next_pc": ("position_code", -1)})
    pc = F.col("position_code")
    m = m.withColumns({
        "reelect_mayor": logic.flag((pc == MAYOR_CODE) & (F.col("position_code_previous") == MAYOR_CODE)
                                    & (F.col("outcome_previous") == "eleito")),
        "promotion": logic.flag(pc > F.col("__next_pc"))}).drop("__next_pc")
    gov = c.filter((pc == GOVERNOR_CODE) & (F.col("outcome") == "eleito")) \
        .select("election_year", F.col("party").alias("party_governor"), "state")
    gov = keep_first(gov, ["election_year", "state"], ["party_governor"])
    m = shifted_key_join(m, gov, ["state"], "election_year", -2)                       # J13
    return m.withColumn("governor_alignment", logic.flag(F.col("party_governor") == F.col("party")))


def n12_offices_per_politician(candidate: DataFrame, mayors_only: bool = False) -> DataFrame:
    src = candidate_mayor(candidate) if mayors_only else candidate.withColumn("position_time", F.col("times_run"))
    return stats.relative_frequency(src, [], "position_time")


def n13_unique_mayors(mayor: DataFrame) -> DataFrame:
    return mayor.agg(F.count_distinct("candidate_id").alias("n_mayors"))


def n14_reelection_rate(mayor: DataFrame) -> DataFrame:
    """Fix: the notebook reports counts (≈ 11 k re-election runs), so a NULL
    flag (no previous candidacy) counts as 0 instead of poisoning the sum."""
    out = mayor.agg(A.sum_skip("reelect_mayor").alias("reelect"),
                    A.count_if((F.col("position_code") == MAYOR_CODE) & (F.col("outcome") == "eleito"))
                    .alias("previous_mayor"))
    return out.withColumn("percent", F.try_divide(F.col("reelect"), F.col("previous_mayor")))


def n17_logits(mayor: DataFrame) -> dict[str, DataFrame]:
    al = mayor.withColumn("governor_alignment", F.col("governor_alignment").cast("string"))
    prev = al.filter((F.col("position_code_previous") == MAYOR_CODE) & (F.col("outcome_previous") == "eleito"))
    return {
        "reelection": stats.logistic_regression(mayor, "reelect_mayor", ["coalition_size_previous", "edu", "gender"]),
        "promotion": stats.logistic_regression(mayor, "promotion",
                                               ["coalition_size_previous", "edu", "gender", "campaign"]),
        "alignment": stats.logistic_regression(al, "promotion", [], ["governor_alignment"]),
        "alignment_reelection": stats.logistic_regression(prev, "reelect_mayor", [], ["governor_alignment"]),
    }


def n18_lame_duck_promotion(mayor: DataFrame) -> DataFrame:
    m = windows.lag_lead(mayor, ["candidate_id"], ["election_year", "round", "position_code"],
                         {"position_future": ("position_code", -1)})
    m = m.withColumns({"promotion": logic.replace_na(logic.flag(F.col("position_future") < F.col("position_code")), 0),
                       "age": F.col("election_year") - logic.try_int("birthyear")})
    m = m.filter((F.col("position_code") == MAYOR_CODE) & (F.col("outcome") == "eleito")
                 & (F.col("position_code_previous") == MAYOR_CODE) & (F.col("outcome_previous") == "eleito"))
    return stats.linear_regression(m, "promotion", ["governor_alignment", "edu", "age", "gender", "coalition_size"],
                                   ["party"])


def n19_career_length(mayor: DataFrame) -> tuple[DataFrame, DataFrame]:
    model = stats.linear_regression(mayor, "position_time", ["reelect_mayor"])
    lab = mayor.withColumn("reelect_mayor", F.when(F.col("reelect_mayor") == 1, "reelected")
                           .otherwise("non-reelected"))
    freq = A.count_by(lab, ["reelect_mayor", "position_time"], "positions")
    freq = windows.share_within(freq, ["reelect_mayor"], "positions", "n")
    return model, freq


def with_age_local(candidate: DataFrame) -> DataFrame:
    return candidate.withColumns({"age": F.col("election_year") - F.col("birthyear").try_cast("double"),
                                  "local": logic.flag(in_seq(F.col("election_year"), *LOCAL_YEARS))})


def n21_age_density(candidate: DataFrame, positions=LOCAL_POSITIONS, bin_width: float = 1.0) -> DataFrame:
    keys = ["cpf_candidate", "candidate_name", "candidate_num", "cod_tse", "election_year", "round", "position_code"]
    c = with_age_local(candidate)
    c = sorting.sample_exact(c, SAMPLE_FRACTION, [k for k in keys if k in c.columns] or c.columns, SAMPLE_SEED)
    c = c.filter((F.col("age") < 100) & F.col("position").isin(list(positions)))
    return stats.histogram_density(c, ["position"], "age", bin_width)


def n22_education_mix(candidate: DataFrame, local: bool = True) -> DataFrame:
    c = with_age_local(candidate)
    if local:
        c = c.filter((F.col("local") == 1) & F.col("position").isin(list(LOCAL_POSITIONS)))
    else:
        c = c.filter((F.col("local") != 1) & F.col("position").isin(list(FEDERAL_POSITIONS)))
    x = A.count_by(c, ["election_year", "position", "edu"])
    return windows.share_within(x, ["election_year", "position"], "n", "share")


def n23_top_occupations(candidate: DataFrame, local: bool = True, k: int = 20) -> DataFrame:
    c = with_age_local(candidate)
    c = c.filter(~F.col("occupation_code").isin(list(NO_OCCUPATION_CODES)) & (F.col("local") == (1 if local else 0)))
    x = windows.share_of_total(A.count_by(c, ["occupation"]), "n", "pct")
    return sorting.top_k(x, k, "-n", "occupation")


def n24_top_occupations_position(candidate: DataFrame, position_code: int = MAYOR_CODE, k: int = 20) -> DataFrame:
    occ = F.col("occupation")
    c = candidate.filter((F.col("position_code") == position_code) & (occ != NO_OCCUPATION_TEXT[0])
                         & (occ != NO_OCCUPATION_TEXT[1]))
    x = windows.share_of_total(A.count_by(c, ["occupation"]), "n", "prop")
    return sorting.top_k(x, k, "-prop", "occupation")


def n25_municipal_servants_elected(candidate: DataFrame, k: int = 10) -> DataFrame:
    el = F.col("outcome").rlike("^eleito")
    a = A.count_if((F.col("occupation_code") == MUNICIPAL_SERVANT_CODE) & el, True)
    b = A.count_if(el, True)
    x = candidate.groupBy("position").agg(F.try_multiply(F.try_divide(a, b), F.lit(100.0)).alias("prop"))
    return sorting.top_k(x, k, "-prop", "position")
