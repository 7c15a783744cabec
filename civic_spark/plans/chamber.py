"""D7 ``election_chamber``: one row per elected mayor with chamber structure.

Plan shape (default): the election table is aggregated once to mergeable
partials per municipality, year, party and coalition (``council_partials``);
the group filters (F8, F9, F7, F10) and the ~25 measures (A8–A11 over the
councillors) are formed there, and the mayors' own rows are joined to them.
Two more strategies give the same rows: ``aggregate`` filters and aggregates
the rows themselves, ``window`` partitions them once by municipality.

Measures (councillor rows, "vereador"):
* mayor party: seat share, margin over 0.5, majority, mean education /
  campaign / age / ideology, ideology sd, vote sum;
* mayor coalition (party named as a word in the mayor's coalition text, X8,
  Q11): the same set; opposition (not in the coalition) the same set
  (computed; only ideology columns are published, Q19 — ``full=True`` keeps all);
* chamber size; effective number of parties 1 / Σ share² (A19);
* municipal vote totals for mayor and council (A9); victory margin between
  the two most voted rows of the municipality (W7, Q20 — ``full=True``);
* mayor attributes, ``mayor_male`` recoded, prior terms (W3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean, logic, text
from ..functions.logic import in_seq
from ..operators import groups
from ..operators.joins import left_join
from ..operators.windows import sequence_number
from . import council_partials
from .common import ELECTED_PATTERN, LOCAL_YEARS

# --- fixed values ---
MAYOR, COUNCIL = "prefeito", "vereador"
EXCLUDED_MUNICIPALITIES = ("221040",)
MUN = ["election_year", "cod_ibge_6"]
PERSON = ["cpf_candidate", "elec_title", "candidate_name"]
# --- end of fixed values ---


def common_filters(df: DataFrame, strategy: str = "aggregate") -> DataFrame:
    """Steps shared by D7 and D8: municipal years; one election type per
    municipality (F8); no second round (F9); (code, type, position) groups
    with at least one elected row (F7).

    ``strategy="aggregate"``: each group flag is a partial aggregate joined
    back on the group's key, so no task holds a whole municipality.

    ``strategy="window"``: the rows are hash-partitioned once by
    ``cod_ibge_6``; that partitioning satisfies every later window ((year,
    municipality) groups, and the F7 groups keyed (municipality, code, type,
    position) — the same groups, as the code determines the municipality).
    One exchange, but one municipality's rows must fit one task."""
    df = df.filter(in_seq(F.col("election_year"), *LOCAL_YEARS))
    f7_keys = ["cod_ibge_6", "cod_tse", "election_type", "position"]
    elected_row = F.col("outcome").rlike(ELECTED_PATTERN)
    if strategy == "window":
        df = df.repartition("cod_ibge_6")
        df = groups.keep_groups_single_value(df, MUN, "election_type", strategy="window")
        df = groups.drop_groups_any(df, MUN, F.col("round") == 2, strategy="window")
        df = clean.drop_matching(df, starts="round")
        return groups.keep_groups_any(df, f7_keys, elected_row, strategy="window")
    if strategy != "aggregate":
        raise ValueError(strategy)
    df = groups.keep_groups_single_value(df, MUN, "election_type")
    df = groups.drop_groups_any(df, MUN, F.col("round") == 2)
    df = clean.drop_matching(df, starts="round")
    # F7's key table holds free-text election types: no structural bound, so a
    # shuffle semi-join (AQE splits a skewed partition)
    return groups.keep_groups_any(df, f7_keys, elected_row)


def _count_if_over(p: Column, w, poison: bool = True) -> Column:
    n = F.count_if(p).over(w)
    return F.when(F.count(F.lit(1)).over(w) == F.count(p).over(w), n) if poison else n


def _leaf(w):
    """Aggregate leaves as window values (``w``) or as plain aggregates (None)."""
    return (lambda a: a.over(w)) if w is not None else (lambda a: a)


def _count_if(p: Column, w, poison: bool = True) -> Column:
    lf = _leaf(w)
    n = lf(F.count_if(p))
    return F.when(lf(F.count(F.lit(1))) == lf(F.count(p)), n) if poison else n


def _side_measures(prefix: str, member: Column, ideology_prefix: str, w) -> dict[str, Column]:
    """The measure set of one side (mayor party / coalition / opposition):
    window values over the municipality (``w``) or aggregates (``w=None``)
    (A8–A11 over councillors)."""
    lf = _leaf(w)
    council = F.col("position") == COUNCIL
    sel = council & member
    share = F.try_divide(_count_if(sel, w), _count_if(council, w))
    return {
        f"{prefix}_share": share,
        f"{prefix}_margin": share - 0.5,
        f"{prefix}_majority": logic.flag(share > 0.5),
        f"{prefix}_edu": lf(F.avg(F.when(sel, F.col("edu")))),
        f"{prefix}_campaign": lf(F.avg(F.when(sel, F.col("campaign")))),
        f"{prefix}_age": lf(F.avg(F.when(sel, F.col("age")))),
        f"{prefix}_vote": F.coalesce(lf(F.sum(F.when(sel, F.col("vote")))), F.lit(0)),
        f"{ideology_prefix}_ideology_mean": lf(F.avg(F.when(sel, F.col("ideology")))),
        f"{ideology_prefix}_ideology_sd": lf(F.stddev_samp(F.when(sel, F.col("ideology")))),
    }


def _all_measures(w) -> dict[str, Column]:
    council = F.col("position") == COUNCIL
    m = {}
    m.update(_side_measures("mayor_party", F.col("party") == F.col("mayor_party"), "mayor_party", w))
    m.update(_side_measures("coalition", F.col("coalition_member") == 1, "coalition_party", w))
    m.update(_side_measures("opposition", F.col("coalition_member") != 1, "opposition_party", w))
    m["chamber_size"] = _count_if(council, w)
    return m


def _totals(w) -> dict[str, Column]:
    lf, pos = _leaf(w), F.col("position")
    return {"total_vote_mayor": F.coalesce(lf(F.sum(F.when(pos == MAYOR, F.col("vote")))), F.lit(0)),
            "total_vote_legislative": F.coalesce(lf(F.sum(F.when(pos == COUNCIL, F.col("vote")))), F.lit(0))}


def _mayor_values(w) -> dict[str, Column]:
    lf, pos = _leaf(w), F.col("position")
    return {"mayor_party": lf(F.max(F.when(pos == MAYOR, F.col("party")))),
            "mayor_coalition": lf(F.max(F.when(pos == MAYOR, F.col("coalition"))))}


def _vote_margin_rank():
    return Window.partitionBy(*MUN).orderBy(F.col("vote").desc_nulls_last(), F.col("position_code").desc_nulls_last(),
                                            F.col("candidate_name").asc_nulls_last())


def _build_window(df, excluded, full, match):
    w = Window.partitionBy(*MUN)
    pos = F.col("position")
    # W1 totals over all rows of the municipality; the elected rows keep them
    df = df.withColumns(_totals(w))
    if full:                                                  # W7 over all rows of the municipality (Q20)
        df = df.withColumn("__rn", F.row_number().over(_vote_margin_rank()))
        v1 = F.max(F.when(F.col("__rn") == 1, F.col("vote"))).over(w)
        v2 = F.max(F.when(F.col("__rn") == 2, F.col("vote"))).over(w)
        df = df.withColumn("vote_margin", F.try_divide(v1 - v2, v2)).drop("__rn")
    df = df.filter(F.col("elected") == 1) \
        .withColumns({"coalition_size": F.lit(1) + text.count_matches("coalition", "/"),
                      "age": F.col("election_year") - logic.try_int("birthyear")}) \
        .filter(~F.col("cod_ibge_6").isin(list(excluded)))
    df = df.withColumn("__mayors", F.count_if(pos == MAYOR).over(w)) \
        .filter(F.col("__mayors") == 1).drop("__mayors")                             # F10
    df = df.withColumns(_mayor_values(w))                                           # W8
    member = text.detect_word("mayor_coalition", "party", match)
    df = df.withColumn("coalition_member", logic.flag(member & (pos == COUNCIL)))
    measures = _all_measures(w)
    keep = [c for c in measures if full or not c.startswith("opposition_") or "ideology" in c]
    df = df.withColumns({k: measures[k] for k in keep})
    # effective number of parties (A19); the party windows refine the partitioning
    wp = Window.partitionBy(*MUN, "party")
    first = F.row_number().over(wp.orderBy(F.col("candidate_name").asc_nulls_last(),
                                           F.col("position_code").asc_nulls_last())) == 1
    df = df.withColumns({"__np": _count_if_over(pos == COUNCIL, wp), "__first": first})
    sq = F.sum(F.when(F.col("__first"), F.col("__np") * F.col("__np"))).over(w)
    df = df.withColumn("effective_parties", F.try_divide(F.col("chamber_size") * F.col("chamber_size"), sq)) \
        .drop("__np", "__first")
    return df, keep


def _build_aggregate(df, elected, full, match):
    pos = F.col("position")

    tot = df.groupBy(*MUN).agg(*[v.alias(k) for k, v in _totals(None).items()])
    if full:                                                  # W7: partial group limit before the shuffle
        from ..operators.windows import top2_relative_gap
        tot = left_join(tot, top2_relative_gap(df, MUN, "vote", ["-vote", "-position_code", "candidate_name"],
                                               "vote_margin"), MUN)
    # F10 + W8 in one aggregate: municipalities with exactly one elected mayor, and that mayor's values
    mv = elected.groupBy(*MUN).agg(F.count_if(pos == MAYOR).alias("__mayors"),
                                   *[v.alias(k) for k, v in _mayor_values(None).items()])
    mv = mv.filter(F.col("__mayors") == 1).drop("__mayors")
    el = elected.join(mv, MUN)
    member = text.detect_word("mayor_coalition", "party", match)
    el = el.withColumn("coalition_member", logic.flag(member & (pos == COUNCIL)))
    measures = _all_measures(None)
    keep = [c for c in measures if full or not c.startswith("opposition_") or "ideology" in c]
    agg = el.groupBy(*MUN).agg(*[measures[k].alias(k) for k in keep])
    # effective number of parties (A19): two-level aggregate
    per_party = el.groupBy(*MUN, "party").agg(_count_if(pos == COUNCIL, None).alias("__n"))
    eff = per_party.groupBy(*MUN).agg(F.sum(F.col("__n") * F.col("__n")).alias("__sq"))
    agg = left_join(agg, eff, MUN).withColumn(
        "effective_parties", F.try_divide(F.col("chamber_size") * F.col("chamber_size"), F.col("__sq"))).drop("__sq")
    mayors = el.filter(pos == MAYOR)
    out = left_join(mayors, agg, MUN)
    out = left_join(out, tot, MUN)
    return out, keep


def build(election: DataFrame, *, excluded=EXCLUDED_MUNICIPALITIES, full: bool = False,
          match: str = "word", strategy: str = "partials") -> DataFrame:
    """``strategy``: ``"partials"`` (default, one aggregate of the election
    table), ``"aggregate"`` (aggregates of its rows) or ``"window"`` (one
    exchange; a municipality's rows must fit one task).  All give the same rows."""
    df = election
    if "ideology" not in df.columns:                         # Q15: optional input
        df = df.withColumn("ideology", F.lit(None).cast("double"))
    pos = F.col("position")
    if strategy == "partials":
        return _published(*_from_partials(df, excluded, full, match), full)
    df = common_filters(df, strategy)
    elected = df.filter(F.col("elected") == 1) \
        .withColumns({"coalition_size": F.lit(1) + text.count_matches("coalition", "/"),
                      "age": F.col("election_year") - logic.try_int("birthyear")}) \
        .filter(~F.col("cod_ibge_6").isin(list(excluded)))
    if strategy == "window":
        df, keep = _build_window(df, excluded, full, match)
    else:
        df, keep = _build_aggregate(df, elected, full, match)
    return _published(df.filter(pos == MAYOR), keep, full)


def _from_partials(df, excluded, full, match):
    mayors, measures, totals = council_partials.chamber_tables(df, MAYOR, COUNCIL, excluded, match)
    if full:                                                  # W7 over the surviving rows of the municipality (Q20)
        from ..operators.windows import top2_relative_gap
        rows, part = council_partials.filtered_partials(df)
        alive = left_join(rows, part.select(*MUN, *council_partials.F7_KEYS[1:]).distinct(), [*MUN, *council_partials.F7_KEYS[1:]], how="left_semi")
        totals = left_join(totals, top2_relative_gap(alive, MUN, "vote", ["-vote", "-position_code", "candidate_name"], "vote_margin"), MUN)
    keep = [c for c in measures.columns if c not in (*MUN, "effective_parties") and (full or not c.startswith("opposition_") or "ideology" in c)]
    out = mayors.withColumns({"coalition_size": F.lit(1) + text.count_matches("coalition", "/"), "age": F.col("__age")})
    out = out.drop("mayor_party", "mayor_coalition")
    return left_join(left_join(out, measures.select(*MUN, *keep, "effective_parties"), MUN), totals, MUN), keep


def _published(out: DataFrame, keep: list[str], full: bool) -> DataFrame:
    gender = F.col("gender")
    male = F.when(gender == 2, 1).when(gender == 4, 0)
    sel = [
        "cod_ibge_6", "candidate_name", "cpf_candidate", "elec_title", "election_year", "mun_name",
        F.col("age").alias("mayor_age"), "birthyear", F.col("edu").alias("mayor_edu"), male.alias("mayor_male"),
        F.col("edu_desc").alias("mayor_edu_desc"), F.col("party").alias("mayor_party"),
        F.col("campaign").alias("mayor_campaign"), F.col("coalition").alias("mayor_coalition"),
        F.col("occupation").alias("mayor_occupation"), F.col("coalition_size").alias("mayor_coalition_size"),
        F.col("incumbent").alias("mayor_incumbent"), F.col("reelected").alias("mayor_reelected"),
        *[c for c in keep if c.startswith("mayor_party_")],
        *[c for c in ["coalition_name", "coalition_member"] if c in out.columns],
        *[c for c in keep if c.startswith("coalition")], "chamber_size",
        *[c for c in ["outcome", "outcome_previous", "ideology"] if c in out.columns],
        *[c for c in keep if c.startswith("opposition")],
        *[c for c in ["position", "position_code", "position_previous"] if c in out.columns],
        "total_vote_mayor", "total_vote_legislative", "effective_parties", *(["vote_margin"] if full else []),
    ]
    out = out.select(*sel)
    out = sequence_number(out, PERSON, ["election_year", "cod_ibge_6"], "time_office", -1)
    return clean.leading_then_sorted(out, "cod_ibge_6", "election_year")
