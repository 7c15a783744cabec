"""D8 ``election_coalition``: the marginal council seat per municipality.

After the D7 group filters, municipalities keep exactly one elected mayor
(F10); each councillor's coalition (own party when the coalition text is
empty, X27) is on the government side when the mayor's coalition names the
councillor's party as a word (X8), else on the opposition side.  One
``groupBy(year, municipality, coalition, side)`` summarises both sides (A25).
Chamber covariates (seats, quota = votes / seats (A20), effective parties)
come from a second aggregate on the same keys; chambers under nine seats are
dropped (Q24).  The quotient table, last seat and runner-up are computed by
``operators.apportion.marginal_seat`` (X14, W9, W10, A24).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import logic, text
from ..operators import aggregates as A
from ..operators.apportion import marginal_seat
from . import council_partials
from .chamber import COUNCIL, EXCLUDED_MUNICIPALITIES, MAYOR, MUN, _count_if_over, common_filters

MIN_SEATS = 9


def _summary(el) -> dict:
    return {
        "coalition_n_candidates": F.count(F.lit(1)),
        "coalition_n_elected": A.count_if(el == 1, poison=True),
        "coalition_edu": F.avg("edu"),
        "coalition_campaign": F.avg("campaign"),
        "coalition_age": F.avg("age"),
        "coalition_vote": A.sum_skip("vote"),
    }


def coalition_table(election: DataFrame, *, excluded=EXCLUDED_MUNICIPALITIES, match: str = "word",
                    strategy: str = "partials") -> DataFrame:
    """Per (year, municipality, coalition, side): candidates, elected, means,
    votes, plus the chamber covariates of the municipality.

    ``strategy="partials"`` (default): everything from one aggregate of the
    election table (``council_partials``).  ``strategy="aggregate"``: mayor values, chamber covariates and
    the party seat counts are partial aggregates keyed by municipality-year
    (bounded by construction, broadcast back), so a hot municipality never
    sits in one task.  ``strategy="window"``: the same values as windows on
    rows partitioned once by municipality; the final ``groupBy`` refines that
    partitioning and needs no further exchange."""
    if strategy == "partials":
        if "ideology" not in election.columns:
            election = election.withColumn("ideology", F.lit(None).cast("double"))
        return council_partials.council_lists(election, MAYOR, COUNCIL, excluded, match)
    df = common_filters(election, strategy)
    df = df.filter(~F.col("cod_ibge_6").isin(list(excluded)))
    pos, el = F.col("position"), F.col("elected")
    mayor_row = (pos == MAYOR) & (el == 1)
    seat = el == 1
    side = text.detect_word("mayor_coalition", "party", match)
    if strategy == "window":
        w = Window.partitionBy(*MUN)
        df = df.withColumn("__mayors", F.count_if(mayor_row).over(w)).filter(F.col("__mayors") == 1) \
            .drop("__mayors")
        df = df.withColumns({"mayor_party": F.max(F.when(mayor_row, F.col("party"))).over(w),
                             "mayor_coalition": F.max(F.when(mayor_row, F.col("coalition"))).over(w)})
        df = df.withColumn("coalition", logic.empty_to("coalition", "party"))
        council = df.filter(pos == COUNCIL)
        wp = Window.partitionBy(*MUN, "party")
        first = F.row_number().over(wp.orderBy(F.col("candidate_name").asc_nulls_last(),
                                               F.col("position_code").asc_nulls_last())) == 1
        council = council.withColumns({
            "n_available_seats": _count_if_over(seat, w),
            "__votes": F.when(F.count(F.lit(1)).over(w) == F.count("vote").over(w), F.sum("vote").over(w)),
            "__np": _count_if_over(seat, wp), "__first": first})
        council = council.withColumns({
            "electoral_quotient": F.try_divide(F.col("__votes"), F.col("n_available_seats")),
            "effective_parties": F.try_divide(
                F.col("n_available_seats") * F.col("n_available_seats"),
                F.sum(F.when(F.col("__first"), F.col("__np") * F.col("__np"))).over(w))})
        council = council.filter(side.isNotNull())
        aggs = _summary(el)
        aggs.update({c: F.max(c) for c in ("n_available_seats", "electoral_quotient", "effective_parties")})
        return A.split_summary(council, MUN + ["coalition"], side.cast("int"), "mayor_coalition_member", aggs)
    if strategy != "aggregate":
        raise ValueError(strategy)
    # municipality-year keyed tables, joined back; Spark broadcasts them where it measures them small
    mv = df.groupBy(*MUN).agg(F.count_if(mayor_row).alias("__mayors"),
                              F.max(F.when(mayor_row, F.col("party"))).alias("mayor_party"),
                              F.max(F.when(mayor_row, F.col("coalition"))).alias("mayor_coalition"))
    df = df.join(mv.filter(F.col("__mayors") == 1).drop("__mayors"), MUN)
    df = df.withColumn("coalition", logic.empty_to("coalition", "party"))
    council = df.filter(pos == COUNCIL)
    ch = council.groupBy(*MUN).agg(A.count_if(seat, poison=True).alias("n_available_seats"),
                                   A.sum_poison("vote").alias("__votes"))
    per_party = council.groupBy(*MUN, "party").agg(A.count_if(seat, poison=True).alias("__np"))
    eff = per_party.groupBy(*MUN).agg(F.sum(F.col("__np") * F.col("__np")).alias("__sq"))
    ch = ch.join(eff, MUN, "left").select(
        *MUN, "n_available_seats",
        F.try_divide(F.col("__votes"), F.col("n_available_seats")).alias("electoral_quotient"),
        F.try_divide(F.col("n_available_seats") * F.col("n_available_seats"), F.col("__sq")).alias("effective_parties"))
    coal = A.split_summary(council.filter(side.isNotNull()), MUN + ["coalition"], side.cast("int"),
                           "mayor_coalition_member", _summary(el))
    return coal.join(ch, MUN, "left")


def build(election: DataFrame, *, order: str = "round_first", **kw) -> DataFrame:
    """``kw``: ``excluded``, ``match``, ``strategy`` (see ``coalition_table``)."""
    x = coalition_table(election, **kw).filter(F.col("n_available_seats") >= MIN_SEATS)
    out = marginal_seat(x, MUN, "coalition", "coalition_vote", "n_available_seats", "mayor_coalition_member",
                        quota="electoral_quotient", order=order)
    return out.select("cod_ibge_6", "election_year", "mayor_opposition_flip", "quotient_margin", "total_vote")
