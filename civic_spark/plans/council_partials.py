"""Mergeable partials behind D7 and D8: the election table is aggregated once.

Every filter and measure of D7 and D8 looks at rows through a few values: the municipality and year, the type, the
position, the party and the coalition.  One partial aggregate by these (``GRAIN``) holds counts, sums and second
moments; it has a few rows per party and municipality whatever the number of candidacies, and is written once.  Group
filters (F7–F10), the mayor's values (W8), the three sides' measures, the chamber's covariates and the lists of D8 are
then formed at that grain: a predicate is the same for all rows of a partial, so a conditional count is a sum of counts.
A municipality that holds a third of all rows costs each map task a few partial rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import logic, text
from ..functions.logic import in_seq
from ..operators import groups
from ..operators.joins import left_join
from ..session import cut_lineage
from .common import ELECTED_PATTERN, LOCAL_YEARS

MUN = ["election_year", "cod_ibge_6"]
F7_KEYS = ["cod_ibge_6", "cod_tse", "election_type", "position"]
GRAIN = [*MUN, "cod_tse", "election_type", "position", "party", "coalition"]
#: Averaged columns, over all rows (D8) and over elected rows (D7, with the age on election day).
MEANS = ("edu", "campaign", "age")


def local_rows(election: DataFrame) -> DataFrame:
    """Municipal years, with D7's age of a candidate as ``__age``."""
    return election.filter(in_seq(F.col("election_year"), *LOCAL_YEARS)).withColumn(
        "__age", F.col("election_year") - logic.try_int("birthyear"))


def partials(rows: DataFrame) -> DataFrame:
    """One row per ``GRAIN``.  Suffix ``_e``: over elected rows."""
    el, ideology = F.col("elected") == 1, F.col("ideology")
    won = F.col("outcome").rlike(ELECTED_PATTERN)
    aggs = {"n": F.count(F.lit(1)), "n_e": F.count_if(el), "el_null": F.count_if(F.col("elected").isNull()),
            "second": F.count_if(F.col("round") == 2), "round_null": F.count_if(F.col("round").isNull()),
            "won": F.count_if(won), "vote": F.sum("vote"), "vote_n": F.count("vote"),
            "vote_e": F.sum(F.when(el, F.col("vote")))}
    for c in MEANS:
        own = F.when(el, F.col("__age" if c == "age" else c))
        aggs |= {f"{c}_s": F.sum(c), f"{c}_n": F.count(c), f"{c}_es": F.sum(own), f"{c}_en": F.count(own)}
    own = F.when(el, ideology)
    aggs |= {"ideology_en": F.count(own), "ideology_em": F.avg(own), "ideology_ev": F.var_pop(own)}
    return rows.groupBy(*GRAIN).agg(*[v.alias(f"p_{k}") for k, v in aggs.items()])


def survivors(part: DataFrame) -> DataFrame:
    """F8, F9 and F7 over partials: one election type, no second round, groups with an elected row."""
    part = groups.keep_groups_single_value(part, MUN, "election_type")
    second = F.when(F.col("p_second") > 0, True).when(F.col("p_round_null") == 0, False)      # NULL: NA, which F9 drops
    part = groups.drop_groups_any(part, MUN, second)
    return groups.keep_groups_any(part, F7_KEYS, F.col("p_won") > 0)


def filtered_partials(election: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(municipal rows, surviving partials); the partials are written once."""
    rows = local_rows(election)
    return rows, survivors(cut_lineage(partials(rows)))


def with_mayor(part: DataFrame, mayor: str) -> DataFrame:
    """F10 + W8: partials of municipalities with exactly one elected mayor, with the mayor's party and coalition."""
    elected_mayor = (F.col("position") == mayor) & (F.col("p_n_e") > 0)
    values = part.groupBy(*MUN).agg(F.sum(F.when(F.col("position") == mayor, F.col("p_n_e"))).alias("__mayors"),
                                    F.max(F.when(elected_mayor, F.col("party"))).alias("mayor_party"),
                                    F.max(F.when(elected_mayor, F.col("coalition"))).alias("mayor_coalition"))
    return part.join(values.filter(F.col("__mayors") == 1).drop("__mayors"), MUN)


def count_of(pred: Column, n: str) -> Column:
    """Count of rows with ``pred``, NULL where it is NULL for a row (R's ``sum`` of a condition)."""
    undecided = F.count_if(pred.isNull() & (F.col(n) > 0))
    return F.when(undecided == 0, F.coalesce(F.sum(F.when(pred, F.col(n))), F.lit(0)))


def mean_of(pred: Column, total: str, n: str, kind) -> Column:
    """Mean over the rows with ``pred``, of the type that an average of the rows has."""
    return F.try_divide(F.sum(F.when(pred, F.col(total))), F.sum(F.when(pred, F.col(n)))).cast(kind)


def sd_of(pred: Column) -> tuple[Column, Column]:
    """Mean and sample deviation of the elected rows' ideology with ``pred``, from merged moments."""
    n, m, v = F.col("p_ideology_en"), F.col("p_ideology_em"), F.col("p_ideology_ev")
    pick = lambda x: F.sum(F.when(pred & (n > 0), x))
    mean = F.try_divide(pick(n * m), pick(n))
    inside, between = pick(n * v), pick(n * m * m) - F.try_divide(pick(n * m) * pick(n * m), pick(n))
    return mean, F.sqrt(F.try_divide(F.greatest(inside + between, F.lit(0.0)), pick(n) - 1))


def side_measures(prefix: str, member: Column, ideology_prefix: str, council: Column, kinds: dict) -> dict[str, Column]:
    """D7's measures of one side (mayor party, coalition, opposition) over elected councillors."""
    sel = council & member
    share = F.try_divide(count_of(sel, "p_n_e"), count_of(council, "p_n_e"))
    mean, deviation = sd_of(sel)
    return {
        f"{prefix}_share": share,
        f"{prefix}_margin": share - 0.5,
        f"{prefix}_majority": logic.flag(share > 0.5),
        **{f"{prefix}_{c}": mean_of(sel, f"p_{c}_es", f"p_{c}_en", kinds[c]) for c in MEANS},
        f"{prefix}_vote": F.coalesce(F.sum(F.when(sel, F.col("p_vote_e"))), F.lit(0)),
        f"{ideology_prefix}_ideology_mean": mean,
        f"{ideology_prefix}_ideology_sd": deviation,
    }


def mean_kinds(election: DataFrame) -> dict:
    return {f.name: f.dataType for f in election.select(*[F.avg(c).alias(c) for c in MEANS]).schema.fields}


def effective(per_party: DataFrame, seats: str) -> DataFrame:
    """A19 denominators: squared seats of the parties, summed per municipality."""
    return per_party.groupBy(*MUN).agg(F.sum(F.col(seats) * F.col(seats)).alias("__sq"))


def chamber_tables(election: DataFrame, mayor: str, council: str, excluded, match: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mayor rows, measures, vote totals) of D7, the tables one row per municipality and year."""
    rows, part = filtered_partials(election)
    pos = F.col("position")
    total = lambda p: F.coalesce(F.sum(F.when(pos == p, F.col("p_vote"))), F.lit(0))
    totals = part.groupBy(*MUN).agg(total(mayor).alias("total_vote_mayor"), total(council).alias("total_vote_legislative"))
    # a municipality counts for its elected rows only
    elected = with_mayor(part.filter((F.col("p_n_e") > 0) & ~F.col("cod_ibge_6").isin(list(excluded))), mayor)
    sits = pos == council
    member = logic.flag(text.detect_word("mayor_coalition", "party", match) & sits)
    elected = elected.withColumn("coalition_member", member)
    kinds = mean_kinds(election)
    measures = (side_measures("mayor_party", F.col("party") == F.col("mayor_party"), "mayor_party", sits, kinds)
                | side_measures("coalition", F.col("coalition_member") == 1, "coalition_party", sits, kinds)
                | side_measures("opposition", F.col("coalition_member") != 1, "opposition_party", sits, kinds)
                | {"chamber_size": count_of(sits, "p_n_e")})
    table = elected.groupBy(*MUN).agg(*[v.alias(k) for k, v in measures.items()])
    per_party = elected.groupBy(*MUN, "party").agg(count_of(sits, "p_n_e").alias("__n"))
    table = left_join(table, effective(per_party, "__n"), MUN).withColumn(
        "effective_parties", F.try_divide(F.col("chamber_size") * F.col("chamber_size"), F.col("__sq"))).drop("__sq")
    # the mayors' own rows: a filtered read, kept where their group survived and their municipality has one mayor
    kept = elected.filter(pos == mayor).select(*MUN, *F7_KEYS[1:], "coalition_member", "mayor_party", "mayor_coalition")
    mayors = left_join(rows.filter((pos == mayor) & (F.col("elected") == 1)), kept, [*MUN, *F7_KEYS[1:]], how="inner")
    return mayors, table, totals


def council_lists(election: DataFrame, mayor: str, council: str, excluded, match: str) -> DataFrame:
    """D8's lists: per municipality, coalition and side, with the chamber's seats, quotient and effective parties."""
    _, part = filtered_partials(election)
    part = with_mayor(part.filter(~F.col("cod_ibge_6").isin(list(excluded))), mayor)
    part = part.withColumn("coalition", logic.empty_to("coalition", "party")).filter(F.col("position") == council)
    seats = F.when(F.sum("p_el_null") == 0, F.sum("p_n_e"))
    chamber = part.groupBy(*MUN).agg(seats.alias("n_available_seats"), F.when(F.sum("p_vote_n") == F.sum("p_n"), F.sum("p_vote")).alias("__votes"))
    per_party = part.groupBy(*MUN, "party").agg(seats.alias("__n"))
    chamber = chamber.join(effective(per_party, "__n"), MUN, "left").select(
        *MUN, "n_available_seats", F.try_divide(F.col("__votes"), F.col("n_available_seats")).alias("electoral_quotient"),
        F.try_divide(F.col("n_available_seats") * F.col("n_available_seats"), F.col("__sq")).alias("effective_parties"))
    side = text.detect_word("mayor_coalition", "party", match)
    kinds, every = mean_kinds(election), F.lit(True)
    lists = part.filter(side.isNotNull()).withColumn("mayor_coalition_member", side.cast("int")).groupBy(
        *MUN, "coalition", "mayor_coalition_member").agg(
            F.sum("p_n").alias("coalition_n_candidates"), seats.alias("coalition_n_elected"),
            *[mean_of(every, f"p_{c}_s", f"p_{c}_n", kinds[c]).alias(f"coalition_{c}") for c in MEANS],
            F.coalesce(F.sum("p_vote"), F.lit(0)).alias("coalition_vote"))
    return lists.join(chamber, MUN, "left")
