"""Shared pieces of the dataset builders: the coalition lookup (J6 as used by
D2, D3 and D4), the municipality dimension (S15 / J1) and year cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.logic import in_seq
from ..operators.aggregates import keep_first
from ..operators.joins import left_join
from ..operators.unions import bind_rows

# --- fixed values: election cycles and lookup keys ---
LOCAL_YEARS = (2000, 2016, 4)        # municipal elections
FED_YEARS = (2002, 2014, 4)          # state / federal elections
WIDE_POSITION_MAX = 7                # position codes up to 7 take the state-level coalition
LOCAL_KEYS = ["election_year", "state", "cod_tse", "election_type", "round", "position_code", "party"]
WIDE_KEYS = ["election_year", "state", "election_type", "round", "position_code", "party"]
ELECTED_PATTERN = "^eleito|media"
# --- end of fixed values ---


def municipality_codes(dim: DataFrame) -> DataFrame:
    """``cod_tse → cod_ibge_6`` (first six characters of the 7-digit code),
    one row per electoral code."""
    d = dim.select("cod_tse", F.substring("cod_ibge_7", 1, 6).alias("cod_ibge_6"))
    return keep_first(d, ["cod_tse"], ["cod_ibge_6"])


def attach_municipality(df: DataFrame, dim: DataFrame, on: str = "cod_tse", prefix: str = "") -> DataFrame:
    """Left join the municipality dimension."""
    codes = municipality_codes(dim)
    if prefix:
        codes = codes.withColumnRenamed("cod_ibge_6", f"{prefix}cod_ibge_6")
    return left_join(df, codes, on, "cod_tse")


def coalition_lookup(df: DataFrame, coalition: DataFrame, with_type_by_position: bool = False) -> DataFrame:
    """J6 on D1: fill ``coalition``, ``coalition_name`` (and ``coalition_type``).

    * local lookup: D1 rows of municipal years on the seven local keys;
    * wide lookup: D1 rows of state / federal years, without the municipality;
    * ``coalition`` / ``coalition_name``: the original value if present, else
      the wide match for position codes ≤ 7 and the local match above 7
      (NULL position → NULL, as the reference's ``case_when`` gives);
    * ``coalition_type``: D2 chooses by position like the others
      (``with_type_by_position``); D3 / D4 take the local type, else the wide
      type (Q30: the suffixes meant different things there).

    Each lookup is de-duplicated on its key first, so the joins cannot fan out.
    """
    cols = ["coalition", "coalition_name", "coalition_type"]
    y = F.col("election_year")
    loc = coalition.filter(in_seq(y, *LOCAL_YEARS))
    wid = coalition.filter(in_seq(y, *FED_YEARS))
    loc = keep_first(loc.select(*LOCAL_KEYS, *cols), LOCAL_KEYS, cols)
    wid = keep_first(wid.select(*WIDE_KEYS, *cols), WIDE_KEYS, cols)
    loc = loc.select(*LOCAL_KEYS, *[F.col(c).alias(f"loc_{c}") for c in cols])
    wid = wid.select(*WIDE_KEYS, *[F.col(c).alias(f"fed_{c}") for c in cols])
    # The two lookups cover disjoint years (year % 4 == 0 vs == 2), so a row can
    # only ever match one of them: split the rows by cycle and join each part to
    # its own lookup — every row is shuffled once, not once per lookup.
    is_loc = F.coalesce(in_seq(y, *LOCAL_YEARS), F.lit(False))
    is_fed = F.coalesce(in_seq(y, *FED_YEARS), F.lit(False))
    out = bind_rows(left_join(df.filter(is_loc), loc, LOCAL_KEYS),
                    left_join(df.filter(is_fed), wid, WIDE_KEYS),
                    df.filter(~is_loc & ~is_fed))
    for c in cols:
        for side in ("loc", "fed"):
            if f"{side}_{c}" not in out.columns:
                out = out.withColumn(f"{side}_{c}", F.lit(None).cast("string"))
    pc = F.col("position_code")

    def pick(c: str) -> Column:
        orig = F.col(c) if c in df.columns else F.lit(None).cast("string")
        chosen = F.when(pc <= WIDE_POSITION_MAX, F.col(f"fed_{c}")).when(pc > WIDE_POSITION_MAX, F.col(f"loc_{c}"))
        return F.when(orig.isNull(), chosen).otherwise(orig)

    new = {"coalition": pick("coalition"), "coalition_name": pick("coalition_name")}
    if with_type_by_position:
        new["coalition_type"] = pick("coalition_type")
    else:
        new["coalition_type"] = F.coalesce(F.col("loc_coalition_type"), F.col("fed_coalition_type"))
    out = out.withColumns(new)
    return out.drop(*[f"loc_{c}" for c in cols], *[f"fed_{c}" for c in cols])


def elected_flag(outcome: str = "outcome") -> Column:
    """``if_else(str_detect(outcome, '^eleito|media'), 1, 0)`` (NULL outcome → NULL)."""
    p = F.col(outcome).rlike(ELECTED_PATTERN)
    return F.when(p, 1).when(~p, 0)


def clean_members(c: Column) -> Column:
    """Coalition member text: drop dashes and digits, then a leading ``/ ``
    (``12 - PT / 15 - PMDB`` → ``  pt /   pmdb`` after lowering; Q31 kept)."""
    x = F.regexp_replace(F.regexp_replace(c, "-", ""), "[0-9]+", "")
    return F.regexp_replace(x, "^/\\s", "")
