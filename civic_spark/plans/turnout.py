"""D9 ``vote_count`` (turnout details) and D13 diagnostics.

D9: the official tally per municipality × position × round, with codes padded
(X3), text lowered and folded (P9), foreign / transit / header-residue rows
dropped (F14), municipality codes attached (J1), all counts summed over the
remaining columns (A4, ``na.rm``), turnout rebuilt as the sum of its four
parts (Q2 fix) and registered voters as turnout + abstention.  Then the
candidate-level votes of D5 are summed to the same grain (A1) and the tally
is repaired where the microdata are larger (J8 right join + X15; Q7 kept:
where the microdata are smaller or missing, turnout and registered voters
take the tally's nominal count).

D13: microdata totals beside the official tally (J14), and totals per
municipality × position × year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, text
from ..operators.aggregates import sum_all, sum_poison
from ..operators.joins import left_join, right_join
from .common import attach_municipality

DROP_STATES = ("zz", "spool off", "", "vt")
GRAIN = ["cod_ibge_6", "election_year", "round", "position", "election_type"]


def tally(details: DataFrame, municipality_dim: DataFrame) -> DataFrame:
    d = details.toDF(*[c.upper() for c in details.columns])
    d = d.select(
        text.pad_left("CODIGO_MUNICIPIO", 5).alias("cod_tse"), F.col("ANO_ELEICAO").alias("election_year"),
        F.col("SIGLA_UF").alias("state"), F.col("DESCRICAO_ELEICAO").alias("election_type"),
        F.col("NUM_TURNO").alias("round"), F.col("CODIGO_CARGO").alias("position_code"),
        F.col("DESCRICAO_CARGO").alias("position"), F.col("QTD_APTOS").alias("registered_voters"),
        F.col("QTD_COMPARECIMENTO").alias("vote_turnout"), F.col("QTD_ABSTENCOES").alias("vote_abstention"),
        F.col("QTD_VOTOS_NOMINAIS").alias("vote_nominal"),
        (F.col("QTD_VOTOS_BRANCOS") + F.col("QTD_VOTOS_NULOS")).alias("vote_blank"),
        F.col("QTD_VOTOS_LEGENDA").alias("vote_legend"), F.col("QTD_VOTOS_ANULADOS").alias("vote_cancelled"))
    d = clean.clean_text(d)
    st = F.col("state")
    d = d.filter(~st.isin(list(DROP_STATES)))
    d = attach_municipality(d, municipality_dim)
    keys = [c for c in d.columns if not (c.startswith("vote") or c.endswith("voters"))]
    d = sum_all(d, keys, na_rm=True)
    turnout = F.col("vote_nominal") + F.col("vote_blank") + F.col("vote_legend") + F.col("vote_cancelled")
    return d.withColumn("vote_turnout", turnout) \
            .withColumn("registered_voters", F.col("vote_turnout") + F.col("vote_abstention"))


def microdata_totals(election: DataFrame) -> DataFrame:
    return election.groupBy(*GRAIN).agg(sum_poison("vote").alias("vote_nominal"))


def build(details: DataFrame, municipality_dim: DataFrame, election: DataFrame) -> DataFrame:
    t = tally(details, municipality_dim).withColumnRenamed("vote_nominal", "tally_nominal")
    m = microdata_totals(election).withColumnRenamed("vote_nominal", "micro_nominal")
    x = right_join(m, t, GRAIN)
    micro, tal = F.col("micro_nominal"), F.col("tally_nominal")
    ok = micro >= tal
    parts = F.col("vote_blank") + F.col("vote_legend") + F.col("vote_cancelled")
    x = x.withColumn("vote_turnout", F.when(ok, micro + parts).otherwise(tal))
    x = x.withColumn("registered_voters", F.when(ok, F.col("vote_turnout") + F.col("vote_abstention")).otherwise(tal))
    x = x.withColumn("vote_nominal", F.when(ok, micro).otherwise(tal)).drop("micro_nominal", "tally_nominal")
    return clean.leading_then_sorted(x, "cod_tse", "cod_ibge_6", "election_year")


def diagnostics(election: DataFrame, vote_count: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(microdata vs tally per grain, totals per municipality × position × year)."""
    m = microdata_totals(election)
    right = vote_count.select(*GRAIN, "registered_voters",
                              *[F.col(c).alias("vote_nominal_2") if c == "vote_nominal" else F.col(c)
                                for c in vote_count.columns if c.startswith("vote")])
    compare = left_join(m, right, GRAIN)
    per_mun = vote_count.groupBy("cod_ibge_6", "position", "election_year").agg(
        sum_poison("vote_nominal").alias("vote_nominal"), sum_poison("vote_turnout").alias("vote_turnout"))
    return compare, per_mun
