"""D3 ``election_local`` / ``election_fed_state``: votes per candidate × municipality.

1. sentinels → NULL (F11);
2. electoral zones collapsed: sum of votes over every column but zone and
   votes, NA-poisoning (A1 + P13) — done first, before any join;
3. rename (P2); drop 2014 rows with zero votes (F6);
4. fold + lower text (P9);
5. state / federal feed only: drop the double-counted presidential second
   round whose outcome is "2º turno" (Q4: matched as ``^2.? turno$`` after
   folding);
6. municipality codes (J1, broadcast) and the two-tier coalition lookup (J6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..operators.aggregates import collapse_sum
from .common import attach_municipality, coalition_lookup

SECOND_ROUND_OUTCOME = "^2.? turno$"


def build(raw: DataFrame, coalition: DataFrame, municipality_dim: DataFrame, *, level: str) -> DataFrame:
    """``raw``: the vote feed (``ELECTION_RAW``); ``level``: 'local' or 'fed_state'."""
    df = raw.toDF(*[c.lower() for c in raw.columns])
    df = clean.na_sentinels(df, ("#NE#", "#NULO#", ""))
    keys = clean.names_not_matching(df, "numero_zona|total_votos")
    df = collapse_sum(df.drop("numero_zona"), ["total_votos"], keys, poison=True)
    df = df.select(
        F.col("ano_eleicao").alias("election_year"), F.col("sigla_uf").alias("state"),
        F.col("descricao_eleicao").alias("election_type"), F.col("codigo_municipio").alias("cod_tse"),
        F.col("nome_candidato").alias("candidate_name"), F.col("numero_cand").alias("candidate_num"),
        F.col("desc_sit_candidato").alias("candidate_status"), F.col("num_turno").alias("round"),
        F.col("codigo_cargo").alias("position_code"), F.col("descricao_cargo").alias("position"),
        F.col("sigla_partido").alias("party"), F.col("nome_municipio").alias("mun_name"),
        F.col("composicao_legenda").alias("coalition"), F.col("nome_coligacao").alias("coalition_name"),
        F.col("desc_sit_cand_tot").alias("outcome"), F.col("total_votos").alias("vote"))
    df = df.filter(~((F.col("election_year") == 2014) & (F.col("vote") == 0)))
    df = clean.clean_text(df)
    if level == "fed_state":
        df = df.filter(~((F.col("position_code") == 1) & (F.col("round") == 2)
                         & F.col("outcome").rlike(SECOND_ROUND_OUTCOME)))
    df = attach_municipality(df, municipality_dim)
    return coalition_lookup(df, coalition)
