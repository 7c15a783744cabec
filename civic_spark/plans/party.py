"""D2 ``party``: party votes per municipality (nominal + legend).

1. sentinels → NULL; municipality code padded to 5 (X3);
2. project / rename, member text cleaned (P1, X6);
3. 2002 repair: legend votes recorded for governor / president are nominal
   votes (X15);
4. fold + lower text; national rows out (F14);
5. coalition type by first letter; an isolated party is its own coalition;
6. sum votes over every non-vote column (A1, NA-poisoning);
7. duplicate keys (type, year, code, position, round, party): coalition
   attributes take the group's first non-NULL value and votes are summed
   again (A18 + A14) — one aggregation, unique rows pass through;
8. municipality codes (J1) and the two-tier coalition lookup (J6, type by
   position as well).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, logic, text
from ..operators.aggregates import collapse_sum, reaggregate_duplicates
from .common import attach_municipality, clean_members, coalition_lookup

DUP_GROUP = ["election_type", "election_year", "state", "cod_tse", "position", "position_code", "round", "party",
             "mun_name"]


def build(raw: DataFrame, coalition: DataFrame, municipality_dim: DataFrame) -> DataFrame:
    df = raw.toDF(*[c.lower() for c in raw.columns])
    df = clean.na_sentinels(df, ("#NE#", "#NULO#", ""))
    df = df.withColumn("codigo_municipio", text.pad_left("codigo_municipio", 5))
    df = df.select(
        F.col("ano_eleicao").alias("election_year"), F.col("sigla_uf").alias("state"),
        F.col("descricao_eleicao").alias("election_type"), F.col("codigo_municipio").alias("cod_tse"),
        F.col("num_turno").alias("round"), F.col("codigo_cargo").alias("position_code"),
        F.col("descricao_cargo").alias("position"), F.col("sigla_partido").alias("party"),
        F.col("nome_municipio").alias("mun_name"), clean_members(F.col("composicao_legenda")).alias("coalition"),
        F.col("nome_coligacao").alias("coalition_name"), F.col("tipo_legenda").alias("coalition_type"),
        F.col("qtde_votos_legenda").alias("vote_legend"), F.col("qtde_votos_nominais").alias("vote_nominal"))
    fix = (F.col("election_year") == 2002) & (F.col("vote_legend") > 0) & F.col("position").rlike(
        "^GOVERNADOR|PRESIDENTE")
    df = df.withColumns({
        "vote_nominal": F.when(fix, F.col("vote_legend")).otherwise(F.col("vote_nominal")),
        "vote_legend": F.when(fix, F.lit(0).cast("long")).otherwise(F.col("vote_legend"))})
    df = clean.clean_text(df)
    df = df.filter(F.col("state") != "br")
    ctype = logic.case_when((F.col("coalition_type").rlike("^c"), "coligacao"),
                            (F.col("coalition_type").rlike("^p"), "partido isolado"),
                            default=F.col("coalition_type"))
    df = df.withColumn("coalition_type", ctype)
    df = df.withColumn("coalition", F.when(F.col("coalition_type") == "partido isolado", F.col("party"))
                       .otherwise(F.col("coalition")))
    keys = clean.names_not_matching(df, "vote")
    df = collapse_sum(df, ["vote_legend", "vote_nominal"], keys, poison=True)
    df = reaggregate_duplicates(df, DUP_GROUP, ["vote_legend", "vote_nominal"],
                                fill_first=["coalition", "coalition_name", "coalition_type"],
                                order=["coalition", "coalition_name", "coalition_type"])
    df = attach_municipality(df, municipality_dim)
    return coalition_lookup(df, coalition, with_type_by_position=True)
