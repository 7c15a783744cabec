"""D1 ``coalition``: party × position × round × place × year → coalition members.

Steps (all one lazy plan):
1. fold accents + lower every text column (X1, X2, P9);
2. pad all-digit municipality codes to 5 characters (X3 guarded);
3. sentinels → NULL (F11);
4. project / rename; member text cleaned (X6, Q31);
5. ``isolado`` types become ``partido isolado``; an isolated party is its own
   coalition (X16 — a NULL type leaves the coalition NULL, as in R);
6. keep the first row per (type, year, code, position, round, party) (A15);
7. 2006 and 2010: members rebuilt as the sorted ``a / b / c`` list of the
   parties sharing all other attributes (A13 over a window).  The window is
   bounded by construction: after step 6 a group holds at most one row per
   party, i.e. a few dozen rows whatever the data size;
8. presidential rows (inline parameter table, S16) and existing rows with
   position ≤ 2 are fanned out from the national code to every state code
   (J11); other rows of that set get a NULL code, as the reference's join does;
9. union with the rows of position > 2 (U2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import clean, logic, text
from ..operators.aggregates import keep_first, string_agg_sorted_over
from ..operators.joins import left_join
from ..operators.unions import bind_rows
from .common import clean_members

COLUMNS = ["election_year", "state", "election_type", "cod_tse", "round", "position_code", "party",
           "coalition", "coalition_name", "coalition_type"]
DEDUPE_KEYS = ["election_type", "election_year", "cod_tse", "position_code", "round", "party"]
REBUILD_YEARS = [2006, 2010]

# --- fixed values: presidential coalitions missing from the raw file (kept as
# published, including the 2006 pairing of pt with another ticket's list, Q10) ---
PRESIDENTIAL_ROWS = [
    # (election_year, election_type, round, party, coalition, coalition_name)
    (2006, "eleicoes 2006", 1, "psdb", "psdb/pfl/pps", "coligacao por um brasil decente"),
    (2006, "eleicoes 2006", 2, "psdb", "psdb/pfl/pps", "coligacao por um brasil decente"),
    (2006, "eleicoes 2006", 1, "pt", "psol/pcb/pstu", "frente de esquerda"),
    (2006, "eleicoes 2006", 2, "pt", "psol/pcb/pstu", "frente de esquerda"),
    (2006, "eleicoes 2006", 1, "psol", "pt/prb/pc do b", "a forca do povo"),
    (2010, "eleicoes 2010", 1, "psdb", "psdb/dem/pps/pmn/pt do b/ptb", "o brasil pode mais"),
    (2010, "eleicoes 2010", 2, "psdb", "psdb/dem/pps/pmn/pt do b/ptb", "o brasil pode mais"),
    (2010, "eleicoes 2010", 1, "pt", "pt/pmdb/pdt/pc do b/psb/pr/prb/psc/ptc/ptn", "para o brasil seguir mudando"),
    (2010, "eleicoes 2010", 2, "pt", "pt/pmdb/pdt/pc do b/psb/pr/prb/psc/ptc/ptn", "para o brasil seguir mudando"),
]
NATIONAL = "br"
# --- end of fixed values ---


def presidential_rows(spark: SparkSession) -> DataFrame:
    rows = [(y, t, NATIONAL, NATIONAL, "coligacao", r, 1, p, c, n) for (y, t, r, p, c, n) in PRESIDENTIAL_ROWS]
    return spark.createDataFrame(rows, "election_year int, election_type string, state string, cod_tse string, "
                                       "coalition_type string, round int, position_code int, party string, "
                                       "coalition string, coalition_name string")


def build(raw: DataFrame, *, rebuild_years=REBUILD_YEARS) -> DataFrame:
    """``raw``: the coalition feed (``COALITION_RAW`` layout, any header case)."""
    spark = raw.sparkSession
    df = raw.toDF(*[c.lower() for c in raw.columns])          # Q1 fixed: names lower-cased
    df = clean.clean_text(df)
    df = df.withColumn("sigla_ue", F.when(F.col("sigla_ue").rlike("[a-z]+"), F.col("sigla_ue"))
                       .otherwise(text.pad_left("sigla_ue", 5)))
    df = clean.na_sentinels(df, ("#ne#", "#nulo#", ""))
    df = df.select(
        F.col("ano_eleicao").alias("election_year"), F.col("sigla_uf").alias("state"),
        F.col("descricao_eleicao").alias("election_type"), F.col("sigla_ue").alias("cod_tse"),
        F.col("num_turno").alias("round"), F.col("codigo_cargo").alias("position_code"),
        F.col("sigla_partido").alias("party"), clean_members(F.col("composicao_coligacao")).alias("coalition"),
        F.col("nome_coligacao").alias("coalition_name"), F.col("tipo_legenda").alias("coalition_type"))
    df = clean.map_strings(df, F.lower)
    df = df.withColumn("coalition_type", logic.if_else(F.col("coalition_type").rlike("isolado"),
                                                       F.lit("partido isolado"), F.col("coalition_type")))
    df = df.withColumn("coalition", logic.if_else(F.col("coalition_type") == "partido isolado",
                                                  F.col("party"), F.col("coalition")))
    df = keep_first(df, DEDUPE_KEYS, ["party", "coalition", "coalition_name", "coalition_type", "state"])

    # 2006 / 2010: members = all parties sharing every other attribute
    group = [c for c in df.columns if c not in ("party", "coalition")]
    w = Window.partitionBy(*[F.col(c) for c in group])
    is_rb = F.coalesce(F.col("election_year").isin(list(rebuild_years)), F.lit(False))
    rebuilt = df.filter(is_rb).withColumn("coalition", string_agg_sorted_over("party", w))
    df = bind_rows(df.filter(~is_rb), rebuilt.select(*df.columns))

    # state codes: two-letter codes other than the national one
    states = (df.select("cod_tse").distinct()
                .filter((F.length("cod_tse") <= 2) & (F.col("cod_tse") != NATIONAL))
                .select(F.col("cod_tse").alias("__state_code"), F.lit(NATIONAL).alias("state")))
    top = bind_rows(presidential_rows(spark), df.filter(F.col("position_code") <= 2))
    top = left_join(top, states, "state")
    top = top.withColumn("cod_tse", F.col("__state_code")).withColumn("state", F.col("__state_code")) \
             .drop("__state_code")
    out = bind_rows(df.filter(F.col("position_code") > 2), top)
    return out.select(*COLUMNS)
