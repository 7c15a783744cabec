"""D12 ``filiado``: one party-membership record with dates and candidate ids.

Names lowered (P11), municipality codes joined on the record's municipality
(J3), fields renamed and the voter title padded to 12 (P1, X3), text lowered
(P10), day-first dates parsed (X21) and their years derived (X22); the
termination year is the later of end / cancel years, 2019 when neither
exists (X18, X19; Q3 fix).  Candidate ids come from D4: defective ids out
(F13, NULL kept as R's ``%in%`` does), distinct (title, id, name) rows (A16),
title padded, then a left join on the title (J12).  The title join uses plain
equality (documented deviation from R's NA = NA matching: NULL titles would
otherwise pair all untitled members with all untitled candidates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, logic, text
from ..operators.joins import left_join
from .common import municipality_codes

# --- fixed values ---
DEFAULT_TERMINATION_YEAR = 2019
DEFECTIVE_IDS = ("", "0", "0" * 11, "9" * 11)
TITLE_WIDTH = 12
# --- end of fixed values ---


def build(raw: DataFrame, candidate: DataFrame, municipality_dim: DataFrame) -> DataFrame:
    df = clean.rename_with(raw, str.lower)
    df = left_join(df, municipality_codes(municipality_dim), "codigo_do_municipio", "cod_tse")
    df = df.select(
        "cod_ibge_6", F.col("uf").alias("state"), F.col("nome_do_municipio").alias("mun_name"),
        F.col("zona_eleitoral").alias("electoral_zone"), F.col("secao_eleitoral").alias("electoral_section"),
        text.pad_left("numero_da_inscricao", TITLE_WIDTH).alias("electoral_title"),
        F.col("nome_do_filiado").alias("member_name"), F.col("sigla_do_partido").alias("party"),
        F.col("data_da_extracao").alias("date_record_extraction"), F.col("data_da_filiacao").alias("date_start"),
        F.col("data_da_desfiliacao").alias("date_end"), F.col("data_do_cancelamento").alias("date_cancel"),
        F.col("motivo_do_cancelamento").alias("reason_cancel"), F.col("situacao_do_registro").alias("member_status"))
    df = clean.map_strings(df, F.lower)
    dates = clean.select_names(df.columns, starts="date")
    df = clean.map_columns(df, dates, logic.parse_dmy)
    df = df.withColumns({"year_" + d[len("date_"):]: F.year(d) for d in dates})
    df = df.withColumn("year_termination", logic.replace_na(logic.pmax("year_end", "year_cancel"),
                                                            DEFAULT_TERMINATION_YEAR))
    title = text.pad_left("elec_title", TITLE_WIDTH)
    ids = candidate.filter(logic.not_in("cpf_candidate", DEFECTIVE_IDS)) \
        .select(title.alias("electoral_title"), "cpf_candidate", "candidate_name") \
        .filter(F.col("electoral_title").rlike("[^0]")).distinct()
    # A missing, empty or all-zero title identifies nobody: such candidates are left
    # out and equality is plain, so members without a title stay unmatched instead
    # of pairing with every candidate without one.
    return left_join(df, ids, "electoral_title", null_safe=False)
