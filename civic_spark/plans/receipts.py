"""D10 ``campaign_local`` / ``campaign_fed_state``: campaign receipts 2002–2016.

Eight yearly layouts (one per election year) are normalised (S11), mapped to
one canonical layout (S13, registry below), tagged with their year from the
file name (S14, Q32 fix), bound (U2) and cleaned: codes padded (X3, Q12),
sentinels → NULL (F11), quotes / backslashes stripped (X6), zero-value
receipts dropped (F4).  The candidate id is repaired from D4, first on the
state-level key (state, name, number, year), then on the municipal key
(municipality, name, number, year) (J3, J5); the id table is de-duplicated
on each key first so a receipt never multiplies (J12).  Defective ids are
dropped (F12, F13) and the table is split by election cycle (S21), the local
part with municipality codes (J1).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, text
from ..functions.logic import in_seq
from ..operators.aggregates import keep_first
from ..operators.joins import left_join
from ..operators.unions import bind_all
from ..sources.readers import adapt_layout, normalise_header
from ..sources.schemas import RECEIPT_CANONICAL
from .common import FED_YEARS, LOCAL_YEARS, attach_municipality

# --- fixed values: yearly receipt layouts, canonical name ← source column ---
LAYOUTS: dict[int, dict[str, str]] = {
    2002: {"cod_uf": "sg_uf", "party": "sg_part", "candidate_name": "no_cand", "candidate_num": "nr_cand",
           "position": "ds_cargo", "cod_uf_donor": "sg_uf_doador", "cpf_cnpj_donor": "cd_cpf_cgc",
           "donor_name": "no_doador", "date_receipt": "dt_receita", "value_receipt": "vr_receita",
           "type_resource": "tp_recurso"},
    2004: {"cod_tse": "sg_ue", "party": "sg_part", "candidate_name": "no_cand", "candidate_num": "nr_cand",
           "position": "ds_cargo", "position_code": "cd_cargo", "donation_status": "rv_meaning",
           "cpf_cnpj_donor": "cd_cpf_cgc_doa", "donor_name": "no_doador", "type_source": "rtrim_ltrim_dr_ds_titulo_",
           "type_resource": "decode_rec_tp_recurso_0_emespecie_1_cheque_2_estimado__naoinformado_",
           "value_receipt": "vr_receita"},
    2006: {"cod_uf": "unidade_eleitoral_candidato", "party": "sigla_partido", "candidate_name": "nome_candidato",
           "candidate_num": "numero_candidato", "cpf_candidate": "numero_cnpj_candidato",
           "position": "descricao_cargo", "position_code": "codigo_cargo", "cpf_cnpj_donor": "numero_cpf_cgc_doador",
           "mun_donor": "unidade_eleitoral_doador", "donor_name": "nome_doador", "type_source": "tipo_receita",
           "type_resource": "descricao_tipo_recurso", "value_receipt": "valor_receita"},
    2008: {"cod_tse": "sg_ue", "party": "sg_partido", "candidate_name": "nm_candidato",
           "candidate_num": "nr_candidato", "cpf_candidate": "cd_num_cpf", "position": "ds_cargo",
           "position_code": "cd_cargo", "cpf_cnpj_donor": "cd_cpf_cnpj_doador", "cod_tse_donor": "sg_ue_1",
           "donor_name": "nm_doador", "type_source": "ds_titulo", "type_resource": "ds_esp_recurso",
           "campaign_manager_name": "nm_adm", "cpf_campaign_manager": "cd_cpf_adm", "date_receipt": "dt_receita",
           "value_receipt": "vr_receita"},
    2010: {"cod_uf": "uf", "party": "sigla_partido", "candidate_name": "nome_candidato",
           "candidate_num": "numero_candidato", "position": "cargo", "cpf_candidate": "cpf_do_candidato",
           "receipt_number": "numero_recibo_eleitoral", "cpf_cnpj_donor": "cpf_cnpj_do_doador",
           "donor_name": "nome_do_doador", "date_receipt": "data_da_receita", "value_receipt": "valor_receita",
           "type_source": "tipo_receita", "type_resource": "tipo_receita", "desc_resource": "especie_recurso"},
    2012: {"cod_uf": "uf", "cod_tse": "numero_ue", "party": "sigla_partido", "candidate_num": "numero_candidato",
           "position": "cargo", "cpf_candidate": "cpf_do_candidato", "receipt_number": "numero_recibo_eleitoral",
           "cpf_cnpj_donor": "cpf_cnpj_do_doador", "donor_name_tax": "nome_do_doador_receita_federal_",
           "donor_name": "nome_do_doador", "cod_tse_donor": "sigla_ue_doador", "party_donor": "numero_partido_doador",
           "candidate_num_donor": "numero_candidato_doador", "cod_sector_donor": "cod_setor_economico_do_doador",
           "desc_sector_donor": "setor_economico_do_doador", "date_receipt": "data_da_receita",
           "value_receipt": "valor_receita", "origin_resource": "fonte_recurso", "type_source": "tipo_receita",
           "type_resource": "especie_recurso", "desc_resource": "descricao_da_receita"},
    2014: {"election_code": "cod_eleicao", "election_type": "desc_eleicao", "cod_uf": "uf",
           "party": "sigla_partido", "candidate_num": "numero_candidato", "position": "cargo",
           "cpf_candidate": "cpf_do_candidato", "receipt_number": "numero_recibo_eleitoral",
           "cpf_cnpj_donor": "cpf_cnpj_do_doador", "donor_name": "nome_do_doador",
           "donor_name_tax": "nome_do_doador_receita_federal_", "cod_tse_donor": "sigla_ue_doador",
           "party_donor": "numero_partido_doador", "candidate_num_donor": "numero_candidato_doador",
           "cod_sector_donor": "cod_setor_economico_do_doador", "desc_sector_donor": "setor_economico_do_doador",
           "date_receipt": "data_da_receita", "value_receipt": "valor_receita", "origin_resource": "fonte_recurso",
           "type_source": "tipo_receita", "type_resource": "especie_recurso", "desc_resource": "descricao_da_receita"},
    2016: {"election_code": "cod_eleicao", "election_type": "desc_eleicao", "cod_tse": "sigla_da_ue",
           "party": "sigla_partido", "candidate_num": "numero_candidato", "position": "cargo",
           "cpf_candidate": "cpf_do_candidato", "receipt_number": "numero_recibo_eleitoral",
           "cpf_cnpj_donor": "cpf_cnpj_do_doador", "donor_name": "nome_do_doador",
           "donor_name_tax": "nome_do_doador_receita_federal_", "cod_tse_donor": "sigla_ue_doador",
           "party_donor": "numero_partido_doador", "candidate_num_donor": "numero_candidato_doador",
           "cod_sector_donor": "cod_setor_economico_do_doador", "desc_sector_donor": "setor_economico_do_doador",
           "date_receipt": "data_da_receita", "value_receipt": "valor_receita", "origin_resource": "fonte_recurso",
           "type_source": "tipo_receita", "type_resource": "especie_recurso", "desc_resource": "descricao_da_receita"},
}
HEADER_RESIDUE_YEAR, HEADER_RESIDUE = 2010, "UF"
SENTINELS = ("#nulo", "#NULO", "#nulo#", "#NULO#")
DEFECTIVE_ID = "00000000000"
# --- end of fixed values ---


def adapt(frames: Mapping[int, DataFrame]) -> DataFrame:
    """S11 + S13 + S14 + P9/P10 + U2: yearly tables → one canonical table."""
    parts = []
    for year, raw in frames.items():
        df = normalise_header(raw)
        if year == HEADER_RESIDUE_YEAR and "uf" in df.columns:
            df = df.filter(F.col("uf") != HEADER_RESIDUE)
        a = adapt_layout(df, LAYOUTS[year], RECEIPT_CANONICAL).withColumn("election_year", F.lit(year))
        a = clean.map_strings(a, F.lower)
        a = clean.map_columns(a, clean.select_names(a.columns, contains="name", starts="type")
                              + clean.select_names(a.columns, starts="desc"), text.fold_accents)
        parts.append(a)
    return bind_all(parts)


def _repair_id(df: DataFrame, ids: DataFrame, left_keys, right_keys) -> DataFrame:
    r = keep_first(ids.select(*right_keys, "cpf_candidate"), list(right_keys), ["cpf_candidate"])
    r = r.withColumnRenamed("cpf_candidate", "__cpf")
    x = left_join(df, r, list(left_keys), list(right_keys))
    own = F.col("cpf_candidate")
    bad = (own == "") | own.isNull() | (F.length(own) > 11)
    return x.withColumn("cpf_candidate", F.when(bad, F.col("__cpf")).otherwise(own)).drop("__cpf")


def build(frames: Mapping[int, DataFrame], candidate: DataFrame, municipality_dim: DataFrame) -> dict[str, DataFrame]:
    df = adapt(frames)
    df = df.withColumns({"cod_tse": text.pad_left("cod_tse", 5), "cod_tse_donor": text.pad_left("cod_tse_donor", 5)})
    df = clean.na_sentinels(df, SENTINELS)
    df = clean.map_strings(df, lambda c: F.regexp_replace(F.regexp_replace(c, '"', ""), r"\\", ""))
    df = df.filter(~(F.col("value_receipt") == 0))
    ids = candidate.select("cpf_candidate", "election_year", "cod_tse", "state",
                           F.col("candidate_num").cast("string").alias("candidate_num"), "candidate_name") \
        .distinct().filter(F.col("cpf_candidate") != "0")
    fed = ids.filter(F.col("election_year") % 4 == 2).withColumnRenamed("state", "cod_uf")
    df = _repair_id(df, fed, ["cod_uf", "candidate_name", "candidate_num", "election_year"],
                    ["cod_uf", "candidate_name", "candidate_num", "election_year"])
    loc = ids.filter(F.col("election_year") % 4 == 0)
    df = _repair_id(df, loc, ["cod_tse", "candidate_name", "candidate_num", "election_year"],
                    ["cod_tse", "candidate_name", "candidate_num", "election_year"])
    df = df.filter((F.length("cpf_candidate") > 1) & (F.length("cpf_cnpj_donor") > 1)
                   & (F.col("cpf_candidate") != DEFECTIVE_ID) & (F.col("cpf_cnpj_donor") != DEFECTIVE_ID))
    df = clean.leading_then_sorted(df, "cod_uf", "cod_tse", "election_year", "cpf_candidate")
    y = F.col("election_year")
    return {"campaign_fed_state": df.filter(in_seq(y, *FED_YEARS)),
            "campaign_local": attach_municipality(df.filter(in_seq(y, *LOCAL_YEARS)), municipality_dim)}

