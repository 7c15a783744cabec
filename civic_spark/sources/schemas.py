"""Explicit schemas per raw feed (S8): ids are text, counts long, money decimal."""

from __future__ import annotations

import re

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()
MONEY = T.DecimalType(18, 2)


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
          "date": T.DateType()}


def struct(spec: str) -> T.StructType:
    """``'a string, b int, c decimal(18,2)'`` → StructType (names may contain ``/``)."""
    fields = []
    for name, typ in re.findall(r"([^\s,]+) (string|int|long|double|date|decimal\(\d+,\d+\))", spec):
        if typ.startswith("decimal"):
            p, s_ = re.findall(r"\d+", typ)
            dt = T.DecimalType(int(p), int(s_))
        else:
            dt = _TYPES[typ]
        fields.append(T.StructField(name, dt, True))
    return T.StructType(fields)


MUNICIPALITY_DIM = struct("cod_tse string, cod_ibge_7 string, state string, mun_name_tse string")

CANDIDATE_RAW = struct(
    "SIGLA_UE string, ANO_ELEICAO string, DESCRICAO_UE string, SIGLA_UF string, DESCRICAO_ELEICAO string, "
    "NUM_TURNO int, CODIGO_CARGO int, DESCRICAO_CARGO string, NOME_CANDIDATO string, NUMERO_CANDIDATO int, "
    "DES_SITUACAO_CANDIDATURA string, CPF_CANDIDATO string, SIGLA_PARTIDO string, COMPOSICAO_LEGENDA string, "
    "NOME_COLIGACAO string, CODIGO_OCUPACAO int, DESCRICAO_OCUPACAO string, DATA_NASCIMENTO string, "
    "NUM_TITULO_ELEITORAL_CANDIDATO string, IDADE_DATA_ELEICAO int, CODIGO_SEXO int, COD_GRAU_INSTRUCAO int, "
    "DESCRICAO_GRAU_INSTRUCAO string, CODIGO_MUNICIPIO_NASCIMENTO string, NOME_MUNICIPIO_NASCIMENTO string, "
    "DESPESA_MAX_CAMPANHA decimal(18,2), DESC_SIT_TOT_TURNO string, EMAIL_CANDIDATO string, "
    "DESCRICAO_COR_RACA string, DESCRICAO_ESTADO_CIVIL string")

ELECTION_RAW = struct(
    "ano_eleicao int, sigla_uf string, descricao_eleicao string, codigo_municipio string, numero_zona int, "
    "nome_candidato string, numero_cand int, desc_sit_candidato string, num_turno int, codigo_cargo int, "
    "descricao_cargo string, sigla_partido string, nome_municipio string, composicao_legenda string, "
    "nome_coligacao string, desc_sit_cand_tot string, total_votos long")

PARTY_RAW = struct(
    "ano_eleicao int, sigla_uf string, descricao_eleicao string, codigo_municipio string, num_turno int, "
    "codigo_cargo int, descricao_cargo string, sigla_partido string, nome_municipio string, "
    "composicao_legenda string, nome_coligacao string, tipo_legenda string, qtde_votos_legenda long, "
    "qtde_votos_nominais long")

COALITION_RAW = struct(
    "ano_eleicao int, sigla_uf string, descricao_eleicao string, sigla_ue string, num_turno int, "
    "codigo_cargo int, sigla_partido string, composicao_coligacao string, nome_coligacao string, "
    "tipo_legenda string")

DETAILS_RAW = struct(
    "CODIGO_MUNICIPIO string, ANO_ELEICAO int, SIGLA_UF string, DESCRICAO_ELEICAO string, NUM_TURNO int, "
    "CODIGO_CARGO int, DESCRICAO_CARGO string, QTD_APTOS long, QTD_COMPARECIMENTO long, QTD_ABSTENCOES long, "
    "QTD_VOTOS_NOMINAIS long, QTD_VOTOS_BRANCOS long, QTD_VOTOS_NULOS long, QTD_VOTOS_LEGENDA long, "
    "QTD_VOTOS_ANULADOS long")

MEMBERSHIP_RAW = struct(
    "uf string, codigo_do_municipio string, nome_do_municipio string, zona_eleitoral string, "
    "secao_eleitoral string, numero_da_inscricao string, nome_do_filiado string, sigla_do_partido string, "
    "data_da_extracao string, data_da_filiacao string, data_da_desfiliacao string, data_do_cancelamento string, "
    "motivo_do_cancelamento string, situacao_do_registro string")

DECLARED_RAW = struct(
    "sigla_da_ue string, nome_da_ue string, numero_candidato string, nome_candidato string, cargo string, "
    "cpf_do_candidato string, numero_recibo_eleitoral string, cpf/cnpj_do_doador string, nome_do_doador string, "
    "sigla_ue_doador string, numero_partido_doador string, numero_candidato_doador string, "
    "cod_setor_economico_do_doador string, valor_receita string, data_da_receita string, tipo_receita string, "
    "fonte_recurso string, especie_recurso string, cpf/cnpj_do_doador_originario string, "
    "nome_do_doador_originario string, tipo_doador_originario string, setor_economico_do_doador_originario string")

# Canonical receipts layout (D10); all text except year and value.
RECEIPT_CANONICAL = struct(
    "election_year int, election_code string, election_type string, cod_uf string, cod_tse string, "
    "party string, candidate_name string, candidate_num string, cpf_candidate string, position string, "
    "position_code string, donation_status string, receipt_number string, cpf_cnpj_donor string, "
    "donor_name string, donor_name_tax string, mun_donor string, cod_uf_donor string, cod_tse_donor string, "
    "party_donor string, candidate_num_donor string, cod_sector_donor string, desc_sector_donor string, "
    "date_receipt string, value_receipt decimal(18,2), origin_resource string, type_source string, "
    "type_resource string, desc_resource string, campaign_manager_name string, cpf_campaign_manager string")


# --- fixed values: positional column names of the headerless yearly candidate files (S12) ---
# Files before 2012 have 43 columns, files of 2012 have 58; later files carry a header.
CANDIDATE_NAMES_BEFORE_2012 = [
    "DATA_GERACAO", "HORA_GERACAO", "ANO_ELEICAO", "NUM_TURNO", "DESCRICAO_ELEICAO", "SIGLA_UF", "SIGLA_UE",
    "DESCRICAO_UE", "CODIGO_CARGO", "DESCRICAO_CARGO", "NOME_CANDIDATO", "SEQUENCIAL_CANDIDATO",
    "NUMERO_CANDIDATO", "CPF_CANDIDATO", "NOME_URNA_CANDIDATO", "COD_SITUACAO_CANDIDATURA",
    "DES_SITUACAO_CANDIDATURA", "NUMERO_PARTIDO", "SIGLA_PARTIDO", "NOME_PARTIDO", "CODIGO_LEGENDA",
    "SIGLA_LEGENDA", "COMPOSICAO_LEGENDA", "NOME_COLIGACAO", "CODIGO_OCUPACAO", "DESCRICAO_OCUPACAO",
    "DATA_NASCIMENTO", "NUM_TITULO_ELEITORAL_CANDIDATO", "IDADE_DATA_ELEICAO", "CODIGO_SEXO", "DESCRICAO_SEXO",
    "COD_GRAU_INSTRUCAO", "DESCRICAO_GRAU_INSTRUCAO", "CODIGO_ESTADO_CIVIL", "DESCRICAO_ESTADO_CIVIL",
    "CODIGO_NACIONALIDADE", "DESCRICAO_NACIONALIDADE", "SIGLA_UF_NASCIMENTO", "CODIGO_MUNICIPIO_NASCIMENTO",
    "NOME_MUNICIPIO_NASCIMENTO", "DESPESA_MAX_CAMPANHA", "COD_SIT_TOT_TURNO", "DESC_SIT_TOT_TURNO",
]
CANDIDATE_NAMES_2012 = [
    "DT_GERACAO", "HH_GERACAO", "ANO_ELEICAO", "CD_TIPO_ELEICAO", "NM_TIPO_ELEICAO", "NR_TURNO", "CD_ELEICAO",
    "DS_ELEICAO", "DT_ELEICAO", "TP_ABRANGENCIA", "SG_UF", "SG_UE", "NM_UE", "CD_CARGO", "DS_CARGO",
    "SQ_CANDIDATO", "NR_CANDIDATO", "NM_CANDIDATO", "NM_URNA_CANDIDATO", "NM_SOCIAL_CANDIDATO",
    "NR_CPF_CANDIDATO", "NM_EMAIL", "CD_SITUACAO_CANDIDATURA", "DS_SITUACAO_CANDIDATURA",
    "CD_DETALHE_SITUACAO_CAND", "DS_DETALHE_SITUACAO_CAND", "TP_AGREMIACAO", "NR_PARTIDO", "SG_PARTIDO",
    "NM_PARTIDO", "SQ_COLIGACAO", "NM_COLIGACAO", "DS_COMPOSICAO_COLIGACAO", "CD_NACIONALIDADE",
    "DS_NACIONALIDADE", "SG_UF_NASCIMENTO", "CD_MUNICIPIO_NASCIMENTO", "NM_MUNICIPIO_NASCIMENTO",
    "DT_NASCIMENTO", "NR_IDADE_DATA_POSSE", "NR_TITULO_ELEITORAL_CANDIDATO", "CD_GENERO", "DS_GENERO",
    "CD_GRAU_INSTRUCAO", "DS_GRAU_INSTRUCAO", "CD_ESTADO_CIVIL", "DS_ESTADO_CIVIL", "CD_COR_RACA",
    "DS_COR_RACA", "CD_OCUPACAO", "DS_OCUPACAO", "NR_DESPESA_MAX_CAMPANHA", "CD_SIT_TOT_TURNO",
    "DS_SIT_TOT_TURNO", "ST_REELEICAO", "ST_DECLARAR_BENS", "NR_PROTOCOLO_CANDIDATURA", "NR_PROCESSO",
]
#: The names of the 2012 layout behind the names used since the first feeds.
CANDIDATE_2012_SOURCES = {
    "SIGLA_UE": "SG_UE", "DESCRICAO_UE": "NM_UE", "SIGLA_UF": "SG_UF", "DESCRICAO_ELEICAO": "DS_ELEICAO",
    "NUM_TURNO": "NR_TURNO", "CODIGO_CARGO": "CD_CARGO", "DESCRICAO_CARGO": "DS_CARGO",
    "NOME_CANDIDATO": "NM_CANDIDATO", "NUMERO_CANDIDATO": "NR_CANDIDATO",
    "DES_SITUACAO_CANDIDATURA": "DS_SITUACAO_CANDIDATURA", "CPF_CANDIDATO": "NR_CPF_CANDIDATO",
    "SIGLA_PARTIDO": "SG_PARTIDO", "COMPOSICAO_LEGENDA": "DS_COMPOSICAO_COLIGACAO", "NOME_COLIGACAO": "NM_COLIGACAO",
    "CODIGO_OCUPACAO": "CD_OCUPACAO", "DESCRICAO_OCUPACAO": "DS_OCUPACAO", "DATA_NASCIMENTO": "DT_NASCIMENTO",
    "NUM_TITULO_ELEITORAL_CANDIDATO": "NR_TITULO_ELEITORAL_CANDIDATO", "IDADE_DATA_ELEICAO": "NR_IDADE_DATA_POSSE",
    "CODIGO_SEXO": "CD_GENERO", "COD_GRAU_INSTRUCAO": "CD_GRAU_INSTRUCAO",
    "DESCRICAO_GRAU_INSTRUCAO": "DS_GRAU_INSTRUCAO", "CODIGO_MUNICIPIO_NASCIMENTO": "CD_MUNICIPIO_NASCIMENTO",
    "NOME_MUNICIPIO_NASCIMENTO": "NM_MUNICIPIO_NASCIMENTO", "DESPESA_MAX_CAMPANHA": "NR_DESPESA_MAX_CAMPANHA",
    "DESC_SIT_TOT_TURNO": "DS_SIT_TOT_TURNO", "EMAIL_CANDIDATO": "NM_EMAIL", "DESCRICAO_COR_RACA": "DS_COR_RACA",
    "DESCRICAO_ESTADO_CIVIL": "DS_ESTADO_CIVIL",
}
# --- end of fixed values ---

assert len(CANDIDATE_NAMES_BEFORE_2012) == 43 and len(CANDIDATE_NAMES_2012) == 58


def candidate_names_for_year(year: int) -> list[str] | None:
    """Positional names of a year's headerless candidate files (None: the file has a header)."""
    if year < 2012:
        return CANDIDATE_NAMES_BEFORE_2012
    if year == 2012:
        return CANDIDATE_NAMES_2012
    return None
