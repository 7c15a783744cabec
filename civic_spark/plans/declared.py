"""D11 ``declaracao_receita``: declared receipts (2016) with recipient and donor
municipality codes.

Header normalised (S11: fold, lower, whitespace → ``_``), 22 fields renamed
with a constant year (P1, P12), text lowered (P9) and the municipality name
folded (X1); the municipality dimension is joined twice in two roles —
recipient and donor (J4, Q18 fix: codes derived as in S15).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, logic, text
from .common import attach_municipality

YEAR = 2016
PROJECTION = {
    "cod_tse": "sigla_da_ue", "mun_name": "nome_da_ue", "candidate_num": "numero_candidato",
    "candidate_name": "nome_candidato", "position": "cargo", "cpf": "cpf_do_candidato",
    "receipt_number": "numero_recibo_eleitoral", "donator_cpf": "cpf/cnpj_do_doador",
    "donator_name": "nome_do_doador", "donator_cod_tse": "sigla_ue_doador", "donator_party": "numero_partido_doador",
    "donator_candidate_number": "numero_candidato_doador", "donator_cnae": "cod_setor_economico_do_doador",
    "receipt_value": "valor_receita", "receipt_date": "data_da_receita", "receipt_type": "tipo_receita",
    "donation_source": "fonte_recurso", "donation_type": "especie_recurso",
    "political_donator_cpf": "cpf/cnpj_do_doador_originario", "political_donator_name": "nome_do_doador_originario",
    "political_donator_type": "tipo_doador_originario",
    "political_donator_cnae": "setor_economico_do_doador_originario",
}


def _header(name: str) -> str:
    import re
    import unicodedata
    n = "".join(ch for ch in unicodedata.normalize("NFKD", name) if not unicodedata.combining(ch))
    return re.sub(r"\s+", "_", n.lower())


def build(raw: DataFrame, municipality_dim: DataFrame) -> DataFrame:
    df = clean.rename_with(raw, _header)
    cols = {k: F.col(f"`{v}`") for k, v in PROJECTION.items()}
    cols["receipt_value"] = logic.decimal_comma(F.col("valor_receita"))
    df = clean.project(df, cols).withColumn("year", F.lit(YEAR))
    df = clean.map_strings(df, F.lower).withColumn("mun_name", text.fold_accents("mun_name"))
    df = attach_municipality(df, municipality_dim, "cod_tse")
    return attach_municipality(df, municipality_dim, "donator_cod_tse", prefix="donator_")
