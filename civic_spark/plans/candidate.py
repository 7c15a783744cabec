"""D4 ``candidate``: one row per candidacy, with careers and incumbency.

1. sentinels → NULL; 31 source fields projected and renamed; birth year is
   "19" + the last two characters of the birth date (Q8 kept; R's ``paste0``
   writes a missing date as ``19NA``);
2. municipality codes (J1, broadcast);
3. 2014 rows: race / civil status / education description rotated back (P8,
   one pass);
4. fold + lower text (P9); two-tier coalition lookup (J6);
5. ordinal labels for substitute senators (codes 9, 10; Q27 kept);
6. keep the first row per candidacy key (A15, explicit order);
7. outcome repair from the candidacy status (X15) and ``elected`` (X16);
8. ``times_run`` / ``times_office``: running counts over the person's history
   ordered by year and round (W4, NA-poisoning like ``cumsum``), by the
   segmented scan, so a hot person key never sits in one task;
9. supplementary election types = types with fewer than 1,000 rows (A17);
10. lagged self-join: the same person, place and position four years earlier
    (J9, SQL equality — NULL keys never match), on a right side without
    supplementary elections or second-round outcomes, one row per key (J10, A15);
11. incumbency: 1 / 0, NULL in the first year of each cycle (W11, Q9);
12. columns: person id, municipality, year first, the rest alphabetical (P6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, logic, text
from ..operators.aggregates import having_count, keep_first
from ..operators.joins import exclude_values_in, lagged_self_join
from ..operators.scan import ordered_scan
from ..operators.windows import group_min_boundary
from ..session import cut_lineage
from .common import attach_municipality, coalition_lookup, elected_flag

# --- fixed values ---
SUPPLEMENTARY_MAX_ROWS = 1000
POSITION_LABELS = {9: "1º suplente senador", 10: "2º suplente senador"}
ROTATION_YEAR = "2014"
NO_OUTCOME_TEXT = "renuncia/falecimento/cassacao antes da eleicao"
DEDUPE_KEYS = ["cod_tse", "candidate_name", "candidate_num", "election_type", "election_year", "round",
               "position_code"]
PERSON_KEYS = ["cpf_candidate", "elec_title", "candidate_name"]
LAG_KEYS = ["cpf_candidate", "candidate_name", "elec_title", "birthyear", "cod_tse", "position"]
LAG_DEDUPE = ["election_year", "cpf_candidate", "candidate_name", "elec_title", "birthyear", "cod_tse", "position"]
# --- end of fixed values ---

PROJECTION = {
    "cod_tse": "SIGLA_UE", "election_year": "ANO_ELEICAO", "mun_name": "DESCRICAO_UE", "state": "SIGLA_UF",
    "election_type": "DESCRICAO_ELEICAO", "round": "NUM_TURNO", "tse_name": "DESCRICAO_UE",
    "position_code": "CODIGO_CARGO", "position": "DESCRICAO_CARGO", "candidate_name": "NOME_CANDIDATO",
    "candidate_num": "NUMERO_CANDIDATO", "candidate_status": "DES_SITUACAO_CANDIDATURA",
    "cpf_candidate": "CPF_CANDIDATO", "party": "SIGLA_PARTIDO", "coalition": "COMPOSICAO_LEGENDA",
    "coalition_name": "NOME_COLIGACAO", "occupation_code": "CODIGO_OCUPACAO", "occupation": "DESCRICAO_OCUPACAO",
    "elec_title": "NUM_TITULO_ELEITORAL_CANDIDATO", "age": "IDADE_DATA_ELEICAO", "gender": "CODIGO_SEXO",
    "edu": "COD_GRAU_INSTRUCAO", "edu_desc": "DESCRICAO_GRAU_INSTRUCAO",
    "mun_birth_code": "CODIGO_MUNICIPIO_NASCIMENTO", "mun_birth_name": "NOME_MUNICIPIO_NASCIMENTO",
    "campaign": "DESPESA_MAX_CAMPANHA", "outcome": "DESC_SIT_TOT_TURNO", "email": "EMAIL_CANDIDATO",
    "race": "DESCRICAO_COR_RACA", "civil_status": "DESCRICAO_ESTADO_CIVIL",
}


def build(raw: DataFrame, coalition: DataFrame, municipality_dim: DataFrame, *,
          supplementary_max_rows: int = SUPPLEMENTARY_MAX_ROWS, materialize: bool = True) -> DataFrame:
    """``materialize``: the de-duplicated candidacies with career counts are
    used four times below (supplementary types, lag table, cycle minima, the
    main rows), so they are written once as a reliable checkpoint in the
    shared checkpoint folder; the plan downstream starts from that table."""
    df = clean.na_sentinels(raw, ("#NE#", "#NULO#", ""))
    cols = {k: F.col(v) for k, v in PROJECTION.items()}
    cols["cod_tse"] = F.col("SIGLA_UE").cast("string")
    cols["birthyear"] = text.paste0(F.lit("19"), text.tail("DATA_NASCIMENTO", 2), na_text="NA")
    df = clean.project(df, cols)
    df = attach_municipality(df, municipality_dim)
    df = clean.rotate_when(df, F.coalesce(F.col("election_year") == ROTATION_YEAR, F.lit(False)),
                           {"race": "civil_status", "civil_status": "edu_desc", "edu_desc": "race"})
    df = clean.clean_text(df)
    df = df.withColumn("election_year", logic.try_int("election_year"))
    df = coalition_lookup(df, coalition)
    df = df.withColumn("position", logic.case_when(
        *[(F.col("position_code") == k, v) for k, v in POSITION_LABELS.items()], default=F.col("position")))
    df = keep_first(df, DEDUPE_KEYS, ["cpf_candidate", "elec_title", "party", "outcome"])

    status, outcome = F.col("candidate_status"), F.col("outcome")
    df = df.withColumn("outcome", logic.case_when(
        (status.rlike("^deferido") & outcome.isNull(), F.lit(None).cast("string")),
        ((status == "indeferido") & outcome.isNull(), "indeferido"),
        (~status.rlike("^deferido|^indeferido") & outcome.isNull(), NO_OUTCOME_TEXT),
        default=outcome))
    df = df.withColumns({"election_year_lag": F.col("election_year") - 4, "elected": elected_flag()})

    # careers: NA-poisoning running counts in year order over range-partitioned rows, so no
    # task holds a whole person key (e.g. the group of candidacies whose ids are all missing)
    order = ["election_year", "round", "position_code", "cod_tse", "election_type", "candidate_num"]
    df = ordered_scan(df, PERSON_KEYS, order, sums={
        "times_run": ((F.col("round") == 1).cast("int"), True),
        "times_office": (F.col("elected"), True)})
    if materialize:
        df = cut_lineage(df)

    supplementary = having_count(df, ["election_type"], "<", supplementary_max_rows).select("election_type")
    right = exclude_values_in(df, supplementary, "election_type") \
        .filter(~F.col("outcome").rlike("turno$"))
    right = keep_first(right, LAG_DEDUPE, ["round", "election_type", "candidate_num"])
    df = lagged_self_join(df, right, LAG_KEYS, "election_year", 4,
                          {"incumbent": "elected", "outcome_previous": "outcome", "position_previous": "position",
                           "position_code_previous": "position_code"})

    df = df.withColumn("local", logic.cycle_flag("election_year"))
    df = group_min_boundary(df, "local", "election_year", "__min_year")
    inc, y = F.col("incumbent"), F.col("election_year")
    df = df.withColumn("incumbent", logic.case_when(
        (inc == 1, 1), ((inc == 0) | (inc.isNull() & (y > F.col("__min_year"))), 0), default=None))
    df = df.drop("local", "election_year_lag", "__min_year")
    return clean.leading_then_sorted(df, "cpf_candidate", "cod_ibge_6", "election_year")
