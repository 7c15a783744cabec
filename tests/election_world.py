"""A hand-written micro election (FIXTURES.md §3 edge rows) with known results.

Municipality 00001 (IBGE 110001), 2016, one round:
  mayor race: A (PT, coalition "13 - PT / 15 - PMDB", 600 votes over two zones, elected, also
  elected mayor there in 2012) vs B (PSDB, isolated party, 400 votes);
  council: nine elected councillors + one substitute (see COUNCIL).
Municipality 00002 (IBGE 110002), 2016: one councillor whose zone vote is NULL (A1 poisoning)
  and a second round (dropped by the chamber filters).
Municipality 12345 (IBGE 221040): excluded by hand in the chamber datasets.
"""

from __future__ import annotations

from civic_spark.sources import schemas

DIM = [("00001", "1100015", "ro", "Alta Floresta"), ("00002", "1100023", "ro", "Ariquemes"),
       ("12345", "2210409", "pi", "Sao Miguel do Tapuio"), ("71072", "3550308", "sp", "São Paulo")]

# (name, party, composicao, outcome, votes zone1, votes zone2, edu, campaign, number, cpf, title, birth)
COUNCIL = [
    ("V1", "PT", "PT", "ELEITO POR QP", 60, 40, 8, 1000, 13001, "00000000101", "000000000101", "01/01/1970"),
    ("V2", "PT", "PT", "MÉDIA", 80, 0, 6, 800, 13002, "00000000102", "000000000102", "01/01/1971"),
    ("V3", "PMDB", "PMDB", "ELEITO POR QP", 90, 0, 4, 600, 15001, "00000000103", "000000000103", "01/01/1972"),
    ("V4", "PSDB", "PSDB", "ELEITO POR QP", 100, 20, 8, 900, 45001, "00000000104", "000000000104", "01/01/1973"),
    ("V5", "PSDB", "PSDB", "MÉDIA", 70, 0, 2, 500, 45002, "00000000105", "000000000105", "01/01/1974"),
    ("V6", "PT DO B", "PT DO B", "ELEITO POR QP", 60, 0, 5, 400, 70001, "00000000106", "000000000106", "01/01/1975"),
    ("V7", "PT", "PT", "SUPLENTE", 30, 0, 3, 300, 13003, "00000000107", "000000000107", "01/01/1976"),
    ("V8", "PMDB", "PMDB", "ELEITO POR QP", 50, 0, 3, 200, 15002, "00000000108", "000000000108", "01/01/1977"),
    ("V9", "PSDB", "PSDB", "MÉDIA", 40, 0, 7, 100, 45003, "00000000109", "000000000109", "01/01/1978"),
    ("V10", "PT", "PT", "ELEITO POR QP", 35, 0, 9, 50, 13004, "00000000110", "000000000110", "01/01/1979"),
]
TYPE = "ELEIÇÃO ORDINÁRIA"


def _cand(year, cod, name, party, comp, outcome, pos_code, pos, num, cpf, title, birth, edu, campaign,
          status="DEFERIDO", rnd=1, state="RO", **extra):
    row = {f.name: None for f in schemas.CANDIDATE_RAW.fields}
    row.update({"SIGLA_UE": cod, "ANO_ELEICAO": str(year), "DESCRICAO_UE": "ALTA FLORESTA", "SIGLA_UF": state,
                "DESCRICAO_ELEICAO": TYPE, "NUM_TURNO": rnd, "CODIGO_CARGO": pos_code, "DESCRICAO_CARGO": pos,
                "NOME_CANDIDATO": name, "NUMERO_CANDIDATO": num, "DES_SITUACAO_CANDIDATURA": status,
                "CPF_CANDIDATO": cpf, "SIGLA_PARTIDO": party, "COMPOSICAO_LEGENDA": comp, "NOME_COLIGACAO": "#NE#",
                "CODIGO_OCUPACAO": 298, "DESCRICAO_OCUPACAO": "SERVIDOR PÚBLICO MUNICIPAL",
                "DATA_NASCIMENTO": birth, "NUM_TITULO_ELEITORAL_CANDIDATO": title, "IDADE_DATA_ELEICAO": 40,
                "CODIGO_SEXO": 2, "COD_GRAU_INSTRUCAO": edu, "DESCRICAO_GRAU_INSTRUCAO": "SUPERIOR",
                "DESPESA_MAX_CAMPANHA": campaign, "DESC_SIT_TOT_TURNO": outcome, "DESCRICAO_COR_RACA": "PARDA",
                "DESCRICAO_ESTADO_CIVIL": "CASADO(A)"})
    row.update(extra)
    return row


def candidates():
    from decimal import Decimal
    rows = [
        _cand(2016, "00001", "A", "PT", "13 - PT / 15 - PMDB", "ELEITO", 11, "PREFEITO", 13, "00000000001",
              "000000000001", "05/05/1960", 8, Decimal("5000.00")),
        _cand(2016, "00001", "B", "PSDB", "PSDB", "NÃO ELEITO", 11, "PREFEITO", 45, "00000000002", "000000000002",
              "06/06/1961", 6, Decimal("4000.00")),
        _cand(2012, "00001", "A", "PT", "13 - PT / 15 - PMDB", "ELEITO", 11, "PREFEITO", 13, "00000000001",
              "000000000001", "05/05/1960", 8, Decimal("3000.00")),
        # a 2012 candidacy without outcome and an indeferido one (outcome repair)
        _cand(2012, "00001", "C", "PV", "PV", None, 11, "PREFEITO", 43, "00000000003", "000000000003", None, 4,
              Decimal("10.00"), status="INDEFERIDO"),
        _cand(2012, "00001", "D", "PV", "PV", None, 13, "VEREADOR", 43001, "00000000004", "000000000004", "01/01/1980",
              4, Decimal("10.00"), status="RENÚNCIA"),
    ]
    for (name, party, comp, outcome, z1, z2, edu, camp, num, cpf, title, birth) in COUNCIL:
        rows.append(_cand(2016, "00001", name, party, comp, outcome, 13, "VEREADOR", num, cpf, title, birth, edu,
                          Decimal(camp)))
    # exact duplicate candidacy (A15 removes it)
    rows.append(dict(rows[0]))
    return rows


def _vote(year, cod, name, num, pos_code, pos, party, comp, outcome, zone, votes, rnd=1, state="RO"):
    return {"ano_eleicao": year, "sigla_uf": state, "descricao_eleicao": TYPE, "codigo_municipio": cod,
            "numero_zona": zone, "nome_candidato": name, "numero_cand": num, "desc_sit_candidato": "DEFERIDO",
            "num_turno": rnd, "codigo_cargo": pos_code, "descricao_cargo": pos, "sigla_partido": party,
            "nome_municipio": "ALTA FLORESTA", "composicao_legenda": comp, "nome_coligacao": "#NULO#",
            "desc_sit_cand_tot": outcome, "total_votos": votes}


def votes():
    rows = [
        _vote(2016, "00001", "A", 13, 11, "PREFEITO", "PT", "13 - PT / 15 - PMDB", "ELEITO", 1, 350),
        _vote(2016, "00001", "A", 13, 11, "PREFEITO", "PT", "13 - PT / 15 - PMDB", "ELEITO", 2, 250),
        _vote(2016, "00001", "B", 45, 11, "PREFEITO", "PSDB", "PSDB", "NÃO ELEITO", 1, 400),
    ]
    for (name, party, comp, outcome, z1, z2, edu, camp, num, cpf, title, birth) in COUNCIL:
        rows.append(_vote(2016, "00001", name, num, 13, "VEREADOR", party, comp, outcome, 1, z1))
        if z2:
            rows.append(_vote(2016, "00001", name, num, 13, "VEREADOR", party, comp, outcome, 2, z2))
    # municipality 00002: NULL vote in one zone → poisoned total; a second round
    rows.append(_vote(2016, "00002", "X", 13100, 13, "VEREADOR", "PT", "PT", "ELEITO", 1, 10))
    rows.append(_vote(2016, "00002", "X", 13100, 13, "VEREADOR", "PT", "PT", "ELEITO", 2, None))
    rows.append(_vote(2016, "00002", "Y", 13, 11, "PREFEITO", "PT", "PT", "ELEITO", 1, 500, rnd=2))
    # 2014 zero-vote row (dropped) and foreign vote (state zz)
    rows.append(_vote(2014, "00001", "Z", 99, 6, "DEPUTADO FEDERAL", "PT", "PT", "SUPLENTE", 1, 0))
    return rows


def coalition_rows():
    base = {"ano_eleicao": 2016, "sigla_uf": "RO", "descricao_eleicao": TYPE, "num_turno": 1,
            "nome_coligacao": "UNIDOS", "tipo_legenda": "COLIGAÇÃO"}
    rows = [
        {**base, "sigla_ue": "1", "codigo_cargo": 11, "sigla_partido": "PT",
         "composicao_coligacao": "13 - PT / 15 - PMDB"},
        {**base, "sigla_ue": "1", "codigo_cargo": 11, "sigla_partido": "PMDB",
         "composicao_coligacao": "13 - PT / 15 - PMDB"},
        {**base, "sigla_ue": "1", "codigo_cargo": 11, "sigla_partido": "PSDB", "composicao_coligacao": "#NE#",
         "tipo_legenda": "PARTIDO ISOLADO"},
        # duplicate of the first row (dropped by the dedupe)
        {**base, "sigla_ue": "00001", "codigo_cargo": 11, "sigla_partido": "PT",
         "composicao_coligacao": "13 - PT / 15 - PMDB"},
        # 2010: state rows rebuilt from their parties; national president row fanned out
        {**base, "ano_eleicao": 2010, "sigla_ue": "RO", "codigo_cargo": 6, "sigla_partido": "PT",
         "composicao_coligacao": "X", "nome_coligacao": "FRENTE"},
        {**base, "ano_eleicao": 2010, "sigla_ue": "RO", "codigo_cargo": 6, "sigla_partido": "PDT",
         "composicao_coligacao": "X", "nome_coligacao": "FRENTE"},
        {**base, "ano_eleicao": 2010, "sigla_ue": "SP", "codigo_cargo": 6, "sigla_partido": "PV",
         "composicao_coligacao": "PV", "nome_coligacao": "VERDE", "sigla_uf": "SP"},
    ]
    return rows


def details():
    def d(cod, pos_code, pos, aptos, comp, abst, nom, bra, nul, leg, anul, state="RO", zone=1):
        return {"CODIGO_MUNICIPIO": cod, "ANO_ELEICAO": 2016, "SIGLA_UF": state, "DESCRICAO_ELEICAO": TYPE,
                "NUM_TURNO": 1, "CODIGO_CARGO": pos_code, "DESCRICAO_CARGO": pos, "QTD_APTOS": aptos,
                "QTD_COMPARECIMENTO": comp, "QTD_ABSTENCOES": abst, "QTD_VOTOS_NOMINAIS": nom,
                "QTD_VOTOS_BRANCOS": bra, "QTD_VOTOS_NULOS": nul, "QTD_VOTOS_LEGENDA": leg,
                "QTD_VOTOS_ANULADOS": anul}
    return [
        d("1", 11, "PREFEITO", 1000, 700, 300, 500, 30, 20, 0, 5),
        d("1", 11, "PREFEITO", 1000, 800, 200, 400, 20, 10, 0, 5),
        d("1", 13, "VEREADOR", 2000, 1500, 500, 700, 10, 10, 5, 0),
        d("1", 13, "VEREADOR", 10, 10, 0, 10, 0, 0, 0, 0, state="ZZ"),
    ]


def frames(spark):
    from pyspark.sql import Row  # noqa: F401
    dim = spark.createDataFrame(DIM, schemas.MUNICIPALITY_DIM)
    cand = spark.createDataFrame([tuple(r[f.name] for f in schemas.CANDIDATE_RAW.fields) for r in candidates()],
                                 schemas.CANDIDATE_RAW)
    vot = spark.createDataFrame([tuple(r[f.name] for f in schemas.ELECTION_RAW.fields) for r in votes()],
                                schemas.ELECTION_RAW)
    coal = spark.createDataFrame([tuple(r.get(f.name) for f in schemas.COALITION_RAW.fields) for r in coalition_rows()],
                                 schemas.COALITION_RAW)
    det = spark.createDataFrame([tuple(r[f.name] for f in schemas.DETAILS_RAW.fields) for r in details()],
                                schemas.DETAILS_RAW)
    party = spark.createDataFrame(party_rows(), schemas.PARTY_RAW)
    return {"dim": dim, "candidate": cand, "votes": vot, "coalition": coal, "details": det, "party": party}


def party_rows():
    def p(year, cod, pos_code, pos, party, comp, ctype, legend, nominal, state="RO", name="#NE#", mun="ALTA FLORESTA"):
        return (year, state, TYPE if year == 2016 else "ELEIÇÃO GERAL", cod, 1, pos_code, pos, party, mun, comp, name,
                ctype, legend, nominal)
    return [
        # zone rows of one party: summed (A1)
        p(2016, "1", 13, "VEREADOR", "PT", "13 - PT / 15 - PMDB", "COLIGAÇÃO", 10, 100),
        p(2016, "1", 13, "VEREADOR", "PT", "13 - PT / 15 - PMDB", "COLIGAÇÃO", 5, 50),
        # duplicate key with and without coalition (A18 + A14)
        p(2016, "1", 13, "VEREADOR", "PSDB", None, "PARTIDO ISOLADO", 1, 10),
        p(2016, "1", 13, "VEREADOR", "PSDB", None, None, 2, 20),
        # 2002 governor with legend votes: moved to nominal
        p(2002, "1", 3, "GOVERNADOR", "PV", "PV", "COLIGACAO", 7, 0),
        # national row dropped
        p(2016, "1", 13, "VEREADOR", "PV", "PV", "PARTIDO ISOLADO", 1, 1, state="BR"),
    ]
