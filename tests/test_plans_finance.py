"""D10 receipts, D11 declared receipts, D12 membership on micro-fixtures."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from civic_spark.plans import declared, membership, receipts
from civic_spark.sources import schemas
from tests import election_world as W


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(W.DIM, schemas.MUNICIPALITY_DIM)


@pytest.fixture(scope="module")
def candidate(spark):
    rows = [("00000000001", 2008, "00001", "ro", 13, "ana", "000000000001"),
            ("00000000002", 2010, "ro", "ro", 4512, "bia", "000000000002"),
            ("0", 2008, "00001", "ro", 99, "zed", "000000000003"),
            ("00000000000", 2008, "00001", "ro", 98, "yan", "12"),
            ("00000000005", 2008, "00001", "ro", 97, "xu", "12")]
    return spark.createDataFrame(rows, "cpf_candidate string, election_year int, cod_tse string, state string, "
                                       "candidate_num int, candidate_name string, elec_title string")


def test_d10_receipts(spark, candidate, dim):
    y2008 = spark.createDataFrame([
        ("1", "PT", "ANA", "13", "", "Prefeito", "11", "12345678901", "1", "DOADOR Á", "t", "e", "x", "y",
         "01/01/2008", "150.5"),
        ("1", "PT", "ANA", "13", "123456789012345", "Prefeito", "11", "12345678902", "1", "D2", "t", "e", "x", "y",
         "01/01/2008", "0"),
        ("1", "PT", "ANA", "13", None, "Prefeito", "11", "00000000000", "1", "D3", "t", "e", "x", "y",
         "01/01/2008", "10"),
    ], "SG_UE string, SG_PARTIDO string, NM_CANDIDATO string, NR_CANDIDATO string, CD_NUM_CPF string, "
       "DS_CARGO string, CD_CARGO string, CD_CPF_CNPJ_DOADOR string, SG_UE_1 string, NM_DOADOR string, "
       "DS_TITULO string, DS_ESP_RECURSO string, NM_ADM string, CD_CPF_ADM string, DT_RECEITA string, "
       "VR_RECEITA string")
    y2010 = spark.createDataFrame([
        ("UF", "x", "x", "x", "x", "x", "x", "x", "x", "x", "x", "x"),
        ("RO", "PSDB", "BIA", "4512", "Deputado", "", "R1", "98765432100", "DOADORA", "02/02/2010", "1234,50",
         "rec"),
    ], "UF string, SIGLA_PARTIDO string, NOME_CANDIDATO string, NUMERO_CANDIDATO string, CARGO string, "
       "CPF_DO_CANDIDATO string, NUMERO_RECIBO_ELEITORAL string, `CPF/CNPJ_DO_DOADOR` string, NOME_DO_DOADOR string, "
       "DATA_DA_RECEITA string, VALOR_RECEITA string, TIPO_RECEITA string")
    out = receipts.build({2008: y2008, 2010: y2010}, candidate, dim)
    loc = out["campaign_local"].collect()
    assert len(loc) == 1                                 # zero value and defective donor dropped
    r = loc[0].asDict()
    assert r["cpf_candidate"] == "00000000001"           # repaired from the candidate table (empty own id)
    assert r["cod_tse"] == "00001" and r["cod_ibge_6"] == "110001" and r["donor_name"] == "doador a"
    assert r["value_receipt"] == Decimal("150.50") and r["election_year"] == 2008
    fed = out["campaign_fed_state"].collect()
    assert len(fed) == 1 and fed[0]["cpf_candidate"] == "00000000002" and fed[0]["value_receipt"] == Decimal("1234.50")
    assert out["campaign_local"].columns[:4] == ["cod_uf", "cod_tse", "election_year", "cpf_candidate"]


def test_d11_declared(spark, dim):
    names = [f.name for f in schemas.DECLARED_RAW.fields]
    header = [n.replace("_", " ").title() for n in names]
    row = tuple("00001" if n == "sigla_da_ue" else "71072" if n == "sigla_ue_doador" else
                "10,50" if n == "valor_receita" else "SÃO PAULO" if n == "nome_da_ue" else "X" for n in names)
    raw = spark.createDataFrame([row], ", ".join(f"`{h}` string" for h in header))
    out = declared.build(raw, dim).collect()[0].asDict()
    assert out["cod_ibge_6"] == "110001" and out["donator_cod_ibge_6"] == "355030"
    assert out["receipt_value"] == Decimal("10.50") and out["year"] == 2016 and out["mun_name"] == "sao paulo"


def test_d12_membership(spark, candidate, dim):
    rows = [("RO", "00001", "X", "1", "2", "1", "MARIA", "PT", "01/01/2019", "10/05/2001", "01/02/2010", "",
             "", "REGULAR"),
            ("RO", "00001", "X", "1", "2", "12", "JOAO", "PT", "01/01/2019", "10/05/2001", "", "03-03-2012",
             "", "CANCELADO"),
            ("RO", "99999", "X", "1", "2", "5", "ZE", "PV", "01/01/2019", "bad", "", "", "", "REGULAR")]
    raw = spark.createDataFrame(rows, schemas.MEMBERSHIP_RAW)
    out = {r["member_name"]: r.asDict() for r in membership.build(raw, candidate, dim).collect()}
    m = out["maria"]
    assert m["electoral_title"] == "000000000001" and m["cpf_candidate"] == "00000000001"
    assert (m["year_start"], m["year_end"], m["year_termination"]) == (2001, 2010, 2010)
    # title 12 belongs to one valid id and one defective id (eleven zeros, filtered out)
    assert out["joao"]["cpf_candidate"] == "00000000005" and out["joao"]["year_termination"] == 2012
    assert out["ze"]["year_termination"] == 2019 and out["ze"]["date_start"] is None
    assert out["ze"]["cod_ibge_6"] is None
