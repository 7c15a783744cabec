"""Synthetic raw election feeds, generated with Spark, for load-testing the
dataset builders (never used by a registered query).

Every municipality holds a mayor race (three candidates) and a council race
(9–13 seats, three candidates per seat, six parties) in each municipal year,
and every state a governor race (four candidates) in each state year;
the same people run again each cycle, so careers and incumbency are exercised.
Votes are pseudo-random from a hash of the candidacy, split over two zones.
All columns follow the raw layouts in ``civic_spark.sources.schemas``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civic_spark.sources import schemas

STATES = ["ac", "al", "am", "ap", "ba", "ce", "df", "es", "go", "ma", "mg", "ms", "mt", "pa", "pb", "pe", "pi",
          "pr", "rj", "rn", "ro", "rr", "rs", "sc", "se", "sp", "to"]
PARTIES = [("PT", 13), ("PMDB", 15), ("PSDB", 45), ("PP", 11), ("PDT", 12), ("PV", 43)]
YEARS = [2000, 2004, 2008, 2012, 2016]
FED_YEARS = [2002, 2006, 2010, 2014]


def _h(*cols) -> F.Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1_000_003))


def generate(spark: SparkSession, municipalities: int = 2000) -> dict[str, DataFrame]:
    mun = (spark.range(1, municipalities + 1).withColumnRenamed("id", "m")
           .withColumn("cod_tse", F.lpad(F.col("m").cast("string"), 5, "0"))
           .withColumn("state", F.element_at(F.array(*[F.lit(s) for s in STATES]), (F.col("m") % 27 + 1).cast("int")))
           .withColumn("seats", (F.lit(9) + F.col("m") % 5).cast("int")))
    dim = mun.select("cod_tse", (F.lit(1_000_000) + F.col("m") * 10).cast("string").alias("cod_ibge_7"),
                     "state", F.concat(F.lit("MUNICIPIO "), F.col("m")).alias("mun_name_tse"))
    years = spark.createDataFrame([(y,) for y in YEARS], "year int")
    parties = spark.createDataFrame([(i, p, n) for i, (p, n) in enumerate(PARTIES)], "pidx int, party string, pnum int")

    # candidacies: mayor slots 0..2, council slots 0..3*seats-1
    mayors = mun.crossJoin(F.broadcast(years)).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(2)))) \
        .withColumn("position_code", F.lit(11))
    council = mun.crossJoin(F.broadcast(years)) \
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("seats") * 3 - 1))).withColumn("position_code", F.lit(13))
    c = mayors.unionByName(council).withColumn("pidx", (F.col("slot") % 6).cast("int")) \
        .join(F.broadcast(parties), "pidx")
    c = c.withColumn("vote", (F.lit(10) + _h("m", "year", "slot", "position_code") % 990).cast("long"))
    rank = Window.partitionBy("m", "year", "position_code").orderBy(F.col("vote").desc(), F.col("slot"))
    c = c.withColumn("rk", F.row_number().over(rank))
    c = c.withColumn("outcome", F.when(F.col("position_code") == 11,
                                       F.when(F.col("rk") == 1, "ELEITO").otherwise("NÃO ELEITO"))
                     .otherwise(F.when(F.col("rk") <= F.col("seats"), "ELEITO POR QP").otherwise("SUPLENTE")))
    c = c.withColumn("pos", F.when(F.col("position_code") == 11, "PREFEITO").otherwise("VEREADOR"))
    c = c.withColumn("num", F.when(F.col("position_code") == 11, F.col("pnum"))
                     .otherwise(F.col("pnum") * 1000 + F.col("slot")).cast("int"))
    c = c.withColumn("person", F.concat_ws("-", F.col("m"), F.col("position_code"), F.col("slot")))
    c = c.withColumn("coal", F.when(F.col("pidx") < 2, F.lit("13 - PT / 15 - PMDB"))
                     .when(F.col("pidx") < 4, F.lit("45 - PSDB / 11 - PP")).otherwise(F.col("party")))

    cand_cols = {f.name: F.lit(None).cast(f.dataType) for f in schemas.CANDIDATE_RAW.fields}
    cand_cols.update({
        "SIGLA_UE": F.col("cod_tse"), "ANO_ELEICAO": F.col("year").cast("string"),
        "DESCRICAO_UE": F.concat(F.lit("MUNICÍPIO "), F.col("m")), "SIGLA_UF": F.upper("state"),
        "DESCRICAO_ELEICAO": F.concat(F.lit("ELEIÇÕES "), F.col("year")), "NUM_TURNO": F.lit(1), "CODIGO_CARGO": F.col("position_code"),
        "DESCRICAO_CARGO": F.col("pos"), "NOME_CANDIDATO": F.concat(F.lit("CANDIDATO "), F.col("person")),
        "NUMERO_CANDIDATO": F.col("num"), "DES_SITUACAO_CANDIDATURA": F.lit("DEFERIDO"),
        "CPF_CANDIDATO": F.lpad(_h("person").cast("string"), 11, "0"), "SIGLA_PARTIDO": F.col("party"),
        "COMPOSICAO_LEGENDA": F.col("coal"), "NOME_COLIGACAO": F.lit("#NE#"),
        "CODIGO_OCUPACAO": (F.lit(100) + _h("person") % 300).cast("int"), "DESCRICAO_OCUPACAO": F.lit("OUTROS"),
        "DATA_NASCIMENTO": F.concat(F.lit("01/01/19"), F.lpad((F.lit(40) + _h("person") % 50).cast("string"), 2, "0")),
        "NUM_TITULO_ELEITORAL_CANDIDATO": F.lpad(_h("person", F.lit("t")).cast("string"), 12, "0"),
        "IDADE_DATA_ELEICAO": (F.lit(25) + _h("person") % 50).cast("int"), "CODIGO_SEXO": F.lit(2),
        "COD_GRAU_INSTRUCAO": (F.lit(1) + _h("person") % 8).cast("int"), "DESCRICAO_GRAU_INSTRUCAO": F.lit("SUPERIOR"),
        "DESPESA_MAX_CAMPANHA": (F.col("vote") * 10).cast("decimal(18,2)"), "DESC_SIT_TOT_TURNO": F.col("outcome")})
    candidate = c.select(*[cand_cols[f.name].cast(f.dataType).alias(f.name) for f in schemas.CANDIDATE_RAW.fields])

    zones = c.withColumn("zone", F.explode(F.array(F.lit(1), F.lit(2))))
    zvote = F.when(F.col("zone") == 1, F.floor(F.col("vote") / 2)).otherwise(F.col("vote") - F.floor(F.col("vote") / 2))
    votes = zones.select(
        F.col("year").alias("ano_eleicao"), F.upper("state").alias("sigla_uf"), F.concat(F.lit("ELEIÇÕES "), F.col("year")).alias("descricao_eleicao"),
        F.col("cod_tse").alias("codigo_municipio"), F.col("zone").cast("int").alias("numero_zona"),
        F.concat(F.lit("CANDIDATO "), F.col("person")).alias("nome_candidato"), F.col("num").alias("numero_cand"),
        F.lit("DEFERIDO").alias("desc_sit_candidato"), F.lit(1).alias("num_turno"),
        F.col("position_code").cast("int").alias("codigo_cargo"), F.col("pos").alias("descricao_cargo"),
        F.col("party").alias("sigla_partido"), F.concat(F.lit("MUNICÍPIO "), F.col("m")).alias("nome_municipio"),
        F.col("coal").alias("composicao_legenda"), F.lit("#NULO#").alias("nome_coligacao"),
        F.col("outcome").alias("desc_sit_cand_tot"), zvote.cast("long").alias("total_votos"))

    coalition = c.filter("position_code = 11").select(
        F.col("year").alias("ano_eleicao"), F.upper("state").alias("sigla_uf"), F.concat(F.lit("ELEIÇÕES "), F.col("year")).alias("descricao_eleicao"),
        F.col("m").cast("string").alias("sigla_ue"), F.lit(1).alias("num_turno"), F.lit(11).alias("codigo_cargo"),
        F.col("party").alias("sigla_partido"), F.col("coal").alias("composicao_coligacao"),
        F.lit("COLIGAÇÃO UNIDA").alias("nome_coligacao"),
        F.when(F.col("pidx") < 4, "COLIGAÇÃO").otherwise("PARTIDO ISOLADO").alias("tipo_legenda"))

    tot = c.groupBy("m", "cod_tse", "state", "year", "position_code", "pos").agg(F.sum("vote").alias("v"))
    details = tot.select(
        F.col("m").cast("string").alias("CODIGO_MUNICIPIO"), F.col("year").alias("ANO_ELEICAO"),
        F.upper("state").alias("SIGLA_UF"), F.concat(F.lit("ELEIÇÕES "), F.col("year")).alias("DESCRICAO_ELEICAO"), F.lit(1).alias("NUM_TURNO"),
        F.col("position_code").cast("int").alias("CODIGO_CARGO"), F.col("pos").alias("DESCRICAO_CARGO"),
        (F.col("v") * 2).alias("QTD_APTOS"), (F.col("v") + 50).alias("QTD_COMPARECIMENTO"),
        (F.col("v") - 50).alias("QTD_ABSTENCOES"), (F.col("v") - _h("m", "year") % 20).alias("QTD_VOTOS_NOMINAIS"),
        F.lit(20).cast("long").alias("QTD_VOTOS_BRANCOS"), F.lit(20).cast("long").alias("QTD_VOTOS_NULOS"),
        F.lit(5).cast("long").alias("QTD_VOTOS_LEGENDA"), F.lit(5).cast("long").alias("QTD_VOTOS_ANULADOS"))
    # state elections: a governor race (position 3, four candidates) per state and state year,
    # voted in every municipality of the state
    fed_years = spark.createDataFrame([(y,) for y in FED_YEARS], "year int")
    st = spark.createDataFrame([(i, s_) for i, s_ in enumerate(STATES)], "sidx int, state string")
    gov = st.crossJoin(F.broadcast(fed_years)).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(3)))) \
        .withColumn("pidx", (F.col("slot") % 6).cast("int")).join(F.broadcast(parties), "pidx") \
        .withColumn("person", F.concat_ws("-", F.lit("gov"), F.col("state"), F.col("slot")))
    gv = Window.partitionBy("state", "year").orderBy(F.col("gvote").desc(), F.col("slot"))
    gov = gov.withColumn("gvote", (F.lit(10) + _h("state", "year", "slot") % 990).cast("long")) \
        .withColumn("outcome", F.when(F.row_number().over(gv) == 1, "ELEITO").otherwise("NÃO ELEITO"))
    gcols = dict(cand_cols)
    gcols.update({
        "SIGLA_UE": F.upper("state"), "ANO_ELEICAO": F.col("year").cast("string"),
        "DESCRICAO_UE": F.upper("state"), "SIGLA_UF": F.upper("state"),
        "DESCRICAO_ELEICAO": F.concat(F.lit("ELEIÇÕES "), F.col("year")), "NUM_TURNO": F.lit(1),
        "CODIGO_CARGO": F.lit(3), "DESCRICAO_CARGO": F.lit("GOVERNADOR"),
        "NOME_CANDIDATO": F.concat(F.lit("CANDIDATO "), F.col("person")), "NUMERO_CANDIDATO": F.col("pnum"),
        "CPF_CANDIDATO": F.lpad(_h("person").cast("string"), 11, "0"), "SIGLA_PARTIDO": F.col("party"),
        "COMPOSICAO_LEGENDA": F.col("party"), "CODIGO_OCUPACAO": F.lit(298).cast("int"),
        "DATA_NASCIMENTO": F.lit("01/01/1955"),
        "NUM_TITULO_ELEITORAL_CANDIDATO": F.lpad(_h("person", F.lit("t")).cast("string"), 12, "0"),
        "IDADE_DATA_ELEICAO": F.lit(50), "COD_GRAU_INSTRUCAO": F.lit(8),
        "DESPESA_MAX_CAMPANHA": F.lit(1000).cast("decimal(18,2)"), "DESC_SIT_TOT_TURNO": F.col("outcome")})
    candidate = candidate.unionByName(
        gov.select(*[gcols[f.name].cast(f.dataType).alias(f.name) for f in schemas.CANDIDATE_RAW.fields]))
    gmun = gov.join(mun.select("m", "cod_tse", "state"), "state")
    votes_fed = gmun.select(
        F.col("year").alias("ano_eleicao"), F.upper("state").alias("sigla_uf"),
        F.concat(F.lit("ELEIÇÕES "), F.col("year")).alias("descricao_eleicao"), F.col("cod_tse").alias("codigo_municipio"),
        F.lit(1).alias("numero_zona"), F.concat(F.lit("CANDIDATO "), F.col("person")).alias("nome_candidato"),
        F.col("pnum").cast("int").alias("numero_cand"), F.lit("DEFERIDO").alias("desc_sit_candidato"),
        F.lit(1).alias("num_turno"), F.lit(3).alias("codigo_cargo"), F.lit("GOVERNADOR").alias("descricao_cargo"),
        F.col("party").alias("sigla_partido"), F.concat(F.lit("MUNICÍPIO "), F.col("m")).alias("nome_municipio"),
        F.col("party").alias("composicao_legenda"), F.lit("#NULO#").alias("nome_coligacao"),
        F.col("outcome").alias("desc_sit_cand_tot"),
        (F.lit(1) + _h("m", "year", "slot") % 500).cast("long").alias("total_votos"))
    return {"municipality_dim": dim, "coalition": coalition, "votes_local": votes, "votes_fed_state": votes_fed,
            "candidate": candidate, "details": details}
