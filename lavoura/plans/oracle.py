"""SQL twins of the registered queries, written for DuckDB over the same tables.

They restate each result relationally and share nothing with the Spark code but the
fixed values.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-09-01 00:00:00'"
MARK = "TIMESTAMP '2000-01-01 00:00:00'"

APPLICATIONS = """
qty AS (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey),
app AS (
  SELECT
    printf('PROP_%05d', o_custkey) AS proponente_id,
    epoch_ms(o_orderdate) AS req_ms,
    o_orderdate AS data_solicitacao,
    CASE WHEN o_orderkey % 53 <> 0 THEN
      CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN printf('%014d', o_custkey) ELSE printf('%011d', o_custkey) END
    END AS cpf_cnpj,
    'Produtor ' || c_name AS nome_razao_social,
    CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'JURIDICA' ELSE 'FISICA' END AS tipo_pessoa,
    CAST(20000 + (c_acctbal + 1000) * 60 AS DECIMAL(18,2)) AS renda,
    CAST(o_totalprice AS DECIMAL(18,2)) AS valor,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'CUSTEIO_SAFRA' WHEN '2-HIGH' THEN 'INVESTIMENTO_MAQUINARIO'
      WHEN '3-MEDIUM' THEN 'AMPLIACAO_AREA' ELSE 'OUTROS' END AS finalidade_credito,
    CAST(-34.0 AS DOUBLE) + CAST((o_orderkey * 7919) % 39000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS latitude,
    CAST(-74.0 AS DOUBLE) + CAST((o_orderkey * 104729) % 40000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS longitude,
    'Municipio ' || CAST(o_custkey % 20 + 1 AS VARCHAR) AS municipio,
    CASE WHEN o_orderkey % 101 <> 0 THEN n_name END AS uf,
    CASE WHEN o_orderkey % 89 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(qty * 10 AS DECIMAL(18,2)) END AS area,
    (['SOJA','MILHO','CAFE','CANA_DE_ACUCAR','ALGODAO','FRUTICULTURA','TRIGO','ARROZ','FEIJAO','EUCALIPTO'])[CAST(o_orderkey % 10 + 1 AS INTEGER)]
      AS cultura_principal,
    o_orderkey % 41 > 0 AS possui_experiencia_atividade,
    CAST(o_orderkey % 41 AS INTEGER) AS anos,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(200 + (o_custkey * 37 + o_orderkey) % 701 AS INTEGER) END AS score,
    CASE o_orderkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS multa,
    printf('MAT-%06d', o_orderkey % 1000000) AS numero_matricula_imovel,
    epoch_ms(epoch_ms(o_orderdate) + (o_orderkey % 86400) * 1000
      + CASE WHEN o_orderkey % 50 = 0 THEN 259200000 ELSE 0 END) AS ingestion_timestamp
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN qty ON o_orderkey = l_orderkey
)
"""

SILVER_COLUMNS = """
    proponente_id, data_solicitacao, cpf_cnpj, nome_razao_social, tipo_pessoa,
    renda AS renda_bruta_anual_declarada, valor AS valor_solicitado_credito, finalidade_credito,
    latitude AS localizacao_latitude, longitude AS localizacao_longitude,
    municipio AS localizacao_municipio, uf AS localizacao_uf, area AS area_total_hectares, cultura_principal,
    possui_experiencia_atividade, anos AS anos_experiencia, score AS serasa_score, multa AS ibama_autuacoes_ativas,
    numero_matricula_imovel, '1.0.0' AS versao_schema, 'fixture' AS origem_dados,
    data_solicitacao AS timestamp_geracao_evento, ingestion_timestamp
"""

CLASSES = """
    CASE WHEN area < 50 THEN 'MINIFUNDIO' WHEN area < 200 THEN 'PEQUENA' WHEN area < 1000 THEN 'MEDIA' ELSE 'GRANDE' END
      AS classificacao_propriedade,
    CASE WHEN score IS NULL THEN 'SEM_SCORE' WHEN score >= 700 THEN 'BAIXO' WHEN score >= 500 THEN 'MEDIO'
      WHEN score >= 300 THEN 'ALTO' ELSE 'MUITO_ALTO' END AS faixa_risco_credito,
    (cpf_cnpj IS NOT NULL AND coalesce(valor > 0, FALSE) AND coalesce(area > 0, FALSE) AND uf IS NOT NULL) AS registro_valido
"""

ROW_HASH = """upper(md5(coalesce(proponente_id, '') || coalesce(CAST(req_ms AS VARCHAR), '') || coalesce(CAST(valor AS VARCHAR), '')
      || coalesce(CAST(area AS VARCHAR), '') || coalesce(uf, '')))"""

SILVER = f"""
{APPLICATIONS},
silver AS (SELECT {SILVER_COLUMNS}, {CLASSES}, {AS_OF} AS processed_at, {ROW_HASH} AS row_hash FROM app)
"""

# Money as doubles, the way results are compared.
SILVER_OUT = """
    * REPLACE (
      CAST(renda_bruta_anual_declarada AS DOUBLE) AS renda_bruta_anual_declarada,
      CAST(valor_solicitado_credito AS DOUBLE) AS valor_solicitado_credito,
      CAST(area_total_hectares AS DOUBLE) AS area_total_hectares)
"""

KEY_OUT = "proponente_id, data_solicitacao, CAST(valor_solicitado_credito AS DOUBLE) AS valor_solicitado_credito"


def mean(column: str, decimal: str = "DECIMAL(18,2)") -> str:
    """Exact sum over count; NULL for no values."""
    return f"CAST(sum(CAST({column} AS {decimal})) AS DOUBLE) / nullif(count({column}), 0)"


def whole_mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0)"


def total(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE)"


def sd(column: str) -> str:
    return f"round(stddev_samp(CAST({column} AS DOUBLE)), 4)"


def sd0(column: str) -> str:
    return f"round(coalesce(stddev_samp(CAST({column} AS DOUBLE)), 0.0), 4)"


def share(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) / count(*)"


def mode(keys: str, column: str, name: str, source: str) -> str:
    """A CTE with the most frequent value per key, ties to the smallest."""
    return f"""{name} AS (
  SELECT {keys}, {column} AS v FROM (
    SELECT {keys}, {column}, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {keys}, {column})
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, {column}) = 1)"""


def dispersion(sd_raw: str, mean_name: str, flat: str, steps: list[tuple[float, str]], otherwise: str) -> str:
    tests = " ".join(f"WHEN {sd_raw} / nullif({mean_name}, 0) < CAST({limit} AS DOUBLE) THEN '{label}'" for limit, label in steps)
    return f"CASE WHEN {sd_raw} IS NULL OR {sd_raw} = 0 THEN '{flat}' {tests} ELSE '{otherwise}' END"


DAYS = "date_sub('day', primeira_solicitacao, ultima_solicitacao)"

# --------------------------------------------------------------------------- gold
PROPONENTE_BODY = f"""
usable AS (SELECT * FROM silver WHERE registro_valido AND proponente_id IS NOT NULL AND trim(proponente_id) <> ''),
{mode('proponente_id', 'finalidade_credito', 'm_fin', 'usable')},
{mode('proponente_id', 'cultura_principal', 'm_cul', 'usable')},
{mode('proponente_id', 'classificacao_propriedade', 'm_cla', 'usable')},
{mode('proponente_id', 'faixa_risco_credito', 'm_fai', 'usable')},
agg AS (
  SELECT proponente_id, count(*) AS total_solicitacoes,
    {total('valor_solicitado_credito')} AS valor_total_solicitado, {mean('valor_solicitado_credito')} AS valor_medio_solicitado,
    CAST(max(valor_solicitado_credito) AS DOUBLE) AS valor_maximo_solicitado,
    CAST(min(valor_solicitado_credito) AS DOUBLE) AS valor_minimo_solicitado,
    stddev_samp(CAST(valor_solicitado_credito AS DOUBLE)) AS sd,
    max(data_solicitacao) AS ultima_solicitacao, min(data_solicitacao) AS primeira_solicitacao,
    {whole_mean('serasa_score')} AS serasa_score_medio, max(serasa_score) AS serasa_score_maximo,
    min(serasa_score) AS serasa_score_minimo,
    {mean('localizacao_latitude', 'DECIMAL(18,6)')} AS latitude_media,
    {mean('localizacao_longitude', 'DECIMAL(18,6)')} AS longitude_media,
    {mean('area_total_hectares')} AS area_media_hectares,
    count(DISTINCT finalidade_credito) AS diversidade_finalidades, count(DISTINCT cultura_principal) AS diversidade_culturas,
    count(DISTINCT localizacao_uf) AS diversidade_ufs,
    {whole_mean('anos_experiencia')} AS anos_experiencia_medio, max(anos_experiencia) AS anos_experiencia_maximo,
    {share('ibama_autuacoes_ativas')} AS taxa_autuacoes_ibama, max(processed_at) AS ultima_atualizacao
  FROM usable GROUP BY proponente_id),
gold AS (
  SELECT agg.proponente_id, total_solicitacoes, valor_total_solicitado, valor_medio_solicitado, valor_maximo_solicitado,
    valor_minimo_solicitado, round(sd, 4) AS valor_desvio_padrao, {DAYS} AS dias_entre_primeira_ultima,
    serasa_score_medio, serasa_score_maximo, serasa_score_minimo, latitude_media, longitude_media, area_media_hectares,
    diversidade_finalidades, diversidade_culturas, diversidade_ufs, anos_experiencia_medio, anos_experiencia_maximo,
    taxa_autuacoes_ibama,
    CAST(CASE WHEN serasa_score_medio IS NULL OR serasa_score_medio < 300 THEN 1 WHEN serasa_score_medio < 500 THEN 0.8
      WHEN serasa_score_medio < 700 THEN 0.6 ELSE 0.3 END AS DOUBLE) AS indicador_risco_score,
    CAST(CASE WHEN taxa_autuacoes_ibama > CAST(0.5 AS DOUBLE) THEN 1 WHEN taxa_autuacoes_ibama > CAST(0.2 AS DOUBLE) THEN 0.8
      WHEN taxa_autuacoes_ibama > 0 THEN 0.6 ELSE 0.3 END AS DOUBLE) AS indicador_risco_ambiental,
    valor_total_solicitado / nullif(area_media_hectares, 0) AS valor_por_hectare,
    CAST(month(ultima_solicitacao) AS INTEGER) AS mes_ultima_solicitacao,
    CAST(quarter(ultima_solicitacao) AS INTEGER) AS trimestre_ultima_solicitacao,
    m_fin.v AS finalidade_mais_comum, m_cul.v AS cultura_mais_comum, m_cla.v AS classificacao_mais_comum,
    m_fai.v AS faixa_risco_mais_comum,
    CASE WHEN total_solicitacoes = 1 THEN 'NOVO' WHEN total_solicitacoes <= 5 THEN 'RECORRENTE'
      WHEN total_solicitacoes <= 10 THEN 'FREQUENTE' ELSE 'MUITO_FREQUENTE' END AS perfil_frequencia,
    {dispersion('sd', 'valor_medio_solicitado', 'CONSISTENTE', [(0.2, 'ESTAVEL'), (0.5, 'MODERADO')], 'VOLATIL')} AS perfil_volatilidade,
    CASE WHEN diversidade_finalidades = 1 THEN 'ESPECIALIZADO' WHEN diversidade_finalidades <= 2 THEN 'FOCADO'
      ELSE 'DIVERSIFICADO' END AS perfil_diversificacao,
    ultima_solicitacao, primeira_solicitacao, {AS_OF} AS feature_timestamp, ultima_atualizacao
  FROM agg LEFT JOIN m_fin USING (proponente_id) LEFT JOIN m_cul USING (proponente_id)
    LEFT JOIN m_cla USING (proponente_id) LEFT JOIN m_fai USING (proponente_id))
"""
PROPONENTE = f"{SILVER}, {PROPONENTE_BODY}"

LOC = "localizacao_uf, localizacao_municipio"
LOCATION_BODY = f"""
lusable AS (SELECT * FROM silver WHERE registro_valido AND trim(localizacao_uf) <> '' AND trim(localizacao_municipio) <> ''),
{mode(LOC, 'cultura_principal', 'l_cul', 'lusable')},
{mode(LOC, 'finalidade_credito', 'l_fin', 'lusable')},
{mode(LOC, 'classificacao_propriedade', 'l_cla', 'lusable')},
lagg AS (
  SELECT {LOC}, count(*) AS total_proponentes, count(DISTINCT proponente_id) AS proponentes_unicos,
    {total('valor_solicitado_credito')} AS valor_total_solicitado, {mean('valor_solicitado_credito')} AS valor_medio_solicitado,
    coalesce(stddev_samp(CAST(valor_solicitado_credito AS DOUBLE)), 0.0) AS sd,
    CAST(quantile_disc(valor_solicitado_credito, 0.5) AS DOUBLE) AS valor_mediano_solicitado,
    {total('area_total_hectares')} AS area_total, {mean('area_total_hectares')} AS area_media_hectares,
    {sd0('area_total_hectares')} AS area_desvio_padrao,
    {mean('localizacao_latitude', 'DECIMAL(18,6)')} AS latitude_media,
    {mean('localizacao_longitude', 'DECIMAL(18,6)')} AS longitude_media,
    {sd0('localizacao_latitude')} AS latitude_desvio_padrao, {sd0('localizacao_longitude')} AS longitude_desvio_padrao,
    coalesce({whole_mean('serasa_score')}, CAST(0 AS DOUBLE)) AS serasa_score_medio, {sd0('serasa_score')} AS serasa_score_desvio_padrao,
    {whole_mean('anos_experiencia')} AS anos_experiencia_medio,
    count(DISTINCT cultura_principal) AS diversidade_culturas, count(DISTINCT finalidade_credito) AS diversidade_finalidades,
    count(DISTINCT classificacao_propriedade) AS diversidade_classificacoes,
    {share('ibama_autuacoes_ativas')} AS taxa_autuacoes_ibama,
    {share("faixa_risco_credito = 'BAIXO'")} AS taxa_risco_baixo, {share("faixa_risco_credito = 'MEDIO'")} AS taxa_risco_medio,
    {share("faixa_risco_credito = 'ALTO'")} AS taxa_risco_alto,
    {share("faixa_risco_credito = 'MUITO_ALTO'")} AS taxa_risco_muito_alto,
    {share("tipo_pessoa = 'JURIDICA'")} AS taxa_pessoa_juridica,
    max(data_solicitacao) AS ultima_solicitacao, min(data_solicitacao) AS primeira_solicitacao, max(processed_at) AS ultima_atualizacao
  FROM lusable GROUP BY {LOC}),
lgold AS (
  SELECT lagg.localizacao_uf, lagg.localizacao_municipio,
    lagg.localizacao_uf || '-' || lagg.localizacao_municipio AS localizacao_key,
    total_proponentes, proponentes_unicos, valor_total_solicitado, valor_medio_solicitado, round(sd, 4) AS valor_desvio_padrao,
    valor_mediano_solicitado, area_total AS area_total_hectares, area_media_hectares, area_desvio_padrao, latitude_media,
    longitude_media, latitude_desvio_padrao, longitude_desvio_padrao, serasa_score_medio, serasa_score_desvio_padrao,
    anos_experiencia_medio, diversidade_culturas, diversidade_finalidades, diversidade_classificacoes, taxa_autuacoes_ibama,
    taxa_risco_baixo, taxa_risco_medio, taxa_risco_alto, taxa_risco_muito_alto, taxa_pessoa_juridica,
    valor_total_solicitado / nullif(area_total, 0) AS intensidade_credito_por_hectare,
    CAST(proponentes_unicos AS DOUBLE) / total_proponentes AS taxa_recorrencia,
    taxa_risco_alto + taxa_risco_muito_alto AS taxa_risco_elevado,
    l_cul.v AS cultura_dominante, l_fin.v AS finalidade_dominante, l_cla.v AS classificacao_dominante,
    CASE WHEN total_proponentes < 10 THEN 'BAIXA' WHEN total_proponentes < 50 THEN 'MEDIA'
      WHEN total_proponentes < 200 THEN 'ALTA' ELSE 'MUITO_ALTA' END AS densidade_proponentes,
    {dispersion('sd', 'valor_medio_solicitado', 'HOMOGENEA', [(0.3, 'ESTAVEL'), (0.6, 'MODERADA')], 'HETEROGENEA')} AS homogeneidade_credito,
    CASE WHEN diversidade_culturas = 1 THEN 'MONOCULTURA' WHEN diversidade_culturas <= 3 THEN 'POUCO_DIVERSIFICADA'
      WHEN diversidade_culturas <= 5 THEN 'MODERADAMENTE_DIVERSIFICADA' ELSE 'ALTAMENTE_DIVERSIFICADA' END AS perfil_diversificacao_culturas,
    CASE WHEN latitude_media > -10 THEN 'NORTE' WHEN latitude_media > -20 THEN 'NORDESTE'
      WHEN latitude_media > -30 THEN 'CENTRO_OESTE_SUDESTE' ELSE 'SUL' END AS regiao_geografica,
    ultima_solicitacao, primeira_solicitacao, {AS_OF} AS feature_timestamp, ultima_atualizacao
  FROM lagg LEFT JOIN l_cul USING ({LOC}) LEFT JOIN l_fin USING ({LOC}) LEFT JOIN l_cla USING ({LOC}))
"""
LOCATION = f"{SILVER}, {LOCATION_BODY}"

RISK = "faixa_risco_credito, cultura_principal"
BASE = """CAST(CASE faixa_risco_credito WHEN 'BAIXO' THEN 0.1 WHEN 'MEDIO' THEN 0.3 WHEN 'ALTO' THEN 0.6 WHEN 'MUITO_ALTO' THEN 0.9
      ELSE 0.5 END AS DOUBLE)"""
CROP = """CAST(CASE WHEN cultura_principal IN ('SOJA','MILHO','CAFE') THEN 0.9 WHEN cultura_principal IN ('FRUTICULTURA','TRIGO') THEN 1.1
      ELSE 1.0 END AS DOUBLE)"""
FINE = """CAST(CASE WHEN taxa_autuacoes_ibama > CAST(0.3 AS DOUBLE) THEN 1.2 WHEN taxa_autuacoes_ibama > CAST(0.1 AS DOUBLE) THEN 1.1
      ELSE 1.0 END AS DOUBLE)"""


def quantile(p: float) -> str:
    return f"CAST(quantile_disc(valor_solicitado_credito, {p}) AS DOUBLE)"


RISK_BODY = f"""
rusable AS (SELECT * FROM silver WHERE registro_valido AND trim(faixa_risco_credito) <> '' AND trim(cultura_principal) <> ''),
ragg AS (
  SELECT {RISK}, count(*) AS total_solicitacoes, count(DISTINCT proponente_id) AS proponentes_unicos,
    {total('valor_solicitado_credito')} AS valor_total_solicitado, {mean('valor_solicitado_credito')} AS valor_medio_solicitado,
    stddev_samp(CAST(valor_solicitado_credito AS DOUBLE)) AS sd,
    {quantile(0.25)} AS valor_p25, {quantile(0.5)} AS valor_mediano, {quantile(0.75)} AS valor_p75, {quantile(0.9)} AS valor_p90,
    {total('area_total_hectares')} AS area_total, {mean('area_total_hectares')} AS area_media_hectares,
    {sd('area_total_hectares')} AS area_desvio_padrao,
    {whole_mean('serasa_score')} AS serasa_score_medio, {sd('serasa_score')} AS serasa_score_desvio_padrao,
    min(serasa_score) AS serasa_score_minimo, max(serasa_score) AS serasa_score_maximo,
    {whole_mean('anos_experiencia')} AS anos_experiencia_medio, {sd('anos_experiencia')} AS anos_experiencia_desvio_padrao,
    {share("tipo_pessoa = 'JURIDICA'")} AS taxa_pessoa_juridica,
    {share("classificacao_propriedade = 'MINIFUNDIO'")} AS taxa_minifundio,
    {share("classificacao_propriedade = 'PEQUENA'")} AS taxa_pequena, {share("classificacao_propriedade = 'MEDIA'")} AS taxa_media,
    {share("classificacao_propriedade = 'GRANDE'")} AS taxa_grande,
    {share("finalidade_credito = 'CUSTEIO_SAFRA'")} AS taxa_custeio_safra,
    {share("finalidade_credito = 'INVESTIMENTO_MAQUINARIO'")} AS taxa_investimento_maquinario,
    {share("finalidade_credito = 'AMPLIACAO_AREA'")} AS taxa_ampliacao_area,
    {share('ibama_autuacoes_ativas')} AS taxa_autuacoes_ibama,
    count(DISTINCT localizacao_uf) AS diversidade_ufs, count(DISTINCT localizacao_municipio) AS diversidade_municipios,
    max(data_solicitacao) AS ultima_solicitacao, min(data_solicitacao) AS primeira_solicitacao, max(processed_at) AS ultima_atualizacao
  FROM rusable GROUP BY {RISK}),
rgold AS (
  SELECT {RISK}, faixa_risco_credito || '-' || cultura_principal AS risco_cultura_key, total_solicitacoes, proponentes_unicos,
    valor_total_solicitado, valor_medio_solicitado, round(sd, 4) AS valor_desvio_padrao, valor_p25, valor_mediano, valor_p75, valor_p90,
    area_total AS area_total_hectares, area_media_hectares, area_desvio_padrao, serasa_score_medio, serasa_score_desvio_padrao,
    serasa_score_minimo, serasa_score_maximo, anos_experiencia_medio, anos_experiencia_desvio_padrao, taxa_pessoa_juridica,
    taxa_minifundio, taxa_pequena, taxa_media, taxa_grande, taxa_custeio_safra, taxa_investimento_maquinario, taxa_ampliacao_area,
    taxa_autuacoes_ibama, diversidade_ufs, diversidade_municipios, {BASE} AS peso_risco_base, {CROP} AS fator_risco_cultura,
    valor_total_solicitado / nullif(area_total, 0) AS intensidade_credito_por_hectare,
    CAST(proponentes_unicos AS DOUBLE) / total_solicitacoes AS taxa_recorrencia,
    {BASE} * {CROP} * {FINE} AS score_risco_ajustado,
    CASE WHEN total_solicitacoes < 10 THEN 'BAIXO_VOLUME' WHEN total_solicitacoes < 50 THEN 'MEDIO_VOLUME'
      WHEN total_solicitacoes < 200 THEN 'ALTO_VOLUME' ELSE 'MUITO_ALTO_VOLUME' END AS volume_solicitacoes,
    {dispersion('sd', 'valor_medio_solicitado', 'HOMOGENEO', [(0.3, 'ESTAVEL'), (0.6, 'MODERADO')], 'VOLATIL')} AS volatilidade_credito,
    CASE WHEN taxa_pessoa_juridica > CAST(0.7 AS DOUBLE) THEN 'PREDOMINANTEMENTE_JURIDICA'
      WHEN taxa_pessoa_juridica > CAST(0.3 AS DOUBLE) THEN 'MISTA' ELSE 'PREDOMINANTEMENTE_FISICA' END AS perfil_tipo_pessoa,
    CASE WHEN taxa_custeio_safra > CAST(0.6 AS DOUBLE) THEN 'FOCO_CUSTEIO'
      WHEN taxa_investimento_maquinario > CAST(0.4 AS DOUBLE) THEN 'FOCO_INVESTIMENTO'
      WHEN taxa_ampliacao_area > CAST(0.3 AS DOUBLE) THEN 'FOCO_EXPANSAO' ELSE 'DIVERSIFICADO' END AS perfil_finalidade,
    ultima_solicitacao, primeira_solicitacao, {AS_OF} AS feature_timestamp, ultima_atualizacao
  FROM ragg)
"""
RISK_ALL = f"{SILVER}, {RISK_BODY}"

# ------------------------------------------------------------------------ quality
NOT_NULL = [
    "proponente_id", "cpf_cnpj", "data_solicitacao", "tipo_pessoa", "valor_solicitado_credito", "finalidade_credito",
    "localizacao_uf", "area_total_hectares", "cultura_principal", "classificacao_propriedade", "faixa_risco_credito",
    "registro_valido", "processed_at", "row_hash",
]
DOMAINS = {
    "tipo_pessoa": "'FISICA','JURIDICA'",
    "finalidade_credito": "'CUSTEIO_SAFRA','INVESTIMENTO_MAQUINARIO','AMPLIACAO_AREA','OUTROS'",
    "cultura_principal": "'SOJA','MILHO','CAFE','CANA_DE_ACUCAR','ALGODAO','FRUTICULTURA','TRIGO','ARROZ','FEIJAO','EUCALIPTO'",
    "classificacao_propriedade": "'MINIFUNDIO','PEQUENA','MEDIA','GRANDE'",
    "faixa_risco_credito": "'SEM_SCORE','MUITO_ALTO','ALTO','MEDIO','BAIXO'",
    "registro_valido": "TRUE",
}
EXPRESSIONS = {
    "valor_solicitado_credito": "valor_solicitado_credito > 0",
    "area_total_hectares": "area_total_hectares > 0",
    "localizacao_latitude": "localizacao_latitude BETWEEN -90 AND 90",
    "localizacao_longitude": "localizacao_longitude BETWEEN -180 AND 180",
}


def check_row(kind: str, column: str, failing: str, source: str = "silver", severity: str = "error") -> str:
    return (
        f"SELECT '{kind}' AS check_name, '{column}' AS column_name, '{severity}' AS severity, "
        f"CAST(count(*) FILTER (WHERE {failing}) AS BIGINT) AS failures FROM {source}"
    )


def duplicates_row(kind: str, keys: str, source: str = "silver") -> str:
    return (
        f"SELECT '{kind}' AS check_name, '{keys}' AS column_name, 'error' AS severity, CAST(count(*) AS BIGINT) AS failures "
        f"FROM (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"
    )


def recency_row(column: str, source: str = "silver") -> str:
    return (
        f"SELECT 'recency' AS check_name, '{column}' AS column_name, 'error' AS severity, CAST(CASE WHEN max({column}) >= "
        f"{AS_OF} - INTERVAL 24 HOURS THEN 0 ELSE 1 END AS BIGINT) AS failures FROM {source}"
    )


def union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


SILVER_KEY = "proponente_id,data_solicitacao,valor_solicitado_credito"
RATIO = "CAST(valor_solicitado_credito AS DOUBLE) / nullif(CAST(renda_bruta_anual_declarada AS DOUBLE), 0)"
NOT_NULL_ROWS = [check_row("not_null", c, f"{c} IS NULL") for c in NOT_NULL]
ACCEPTED_ROWS = [check_row("accepted_values", c, f"{c} NOT IN ({v})") for c, v in DOMAINS.items()]
EXPRESSION_ROWS = [check_row("expression_is_true", c, f"NOT ({e})") for c, e in EXPRESSIONS.items()]
RATIO_ROW = check_row("ratio_outliers", "razao_credito_renda", f"processed_at >= {AS_OF} - INTERVAL 24 HOURS AND {RATIO} > 10", severity="warn")
GAP_ROW = f"""SELECT 'load_gap' AS check_name, 'ingestion_timestamp' AS column_name, 'error' AS severity, count(*) AS failures
  FROM (SELECT ingestion_timestamp AS t, lag(ingestion_timestamp) OVER (ORDER BY ingestion_timestamp) AS p FROM silver
    WHERE processed_at >= {AS_OF} - INTERVAL 1 HOUR) WHERE date_sub('minute', p, t) > 5"""
STATUS = "CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status"

GOLD_CHECKS = {
    "proponente": {
        "source": "gold",
        "keys": "proponente_id",
        "filled": [
            "proponente_id", "total_solicitacoes", "valor_total_solicitado", "valor_medio_solicitado", "perfil_frequencia",
            "perfil_volatilidade", "perfil_diversificacao", "indicador_risco_score", "indicador_risco_ambiental", "feature_timestamp",
        ],
        "domains": {
            "perfil_frequencia": "'NOVO','RECORRENTE','FREQUENTE','MUITO_FREQUENTE'",
            "perfil_volatilidade": "'CONSISTENTE','ESTAVEL','MODERADO','VOLATIL'",
            "perfil_diversificacao": "'ESPECIALIZADO','FOCADO','DIVERSIFICADO'",
        },
        "ranges": {
            "total_solicitacoes": "total_solicitacoes >= 1",
            "valor_total_solicitado": "valor_total_solicitado > 0",
            "valor_medio_solicitado": "valor_medio_solicitado > 0",
            "serasa_score_medio": "serasa_score_medio BETWEEN 0 AND 1000",
            "indicador_risco_score": "indicador_risco_score BETWEEN 0 AND 1",
            "indicador_risco_ambiental": "indicador_risco_ambiental BETWEEN 0 AND 1",
        },
    },
    "location": {
        "source": "lgold",
        "keys": "localizacao_uf,localizacao_municipio",
        "filled": [
            "localizacao_uf", "localizacao_municipio", "total_proponentes", "densidade_proponentes", "homogeneidade_credito",
            "perfil_diversificacao_culturas", "regiao_geografica", "taxa_risco_elevado", "feature_timestamp",
        ],
        "domains": {
            "densidade_proponentes": "'BAIXA','MEDIA','ALTA','MUITO_ALTA'",
            "homogeneidade_credito": "'HOMOGENEA','ESTAVEL','MODERADA','HETEROGENEA'",
            "perfil_diversificacao_culturas":
                "'MONOCULTURA','POUCO_DIVERSIFICADA','MODERADAMENTE_DIVERSIFICADA','ALTAMENTE_DIVERSIFICADA'",
            "regiao_geografica": "'NORTE','NORDESTE','CENTRO_OESTE_SUDESTE','SUL'",
        },
        "ranges": {"total_proponentes": "total_proponentes >= 1", "taxa_risco_elevado": "taxa_risco_elevado BETWEEN 0 AND 1"},
    },
    "risk": {
        "source": "rgold",
        "keys": "faixa_risco_credito,cultura_principal",
        "filled": [
            "faixa_risco_credito", "cultura_principal", "total_solicitacoes", "volume_solicitacoes", "volatilidade_credito",
            "perfil_tipo_pessoa", "perfil_finalidade", "peso_risco_base", "fator_risco_cultura", "score_risco_ajustado",
            "feature_timestamp",
        ],
        "domains": {
            "faixa_risco_credito": DOMAINS["faixa_risco_credito"],
            "cultura_principal": DOMAINS["cultura_principal"],
            "volume_solicitacoes": "'BAIXO_VOLUME','MEDIO_VOLUME','ALTO_VOLUME','MUITO_ALTO_VOLUME'",
            "volatilidade_credito": "'HOMOGENEO','ESTAVEL','MODERADO','VOLATIL'",
            "perfil_tipo_pessoa": "'PREDOMINANTEMENTE_JURIDICA','MISTA','PREDOMINANTEMENTE_FISICA'",
            "perfil_finalidade": "'FOCO_CUSTEIO','FOCO_INVESTIMENTO','FOCO_EXPANSAO','DIVERSIFICADO'",
        },
        "ranges": {
            "total_solicitacoes": "total_solicitacoes >= 1",
            "peso_risco_base": "peso_risco_base BETWEEN 0 AND 1",
            "fator_risco_cultura": "fator_risco_cultura BETWEEN 0.5 AND 1.5",
            "score_risco_ajustado": "score_risco_ajustado BETWEEN 0 AND 1.5",
        },
    },
}


def gold_check_rows(name: str) -> str:
    """All checks of one gold table as rows."""
    spec = GOLD_CHECKS[name]
    source, keys = spec["source"], spec["keys"]
    kind = "unique_combination_of_columns" if "," in keys else "unique"
    rows = union(
        [check_row("not_null", c, f"{c} IS NULL", source) for c in spec["filled"]]
        + [check_row("accepted_values", c, f"{c} NOT IN ({v})", source) for c, v in spec["domains"].items()]
        + [check_row("expression_is_true", c, f"NOT ({e})", source) for c, e in spec["ranges"].items()]
        + [recency_row("feature_timestamp", source), duplicates_row(kind, keys, source)]
    )
    return f"SELECT 'gold_{name}' AS table_name, * FROM ({rows})"


# ------------------------------------------------------------------- model, drift
FEATURES = [
    "total_solicitacoes", "valor_total_solicitado", "valor_medio_solicitado", "valor_maximo_solicitado", "valor_minimo_solicitado",
    "serasa_score_medio", "anos_experiencia_medio", "area_media_hectares", "taxa_autuacoes_ibama", "diversidade_culturas",
    "diversidade_finalidades",
]
FEATURE_LIST = ", ".join(FEATURES)
MEDIANS = ["valor_total_solicitado", "anos_experiencia_medio", "serasa_score_medio", "area_media_hectares"]
MEDIAN_DEFAULTS = [50000, 10, 600, 100]
IMPUTED = f"""{PROPONENTE},
feat AS (SELECT proponente_id, {FEATURE_LIST} FROM gold),
med AS (SELECT {", ".join(f"coalesce(quantile_cont({c}, 0.5), {d}) AS m_{c}" for c, d in zip(MEDIANS, MEDIAN_DEFAULTS))} FROM feat),
imputed AS (SELECT feat.* REPLACE (
    {", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in MEDIANS)},
    coalesce(taxa_autuacoes_ibama, 0.0) AS taxa_autuacoes_ibama, coalesce(diversidade_culturas, 1) AS diversidade_culturas) FROM feat, med)
"""


def limited(expression: str, high: int) -> str:
    return f"greatest(CAST(0 AS DOUBLE), least(CAST({high} AS DOUBLE), {expression}))"


D = "CAST({} AS DOUBLE)".format
TARGET = f"""{IMPUTED},
shifted AS (SELECT proponente_id,
    ({limited('valor_total_solicitado / 200000', 2)} - 1) * {D(0.05)} + (1 - {limited('anos_experiencia_medio / 30', 2)}) * {D(0.1)}
    + ({limited('serasa_score_medio / 900', 1)} - {D(0.5)}) * {D(0.2)} + ({limited('area_media_hectares / 1000', 2)} - 1) * {D(0.03)} AS shift
  FROM imputed),
chance AS (SELECT proponente_id, greatest({D(0.1)}, least({D(0.9)}, {D(0.3)} + shift)) AS default_probability FROM shifted)
"""


def uniform(salt: str, *parts: str) -> str:
    """The hash-based number in [0, 1) of the given parts."""
    text = " || '|' || ".join([f"'{salt}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"CAST(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE)"


def drift_side(name: str, condition: str) -> str:
    return f"""{name} AS (SELECT proponente_id, {total('valor_solicitado_credito')} AS valor_total_solicitado,
    {mean('valor_solicitado_credito')} AS valor_medio_solicitado, {mean('area_total_hectares')} AS area_media_hectares,
    {whole_mean('anos_experiencia')} AS anos_experiencia_medio, {whole_mean('serasa_score')} AS serasa_score_medio
  FROM silver WHERE registro_valido AND {condition} GROUP BY proponente_id)"""


DRIFT = f"""{SILVER},
{drift_side('cur', "data_solicitacao >= TIMESTAMP '1998-01-01'")},
{drift_side('base', "data_solicitacao < TIMESTAMP '1998-01-01'")},
long AS (
  SELECT feature, value, 1 AS c, 0 AS b FROM (UNPIVOT (SELECT * EXCLUDE proponente_id FROM cur) ON COLUMNS(*) INTO NAME feature VALUE value)
  UNION ALL
  SELECT feature, value, 0, 1 FROM (UNPIVOT (SELECT * EXCLUDE proponente_id FROM base) ON COLUMNS(*) INTO NAME feature VALUE value)),
size AS (SELECT feature, CAST(sum(c) AS BIGINT) AS n_current, CAST(sum(b) AS BIGINT) AS n_baseline FROM long GROUP BY feature),
steps AS (SELECT feature, value, sum(c) AS c, sum(b) AS b FROM long GROUP BY feature, value),
run AS (SELECT feature, sum(c) OVER w AS cc, sum(b) OVER w AS bb FROM steps WINDOW w AS (PARTITION BY feature ORDER BY value)),
ks AS (SELECT feature, n_current, n_baseline,
    CAST(max(abs(cc * n_baseline - bb * n_current)) AS DOUBLE) / (CAST(n_current AS DOUBLE) * n_baseline) AS d
  FROM run JOIN size USING (feature) GROUP BY feature, n_current, n_baseline),
ksp AS (SELECT *, d * d * (CAST(n_current AS DOUBLE) * n_baseline / (n_current + n_baseline)) AS lam2 FROM ks),
tested AS (SELECT feature, n_current, n_baseline, d, 1.358 * sqrt((n_current + n_baseline) / (CAST(n_current AS DOUBLE) * n_baseline)) AS crit,
    CASE WHEN lam2 < 0.04 THEN CAST(1 AS DOUBLE) ELSE greatest(0.0, least(1.0, list_sum(list_transform(range(1, 101),
      lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(CAST(-2.0 * k * k AS DOUBLE) * lam2))))) END AS p
  FROM ksp)
"""


def metrics(name: str, source: str) -> str:
    """CTEs ending in a one-row ``name`` with the four weighted scores of source(actual, predicted)."""
    return f"""{name}_cls AS (SELECT DISTINCT v AS cls FROM (SELECT quality AS v FROM {source} UNION ALL SELECT predicted FROM {source})),
{name}_per AS (SELECT cls, (SELECT count(*) FROM {source} WHERE quality = cls) AS support,
    (SELECT count(*) FROM {source} WHERE predicted = cls) AS named,
    (SELECT count(*) FROM {source} WHERE quality = cls AND predicted = cls) AS hits FROM {name}_cls),
{name}_pr AS (SELECT *, coalesce(CAST(hits AS DOUBLE) / nullif(named, 0), 0.0) AS pr, coalesce(CAST(hits AS DOUBLE) / nullif(support, 0), 0.0) AS re
  FROM {name}_per),
{name} AS (SELECT CAST(sum(hits) AS DOUBLE) / sum(support) AS accuracy, sum(pr * support) / sum(support) AS precision,
    sum(re * support) / sum(support) AS recall, sum(coalesce(2 * pr * re / nullif(pr + re, 0), 0.0) * support) / sum(support) AS f1,
    CAST(sum(support) AS BIGINT) AS n FROM {name}_pr)"""


# ------------------------------------------------------------------------ scoring
SCORED_BODY = f"""
points AS (SELECT *, CAST(renda AS DOUBLE) / nullif(CAST(valor AS DOUBLE), 0) AS r FROM app),
scored AS (SELECT *, greatest({D(0.0)}, least({D(1.0)},
    {D(0.5)} + CAST(CASE WHEN r > 5 THEN 0.2 WHEN r > 3 THEN 0.1 WHEN r < 1 THEN -0.3 ELSE 0 END AS DOUBLE)
    + CAST(CASE WHEN anos > 10 THEN 0.1 WHEN anos > 5 THEN 0.05 WHEN anos = 0 THEN -0.2 ELSE 0 END AS DOUBLE)
    + CAST(CASE WHEN area > 500 THEN 0.1 WHEN area > 100 THEN 0.05 ELSE 0 END AS DOUBLE)
    + CAST(CASE WHEN score IS NULL OR score = 0 THEN 0 WHEN score > 700 THEN 0.2 WHEN score > 500 THEN 0.1 ELSE -0.1 END AS DOUBLE)
    - CAST(CASE WHEN multa THEN 0.15 ELSE 0 END AS DOUBLE))) AS s FROM points)
"""
SCORED = f"{APPLICATIONS}, {SCORED_BODY}"

# ---------------------------------------------------------------------- increments
CHANGED = f"""{SILVER},
loaded AS (SELECT * REPLACE ({MARK} AS processed_at) FROM silver WHERE ingestion_timestamp <= {MARK}),
later AS (SELECT * FROM silver WHERE ingestion_timestamp > {MARK}),
fixes AS (SELECT s.* REPLACE (CAST(round(area_total_hectares / 2, 2) AS DECIMAL(18,2)) AS area_total_hectares,
    ingestion_timestamp + INTERVAL 1 DAY AS ingestion_timestamp)
  FROM silver s WHERE data_solicitacao BETWEEN {MARK} - INTERVAL 365 DAYS AND {MARK}),
fixed AS (SELECT * REPLACE (
    CASE WHEN area_total_hectares < 50 THEN 'MINIFUNDIO' WHEN area_total_hectares < 200 THEN 'PEQUENA'
      WHEN area_total_hectares < 1000 THEN 'MEDIA' ELSE 'GRANDE' END AS classificacao_propriedade,
    (cpf_cnpj IS NOT NULL AND coalesce(valor_solicitado_credito > 0, FALSE) AND coalesce(area_total_hectares > 0, FALSE)
      AND localizacao_uf IS NOT NULL) AS registro_valido,
    upper(md5(proponente_id || CAST(epoch_ms(data_solicitacao) AS VARCHAR) || CAST(valor_solicitado_credito AS VARCHAR)
      || coalesce(CAST(area_total_hectares AS VARCHAR), '') || coalesce(localizacao_uf, ''))) AS row_hash) FROM fixes),
incoming AS (SELECT * FROM (SELECT * FROM later UNION ALL SELECT * FROM fixed)
  QUALIFY row_number() OVER (PARTITION BY {SILVER_KEY} ORDER BY ingestion_timestamp DESC) = 1),
merged AS (SELECT * FROM incoming UNION ALL SELECT * FROM loaded t WHERE NOT EXISTS (SELECT 1 FROM incoming i
  WHERE i.proponente_id = t.proponente_id AND i.data_solicitacao = t.data_solicitacao
    AND i.valor_solicitado_credito = t.valor_solicitado_credito))
"""

ASSEMBLED_NAMES = [
    "total_solicitacoes", "valor_total_solicitado", "valor_medio_solicitado", "serasa_score_medio", "anos_experiencia_medio",
    "area_media_hectares", "total_proponentes", "area_total_hectares",
]
IN_VIEW = {
    "p": ["total_solicitacoes", "valor_total_solicitado", "valor_medio_solicitado", "serasa_score_medio", "anos_experiencia_medio", "area_media_hectares"],
    "l": ["total_proponentes", "valor_total_solicitado", "valor_medio_solicitado", "area_total_hectares", "serasa_score_medio"],
    "r": ["total_solicitacoes", "valor_total_solicitado", "valor_medio_solicitado", "area_total_hectares", "serasa_score_medio"],
}
FOUND = {"p": "p.proponente_id IS NOT NULL", "l": "l.localizacao_key IS NOT NULL", "r": "r.risco_cultura_key IS NOT NULL"}


def assembled(name: str) -> str:
    tests = " ".join(f"WHEN {FOUND[v]} THEN CAST({v}.{name} AS DOUBLE)" for v in ("r", "l", "p") if name in IN_VIEW[v])
    return f"CASE {tests} END AS f_{name}"


HAS_POSITION = "latitude <> 0 AND longitude <> 0"

SPLIT = f"""{TARGET},
drawn AS (SELECT *, CAST({uniform('target-42', 'proponente_id')} < default_probability AS INTEGER) AS t, {uniform('split-42', 'proponente_id')} AS u FROM chance JOIN imputed USING (proponente_id)),
parted AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY t ORDER BY u) <= ceil({D(0.8)} * count(*) OVER (PARTITION BY t)) THEN 'train'
  ELSE 'test' END AS part FROM drawn)"""

EXPORTS = f"""{PROPONENTE}, {LOCATION_BODY}, {RISK_BODY}, entities AS (
  SELECT 'proponente' AS view, proponente_id AS key, 30 AS ttl, total_solicitacoes AS total, valor_total_solicitado AS valor FROM gold
  UNION ALL SELECT 'location', localizacao_key, 7, total_proponentes, valor_total_solicitado FROM lgold
  UNION ALL SELECT 'risk', risco_cultura_key, 14, total_solicitacoes, valor_total_solicitado FROM rgold
), exports AS (
  SELECT e.*, x.every, x.days FROM entities e, (SELECT unnest([1, 2, 3]) AS every, unnest([40, 10, 1]) AS days) x WHERE e.total % x.every = 0
)"""

# Requests of all applications against views that know some of them. The stand-in model says nothing on
# applicants with 3 to 6 applications; rules decide there.
SERVED = "served AS (SELECT * FROM silver WHERE CAST(right(proponente_id, 1) AS INTEGER) % 2 = 0 AND cultura_principal <> 'SOJA')"
SCORE_PIPELINE = f"""WITH {SILVER}, {SERVED}, {', '.join(b.replace('FROM silver', 'FROM served') for b in (PROPONENTE_BODY, LOCATION_BODY, RISK_BODY))},
{SCORED_BODY}, looked AS (
  SELECT s.proponente_id, s.data_solicitacao, s.valor_solicitado_credito, s.renda_bruta_anual_declarada,
    ({' OR '.join(FOUND.values())}) AS features_found, {assembled('total_solicitacoes')}, {assembled('valor_medio_solicitado')}
  FROM silver s LEFT JOIN gold p ON s.proponente_id = p.proponente_id
  LEFT JOIN lgold l ON coalesce(s.localizacao_uf, 'UNKNOWN') || '-' || coalesce(s.localizacao_municipio, 'UNKNOWN') = l.localizacao_key
  LEFT JOIN rgold r ON s.faixa_risco_credito || '-' || coalesce(s.cultura_principal, 'UNKNOWN') = r.risco_cultura_key
), predicted AS (
  SELECT *, CASE WHEN coalesce(f_total_solicitacoes, 0) BETWEEN 3 AND 6 THEN NULL
    ELSE coalesce(f_valor_medio_solicitado, 0) / (coalesce(f_valor_medio_solicitado, 0) + 200000) END AS chance FROM looked
), decided AS (
  SELECT p.*, CASE WHEN chance IS NULL THEN c.s ELSE 1 - chance END AS score FROM predicted p
  JOIN scored c ON p.proponente_id = c.proponente_id AND p.data_solicitacao = c.data_solicitacao AND p.valor_solicitado_credito = c.valor
)
SELECT proponente_id, data_solicitacao, CAST(valor_solicitado_credito AS DOUBLE) AS valor_solicitado_credito, features_found,
  CASE WHEN chance IS NULL THEN 'rules' ELSE 'model' END AS decided_by, round(score, 6) AS score,
  CASE WHEN score > {D(0.7)} THEN 'LOW' WHEN score > {D(0.4)} THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
  round(least(CAST(valor_solicitado_credito AS DOUBLE), CAST(renda_bruta_anual_declarada AS DOUBLE) * {D(0.3)}) * ({D(0.5)} + score * {D(0.5)}), 6)
    AS credit_limit,
  CASE WHEN score > {D(0.6)} THEN 'APPROVE' WHEN score > {D(0.3)} THEN 'MANUAL_REVIEW' ELSE 'DENY' END AS recommendation FROM decided"""

BRONZE_FLAT = f"""WITH {APPLICATIONS} SELECT proponente_id, data_solicitacao, cpf_cnpj, nome_razao_social, tipo_pessoa,
      CAST(renda AS DOUBLE) AS renda_bruta_anual_declarada, CAST(valor AS DOUBLE) AS valor_solicitado_credito, finalidade_credito,
      latitude AS localizacao_latitude, longitude AS localizacao_longitude, municipio AS localizacao_municipio, uf AS localizacao_uf,
      CAST(area AS DOUBLE) AS area_total_hectares, cultura_principal, possui_experiencia_atividade, anos AS anos_experiencia,
      score AS serasa_score, multa AS ibama_autuacoes_ativas, numero_matricula_imovel, '1.0.0' AS versao_schema,
      'fixture' AS origem_dados, data_solicitacao AS timestamp_geracao_evento, {AS_OF} AS data_ingestao,
      CAST(year(data_solicitacao) AS INTEGER) AS ano_particao, CAST(month(data_solicitacao) AS INTEGER) AS mes_particao,
      CAST(day(data_solicitacao) AS INTEGER) AS dia_particao FROM app"""

ORACLE_SQL: dict[str, str] = {
    "bronze_from_json": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "kafka_envelope": """SELECT CAST(user_id AS VARCHAR) AS kafka_key, props AS kafka_value, 'dados_produtores' AS topic,
      CAST(user_id % 3 AS INTEGER) AS partition, event_id AS "offset", ts AS kafka_timestamp FROM events""",
    "bronze_flat": BRONZE_FLAT,
    "stream_bronze_flat": BRONZE_FLAT,
    "struct_withfield": f"""WITH {APPLICATIONS} SELECT proponente_id, req_ms AS data_solicitacao,
      CAST(valor AS DOUBLE) AS valor_solicitado_credito, '1.0.0' AS versao_schema, 'fixture' AS origem_dados,
      req_ms AS timestamp_geracao_evento FROM app""",
    "partition_columns": f"""WITH {APPLICATIONS} SELECT CAST(year(data_solicitacao) AS INTEGER) AS ano_particao,
      CAST(month(data_solicitacao) AS INTEGER) AS mes_particao, CAST(day(data_solicitacao) AS INTEGER) AS dia_particao, count(*) AS n
      FROM app GROUP BY ALL""",
    "dated_partitions": f"""WITH {APPLICATIONS} SELECT CAST(year(data_solicitacao) AS INTEGER) AS ano, CAST(month(data_solicitacao) AS INTEGER) AS mes,
      tipo_pessoa, count(*) AS n FROM app GROUP BY ALL""",
    "raw_landing_path": f"""WITH {APPLICATIONS} SELECT proponente_id, CAST(valor AS DOUBLE) AS valor_solicitado_credito,
      strftime(ingestion_timestamp, '%Y/%m/%d/%H') || '/' || proponente_id || '_' || strftime(ingestion_timestamp, '%Y%m%d%H%M%S%f') || '.json'
        AS object_by_applicant,
      strftime(ingestion_timestamp, '%Y/%m/%d/%H') || '/' || regexp_replace(nome_razao_social, '[^\\p{{L}}\\p{{N}}_-]', '_', 'g') || '_'
      || strftime(ingestion_timestamp, '%Y%m%d%H%M%S%f') || '.json' AS object_name FROM app""",
    "silver_flatten": f"WITH {APPLICATIONS}, flat AS (SELECT {SILVER_COLUMNS} FROM app) SELECT {SILVER_OUT} FROM flat",
    "silver_classify": f"WITH {SILVER} SELECT {KEY_OUT}, classificacao_propriedade, faixa_risco_credito, registro_valido FROM silver",
    "silver_row_hash": f"WITH {SILVER} SELECT {KEY_OUT}, row_hash FROM silver",
    "silver_full": f"WITH {SILVER} SELECT {SILVER_OUT} FROM silver",
    "silver_metrics": f"""WITH {SILVER} SELECT 'silver' AS table_name, count(*) AS total_rows,
      count(DISTINCT proponente_id) AS unique_proponentes, max(ingestion_timestamp) AS last_ingestion, {AS_OF} AS metric_timestamp FROM silver""",
    "incremental_scan": f"""WITH {SILVER} SELECT {KEY_OUT}, ingestion_timestamp FROM silver WHERE ingestion_timestamp >
      (SELECT coalesce(max(ingestion_timestamp), TIMESTAMP '1970-01-01') FROM silver WHERE ingestion_timestamp <= {MARK})""",
    "incremental_status": f"""WITH {APPLICATIONS} SELECT s.m AS source_max, t.m AS target_max, s.m > t.m AS has_new_data
      FROM (SELECT max(ingestion_timestamp) AS m FROM app) s,
      (SELECT max(ingestion_timestamp) AS m FROM app WHERE ingestion_timestamp <= {MARK}) t""",
    "upsert_silver": f"WITH {CHANGED} SELECT {SILVER_OUT} FROM merged",
    "upsert_new_columns": f"""WITH {SILVER},
      later AS (SELECT {SILVER_KEY}, ingestion_timestamp, tipo_pessoa FROM silver WHERE data_solicitacao > {MARK} - INTERVAL 365 DAYS)
      SELECT {KEY_OUT}, ingestion_timestamp, tipo_pessoa FROM later UNION ALL
      SELECT {KEY_OUT}, ingestion_timestamp, NULL FROM silver t WHERE ingestion_timestamp <= {MARK} AND NOT EXISTS (SELECT 1 FROM later i
        WHERE i.proponente_id = t.proponente_id AND i.data_solicitacao = t.data_solicitacao
          AND i.valor_solicitado_credito = t.valor_solicitado_credito)""",
    "recent_rows": f"""WITH {SILVER} SELECT {KEY_OUT}, ingestion_timestamp FROM silver
      WHERE ingestion_timestamp >= {AS_OF} - INTERVAL 2160 HOURS""",
    "stream_bronze": f"WITH {APPLICATIONS}, flat AS (SELECT {SILVER_COLUMNS} FROM app) SELECT {SILVER_OUT} FROM flat",
    "stream_silver": f"""WITH {SILVER} SELECT CAST(year(data_solicitacao) AS INTEGER) AS ano, CAST(month(data_solicitacao) AS INTEGER) AS mes,
      faixa_risco_credito, registro_valido, count(*) AS n, CAST(sum(valor_solicitado_credito) AS DOUBLE) AS valor,
      min(row_hash) AS first_hash, max(row_hash) AS last_hash FROM silver GROUP BY ALL""",
    "stream_scores": f"""WITH {SCORED} SELECT proponente_id, data_solicitacao, 'success' AS status, s AS score,
      least(CAST(valor AS DOUBLE), CAST(renda AS DOUBLE) * {D(0.3)}) * ({D(0.5)} + s * {D(0.5)}) AS credit_limit,
      CASE WHEN s > {D(0.7)} THEN 'LOW' WHEN s > {D(0.4)} THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
      CASE WHEN s > {D(0.6)} THEN 'APPROVE' WHEN s > {D(0.3)} THEN 'MANUAL_REVIEW' ELSE 'DENY' END AS recommendation FROM scored""",
    "gold_proponente": f"WITH {PROPONENTE} SELECT * FROM gold",
    "gold_location": f"WITH {LOCATION} SELECT * FROM lgold",
    "gold_risk": f"WITH {RISK_ALL} SELECT * FROM rgold",
    "gold_risk_exact": f"WITH {RISK_ALL} SELECT {RISK}, total_solicitacoes, valor_p25, valor_mediano, valor_p75, valor_p90 FROM rgold",
    "gold_incremental": f"""WITH {PROPONENTE},
      touched AS (SELECT proponente_id, bool_or(ingestion_timestamp > {MARK}) AS late FROM usable GROUP BY proponente_id)
      SELECT proponente_id, total_solicitacoes, valor_total_solicitado, valor_medio_solicitado, cultura_mais_comum, perfil_frequencia,
      CASE WHEN late THEN {AS_OF} ELSE {MARK} END AS feature_timestamp,
      CASE WHEN late THEN {AS_OF} ELSE {MARK} END AS ultima_atualizacao FROM gold JOIN touched USING (proponente_id)""",
    "gold_incremental_proponente": f"WITH {PROPONENTE} SELECT * EXCLUDE (feature_timestamp, ultima_atualizacao) FROM gold",
    "gold_incremental_location": f"WITH {LOCATION} SELECT * EXCLUDE (feature_timestamp, ultima_atualizacao) FROM lgold",
    "gold_after_stream": f"WITH {PROPONENTE} SELECT * EXCLUDE (feature_timestamp, ultima_atualizacao) FROM gold",
    "gold_after_load": f"WITH {RISK_ALL} SELECT * EXCLUDE (feature_timestamp, ultima_atualizacao) FROM rgold",
    "gold_between": f"WITH {LOCATION} SELECT * EXCLUDE (feature_timestamp, ultima_atualizacao) FROM lgold",
    "gold_incremental_risk": f"WITH {RISK_ALL} SELECT * EXCLUDE (feature_timestamp, ultima_atualizacao) FROM rgold",
    "gold_counts": f"""WITH {PROPONENTE}, {LOCATION_BODY}, {RISK_BODY}
      SELECT 'proponente_features' AS table_name, count(*) AS total_features FROM gold
      UNION ALL SELECT 'location_features', count(*) FROM lgold UNION ALL SELECT 'risk_features', count(*) FROM rgold""",
    "mode_by_key": f"""WITH {SILVER}, {mode('localizacao_uf', 'cultura_principal', 'm', 'silver')}
      SELECT localizacao_uf, v AS cultura_mais_comum FROM m WHERE localizacao_uf IS NOT NULL""",
    "composite_key": f"""WITH {APPLICATIONS} SELECT coalesce(uf, 'UNKNOWN') || '-' || coalesce(municipio, 'UNKNOWN') AS localizacao_key,
      count(*) AS n FROM app GROUP BY 1""",
    "table_stats": f"""WITH {SILVER} SELECT count(*) AS total_rows, count(DISTINCT proponente_id) AS unique_proponentes,
      min(data_solicitacao) AS min_date, max(data_solicitacao) AS max_date, count(DISTINCT localizacao_uf) AS unique_states FROM silver""",
    "dq_not_null": f"WITH {SILVER} {union(NOT_NULL_ROWS)}",
    "dq_unique": f"""WITH {SILVER} {union([
        duplicates_row('unique_combination_of_columns', 'proponente_id,localizacao_uf'),
        duplicates_row('unique_combination_of_columns', SILVER_KEY), duplicates_row('unique', 'proponente_id')])}""",
    "dq_accepted": f"""WITH {SILVER},
      long AS (SELECT 'tipo_pessoa' AS column_name, tipo_pessoa AS value FROM silver WHERE tipo_pessoa NOT IN ('FISICA','JURIDICA')
        UNION ALL SELECT 'finalidade_credito', v FROM (SELECT CASE WHEN anos_experiencia = 7 THEN 'REFORMA' ELSE finalidade_credito END AS v
          FROM silver) WHERE v NOT IN ('CUSTEIO_SAFRA','INVESTIMENTO_MAQUINARIO','AMPLIACAO_AREA','OUTROS')
        UNION ALL SELECT 'cultura_principal', v FROM (SELECT CASE WHEN anos_experiencia = 11 THEN 'CACAU' ELSE cultura_principal END AS v
          FROM silver) WHERE v NOT IN ('SOJA','MILHO','CAFE','CANA_DE_ACUCAR','ALGODAO','FRUTICULTURA','TRIGO','ARROZ','FEIJAO','EUCALIPTO')
        UNION ALL SELECT 'classificacao_propriedade', classificacao_propriedade FROM silver
          WHERE classificacao_propriedade NOT IN ('MINIFUNDIO','PEQUENA','MEDIA','GRANDE')
        UNION ALL SELECT 'faixa_risco_credito', v FROM (SELECT CASE WHEN anos_experiencia = 13 THEN 'SEM_FAIXA' ELSE faixa_risco_credito END AS v
          FROM silver) WHERE v NOT IN ('SEM_SCORE','MUITO_ALTO','ALTO','MEDIO','BAIXO')
        UNION ALL SELECT 'registro_valido', 'false' FROM silver WHERE NOT registro_valido)
      SELECT column_name, value, count(*) AS n FROM long GROUP BY ALL""",
    "dq_expression": f"WITH {SILVER} {union(EXPRESSION_ROWS)}",
    "dq_recency": f"WITH {SILVER} {recency_row('processed_at')} UNION ALL {recency_row('ingestion_timestamp')}",
    "dq_report": f"""WITH {SILVER}, results AS ({union([*NOT_NULL_ROWS, *ACCEPTED_ROWS, *EXPRESSION_ROWS, recency_row('processed_at'),
        RATIO_ROW, duplicates_row('unique_combination_of_columns', SILVER_KEY), GAP_ROW])})
      SELECT 'silver' AS table_name, *, {STATUS} FROM results""",
    "dq_failures": f"""WITH {SILVER}, results AS ({union([*NOT_NULL_ROWS, *ACCEPTED_ROWS, *EXPRESSION_ROWS, recency_row('processed_at'),
        RATIO_ROW, duplicates_row('unique_combination_of_columns', SILVER_KEY), GAP_ROW])})
      SELECT 'silver' AS table_name, check_name, column_name, severity, failures AS n FROM results WHERE failures > 0""",
    "dq_report_gold": f"""WITH {PROPONENTE}, {LOCATION_BODY}, {RISK_BODY},
      results AS ({union([gold_check_rows(name) for name in GOLD_CHECKS])}) SELECT *, {STATUS} FROM results""",
    "ratio_outliers": f"""WITH {SILVER} SELECT proponente_id, CAST(valor_solicitado_credito AS DOUBLE) AS valor_solicitado_credito,
      CAST(renda_bruta_anual_declarada AS DOUBLE) AS renda_bruta_anual_declarada, {RATIO} AS razao_credito_renda, processed_at
      FROM silver WHERE {RATIO} > 10 AND processed_at >= {AS_OF} - INTERVAL 24 HOURS""",
    "materialize_views": f"""WITH {EXPORTS} SELECT view, key, valor * every AS valor_total_solicitado, {AS_OF} - to_days(days) AS feature_timestamp
      FROM exports WHERE days <= ttl QUALIFY row_number() OVER (PARTITION BY view, key ORDER BY days) = 1""",
    "point_in_time_views": f"""WITH {EXPORTS}, facts AS (SELECT e.view, e.key, d.days FROM exports e, (SELECT unnest([45, 20, 9, 0]) AS days) d
        WHERE e.every = 1)
      SELECT f.view, f.key, e.valor * e.every AS valor_total_solicitado, {AS_OF} - to_days(e.days) AS feature_timestamp, f.days
      FROM facts f LEFT JOIN exports e ON e.view = f.view AND e.key = f.key AND e.days >= f.days AND e.days - f.days < e.ttl
      QUALIFY row_number() OVER (PARTITION BY f.view, f.key, f.days ORDER BY e.days) = 1""",
    "stream_repeats": f"""WITH {APPLICATIONS} SELECT count(*) + count(*) FILTER (anos = 5 AND ingestion_timestamp <= {MARK} - INTERVAL 40 DAYS) AS kept,
      count(*) AS applications, count(*) FILTER (anos = 5 AND ingestion_timestamp <= {MARK}) AS late FROM app""",
    "stream_gaps": """WITH steps AS (SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS before FROM events),
      numbered AS (SELECT *, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL 5 MINUTES THEN 1 ELSE 0 END)
        OVER (PARTITION BY event_type ORDER BY ts) AS spell FROM steps),
      spells AS (SELECT event_type, min(ts) AS first_at, max(ts) AS silent_since FROM numbered GROUP BY event_type, spell),
      told AS (SELECT * FROM spells WHERE epoch_ms(silent_since) + 300000 <= (SELECT epoch_ms(max(ts)) FROM events)),
      ended AS (SELECT *, lead(first_at) OVER (PARTITION BY event_type ORDER BY first_at) AS next_at FROM told)
      SELECT *, date_sub('minute', silent_since, next_at) AS minutes_diff, next_at IS NULL AS lasts FROM ended
      WHERE next_at IS NULL OR date_sub('minute', silent_since, next_at) > 5""",
    "distinct_sketches": f"""WITH {SILVER} SELECT localizacao_uf, count(*) AS n, count(DISTINCT proponente_id) AS proponente_id,
      count(DISTINCT localizacao_municipio) AS localizacao_municipio, TRUE AS proponente_id_within, TRUE AS localizacao_municipio_within,
      TRUE AS proponente_id_as_once, TRUE AS localizacao_municipio_as_once FROM silver
      WHERE year(data_solicitacao) = 1995 AND localizacao_uf IS NOT NULL GROUP BY localizacao_uf""",
    "score_pipeline": SCORE_PIPELINE,
    "stream_score_pipeline": SCORE_PIPELINE,
    "ingest_gaps": """WITH steps AS (SELECT ts AS ingestion_timestamp, lag(ts) OVER (ORDER BY ts) AS prev_timestamp FROM events)
      SELECT *, date_sub('minute', prev_timestamp, ingestion_timestamp) AS minutes_diff FROM steps
      WHERE date_sub('minute', prev_timestamp, ingestion_timestamp) > 5""",
    "spark_features": f"""WITH {APPLICATIONS} SELECT proponente_id,
      CAST(CASE WHEN {HAS_POSITION} THEN round({D(0.1)} + {uniform('ndvi', 'proponente_id', 'req_ms')} * {D(0.8)}, 4) ELSE 0.5 END AS FLOAT) AS avg_ndvi_90d,
      CAST(CASE WHEN {HAS_POSITION} THEN round(abs(latitude - {D(-23.9875)}) * 100 + abs(longitude - {D(-46.3039)}) * 100, 2)
        ELSE 500 END AS FLOAT) AS distancia_porto_km,
      score AS score_credito_externo,
      CAST(floor({uniform('idade', 'proponente_id', 'req_ms')} * 180 + 30) AS INTEGER) AS idade_cultura_predominante_dias,
      CAST(area AS FLOAT) AS area_total_propriedade_ha,
      CAST({uniform('divida', 'proponente_id', 'req_ms')} * {D(0.8)} + {D(0.1)} AS FLOAT) AS percentual_endividamento_total,
      data_solicitacao AS data_snapshot, {AS_OF} AS data_carga_gold, CAST(year(data_solicitacao) AS INTEGER) AS year,
      CAST(month(data_solicitacao) AS INTEGER) AS month, CAST(day(data_solicitacao) AS INTEGER) AS day FROM app""",
    "credit_score_udf": """WITH counted AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS payments,
        count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS queries FROM orders GROUP BY o_custkey)
      SELECT c_custkey, CAST(trunc(greatest(300, least(850, CAST(600 AS DOUBLE) + CASE WHEN c_acctbal > 0 THEN c_acctbal * 200 / 10000 ELSE 0 END
        - coalesce(payments, 0) * 20 - coalesce(queries, 0) * 10))) AS INTEGER) AS credit_score
      FROM customer LEFT JOIN counted ON c_custkey = o_custkey""",
    "feature_export": f"WITH {PROPONENTE} SELECT * EXCLUDE (feature_timestamp), ultima_atualizacao AS feature_timestamp FROM gold",
    "materialize_latest": """SELECT user_id, event_id, event_type, value, ts FROM events
      WHERE ts BETWEEN TIMESTAMP '2024-01-30' AND TIMESTAMP '2024-01-31'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "asof_features": """WITH v AS (SELECT user_id, ts AS view_ts, event_id AS view_id, value AS view_value FROM events WHERE event_type = 'view'),
      j AS (SELECT p.event_id, p.user_id, p.ts AS purchase_ts, v.view_ts, v.view_id, v.view_value,
        coalesce(p.ts - v.view_ts < INTERVAL 2 DAYS, FALSE) AS fresh
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts)
      SELECT event_id, user_id, purchase_ts, CASE WHEN fresh THEN view_ts END AS view_ts, CASE WHEN fresh THEN view_id END AS view_id,
        CASE WHEN fresh THEN view_value END AS view_value FROM j""",
    "assemble_features": f"""WITH {PROPONENTE}, {LOCATION_BODY}, {RISK_BODY}
      SELECT s.proponente_id, s.data_solicitacao, CAST(s.valor_solicitado_credito AS DOUBLE) AS valor_solicitado_credito,
      ({' OR '.join(FOUND.values())}) AS features_found, {', '.join(assembled(n) for n in ASSEMBLED_NAMES)}
      FROM silver s LEFT JOIN gold p ON s.proponente_id = p.proponente_id
      LEFT JOIN lgold l ON coalesce(s.localizacao_uf, 'UNKNOWN') || '-' || coalesce(s.localizacao_municipio, 'UNKNOWN') = l.localizacao_key
      LEFT JOIN rgold r ON s.faixa_risco_credito || '-' || coalesce(s.cultura_principal, 'UNKNOWN') = r.risco_cultura_key""",
    "score_rules": f"""WITH {SCORED} SELECT proponente_id, data_solicitacao, CAST(valor AS DOUBLE) AS valor_solicitado_credito, s AS score,
      CASE WHEN s > {D(0.7)} THEN 'LOW' WHEN s > {D(0.4)} THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
      least(CAST(valor AS DOUBLE), CAST(renda AS DOUBLE) * {D(0.3)}) * ({D(0.5)} + s * {D(0.5)}) AS credit_limit,
      CASE WHEN s > {D(0.6)} THEN 'APPROVE' WHEN s > {D(0.3)} THEN 'MANUAL_REVIEW' ELSE 'DENY' END AS recommendation,
      s >= {D(0.6)} AS approved_in_ui FROM scored""",
    "request_features": f"""WITH {APPLICATIONS} SELECT proponente_id, data_solicitacao, CAST(renda AS DOUBLE) AS renda_bruta_anual_declarada,
      CAST(valor AS DOUBLE) AS valor_solicitado_credito, CAST(area AS DOUBLE) AS area_total_hectares, anos AS anos_experiencia,
      CAST(possui_experiencia_atividade AS INTEGER) AS possui_experiencia_atividade,
      CAST(tipo_pessoa = 'FISICA' AS INTEGER) AS tipo_pessoa_fisica, coalesce(nullif(score, 0), 500) AS serasa_score,
      CAST(coalesce(multa, FALSE) AS INTEGER) AS ibama_autuacoes_ativas, CAST(cultura_principal = 'SOJA' AS INTEGER) AS cultura_principal_soja,
      CAST(cultura_principal = 'MILHO' AS INTEGER) AS cultura_principal_milho,
      CAST(finalidade_credito = 'CUSTEIO_SAFRA' AS INTEGER) AS finalidade_custeio,
      CAST(finalidade_credito = 'INVESTIMENTO_MAQUINARIO' AS INTEGER) AS finalidade_investimento FROM app""",
    "feature_vector": f"""WITH {PROPONENTE} SELECT proponente_id, {', '.join(f'coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}' for c in FEATURES)}
      FROM gold""",
    "request_validation": f"""WITH {APPLICATIONS}, checked AS (SELECT *, CASE
        WHEN length(regexp_replace(coalesce(cpf_cnpj, ''), '[^0-9]', '', 'g')) NOT IN (11, 14) THEN 'invalid_cpf_cnpj' END AS reason FROM app)
      SELECT proponente_id, data_solicitacao, CAST(valor AS DOUBLE) AS valor_solicitado_credito, cpf_cnpj, reason, reason IS NULL AS is_valid
      FROM checked""",
    "ml_features": f"WITH {PROPONENTE} SELECT proponente_id, {FEATURE_LIST} FROM gold",
    "ml_impute": f"WITH {IMPUTED} SELECT * FROM imputed",
    "ml_target": f"""WITH {TARGET} SELECT proponente_id, default_probability,
      CAST({uniform('target-42', 'proponente_id')} < default_probability AS INTEGER) AS target_default FROM chance""",
    "ml_split": f"""WITH {SPLIT} SELECT t AS target_default, part, count(*) AS n, round(sum(valor_total_solicitado), 2) AS valor FROM parted GROUP BY ALL""",
    "ml_scaling": f"""WITH {SPLIT} {union([f"SELECT '{c}' AS feature, round(avg(coalesce(CAST({c} AS DOUBLE), 0)), 4) AS mean, "
        f"round(stddev_samp(coalesce(CAST({c} AS DOUBLE), 0)), 4) AS spread FROM parted WHERE part = 'train'" for c in FEATURES])}""",
    "ml_default_rate": f"""WITH {TARGET}, drawn AS (SELECT default_probability,
      CAST({uniform('target-42', 'proponente_id')} < default_probability AS INTEGER) AS t FROM chance)
      SELECT count(*) AS n, CAST(sum(t) AS BIGINT) AS defaults, round(avg(t), 6) AS default_rate, round(avg(default_probability), 6) AS mean_chance
      FROM drawn""",
    "classification_metrics": f"""WITH pred AS (SELECT quality, 1 - toxic AS predicted FROM labels), {metrics('m', 'pred')} SELECT * FROM m""",
    "ks_drift": f"""WITH {DRIFT} SELECT feature, n_current, n_baseline, round(d, 9) AS ks_statistic, round(crit, 9) AS critical_value,
      round(p, 9) AS p_value, (n_current > 30 AND n_baseline > 30 AND p < 0.05) AS drift_detected FROM tested""",
    "model_gate": f"""WITH {DRIFT}, old_pred AS (SELECT quality, 1 - toxic AS predicted FROM labels),
      new_pred AS (SELECT quality, CASE WHEN n_chars >= 400 THEN 1 ELSE 0 END AS predicted FROM labels JOIN documents USING (doc_id)),
      {metrics('o', 'old_pred')}, {metrics('w', 'new_pred')},
      dr AS (SELECT bool_or(n_current > 30 AND n_baseline > 30 AND p < 0.05) AS drift_detected FROM tested),
      g AS (SELECT w.accuracy, w.f1, o.accuracy AS previous_accuracy, o.f1 AS previous_f1, drift_detected,
        (w.accuracy < o.accuracy - 0.05 OR w.f1 < o.f1 - 0.05) AS performance_degraded FROM w, o, dr)
      SELECT *, drift_detected OR performance_degraded AS deploy FROM g""",
    "small_partitions": f"""WITH {APPLICATIONS} SELECT strftime(ingestion_timestamp, '%Y-%m') AS mes_ingestao, tipo_pessoa,
      count(*) AS record_count FROM app GROUP BY ALL HAVING count(*) < 1000""",
}
