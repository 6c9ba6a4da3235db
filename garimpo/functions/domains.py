"""Coded domains as reference tables, and the joins that decode record columns.

Each domain is one text block of ``code NAME | description`` lines. A domain without
descriptions derives them from the name. Flags are SQL expressions over ``code`` and ``name``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The published code lists.
# ---------------------------------------------------------------------------

MODALIDADE = """
1 LEILAO_ELETRONICO
2 DIALOGO_COMPETITIVO
3 CONCURSO
4 CONCORRENCIA_ELETRONICA
5 CONCORRENCIA_PRESENCIAL
6 PREGAO_ELETRONICO
7 PREGAO_PRESENCIAL
8 DISPENSA_LICITACAO
9 INEXIGIBILIDADE
10 MANIFESTACAO_INTERESSE
11 PRE_QUALIFICACAO
12 CREDENCIAMENTO
13 LEILAO_PRESENCIAL
"""

MODO_DISPUTA = """
1 ABERTO | Aberto - Lances em tempo real
2 FECHADO | Fechado - Propostas sigilosas
3 ABERTO_FECHADO | Aberto-Fechado - Combinação sequencial
4 DISPENSA_COM_DISPUTA | Dispensa com Disputa - Cotação eletrônica
5 NAO_SE_APLICA | Não se aplica
6 FECHADO_ABERTO | Fechado-Aberto - Inverso da opção 3
"""

CRITERIO_JULGAMENTO = """
1 MENOR_PRECO | Menor Preço
2 MAIOR_DESCONTO | Maior Desconto
4 TECNICA_E_PRECO | Técnica e Preço
5 MAIOR_LANCE | Maior Lance
6 MAIOR_RETORNO_ECONOMICO | Maior Retorno Econômico
7 NAO_SE_APLICA | Não se aplica
8 MELHOR_TECNICA | Melhor Técnica
9 CONTEUDO_ARTISTICO | Conteúdo Artístico
"""

INSTRUMENTO_CONVOCATORIO = """
1 EDITAL | Edital - Diálogo competitivo, concurso, concorrência, pregão, etc.
2 AVISO_CONTRATACAO_DIRETA | Aviso de Contratação Direta - Dispensa com Disputa
3 ATO_AUTORIZACAO | Ato que autoriza a Contratação Direta - Dispensa/Inexigibilidade
"""

SITUACAO_CONTRATACAO = """
1 DIVULGADA_PNCP | Divulgada no PNCP - Situação inicial da contratação
2 REVOGADA | Revogada - Contratação revogada conforme justificativa
3 ANULADA | Anulada - Contratação anulada conforme justificativa
4 SUSPENSA | Suspensa - Contratação suspensa conforme justificativa
"""

SITUACAO_ITEM = """
1 EM_ANDAMENTO | Em Andamento - Disputa/seleção não finalizada
2 HOMOLOGADO | Homologado - Resultado definido com fornecedor
3 ANULADO_REVOGADO_CANCELADO | Anulado/Revogado/Cancelado - Item cancelado
4 DESERTO | Deserto - Sem fornecedores interessados
5 FRACASSADO | Fracassado - Fornecedores desclassificados/inabilitados
"""

SITUACAO_RESULTADO_ITEM = """
1 INFORMADO | Informado - Possui valor e fornecedor definidos
2 CANCELADO | Cancelado - Resultado cancelado conforme justificativa
"""

CATEGORIA_ITEM_PLANO = """
1 MATERIAL | Material
2 SERVICO | Serviço
3 OBRAS | Obras
4 SERVICOS_ENGENHARIA | Serviços de Engenharia
5 SOLUCOES_TIC | Soluções de TIC
6 LOCACAO_IMOVEIS | Locação de Imóveis
7 ALIENACAO_CONCESSAO_PERMISSAO | Alienação/Concessão/Permissão
8 OBRAS_SERVICOS_ENGENHARIA | Obras e Serviços de Engenharia
"""

CATEGORIA_PROCESSO = """
1 CESSAO | Cessão
2 COMPRAS | Compras
3 INFORMATICA_TIC | Informática (TIC)
4 INTERNACIONAL | Internacional
5 LOCACAO_IMOVEIS | Locação de Imóveis
6 MAO_DE_OBRA | Mão de Obra
7 OBRAS | Obras
8 SERVICOS | Serviços
9 SERVICOS_ENGENHARIA | Serviços de Engenharia
10 SERVICOS_SAUDE | Serviços de Saúde
11 ALIENACAO_BENS | Alienação de bens móveis/imóveis
"""

TIPO_BENEFICIO = """
1 PARTICIPACAO_EXCLUSIVA | Participação exclusiva para ME/EPP
2 SUBCONTRATACAO | Subcontratação para ME/EPP
3 COTA_RESERVADA | Cota reservada para ME/EPP
4 SEM_BENEFICIO | Sem benefício
5 NAO_SE_APLICA | Não se aplica
"""

PORTE_EMPRESA = """
1 ME | ME - Microempresa
2 EPP | EPP - Empresa de Pequeno Porte
3 DEMAIS | Demais - Demais empresas
4 NAO_SE_APLICA | Não se aplica - Pessoa física
5 NAO_INFORMADO | Não informado
"""

TIPO_CONTRATO = """
1 CONTRATO | Contrato - Acordo formal entre as partes
2 COMODATO | Comodato - Concessão de uso gratuito
3 ARRENDAMENTO | Arrendamento - Cessão mediante pagamento
4 CONCESSAO | Concessão - Execução de serviço público remunerada por tarifa
5 TERMO_ADESAO | Termo de Adesão - Cláusulas pré-definidas
6 CONVENIO | Convênio - Realização de objetivo em comum
7 EMPENHO | Empenho - Promessa de pagamento
8 OUTROS | Outros - Outros tipos não listados
9 TED | TED - Termo de Execução Descentralizada
10 ACT | ACT - Acordo de Cooperação Técnica
11 TERMO_COMPROMISSO | Termo de Compromisso - Acordo para cumprir compromisso
12 CARTA_CONTRATO | Carta Contrato - Formalização simplificada
"""

TIPO_TERMO_CONTRATO = """
1 TERMO_RESCISAO | Termo de Rescisão - Encerramento antes da data final
2 TERMO_ADITIVO | Termo Aditivo - Prorrogação, reajuste, acréscimo ou supressão
3 TERMO_APOSTILAMENTO | Termo de Apostilamento - Atualização de valor
"""

TIPO_DOCUMENTO = """
1 AVISO_CONTRATACAO_DIRETA | Aviso de Contratação Direta
2 EDITAL | Edital
3 MINUTA_CONTRATO | Minuta do Contrato
4 TERMO_REFERENCIA | Termo de Referência
5 ANTEPROJETO | Anteprojeto
6 PROJETO_BASICO | Projeto Básico
7 ESTUDO_TECNICO_PRELIMINAR | Estudo Técnico Preliminar
8 PROJETO_EXECUTIVO | Projeto Executivo
9 MAPA_RISCOS | Mapa de Riscos
10 DFD | DFD
11 ATA_REGISTRO_PRECO | Ata de Registro de Preço
12 CONTRATO | Contrato
13 TERMO_RESCISAO | Termo de Rescisão
14 TERMO_ADITIVO | Termo Aditivo
15 TERMO_APOSTILAMENTO | Termo de Apostilamento
17 NOTA_EMPENHO | Nota de Empenho
18 RELATORIO_FINAL_CONTRATO | Relatório Final de Contrato
"""

NATUREZA_JURIDICA = """
0 NAO_INFORMADA
1015 EXECUTIVO_FEDERAL
1023 EXECUTIVO_ESTADUAL_DF
1031 EXECUTIVO_MUNICIPAL
1040 LEGISLATIVO_FEDERAL
1058 LEGISLATIVO_ESTADUAL_DF
1066 LEGISLATIVO_MUNICIPAL
1074 JUDICIARIO_FEDERAL
1082 JUDICIARIO_ESTADUAL
1104 AUTARQUIA_FEDERAL
1112 AUTARQUIA_ESTADUAL_DF
1120 AUTARQUIA_MUNICIPAL
1139 FUNDACAO_PUBLICA_DIREITO_PUBLICO_FEDERAL
1147 FUNDACAO_PUBLICA_DIREITO_PUBLICO_ESTADUAL_DF
1155 FUNDACAO_PUBLICA_DIREITO_PUBLICO_MUNICIPAL
1163 ORGAO_AUTONOMO_FEDERAL
1171 ORGAO_AUTONOMO_ESTADUAL_DF
1180 ORGAO_AUTONOMO_MUNICIPAL
1198 COMISSAO_POLINACIONAL
1210 CONSORCIO_PUBLICO_DIREITO_PUBLICO
1228 CONSORCIO_PUBLICO_DIREITO_PRIVADO
1236 ESTADO_DF
1244 MUNICIPIO
1252 FUNDACAO_PUBLICA_DIREITO_PRIVADO_FEDERAL
1260 FUNDACAO_PUBLICA_DIREITO_PRIVADO_ESTADUAL_DF
1279 FUNDACAO_PUBLICA_DIREITO_PRIVADO_MUNICIPAL
1287 FUNDO_PUBLICO_INDIRETA_FEDERAL
1295 FUNDO_PUBLICO_INDIRETA_ESTADUAL_DF
1309 FUNDO_PUBLICO_INDIRETA_MUNICIPAL
1317 FUNDO_PUBLICO_DIRETA_FEDERAL
1325 FUNDO_PUBLICO_DIRETA_ESTADUAL_DF
1333 FUNDO_PUBLICO_DIRETA_MUNICIPAL
1341 UNIAO
2011 EMPRESA_PUBLICA
2038 SOCIEDADE_ECONOMIA_MISTA
2046 SOCIEDADE_ANONIMA_ABERTA
2054 SOCIEDADE_ANONIMA_FECHADA
2062 SOCIEDADE_EMPRESARIA_LIMITADA
2070 SOCIEDADE_EMPRESARIA_NOME_COLETIVO
2089 SOCIEDADE_EMPRESARIA_COMANDITA_SIMPLES
2097 SOCIEDADE_EMPRESARIA_COMANDITA_ACOES
2100 SOCIEDADE_MERCANTIL_CAPITAL_INDUSTRIA
2127 SOCIEDADE_CONTA_PARTICIPACAO
2135 EMPRESARIO_INDIVIDUAL
2143 COOPERATIVA
2151 CONSORCIO_SOCIEDADES
2160 GRUPO_SOCIEDADES
2178 ESTABELECIMENTO_SOCIEDADE_ESTRANGEIRA
2194 ESTABELECIMENTO_EMPRESA_BINACIONAL_ARG_BR
2216 EMPRESA_DOMICILIADA_EXTERIOR
2224 CLUBE_FUNDO_INVESTIMENTO
2232 SOCIEDADE_SIMPLES_PURA
2240 SOCIEDADE_SIMPLES_LIMITADA
2259 SOCIEDADE_SIMPLES_NOME_COLETIVO
2267 SOCIEDADE_SIMPLES_COMANDITA_SIMPLES
2275 EMPRESA_BINACIONAL
2283 CONSORCIO_EMPREGADORES
2291 CONSORCIO_SIMPLES
2305 EIRELI_EMPRESARIA
2313 EIRELI_SIMPLES
2321 SOCIEDADE_UNIPESSOAL_ADVOCACIA
2330 COOPERATIVA_CONSUMO
2348 INOVA_SIMPLES
2356 INVESTIDOR_NAO_RESIDENTE
3034 CARTORIO
3069 FUNDACAO_PRIVADA
3077 SERVICO_SOCIAL_AUTONOMO
3085 CONDOMINIO_EDILICIO
3107 COMISSAO_CONCILIACAO_PREVIA
3115 ENTIDADE_MEDIACAO_ARBITRAGEM
3131 ENTIDADE_SINDICAL
3204 ESTABELECIMENTO_FUNDACAO_ASSOCIACAO_ESTRANGEIRA
3212 FUNDACAO_ASSOCIACAO_DOMICILIADA_EXTERIOR
3220 ORGANIZACAO_RELIGIOSA
3239 COMUNIDADE_INDIGENA
3247 FUNDO_PRIVADO
3255 PARTIDO_POLITICO_NACIONAL
3263 PARTIDO_POLITICO_REGIONAL
3271 PARTIDO_POLITICO_LOCAL
3280 COMITE_FINANCEIRO_PARTIDO
3298 FRENTE_PLEBISCITARIA_REFERENDARIA
3301 ORGANIZACAO_SOCIAL
3328 PLANO_PREVIDENCIA_COMPLEMENTAR
3999 ASSOCIACAO_PRIVADA
4014 EMPRESA_INDIVIDUAL_IMOBILIARIA
4090 CANDIDATO_POLITICO
4120 PRODUTOR_RURAL
5010 ORGANIZACAO_INTERNACIONAL
5029 REPRESENTACAO_DIPLOMATICA_ESTRANGEIRA
5037 INSTITUICOES_EXTRATERRITORIAIS
8885 NAO_INFORMADA_ALT
"""

AMPARO_LEGAL = """
1 LEI_14133_ART_28_I
2 LEI_14133_ART_28_II
3 LEI_14133_ART_28_III
4 LEI_14133_ART_28_IV
5 LEI_14133_ART_28_V
6 LEI_14133_ART_74_I
7 LEI_14133_ART_74_II
8 LEI_14133_ART_74_III_A
9 LEI_14133_ART_74_III_B
10 LEI_14133_ART_74_III_C
11 LEI_14133_ART_74_III_D
12 LEI_14133_ART_74_III_E
13 LEI_14133_ART_74_III_F
14 LEI_14133_ART_74_III_G
15 LEI_14133_ART_74_III_H
16 LEI_14133_ART_74_IV
17 LEI_14133_ART_74_V
18 LEI_14133_ART_75_I
19 LEI_14133_ART_75_II
20 LEI_14133_ART_75_III_A
21 LEI_14133_ART_75_III_B
22 LEI_14133_ART_75_IV_A
23 LEI_14133_ART_75_IV_B
24 LEI_14133_ART_75_IV_C
25 LEI_14133_ART_75_IV_D
26 LEI_14133_ART_75_IV_E
27 LEI_14133_ART_75_IV_F
28 LEI_14133_ART_75_IV_G
29 LEI_14133_ART_75_IV_H
30 LEI_14133_ART_75_IV_I
31 LEI_14133_ART_75_IV_J
32 LEI_14133_ART_75_IV_K
33 LEI_14133_ART_75_IV_L
34 LEI_14133_ART_75_IV_M
35 LEI_14133_ART_75_V
36 LEI_14133_ART_75_VI
37 LEI_14133_ART_75_VII
38 LEI_14133_ART_75_VIII
39 LEI_14133_ART_75_IX
40 LEI_14133_ART_75_X
41 LEI_14133_ART_75_XI
42 LEI_14133_ART_75_XII
43 LEI_14133_ART_75_XIII
44 LEI_14133_ART_75_XIV
45 LEI_14133_ART_75_XV
46 LEI_14133_ART_75_XVI
47 LEI_14133_ART_78_I
48 LEI_14133_ART_78_II
49 LEI_14133_ART_78_III
50 LEI_14133_ART_74_CAPUT
51 LEI_14284_ART_29_CAPUT
52 LEI_14284_ART_24_PARAGRAFO_1
53 LEI_14284_ART_25_PARAGRAFO_1
54 LEI_14284_ART_34
55 LEI_9636_ART_11C_I
56 LEI_9636_ART_11C_II
57 LEI_9636_ART_24C_I
58 LEI_9636_ART_24C_II
59 LEI_9636_ART_24C_III
60 LEI_14133_ART_75_XVII
61 LEI_14133_ART_76_I_A
62 LEI_14133_ART_76_I_B
63 LEI_14133_ART_76_I_C
64 LEI_14133_ART_76_I_D
65 LEI_14133_ART_76_I_E
66 LEI_14133_ART_76_I_F
67 LEI_14133_ART_76_I_G
68 LEI_14133_ART_76_I_H
69 LEI_14133_ART_76_I_I
70 LEI_14133_ART_76_I_J
71 LEI_14133_ART_76_II_A
72 LEI_14133_ART_76_II_B
73 LEI_14133_ART_76_II_C
74 LEI_14133_ART_76_II_D
75 LEI_14133_ART_76_II_E
76 LEI_14133_ART_76_II_F
77 LEI_14133_ART_75_XVIII
78 LEI_14628_ART_4
79 LEI_14628_ART_12
80 LEI_14133_ART_1_PARAGRAFO_2
"""

# Category subsets. The two "common" lists differ in the source material; both are kept.
COMMON_BY_VOLUME = (6, 8, 9)
COMMON_FOR_DEVELOPMENT = (6, 4, 8)
ELECTRONIC = (1, 4, 6)
ENVIRONMENT_SUBSETS = {"development": COMMON_FOR_DEVELOPMENT, "staging": ELECTRONIC}

# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Domain:
    """A code list and its flags, SQL expressions over ``code`` and ``name``."""

    listing: str
    flags: dict[str, str] = field(default_factory=dict)
    title_case: bool = True


DOMAINS = {
    "modalidade": Domain(MODALIDADE, {
        "is_electronic": "code IN (1, 4, 6)",
        "is_presencial": "code IN (5, 7, 13)",
        "permite_disputa": "code NOT IN (8, 9)",
        "is_common": "code IN (6, 8, 9)",
    }),
    "modo_disputa": Domain(MODO_DISPUTA, {"permite_lances": "code IN (1, 3, 6)"}),
    "criterio_julgamento": Domain(CRITERIO_JULGAMENTO, {
        "is_price_based": "code IN (1, 2, 4, 6)",
        "requires_technical_evaluation": "code IN (4, 8, 9)",
    }),
    "instrumento_convocatorio": Domain(INSTRUMENTO_CONVOCATORIO),
    "situacao_contratacao": Domain(SITUACAO_CONTRATACAO, {
        "is_active": "code IN (1, 4)",
        "is_cancelled": "code IN (2, 3)",
    }),
    "situacao_item": Domain(SITUACAO_ITEM, {
        "has_winner": "code = 2",
        "is_unsuccessful": "code IN (3, 4, 5)",
    }),
    "situacao_resultado_item": Domain(SITUACAO_RESULTADO_ITEM, {"is_valid": "code = 1"}),
    "categoria_item_plano": Domain(CATEGORIA_ITEM_PLANO, {
        "is_goods": "code = 1",
        "is_services": "code IN (2, 4)",
        "is_construction": "code IN (3, 8)",
        "is_it_solution": "code = 5",
        "is_real_estate": "code IN (6, 7)",
    }),
    "categoria_processo": Domain(CATEGORIA_PROCESSO, {
        "is_goods": "code IN (2, 3)",
        "is_services": "code IN (6, 8, 9, 10)",
        "is_construction": "code = 7",
    }),
    "tipo_beneficio": Domain(TIPO_BENEFICIO, {
        "has_mepp_benefit": "code IN (1, 2, 3)",
        "is_exclusive_mepp": "code = 1",
    }),
    "porte_empresa": Domain(PORTE_EMPRESA, {
        "is_small_business": "code IN (1, 2)",
        "is_large_company": "code = 3",
        "is_individual": "code = 4",
    }),
    "tipo_contrato": Domain(TIPO_CONTRATO, {
        "is_formal_contract": "code IN (1, 2, 3, 4, 5, 12)",
        "is_agreement": "code IN (6, 9, 10, 11)",
    }),
    "tipo_termo_contrato": Domain(TIPO_TERMO_CONTRATO, {
        "is_termination": "code = 1",
        "is_amendment": "code IN (2, 3)",
    }),
    "tipo_documento": Domain(TIPO_DOCUMENTO, {
        "is_procurement_doc": "code IN (1, 2)",
        "is_technical_doc": "code BETWEEN 4 AND 10",
        "is_contract_doc": "code IN (12, 13, 14, 15, 17, 18)",
        "is_amendment_doc": "code IN (13, 14, 15)",
    }),
    "natureza_juridica": Domain(NATUREZA_JURIDICA, {
        "is_public_entity": "code BETWEEN 1015 AND 1341",
        "is_private_entity": "code BETWEEN 2011 AND 5037",
        "is_federal": "name RLIKE 'FEDERAL|UNIAO'",
        "is_state": "contains(name, 'ESTADUAL_DF') OR code = 1236",
        "is_municipal": "contains(name, 'MUNICIPAL') OR code = 1244",
        "is_company": "name RLIKE 'EMPRESA|SOCIEDADE|EMPRESARIO'",
    }),
    "amparo_legal": Domain(AMPARO_LEGAL, {
        "is_dispensavel": "name RLIKE 'ART_74|ART_75|ART_78'",
        "is_inexigivel": "contains(name, 'ART_76')",
        "is_licitacao_obrigatoria": "contains(name, 'ART_28')",
        "is_emergency": "contains(name, 'ART_78')",
        # LEI_14133_ART_28_I reads "LEI 14133, Art. 28, I".
        "artigo": "concat(replace(split_part(name, '_ART_', 1), '_', ' '), ', Art. ', "
                  "replace(split_part(name, '_ART_', 2), '_', ', '))",
    }, title_case=False),
}


def domain_table(spark: SparkSession, name: str) -> DataFrame:
    """``code, name, descricao`` and the domain's flags; at most 91 rows."""
    domain = DOMAINS[name]
    table = literal_table(spark, _rows(name), "code", "name", "descricao")
    spaced = "initcap(lower(replace(name, '_', ' ')))" if domain.title_case else "replace(name, '_', ' ')"
    flags = [f"{rule} AS {flag}" for flag, rule in domain.flags.items()]
    return table.selectExpr("code", "name", f"coalesce(descricao, {spaced}) AS descricao", *flags)


def attach_domain(df: DataFrame, code: str, name: str, prefix: str | None = None) -> DataFrame:
    """Left-join a domain on a code column; unknown codes leave nulls.

    Codes compare as doubles, so 6.0 finds 6 and 6.5 finds nothing. The domain side is a
    fixed list of at most 91 rows, which is why it may be broadcast unconditionally.
    """
    prefix = prefix or name
    table = domain_table(df.sparkSession, name)
    table = table.select(
        F.col("code").cast("double").alias(f"__{prefix}"),
        *(F.col(c).alias(f"{prefix}_{c}") for c in table.columns if c != "code"),
    )
    joined = df.join(
        F.broadcast(table), F.col(code).try_cast("double") == F.col(f"__{prefix}"), "left"
    )
    return joined.drop(f"__{prefix}")


def is_known_code(df: DataFrame, code: str, name: str, flag: str) -> DataFrame:
    """Add a boolean telling whether the code belongs to the domain."""
    found = attach_domain(df, code, name, "__known")
    extra = [c for c in found.columns if c.startswith("__known_")]
    return found.withColumn(flag, F.col("__known_name").isNotNull()).drop(*extra)


def _rows(name: str) -> list[tuple[int, str, str | None]]:
    rows = []
    for line in DOMAINS[name].listing.strip().splitlines():
        head, _, description = line.partition(" | ")
        code, member = head.split(" ")
        rows.append((int(code), member, description or None))
    return rows


def literal_table(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """Fixed rows as an inline table, so the optimizer knows its exact size."""
    def literal(value) -> str:
        if value is None:
            return "CAST(NULL AS STRING)"
        return str(value) if isinstance(value, int) else "'" + value.replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def _lookup(name: str, value: str) -> Column:
    """A literal map from code to name or description, for decoding inside arrays."""
    place = {"name": 1, "descricao": 2}[value]
    return F.create_map(*(F.lit(x) for row in _rows(name) for x in (float(row[0]), row[place])))


def _find(lookup: Column, code: Column) -> Column:
    return F.try_element_at(lookup, code.try_cast("double"))


# Source columns of the parsed code struct of a record, of an item, of a document.
RECORD_CODES = {
    "modalidade": ("modalidadeId", "modalidade"),
    "modoDisputa": ("modoDisputaId", "modo_disputa"),
    "criterioJulgamento": ("criterioJulgamentoId", "criterio_julgamento"),
    "instrumentoConvocatorio": ("instrumentoConvocatorioId", "instrumento_convocatorio"),
}


def parse_record_codes(df: DataFrame, into: str = "parsed_domains") -> DataFrame:
    """Decode the code columns a frame has into one struct of domain names."""
    present = {k: v for k, v in RECORD_CODES.items() if v[0] in df.columns}
    if not present:
        return df
    fields = [
        _find(_lookup(domain, "name"), F.col(source)).alias(target)
        for target, (source, domain) in present.items()
    ]
    return df.withColumn(into, F.struct(*fields))


def parse_item_codes(df: DataFrame, items: str = "itens") -> DataFrame:
    """Decode category, status, criterion and goods/service inside an array of items.

    The array is mapped in place: no explode, no shuffle, order kept.
    """
    names = df.schema[items].dataType.elementType.names
    rules = {
        "itemCategoriaId": {
            "categoria": _lookup("categoria_item_plano", "name"),
            "categoria_descricao": _lookup("categoria_item_plano", "descricao"),
        },
        "situacaoCompraItem": {
            "situacao": _lookup("situacao_item", "name"),
            "situacao_descricao": _lookup("situacao_item", "descricao"),
        },
        "criterioJulgamentoId": {"criterio_julgamento": _lookup("criterio_julgamento", "name")},
    }

    def decode(item: Column) -> Column:
        fields = [
            _find(lookup, item[source]).alias(target)
            for source, targets in rules.items() if source in names
            for target, lookup in targets.items()
        ]
        if "situacaoCompraItem" in names:
            status = item["situacaoCompraItem"].try_cast("double")
            known = _find(_lookup("situacao_item", "name"), status).isNotNull()
            fields.append(F.when(known, status == 2).alias("situacao_has_winner"))
        if "materialOuServico" in names:
            kind = F.when(item["materialOuServico"] == "M", "Material").otherwise("Serviço")
            fields.append(kind.alias("tipo_material_servico"))
        return item.withField("parsed_domains", F.struct(*fields)) if fields else item

    return df.withColumn(items, F.transform(items, decode))


def parse_document_codes(df: DataFrame, documents: str = "arquivos") -> DataFrame:
    """Decode document type and carry the active flag inside an array of documents."""
    names = df.schema[documents].dataType.elementType.names
    kind = _lookup("tipo_documento", "name")
    text = _lookup("tipo_documento", "descricao")

    def decode(doc: Column) -> Column:
        fields = []
        if "tipoDocumentoId" in names:
            fields.append(_find(kind, doc["tipoDocumentoId"]).alias("tipo_documento"))
            fields.append(_find(text, doc["tipoDocumentoId"]).alias("tipo_documento_descricao"))
        if "statusAtivo" in names:
            fields.append(doc["statusAtivo"].alias("arquivo_ativo"))
        return doc.withField("parsed_domains", F.struct(*fields)) if fields else doc

    return df.withColumn(documents, F.transform(documents, decode))


def modalidade_subset(env: str) -> tuple[int, ...] | None:
    """Category codes pulled in an environment; None means all of them."""
    return ENVIRONMENT_SUBSETS.get(env)


def keep_modalidades(df: DataFrame, code: str, codes: tuple[int, ...] | None) -> DataFrame:
    return df if codes is None else df.where(F.col(code).isin(*codes))


def count_by_modalidade(df: DataFrame, code: str) -> DataFrame:
    """Rows per category, with zero for categories that brought nothing."""
    listed = domain_table(df.sparkSession, "modalidade").select("code", "name", "descricao")
    counts = df.groupBy(F.col(code).try_cast("double").alias("__code")).agg(F.count("*").alias("n"))
    joined = listed.join(counts, F.col("code").cast("double") == F.col("__code"), "left")
    return joined.select("code", "name", "descricao", F.coalesce("n", F.lit(0)).alias("records"))
