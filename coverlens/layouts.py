"""Fixed layouts: raw file columns, cleaned schemas, the state table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

UNKNOWN_STATE = "XX"
UNKNOWN_KEY = -1
NOT_INFORMED = "Não informado"

# The states with name and region, and the member for "unknown".
STATES = (
    ("AC", "Acre", "Norte"),
    ("AL", "Alagoas", "Nordeste"),
    ("AP", "Amapá", "Norte"),
    ("AM", "Amazonas", "Norte"),
    ("BA", "Bahia", "Nordeste"),
    ("CE", "Ceará", "Nordeste"),
    ("DF", "Distrito Federal", "Centro-Oeste"),
    ("ES", "Espírito Santo", "Sudeste"),
    ("GO", "Goiás", "Centro-Oeste"),
    ("MA", "Maranhão", "Nordeste"),
    ("MT", "Mato Grosso", "Centro-Oeste"),
    ("MS", "Mato Grosso do Sul", "Centro-Oeste"),
    ("MG", "Minas Gerais", "Sudeste"),
    ("PA", "Pará", "Norte"),
    ("PB", "Paraíba", "Nordeste"),
    ("PR", "Paraná", "Sul"),
    ("PE", "Pernambuco", "Nordeste"),
    ("PI", "Piauí", "Nordeste"),
    ("RJ", "Rio de Janeiro", "Sudeste"),
    ("RN", "Rio Grande do Norte", "Nordeste"),
    ("RS", "Rio Grande do Sul", "Sul"),
    ("RO", "Rondônia", "Norte"),
    ("RR", "Roraima", "Norte"),
    ("SC", "Santa Catarina", "Sul"),
    ("SP", "São Paulo", "Sudeste"),
    ("SE", "Sergipe", "Nordeste"),
    ("TO", "Tocantins", "Norte"),
    ("XX", "Não informado", "Não informado"),
)
STATE_CODES = tuple(code for code, _, _ in STATES)

# Columns of the enrolment file.
ENROLMENT_COLUMNS = (
    "ID_CMPT_MOVEL",
    "CD_OPERADORA",
    "NM_RAZAO_SOCIAL",
    "NR_CNPJ",
    "MODALIDADE_OPERADORA",
    "SG_UF",
    "CD_MUNICIPIO",
    "NM_MUNICIPIO",
    "TP_SEXO",
    "DE_FAIXA_ETARIA",
    "DE_FAIXA_ETARIA_REAJ",
    "CD_PLANO",
    "TP_VIGENCIA_PLANO",
    "DE_CONTRATACAO_PLANO",
    "DE_SEGMENTACAO_PLANO",
    "DE_ABRG_GEOGRAFICA_PLANO",
    "COBERTURA_ASSIST_PLAN",
    "TIPO_VINCULO",
    "QT_BENEFICIARIO_ATIVO",
    "QT_BENEFICIARIO_ADERIDO",
    "QT_BENEFICIARIO_CANCELADO",
    "DT_CARGA",
)

# Enrolment file column to cleaned column.
ENROLMENT_NAMES = {
    "CD_OPERADORA": "carrier_code",
    "CD_MUNICIPIO": "locality_code",
    "NM_MUNICIPIO": "locality_name",
    "SG_UF": "state",
    "TP_SEXO": "sex",
    "DE_FAIXA_ETARIA": "age_band",
    "TIPO_VINCULO": "tie_type",
    "DE_SEGMENTACAO_PLANO": "segment",
    "QT_BENEFICIARIO_ATIVO": "active",
    "QT_BENEFICIARIO_ADERIDO": "joined",
    "QT_BENEFICIARIO_CANCELADO": "cancelled",
}

# Carrier register column to cleaned column.  Columns not named
# here (address, contacts, representative) are personal data and never kept.
CARRIER_NAMES = {
    "REGISTRO_OPERADORA": "carrier_code",
    "CNPJ": "registration_no",
    "Razao_Social": "legal_name",
    "Nome_Fantasia": "trade_name",
    "Modalidade": "kind",
    "Cidade": "seat_locality",
    "UF": "seat_state",
    "Data_Registro_ANS": "registered_on",
}

# Facility register column to cleaned column; two columns may feed
# the same target.
FACILITY_NAMES = {
    "CO_CNES": "facility_code",
    "NO_FANTASIA": "facility_name",
    "NO_RAZAO_SOCIAL": "legal_name",
    "TP_UNIDADE": "type_code",
    "DS_TP_UNIDADE": "type_label",
    "CO_MUNICIPIO": "locality_code",
    "NO_MUNICIPIO": "locality_name",
    "CO_UF": "state",
    "SG_UF": "state",
}
FACILITY_REQUIRED = ("facility_code", "facility_name", "locality_code")

ENROLMENT_GRAIN = (
    "period_key",
    "carrier_code",
    "locality_code",
    "locality_name",
    "state",
    "sex",
    "age_band",
    "tie_type",
    "segment",
)
ENROLMENT_FACT_GRAIN = (
    "period_key",
    "carrier_sk",
    "locality_sk",
    "sex",
    "age_band",
    "tie_type",
    "segment",
)
BLANK_IS_NULL = ("sex", "age_band", "tie_type", "segment")
MEASURES = ("active", "joined", "cancelled")

# Column lists of the warehouse tables, in writing order.
LOCALITY_COLUMNS = ("locality_sk", "locality_code", "locality_name", "state", "state_name", "region")

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("event_at", T.TimestampType()),
        T.StructField("pipeline", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("origin_file", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("received", T.LongType()),
        T.StructField("valid", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("violated_rule", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def states(spark: SparkSession) -> DataFrame:
    """The 28-row state table: state, state_name, region."""
    return spark.createDataFrame(list(STATES), "state string, state_name string, region string")
