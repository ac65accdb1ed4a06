"""Column names, types and key lists shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Of raw and staged cells.
RAW_MEASURE_TYPE = T.DecimalType(28, 10)
# Of grain and fact: as many decimals as a cell, so nothing is rounded before the warehouse.
MEASURE_TYPE = T.DecimalType(24, 10)
WAREHOUSE_TYPE = T.DecimalType(14, 3)
# A measure times a number of rows of this type is exact.
TIMES_TYPE = T.DecimalType(13, 0)
MONTHS_PER_FULL_YEAR = 12

VICTIM, COUNT, WEIGHT = "victim", "count", "weight"
FAMILIES = (VICTIM, COUNT, WEIGHT)

KEY_STRINGS = ("state", "municipality", "indicator", "agent", "weapon", "age_band", "jurisdiction")
SEX_MEASURES = ("female", "male", "unknown_sex")
MEASURES = SEX_MEASURES + ("count_value", "weight_value")

# The columns that populate `value` for each family.
FAMILY_MEASURES = {VICTIM: SEX_MEASURES, COUNT: ("count_value",), WEIGHT: ("weight_value",)}

RAW_SCHEMA = T.StructType(
    [
        T.StructField("state", T.StringType()),
        T.StructField("municipality", T.StringType()),
        T.StructField("indicator", T.StringType()),
        T.StructField("ref_month", T.TimestampType()),
        T.StructField("agent", T.StringType()),
        T.StructField("weapon", T.StringType()),
        T.StructField("age_band", T.StringType()),
        T.StructField("female", T.DoubleType()),
        T.StructField("male", T.DoubleType()),
        T.StructField("unknown_sex", T.DoubleType()),
        T.StructField("victim_total", T.DoubleType()),
        T.StructField("count_value", T.DoubleType()),
        T.StructField("weight_value", T.DoubleType()),
        T.StructField("jurisdiction", T.StringType()),
    ]
)
RAW_COLUMNS = tuple(RAW_SCHEMA.fieldNames())

# The headers of the published feed and the names used here.
SOURCE_HEADERS = {
    "uf": "state",
    "municipio": "municipality",
    "evento": "indicator",
    "data_referencia": "ref_month",
    "agente": "agent",
    "arma": "weapon",
    "faixa_etaria": "age_band",
    "feminino": "female",
    "masculino": "male",
    "nao_informado": "unknown_sex",
    "total_vitima": "victim_total",
    "total": "count_value",
    "total_peso": "weight_value",
    "abrangencia": "jurisdiction",
}

# Staging is the raw feed, typed, without the derived victim total.
STAGING_COLUMNS = tuple(c for c in RAW_COLUMNS if c != "victim_total") + ("source_year",)

GRAIN = (
    "state",
    "municipality",
    "indicator",
    "ref_month",
    "jurisdiction",
    "agent",
    "weapon",
    "age_band",
    "source_year",
)

REQUIRED_IDS = ("time_id", "place_id", "indicator_id", "jurisdiction_id")
OPTIONAL_IDS = ("agent_id", "weapon_id", "age_band_id", "sex_id")
FACT_KEY = REQUIRED_IDS + OPTIONAL_IDS
FACT_COLUMNS = FACT_KEY + ("value", "source_year")

DIMENSIONS = ("time", "place", "indicator", "jurisdiction", "agent", "weapon", "age_band", "sex")
