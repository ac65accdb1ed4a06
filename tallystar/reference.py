"""Indicator classification, state-to-region map and semantic groups (configuration, not data)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.errors import CoverageError
from tallystar.schema import COUNT, VICTIM, WEIGHT

# ---------------------------------------------------------------------------
# Published classification of the 31 indicators.
# (indicator, family, unit, kind)
# ---------------------------------------------------------------------------
INDICATORS = (
    ("Feminicídio", VICTIM, "pessoas", "Vítima - Violência Letal Intencional"),
    ("Tentativa de feminicídio", VICTIM, "pessoas", "Vítima - Tentativa de Violência Letal"),
    ("Homicídio doloso", VICTIM, "pessoas", "Vítima - Violência Letal Intencional"),
    ("Tentativa de homicídio", VICTIM, "pessoas", "Vítima - Tentativa de Violência Letal"),
    ("Lesão corporal seguida de morte", VICTIM, "pessoas", "Vítima - Violência Letal Intencional"),
    ("Roubo seguido de morte (latrocínio)", VICTIM, "pessoas", "Vítima - Violência Letal Intencional"),
    ("Mortes a esclarecer (sem indício de crime)", VICTIM, "pessoas", "Vítima - A Esclarecer"),
    ("Morte no trânsito ou em decorrência dele (exceto homicídio doloso)", VICTIM, "pessoas", "Vítima - Trânsito"),
    ("Mortes no trânsito", VICTIM, "pessoas", "Vítima - Trânsito"),
    ("Suicídio", VICTIM, "pessoas", "Vítima - Autoprovocada"),
    ("Estupro", VICTIM, "pessoas", "Vítima - Violência Sexual"),
    ("Estupro de vulnerável", VICTIM, "pessoas", "Vítima - Violência Sexual"),
    ("Morte de Agente do Estado", VICTIM, "pessoas", "Vítima - Agente do Estado (óbito do agente)"),
    ("Suicídio de Agente do Estado", VICTIM, "pessoas", "Vítima - Agente do Estado (óbito do agente)"),
    ("Morte por intervenção de Agente do Estado", VICTIM, "pessoas", "Vítima - Letalidade Policial (civil morto por agente)"),
    ("Pessoa Desaparecida", VICTIM, "pessoas", "Pessoa - Desaparecimento"),
    ("Pessoa Localizada", VICTIM, "pessoas", "Pessoa - Desaparecimento (Resolução)"),
    ("Mandado de prisão cumprido", COUNT, "mandados", "Ação Policial"),
    ("Arma de Fogo Apreendida", COUNT, "armas (unidades)", "Apreensão - Unidade"),
    ("Furto de veículo", COUNT, "ocorrências", "Ocorrência - Patrimonial"),
    ("Roubo de veículo", COUNT, "ocorrências", "Ocorrência - Patrimonial"),
    ("Roubo de carga", COUNT, "ocorrências", "Ocorrência - Patrimonial"),
    ("Roubo a instituição financeira", COUNT, "ocorrências", "Ocorrência - Patrimonial"),
    ("Tráfico de drogas", COUNT, "ocorrências", "Ocorrência - Criminal (Drogas)"),
    ("Apreensão de Cocaína", WEIGHT, "kg (não confirmado pela fonte)", "Apreensão - Peso"),
    ("Apreensão de Maconha", WEIGHT, "kg (não confirmado pela fonte)", "Apreensão - Peso"),
    ("Atendimento pré-hospitalar", COUNT, "atendimentos", "Serviço - Saúde/Resgate"),
    ("Busca e salvamento", COUNT, "operações", "Serviço - Resgate"),
    ("Combate a incêndios", COUNT, "ocorrências", "Serviço - Bombeiros"),
    ("Emissão de Alvarás de licença", COUNT, "alvarás", "Serviço - Administrativo"),
    ("Realização de vistorias", COUNT, "vistorias", "Serviço - Administrativo"),
)

# Official regions and the states in them.
REGION_STATES = {
    "Norte": ("AC", "AM", "AP", "PA", "RO", "RR", "TO"),
    "Nordeste": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Centro-Oeste": ("DF", "GO", "MS", "MT"),
    "Sudeste": ("ES", "MG", "RJ", "SP"),
    "Sul": ("PR", "RS", "SC"),
}

# Semantic groups by indicator kind; the first match wins.
# (test, text, group), where test is "starts" or "equals".
GROUP_RULES = (
    ("starts", "Vítima", "Vítimas"),
    ("starts", "Pessoa", "Vítimas"),
    ("equals", "Ação Policial", "Ações Policiais"),
    ("starts", "Ocorrência", "Ocorrências"),
    ("equals", "Apreensão - Peso", "Apreensões (Peso)"),
    ("equals", "Apreensão - Unidade", "Apreensões (Unidade)"),
    ("starts", "Serviço", "Serviços"),
)
OTHER_GROUP = "Outro"

# Labels of the sex dimension, ids 1..3 in this order.
SEX_LABELS = {"female": "Feminino", "male": "Masculino", "unknown_sex": "Não Informado"}

# Texts shown by the label measures.
SEVERAL_INDICATORS = "Vários indicadores"
MIXED_UNITS = "unidades mistas — não somar"
SEVERAL_YEARS = "Vários anos"
PARTIAL_PREFIX = "DADOS PARCIAIS — JAN a "
QUALITY_LABELS = {"none": "Sem dados", "good": "Bom", "watch": "Atenção", "serious": "Sério"}

INDICATOR_DDL = "indicator string, family string, unit string, kind string"
REGION_DDL = "state string, region string"


@dataclass(frozen=True)
class Reference:
    """The configuration tables one feed is read with."""

    indicators: DataFrame
    regions: DataFrame
    group_rules: tuple[tuple[str, str, str], ...] = GROUP_RULES
    other_group: str = OTHER_GROUP
    state_code_length: int | None = 2
    year_bounds: tuple[int, int] = (2000, 2100)

    @property
    def group_names(self) -> tuple[str, ...]:
        return tuple(sorted({group for _, _, group in self.group_rules}))


def default_reference(spark: SparkSession) -> Reference:
    regions = [(state, region) for region, states in REGION_STATES.items() for state in states]
    return Reference(
        indicators=spark.createDataFrame(list(INDICATORS), INDICATOR_DDL),
        regions=spark.createDataFrame(regions, REGION_DDL),
    )


def semantic_group(kind: Column, reference: Reference) -> Column:
    """The group of an indicator kind; kinds no rule matches fall into the other group."""
    cases = [
        F.when(kind.startswith(text) if test == "starts" else kind == F.lit(text), F.lit(group))
        for test, text, group in reference.group_rules
    ]
    return F.coalesce(*cases, F.lit(reference.other_group))


def unmapped(df: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Distinct values of `column` that the reference table lacks."""
    return df.select(column).distinct().join(table.select(column), column, "left_anti")


def require_coverage(df: DataFrame, table: DataFrame, column: str) -> None:
    """Fail when the data holds unmapped values; a value is never classified by guess."""
    missing = [row[0] for row in unmapped(df, table, column).orderBy(column).collect()]
    if missing:
        raise CoverageError(f"{column} values without a mapping: {missing}")
