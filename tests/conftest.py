import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallystar.plans.star import build_in_memory  # noqa: E402
from tallystar.reference import default_reference  # noqa: E402
from tallystar.sources.raw import raw_frame  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "4000")  # plans name their files and filters in full
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def row(state, municipality, indicator, year, month, jurisdiction="Estadual", **values):
    victims = [values.get(c) for c in ("female", "male", "unknown_sex")]
    if any(v is not None for v in victims):
        values.setdefault("victim_total", sum(v or 0.0 for v in victims))
    return dict(
        state=state,
        municipality=municipality,
        indicator=indicator,
        ref_month=dt.datetime(year, month, 1),
        jurisdiction=jurisdiction,
        **values,
    )


def zeros():
    return dict(female=0.0, male=0.0, unknown_sex=0.0)


def months(year, last, **values):
    """A town with one indicator in the months January to `last`."""
    return [row("SP", "CIDADE TESTE", "Homicídio doloso", year, m, **(values or zeros())) for m in range(1, last + 1)]


def counts_rows(year, last, scale=1.0):
    """Cargo thefts in four towns of three states, the same every month."""
    towns = (("SP", "A", 4.0), ("SP", "B", 1.0), ("MG", "A", 3.0), ("RJ", "A", 3.0))
    return [
        row(state, town, "Roubo de carga", year, month, count_value=value * scale)
        for month in range(1, last + 1)
        for state, town, value in towns
    ]


def feed_rows():
    """A full year, a partial one, and one case for each rule of the model."""
    elsewhere = ("SP", "OUTRACIDADE")
    full = months(2030, 12) + [
        row("DF", "BRASÍLIA", "Homicídio doloso", 2030, 1, female=1.0, male=0.0, unknown_sex=0.0),
        row("DF", "BRASÍLIA", "Homicídio doloso", 2030, 1, female=0.0, male=1.0, unknown_sex=0.0),
        row(*elsewhere, "Mandado de prisão cumprido", 2030, 1),
        row(*elsewhere, "Mandado de prisão cumprido", 2030, 2, count_value=5.0),
        row(*elsewhere, "Apreensão de Cocaína", 2030, 1, weight_value=12.5),
        row(*elsewhere, "Arma de Fogo Apreendida", 2030, 1, weapon="Pistola", count_value=3.0),
        row(*elsewhere, "Arma de Fogo Apreendida", 2030, 1, weapon="Fuzil", count_value=2.0),
        row(*elsewhere, "Pessoa Desaparecida", 2030, 1, age_band="Maior de Idade", female=1.0, male=0.0, unknown_sex=0.0),
        row(*elsewhere, "Morte de Agente do Estado", 2030, 1, agent="Polícia Militar", female=0.0, male=1.0, unknown_sex=0.0),
    ]
    return {2030: full, 2031: months(2031, 3)}


def star_of(spark, rows_by_year):
    raw = {year: raw_frame(spark, rows) for year, rows in rows_by_year.items()}
    return build_in_memory(raw, default_reference(spark))


@pytest.fixture(scope="session")
def star(spark):
    return star_of(spark, feed_rows())


@pytest.fixture(scope="session")
def feed_context(spark):
    from checks.context import context

    return context(spark, SF)


def as_dicts(df):
    return [r.asDict() for r in df.collect()]
