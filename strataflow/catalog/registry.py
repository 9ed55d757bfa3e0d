"""Registration of a query together with its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.catalog.canon import Canon
from strataflow.catalog.prelude import PRELUDE
from strataflow.session import finely

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(canon) -> DataFrame`` under ``name``; ``sql`` may use the prelude's relations."""
    def register(build: Callable[[Canon], DataFrame]) -> Callable[[Canon], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Canon(finely(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = PRELUDE + sql
        return build

    return register


def shown(df: DataFrame, *ratios: str) -> DataFrame:
    """Presentation types: decimals as doubles, the named ratios rounded to six digits."""
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if field.name in ratios:
            value = F.round(value.cast("double"), 6)
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        columns.append(value.alias(field.name))
    return df.select(*columns)
