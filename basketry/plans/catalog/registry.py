"""Registry of the named queries."""

from pyspark.sql import functions as F, types as T

_QUERIES, _SQL = {}, {}


def _plain(df):
    """Decimals as double, so both engines report the same type."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields])


def query(name: str, build, sql: str = None) -> None:
    """Register ``build(spark, sf_dir)``; ``sql`` is left out where SQL cannot express the result."""
    assert name not in _QUERIES, name
    _QUERIES[name] = lambda spark, sf_dir: _plain(build(spark, sf_dir))
    if sql is not None:
        _SQL[name] = sql


def queries():
    return dict(_QUERIES)


def oracle_sql():
    return dict(_SQL)
