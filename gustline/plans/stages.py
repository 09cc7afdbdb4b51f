"""Stage tables shared by many queries of one application, written once to the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gustline.session import write_stage

_PATHS: dict[tuple, tuple[str, StructType]] = {}
_VALUES: dict[tuple, object] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input's files, so that a changed input is read anew."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored table of this name for this input, built on first use or if its files are gone."""
    key = (spark.sparkContext.applicationId, sf_dir, name, _state(spark, sf_dir))
    if key in _PATHS:
        path, schema = _PATHS[key]
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException:
            del _PATHS[key]
    df = build()
    _PATHS[key] = (write_stage(df, name), df.schema)
    path, schema = _PATHS[key]
    return spark.read.schema(schema).parquet(path)


def value(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name, _state(spark, sf_dir))
    if key not in _VALUES:
        _VALUES[key] = build()
    return _VALUES[key]
