"""Where the source tables come from: Parquet folders, a catalog, JDBC or frames."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kvloom.model import SOURCE_COLUMNS, RunOptions, source_schema


class SourceTables(ABC):
    """Named source tables. A table may be absent."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    @abstractmethod
    def find(self, name: str) -> DataFrame | None:
        """The table, or None where it does not exist."""

    def history(self) -> DataFrame:
        """``ts_kv``, reduced to its eight columns."""
        found = self.find("ts_kv")
        if found is None:
            raise LookupError("source table ts_kv does not exist")
        return found.select(*SOURCE_COLUMNS)

    def latest(self) -> DataFrame:
        """``ts_kv_latest``; without rows where the table is absent."""
        found = self.find("ts_kv_latest")
        if found is None:
            return self.spark.createDataFrame([], source_schema())
        return found.select(*SOURCE_COLUMNS)


class FrameSource(SourceTables):
    """Tables given as DataFrames."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame]):
        super().__init__(spark)
        self._frames = frames

    def find(self, name: str) -> DataFrame | None:
        return self._frames.get(name)

    def replacing(self, **frames: DataFrame) -> FrameSource:
        """The same tables with some of them exchanged."""
        return FrameSource(self.spark, {**self._frames, **frames})


class ParquetSource(SourceTables):
    """One Parquet file or folder per table: ``<root>/<name>`` or ``<root>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, root: str, key_type: T.DataType | None = None):
        super().__init__(spark)
        self._root = root.rstrip("/")
        self._key_type = key_type

    def find(self, name: str) -> DataFrame | None:
        reader = self.spark.read
        if self._key_type is not None and name in ("ts_kv", "ts_kv_latest"):
            reader = reader.schema(source_schema(self._key_type))
        for path in (f"{self._root}/{name}", f"{self._root}/{name}.parquet"):
            try:
                return reader.parquet(path)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        return None


class CatalogSource(SourceTables):
    """Tables or views of the session catalog, in one database."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        super().__init__(spark)
        self._prefix = f"{database}." if database else ""

    def find(self, name: str) -> DataFrame | None:
        full = self._prefix + name
        return self.spark.table(full) if self.spark.catalog.tableExists(full) else None


class JdbcSource(SourceTables):
    """Tables of a relational database.

    ``ts_kv`` is read in parallel over ranges of ``ts``; filters and column
    lists are pushed to the database by Spark.
    """

    # Error conditions that mean "no such table", by the engines' own wording.
    _MISSING = ("JDBC_EXTERNAL_ENGINE_SYNTAX_ERROR", "TABLE_OR_VIEW_NOT_FOUND")

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: dict[str, str] | None = None,
        options: RunOptions | None = None,
        ts_bounds: tuple[int, int] | None = None,
    ):
        super().__init__(spark)
        self._url = url
        self._properties = dict(properties or {})
        self._options = options or RunOptions()
        self._ts_bounds = ts_bounds

    def reader_options(self, name: str) -> dict[str, str]:
        """The JDBC options for one table."""
        given = {
            "url": self._url,
            "dbtable": name,
            "fetchsize": str(self._options.batch_size),
            **self._properties,
        }
        if name == "ts_kv" and self._ts_bounds is not None:
            low, high = self._ts_bounds
            if low > high:
                raise ValueError("ts_bounds: the lower bound is above the upper one")
            # The bounds only cut the ranges; rows outside them are read too.
            given.update(
                partitionColumn="ts",
                lowerBound=str(low),
                upperBound=str(high + 1),
                numPartitions=str(self._options.workers),
            )
        return given

    def find(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.format("jdbc").options(**self.reader_options(name)).load()
        except PySparkException as e:
            if e.getCondition() in self._MISSING:
                return None
            raise
