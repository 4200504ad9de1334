"""Where tables are kept: parquet folders under a root, or managed tables of the catalog.

Both replace data and schema of a table, may partition it, and return the rows written, which are
counted by the write itself (``observe``) and not by a second read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazarlake.sources.files import COMPRESSION, table_path


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _writer(df: DataFrame, by: Sequence[str]):
    writer = df.write.mode("overwrite").option("compression", COMPRESSION)
    return writer.partitionBy(*by) if by else writer


@dataclass(frozen=True)
class FolderStore:
    """Tables as parquet folders, one under the other's name."""

    root: str

    def write(self, df: DataFrame, layer: str, table: str, by: Sequence[str] = ()) -> int:
        observed, seen = _counted(df)
        _writer(observed, by).parquet(table_path(self.root, table))
        return int(seen.get["rows"])

    def read(self, spark: SparkSession, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
        """``schema`` lets a partitioned table without any row be read."""
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(table_path(self.root, table))


@dataclass(frozen=True)
class CatalogStore:
    """Managed tables by name, one schema per layer; the schemas are made if they are missing."""

    catalog: str | None = None
    schemas: dict[str, str] = field(default_factory=lambda: {"bronze": "bronze", "silver": "silver", "gold": "gold"})

    def name(self, layer: str, table: str) -> str:
        parts = [self.catalog, self.schemas[layer], table]
        return ".".join(f"`{p}`" for p in parts if p)

    def write(self, df: DataFrame, layer: str, table: str, by: Sequence[str] = ()) -> int:
        spark = df.sparkSession
        schema = self.name(layer, table).rpartition(".")[0]
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        observed, seen = _counted(df)
        _writer(observed, by).saveAsTable(self.name(layer, table))
        return int(seen.get["rows"])

    def read(self, spark: SparkSession, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
        return spark.read.table(self.name(layer, table))


Store = FolderStore | CatalogStore
