"""Joins of the observed column profile with the data dictionary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazarlake.functions.rates import share_pct
from bazarlake.lake import LAYERS
from bazarlake.plans import glossary as g


def column_dictionary(spark: SparkSession) -> DataFrame:
    """One row per declared column, with its meaning, class and the tags of its table.

    As many rows as the tables have columns, whatever the size of the data.
    """
    classes = {
        (table, column): kind
        for table, kinds in g.CLASSIFIED.items()
        for kind, columns in kinds.items()
        for column in columns
    }
    rows = []
    for layer, tables in LAYERS.items():
        for table in tables:
            domain, grain, classification = g.TABLE_TAGS[table]
            quality = g.QUARANTINE_QUALITY if "quarantine" in table else g.LAYER_QUALITY[layer]
            for column in g.TABLE_COLUMNS[table]:
                kind = classes.get((table, column))
                rows.append(
                    (layer, table, column, g.GLOSSARY[column], kind, g.SENSITIVITY.get(kind))
                    + (domain, grain, classification, quality, g.LAYER_LATENCY[layer])
                )
    return spark.createDataFrame(
        rows,
        "schema_name string, table_name string, column_name string, description string,"
        " semantic_type string, sensitivity string, business_domain string, data_grain string,"
        " data_classification string, quality_status string, latency_target string",
    )


def common_dictionary(spark: SparkSession) -> DataFrame:
    """Meaning of the lineage columns, for every table that has them."""
    return spark.createDataFrame(
        list(g.COMMON_GLOSSARY.items()), "column_name string, common_description string"
    )


def column_inventory(profile: DataFrame, dictionary: DataFrame, common: DataFrame) -> DataFrame:
    """Existing columns with type, meaning, rows and missing cells; the meaning shared by all tables goes first."""
    named = dictionary.select("schema_name", "table_name", "column_name", "description")
    return (
        profile.withColumnRenamed("layer", "schema_name")
        .join(named, ["schema_name", "table_name", "column_name"], "left")
        .join(common, "column_name", "left")
        .select(
            "schema_name",
            "table_name",
            "column_name",
            "data_type",
            "nullable",
            F.coalesce("common_description", "description").alias("comment"),
            "ordinal_position",
            "row_count",
            "null_count",
        )
        .orderBy("schema_name", "table_name", "ordinal_position")
    )


def reconcile(profile: DataFrame, dictionary: DataFrame, common: DataFrame) -> DataFrame:
    """Declared columns found (APPLIED) or not (NOT_FOUND), and lineage columns (APPLIED_COMMON), with
    the cells that are filled; NULL for a column that is not there."""
    key = ["schema_name", "table_name", "column_name"]
    filled = (F.col("row_count") - F.col("null_count")).alias("filled_count")
    existing = profile.withColumnRenamed("layer", "schema_name").select(*key, filled)
    marked = dictionary.select(*key).join(existing.withColumn("found", F.lit(True)), key, "left")
    status = F.when(F.col("found"), "APPLIED").otherwise("NOT_FOUND")
    declared = marked.select(*key, status.alias("status"), "filled_count")
    shared = existing.join(common.select("column_name"), "column_name", "left_semi")
    lineage = shared.select(*key, F.lit("APPLIED_COMMON").alias("status"), "filled_count")
    return declared.unionByName(lineage).orderBy(*key, "status")


def _documented():
    return F.col("comment").isNotNull() & (F.trim("comment") != "")


def coverage(inventory: DataFrame) -> DataFrame:
    """Columns with a meaning, and columns without any value, per table."""
    counted = inventory.groupBy("schema_name", "table_name").agg(
        F.count("*").alias("total_columns"),
        F.count_if(_documented()).alias("documented_columns"),
        F.count_if(_always_empty()).alias("always_empty_columns"),
    )
    rate = share_pct(F.col("documented_columns"), F.col("total_columns"))
    return counted.withColumn("documentation_coverage_pct", rate).orderBy("schema_name", "table_name")


def _always_empty():
    """Rows, but not one value."""
    return (F.col("row_count") > 0) & (F.col("null_count") == F.col("row_count"))


def undocumented(inventory: DataFrame) -> DataFrame:
    """Columns that need attention: without a meaning, or without a single value in their rows."""
    reason = F.when(~_documented(), "undocumented").when(_always_empty(), "always empty")
    return (
        inventory.withColumn("reason", reason)
        .filter("reason IS NOT NULL")
        .orderBy("schema_name", "table_name", "ordinal_position")
        .select("schema_name", "table_name", "column_name", "data_type", "reason")
    )


def require_documented(inventory: DataFrame) -> None:
    """Stop if a column has no meaning, and name all of them: at most one per column of the schema."""
    missing = undocumented(inventory).filter("reason = 'undocumented'").collect()
    if missing:
        raise ValueError(f"{len(missing)} undocumented: " + ", ".join(f"{r.table_name}.{r.column_name}" for r in missing))


def observed_domains(tables: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Values of every column with a declared domain: rows per value, compared with the declaration.

    ``DECLARED`` values are in the domain, ``UNDECLARED`` ones are not, ``NOT_OBSERVED`` ones are
    declared and occur in no row. NULL is outside every domain and not listed. Each table is read
    once, and the values are counted within the tasks before the shuffle.
    """
    spark = tables[0][2].sparkSession
    declared = spark.createDataFrame(
        [(table, column, value) for (table, column), values in g.DOMAINS.items() for value in values],
        "table_name string, column_name string, value string",
    )
    counted = []
    for layer, name, df in tables:
        columns = [column for table, column in g.DOMAINS if table == name]
        if columns:
            cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
            long = df.select(F.explode(cells).alias("cell")).select("cell.*").filter("value IS NOT NULL")
            counted.append(
                long.groupBy("column_name", "value").agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "*")
            )
    observed = reduce(DataFrame.unionByName, counted)
    key = ["table_name", "column_name", "value"]
    joined = observed.join(declared.withColumn("known", F.lit(True)), key, "full")
    status = F.when(F.col("known").isNull(), "UNDECLARED").when(F.col("n").isNull(), "NOT_OBSERVED").otherwise("DECLARED")
    return joined.select(*key, F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count"), status.alias("status")).orderBy(*key)


# Size of the distinct-count sketches: 2 ** 12 registers, an error of about 1.6 % one time in three.
CARDINALITY_ERROR = 0.05


def cardinalities(tables: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """(table_name, column_name, row_count, sketch, estimate) of every column, one aggregate per table.

    The sketches are HyperLogLog and can be merged over parts of a table or over days.
    """
    parts = []
    for _, name, df in tables:
        quoted = [f"`{c}`" for c in df.columns]
        wide = df.agg(
            F.count("*").alias("row_count"),
            *[F.hll_sketch_agg(F.col(q).cast("string")).alias(f"s{i}") for i, q in enumerate(quoted)],
        )
        lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(df.columns)])
        line = wide.select("row_count", F.explode(lines).alias("line"))
        parts.append(line.select(F.lit(name).alias("table_name"), "line.column_name", "row_count", "line.sketch"))
    return reduce(DataFrame.unionByName, parts).withColumn("estimate", F.hll_sketch_estimate("sketch"))


def classified_profile(profile: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Cells and missing cells per table, semantic type and sensitivity."""
    classes = dictionary.filter("semantic_type IS NOT NULL").select(
        "schema_name", "table_name", "column_name", "semantic_type", "sensitivity", "data_classification"
    )
    tagged = profile.withColumnRenamed("layer", "schema_name").join(
        classes, ["schema_name", "table_name", "column_name"]
    )
    counted = tagged.groupBy(
        "schema_name", "table_name", "semantic_type", "sensitivity", "data_classification"
    ).agg(
        F.count("*").alias("column_count"),
        F.sum("row_count").alias("cell_count"),
        F.sum("null_count").alias("null_cell_count"),
    )
    rate = F.coalesce(share_pct(F.col("null_cell_count"), F.col("cell_count"), 4), F.lit(0.0))
    return counted.withColumn("null_cell_rate_pct", rate).orderBy("schema_name", "table_name", "semantic_type")
