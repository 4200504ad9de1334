"""Data-quality reports. Each check is one aggregate per table; nothing is pulled to the driver."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazarlake.functions.lineage import LAYER_LINEAGE
from bazarlake.functions.rates import share_pct
from bazarlake.operators.counters import row_counters, rule_counts, values_of
from bazarlake.operators.keys import orphan_count, orphan_total
from bazarlake.operators.profiling import column_profile
from bazarlake.operators.quarantine import Rule, is_bad
from bazarlake.operators.ranking import exact_percentiles
from bazarlake.plans.silver import ORDER_STATUSES, SCORE_RANGE, item_rules, order_rules

LayerTable = tuple[str, str, DataFrame]

# States of a check.
APPROVED = "APROVADO"
ATTENTION = "ATENCAO"


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- profiles


def column_profiles(tables: Sequence[LayerTable]) -> DataFrame:
    """One row per column of every table."""
    return union_all([column_profile(df, layer, name) for layer, name, df in tables])


def table_profile(columns: DataFrame) -> DataFrame:
    """Rows, columns and missing cells per table, from the column profile."""
    per_table = columns.groupBy("layer", "table_name").agg(
        F.max("row_count").alias("row_count"),
        F.count("*").alias("column_count"),
        F.count_if(F.col("null_count") > 0).alias("columns_with_nulls"),
        F.sum("null_count").alias("total_null_cells"),
        F.sum("row_count").alias("total_cells"),
    )
    rate = F.coalesce(share_pct(F.col("total_null_cells"), F.col("total_cells"), 4), F.lit(0.0))
    return per_table.withColumn("null_cell_rate_pct", rate).orderBy("layer", "table_name")


def _populated(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return column.isNotNull() & (F.trim(column) != "")
    return column.isNotNull()


def _covered(rows: Column, total: Column) -> Column:
    """Coverage in percent; an empty table is fully covered."""
    return F.coalesce(share_pct(rows, total), F.lit(100.0))


def _complete(layer: str, df: DataFrame) -> Column:
    """All lineage columns that the table has are filled."""
    available = [c for c in LAYER_LINEAGE[layer] if c in df.columns]
    return reduce(lambda a, b: a & b, [_populated(df, c) for c in available], F.lit(bool(available)))


def _traced(layer: str, name: str, df: DataFrame) -> DataFrame:
    counted = df.agg(
        F.count("*").alias("row_count"), F.count_if(_complete(layer, df)).alias("rows_with_complete_metadata")
    )
    return _traced_line(counted, layer, name, df.columns)


def _traced_line(counted: DataFrame, layer: str, name: str, columns: Sequence[str]) -> DataFrame:
    expected = LAYER_LINEAGE[layer]
    missing = [c for c in expected if c not in columns]
    return counted.select(
        F.lit(layer).alias("layer"),
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(", ".join(expected)).alias("expected_metadata"),
        F.lit(", ".join(missing) or "none").alias("missing_metadata_columns"),
        "rows_with_complete_metadata",
        _covered(F.col("rows_with_complete_metadata"), F.col("row_count")).alias("traceability_coverage_pct"),
    )


def traceability(tables: Sequence[LayerTable]) -> DataFrame:
    """Lineage columns that are missing and rows where all present ones are filled."""
    return union_all([_traced(*table) for table in tables]).orderBy("layer", "table_name")


def untraced(report: DataFrame) -> DataFrame:
    return report.filter("missing_metadata_columns <> 'none' OR traceability_coverage_pct < 100")


VOLUME_TABLES = (
    ("bronze", "bronze_orders"),
    ("bronze", "bronze_order_items"),
    ("bronze", "bronze_order_reviews"),
    ("silver", "silver_orders"),
    ("silver", "silver_order_items"),
    ("silver", "silver_order_service"),
    ("silver", "silver_quarantine_orders"),
    ("silver", "silver_quarantine_order_items"),
    ("gold", "fact_order_service"),
    ("gold", "fact_order_item_sales"),
    ("gold", "dim_customer"),
    ("gold", "dim_product"),
    ("gold", "dim_seller"),
)


def volume(tables: Sequence[LayerTable]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for layer, name, df in tables
    ]
    return union_all(counts).orderBy("layer", "table_name")


# ---------------------------------------------------------------- completeness and validity

CRITICAL_COLUMNS = (
    "order_id",
    "customer_unique_id",
    "purchase_date_key",
    "gmv_total_value",
    "order_status",
    "delivery_date_key",
    "review_score_avg",
    "seller_customer_distance_km",
)
IDENTIFIERS = ("order_id", "customer_unique_id")
REQUIRED_COLUMNS = ("order_id", "customer_unique_id", "purchase_date_key")


def _missing(name: str) -> Column:
    if name in IDENTIFIERS:
        return F.col(name).isNull() | (F.trim(name) == "")
    return F.col(name).isNull()


def completeness(fact: DataFrame) -> DataFrame:
    """Missing values of the critical columns, one row per column."""
    return _completeness(
        fact.agg(F.count("*").alias("total_orders"), *[F.count_if(_missing(n)).alias(n) for n in CRITICAL_COLUMNS])
    )


def _completeness(wide: DataFrame) -> DataFrame:
    long = wide.unpivot("total_orders", list(CRITICAL_COLUMNS), "column_name", "null_count")
    return long.select(
        "column_name",
        "null_count",
        "total_orders",
        share_pct(F.col("null_count"), F.col("total_orders")).alias("null_pct"),
    ).orderBy(F.desc("null_pct"), "column_name")


def validity_rules() -> dict[str, Column]:
    return {
        "invalid_order_status": ~F.col("order_status").isin(*ORDER_STATUSES),
        "negative_gmv": F.col("gmv_total_value") < 0,
        "negative_freight": F.col("freight_total_value") < 0,
        "invalid_review_score": ~F.col("review_score_avg").between(*SCORE_RANGE),
        "negative_delivery_days": F.col("actual_delivery_days") < 0,
        "negative_distance_km": F.col("seller_customer_distance_km") < 0,
        "inconsistent_delivery_flags": F.col("is_delivery_late") == F.col("is_delivery_on_time"),
    }


def validity(fact: DataFrame) -> DataFrame:
    """Orders that break each rule, one row. A NULL breaks no rule."""
    rules = validity_rules()
    return fact.agg(
        F.count("*").alias("total_orders"), *[F.count_if(test).alias(name) for name, test in rules.items()]
    )


# ---------------------------------------------------------------- keys

UNIQUE_KEYS = (
    ("silver_orders", ("order_id",)),
    ("silver_order_items", ("order_id", "order_item_id")),
    ("fact_order_service", ("order_id",)),
    ("fact_order_item_sales", ("order_id", "order_item_id")),
    ("dim_customer", ("customer_unique_id",)),
    ("dim_product", ("product_id",)),
    ("dim_seller", ("seller_id",)),
)


def _key_counts(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows and distinct keys, from a count per key, so a repeated key shrinks before the shuffle."""
    return _key_line(df.groupBy(*keys).agg(F.count("*").alias("n")), table, keys)


def _key_line(per_key: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_key_rows")).select(
        F.lit(table).alias("table_name"), F.lit(" + ".join(keys)).alias("business_key"), "total_rows", "distinct_key_rows"
    )


def uniqueness(tables: dict[str, DataFrame]) -> DataFrame:
    return _uniqueness([_key_counts(tables[name], name, keys) for name, keys in UNIQUE_KEYS])


def _uniqueness(lines: Sequence[DataFrame]) -> DataFrame:
    return union_all(lines).withColumns(
        {
            "duplicate_rows": F.col("total_rows") - F.col("distinct_key_rows"),
            "uniqueness_pct": share_pct(F.col("distinct_key_rows"), F.col("total_rows")),
        }
    ).orderBy("table_name")


FOREIGN_KEYS = (
    ("fact_order_service", "dim_customer", "customer_unique_id"),
    ("fact_order_service", "dim_seller", "seller_id"),
    ("fact_order_item_sales", "dim_product", "product_id"),
    ("fact_order_item_sales", "dim_seller", "seller_id"),
)


def referential_integrity(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        orphan_count(tables[child], tables[parent], key).select(
            F.lit(f"{child} -> {parent}").alias("relationship"), "orphan_record_count"
        )
        for child, parent, key in FOREIGN_KEYS
    ]
    return union_all(parts).orderBy("relationship")


# ---------------------------------------------------------------- the whole suite, each table read once

_TRACED, _TOTAL = "complete_metadata", "total_orders"


def _keys_of(table: str) -> list[tuple[str, ...]]:
    unique = [keys for name, keys in UNIQUE_KEYS if name == table]
    return list(dict.fromkeys(unique + [(key,) for child, _, key in FOREIGN_KEYS if child == table]))


def checks_in_one_scan(tables: Sequence[LayerTable]) -> dict[str, DataFrame]:
    """Completeness, validity, uniqueness, integrity and traceability over all tables.

    Tables with several checks are counted once (``row_counters``) and every check of theirs reads
    the counters; the others are read by their one check.
    """
    of = {name: (layer, df) for layer, name, df in tables}
    counters: dict[str, DataFrame] = {}
    missing = {f"missing {name}": _missing(name) for name in CRITICAL_COLUMNS}
    for name in dict.fromkeys(name for name, _ in UNIQUE_KEYS):
        layer, df = of[name]
        rules = {_TRACED: _complete(layer, df)}
        if name == "fact_order_service":
            rules |= missing | validity_rules()
        counters[name] = row_counters(df, rules, _keys_of(name))

    fact = counters["fact_order_service"]
    wide = rule_counts(fact, list(missing), _TOTAL)
    orphans = []
    for child, parent, key in FOREIGN_KEYS:
        per_key = values_of(counters[child], (key,), key)
        orphans.append(orphan_total(per_key, of[parent][1], key).select(
            F.lit(f"{child} -> {parent}").alias("relationship"), "orphan_record_count"
        ))
    traced = []
    for layer, name, df in tables:
        if name in counters:
            line = rule_counts(counters[name], [_TRACED]).withColumnRenamed(_TRACED, "rows_with_complete_metadata")
            traced.append(_traced_line(line, layer, name, df.columns))
        else:
            traced.append(_traced(layer, name, df))
    return {
        "completeness": _completeness(wide.withColumnsRenamed({f"missing {n}": n for n in CRITICAL_COLUMNS})),
        "validity": rule_counts(fact, list(validity_rules()), _TOTAL),
        "uniqueness": _uniqueness([_key_line(values_of(counters[name], keys), name, keys) for name, keys in UNIQUE_KEYS]),
        "integrity": union_all(orphans).orderBy("relationship"),
        "traceability": union_all(traced).orderBy("layer", "table_name"),
    }


def _quarantine_counts(entity: str, typed: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """Input rows, rows kept after deduplication and rejected rows, from one scan.

    Rows are counted per key first, with the rejected ones under a NULL key.
    """
    bad = is_bad(rules)
    slim = typed.select(*[F.when(~bad, F.col(k)).alias(k) for k in keys], bad.alias("bad"))
    per_key = slim.groupBy(*keys, "bad").agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_row_count"),
        F.count_if(~F.col("bad")).alias("silver_valid_row_count"),
        F.coalesce(F.sum(F.when(F.col("bad"), F.col("n"))), F.lit(0)).alias("silver_quarantine_row_count"),
    ).select(F.lit(entity).alias("entity"), "*")


def quarantine_rate(orders_typed: DataFrame, items_typed: DataFrame) -> DataFrame:
    counts = _quarantine_counts("orders", orders_typed, order_rules(), ["order_id"]).unionByName(
        _quarantine_counts("order_items", items_typed, item_rules(), ["order_id", "order_item_id"])
    )
    rate = share_pct(F.col("silver_quarantine_row_count"), F.col("bronze_row_count"), 4)
    return counts.withColumn("quarantine_rate_pct", rate)


# ---------------------------------------------------------------- outliers and freshness

# Fractions, accuracy and measures of the outlier report.
PERCENTILES = (0.01, 0.25, 0.50, 0.75, 0.99)
ACCURACY = 10000
OUTLIER_METRICS = {
    "gmv_total_value": "gmv_percentiles",
    "freight_total_value": "freight_percentiles",
    "actual_delivery_days": "delivery_days_percentiles",
    "delivery_delay_days": "delay_days_percentiles",
    "seller_customer_distance_km": "distance_km_percentiles",
}


def outlier_percentiles(fact: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """Approximate percentile vectors of delivered orders, one row, mergeable sketches."""
    delivered = fact.filter("order_status = 'delivered'")
    return delivered.agg(
        *[
            F.percentile_approx(metric, list(PERCENTILES), accuracy).alias(name)
            for metric, name in OUTLIER_METRICS.items()
        ]
    )


def outlier_percentiles_exact(fact: DataFrame) -> DataFrame:
    """The same percentiles without error, one row per metric and fraction."""
    delivered = fact.filter("order_status = 'delivered'")
    return exact_percentiles(delivered, list(OUTLIER_METRICS), PERCENTILES).orderBy("metric", "fraction")


# Size of a quantile sketch: a rank is off by less than half a percent in all but one case in a hundred.
SKETCH_SIZE = 800
RANK_ERROR = 0.01


def monthly_sketches(fact: DataFrame) -> DataFrame:
    """Per month of purchase one mergeable quantile sketch (KLL) and row count per measure.

    A month is sketched once and kept; any span of months is then answered from its sketches.
    """
    delivered = fact.filter("order_status = 'delivered'")
    month = F.floor(F.col("purchase_date_key") / 100).alias("purchase_month")
    return delivered.groupBy(month).agg(
        *[F.kll_sketch_agg_double(F.col(m).cast("double"), SKETCH_SIZE).alias(m) for m in OUTLIER_METRICS],
        *[F.count(m).alias(f"{m}__rows") for m in OUTLIER_METRICS],
    )


def _percentile(fraction: Column, value: Column) -> Column:
    return F.struct(fraction.alias("fraction"), value.alias("value"))


def sketched_percentiles(sketches: DataFrame) -> DataFrame:
    """(metric, fraction, row_count, value) over all given months, from their merged sketches."""
    merged = sketches.agg(
        *[F.kll_merge_agg_double(m).alias(m) for m in OUTLIER_METRICS],
        *[F.sum(f"{m}__rows").alias(f"{m}__rows") for m in OUTLIER_METRICS],
    )
    fractions = F.array(*[F.lit(f) for f in PERCENTILES])
    lines = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"{m}__rows").alias("row_count"),
                F.when(
                    F.col(f"{m}__rows") > 0,
                    F.zip_with(fractions, F.kll_sketch_get_quantile_double(m, fractions), _percentile),
                ).alias("found"),
            )
            for m in OUTLIER_METRICS
        ]
    )
    line = merged.select(F.explode(lines).alias("line")).select("line.*")
    return line.select("metric", "row_count", F.explode("found").alias("f")).select(
        "metric", "f.fraction", "row_count", "f.value"
    )


def rank_errors(fact: DataFrame, percentiles: DataFrame) -> DataFrame:
    """How far each percentile's true ranks are from its fraction, as a share of the rows.

    The true ranks of a value reach from the share of rows below it to the share up to it; the
    error is the distance to that span. One scan counts for all percentiles, which are one row.
    """
    names = {(m, f): f"v{i}_{j}" for i, m in enumerate(OUTLIER_METRICS) for j, f in enumerate(PERCENTILES)}
    wanted = percentiles.agg(
        *[F.max(F.when((F.col("metric") == m) & (F.col("fraction") == f), F.col("value"))).alias(n) for (m, f), n in names.items()]
    )
    delivered = fact.filter("order_status = 'delivered'").select(*[F.col(m).cast("double").alias(m) for m in OUTLIER_METRICS])
    counted = delivered.crossJoin(F.broadcast(wanted)).agg(  # one row
        *[F.count_if(F.col(m) < F.col(n)).alias(f"{n}_below") for (m, _), n in names.items()],
        *[F.count_if(F.col(m) <= F.col(n)).alias(f"{n}_upto") for (m, _), n in names.items()],
    )
    lines = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.lit(f).alias("fraction"), F.col(f"{n}_below").alias("below"), F.col(f"{n}_upto").alias("upto"))
            for (m, f), n in names.items()
        ]
    )
    ranks = counted.select(F.explode(lines).alias("line")).select("line.*")
    low, high = F.col("below") / F.col("row_count"), F.col("upto") / F.col("row_count")
    error = F.greatest(low - F.col("fraction"), F.col("fraction") - high, F.lit(0.0))
    return percentiles.join(F.broadcast(ranks), ["metric", "fraction"]).select(  # a row per percentile
        "metric", "fraction", "row_count", "value", error.alias("rank_error")
    )


FRESHNESS_TABLES = (
    ("bronze_orders", "source_file", "ingestion_timestamp_utc"),
    ("silver_order_service", "silver_pipeline_run_id", "silver_processed_timestamp_utc"),
    ("fact_order_service", "gold_pipeline_run_id", "gold_processed_timestamp_utc"),
)


def freshness(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows with lineage and time of the last load, one table per layer."""
    parts = [
        tables[name]
        .agg(
            F.count(marker).alias("rows_with_traceability_metadata"),
            F.count("*").alias("total_rows"),
            F.max(stamp).alias("latest_processing_timestamp_utc"),
        )
        .select(F.lit(name).alias("table_name"), "*")
        for name, marker, stamp in FRESHNESS_TABLES
    ]
    covered = share_pct(F.col("rows_with_traceability_metadata"), F.col("total_rows"))
    return union_all(parts).withColumn("traceability_coverage_pct", covered)


# ---------------------------------------------------------------- summary

# Dimension, scope and criterion of each summary line.
SUMMARY_LINES = {
    "completeness": (
        "Completude de chaves críticas",
        "fact_order_service.order_id, customer_unique_id e purchase_date_key",
        "Sem nulos ou vazios",
    ),
    "validity": (
        "Validade de domínio e medidas",
        "Status, GMV, frete, review, prazo, distância e flags",
        "Nenhuma ocorrência inválida",
    ),
    "uniqueness": ("Unicidade", "Chaves de pedidos, itens e dimensões", "duplicate_rows = 0"),
    "integrity": (
        "Integridade referencial",
        "Fatos relacionados a dimensões",
        "orphan_record_count = 0",
    ),
    "traceability": (
        "Rastreabilidade estrutural",
        "Metadados obrigatórios por camada",
        "Sem metadados ausentes e cobertura de 100%",
    ),
}


def _summary_line(issues: DataFrame, line: str) -> DataFrame:
    dimension, scope, criterion = SUMMARY_LINES[line]
    count = F.coalesce("issue_count", F.lit(0)).cast("bigint")
    return issues.select(
        F.lit(dimension).alias("quality_dimension"),
        F.lit(scope).alias("scope"),
        F.lit(criterion).alias("acceptance_criterion"),
        count.alias("issue_count"),
        F.when(count == 0, APPROVED).otherwise(ATTENTION).alias("status"),
    )


def summary(
    completeness: DataFrame, validity: DataFrame, uniqueness: DataFrame, integrity: DataFrame, traceability: DataFrame
) -> DataFrame:
    """Issues and state of the five dimensions; every state follows from its count."""
    broken = reduce(lambda a, b: a + b, [F.col(name) for name in validity_rules()])
    issues = {
        "completeness": completeness.filter(F.col("column_name").isin(*REQUIRED_COLUMNS)).agg(
            F.sum("null_count").alias("issue_count")
        ),
        "validity": validity.select(broken.alias("issue_count")),
        "uniqueness": uniqueness.agg(F.sum("duplicate_rows").alias("issue_count")),
        "integrity": integrity.agg(F.sum("orphan_record_count").alias("issue_count")),
        "traceability": untraced(traceability).agg(F.count("*").alias("issue_count")),
    }
    return union_all([_summary_line(df, line) for line, df in issues.items()]).orderBy("quality_dimension")


def failed_rules(summary: DataFrame) -> DataFrame:
    """Number of dimensions that are not approved and the overall state, one row."""
    failed = summary.agg(F.count_if(F.col("status") != APPROVED).alias("failed_rule_count"))
    state = F.when(F.col("failed_rule_count") == 0, APPROVED).otherwise(ATTENTION)
    return failed.withColumn("overall_status", state)


def drilldown(
    summary: DataFrame,
    completeness: DataFrame,
    validity: DataFrame,
    uniqueness: DataFrame,
    integrity: DataFrame,
    traceability: DataFrame,
    only_on_failure: bool = True,
) -> DataFrame:
    """The offending lines of every check: section, item and count.

    With ``only_on_failure`` nothing is listed while all dimensions are approved.
    """

    def section(df: DataFrame, name: str, item: str, count: str | Column) -> DataFrame:
        amount = F.col(count) if isinstance(count, str) else count
        return df.select(
            F.lit(name).alias("section"), F.col(item).alias("item"), amount.cast("bigint").alias("issue_count")
        )

    rules = validity.unpivot("total_orders", list(validity_rules()), "rule", "broken")
    untraced_rows = F.col("row_count") - F.col("rows_with_complete_metadata")
    listed = union_all(
        [
            section(summary.filter(F.col("status") != APPROVED), "summary", "quality_dimension", "issue_count"),
            section(completeness.filter("null_count > 0"), "completeness", "column_name", "null_count"),
            section(rules.filter("broken > 0"), "validity", "rule", "broken"),
            section(uniqueness.filter("duplicate_rows > 0"), "uniqueness", "table_name", "duplicate_rows"),
            section(integrity.filter("orphan_record_count > 0"), "integrity", "relationship", "orphan_record_count"),
            section(untraced(traceability), "traceability", "table_name", untraced_rows),
        ]
    )
    if only_on_failure:
        failing = failed_rules(summary).filter("failed_rule_count > 0").select("overall_status")
        listed = listed.crossJoin(F.broadcast(failing)).drop("overall_status")  # at most one row
    return listed.orderBy("section", F.desc("issue_count"), "item")
