"""The tables of all layers over one set of feeds, lazily or from written tables.

``Lake`` composes each table from its inputs when asked for it; nothing runs until an action,
and Catalyst then computes only the columns and joins that the query reads. ``build`` writes the
layers one after the other, each reading the written tables before it, as a batch run does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazarlake.functions.lineage import with_gold_lineage, with_silver_lineage
from bazarlake.operators.dedupe import keep_one_of_repeated, keep_one_packed
from bazarlake.operators.quarantine import VERDICT, accepted_side, judged, rejected_side
from bazarlake.operators.workdir import shuffles_removed
from bazarlake.plans import bronze as bronze_plans
from bazarlake.plans import gold, silver
from bazarlake.sources.feeds import FEEDS
from bazarlake.sources.store import FolderStore, Store


def _unhashed(bronze: DataFrame) -> DataFrame:
    """Without the content hash, which would go through the shuffle. Where rows of a key differ in
    nothing else, the totals of an order are the same whichever of them is kept."""
    return bronze.drop("record_hash")


class Lake:
    """Silver and gold tables over the nine feeds (bare text or bronze tables)."""

    #: How large tables keep one row per key, and how the items do, whose numbers repeat more often.
    #: By default each plan's own way, which needs no action.
    _keeping: dict[str, silver.Once] = {}
    _keeping_items: dict[str, silver.Once] = {}

    def __init__(self, feed: Callable[[str], DataFrame]):
        self._feed = feed

    # silver

    @cached_property
    def silver_customers(self) -> DataFrame:
        return silver.customers(self._feed("customers"), **self._keeping)

    @cached_property
    def silver_sellers(self) -> DataFrame:
        return silver.sellers(self._feed("sellers"))

    @cached_property
    def silver_category_translation(self) -> DataFrame:
        return silver.category_translation(self._feed("category_translation"))

    @cached_property
    def silver_products(self) -> DataFrame:
        return silver.products(self._feed("products"), **self._keeping)

    @cached_property
    def orders_typed(self) -> DataFrame:
        return silver.orders_typed(self._feed("orders"))

    @cached_property
    def silver_quarantine_orders(self) -> DataFrame:
        return silver.quarantine_orders(self.orders_typed)

    @cached_property
    def silver_orders(self) -> DataFrame:
        return silver.orders(self.orders_typed, **self._keeping)

    @cached_property
    def items_typed(self) -> DataFrame:
        return silver.items_typed(self._feed("order_items"))

    @cached_property
    def silver_quarantine_order_items(self) -> DataFrame:
        return silver.quarantine_order_items(self.items_typed)

    @cached_property
    def silver_order_items(self) -> DataFrame:
        return silver.order_items(self.items_typed, **self._keeping_items)

    @cached_property
    def payments_typed(self) -> DataFrame:
        return silver.payments_typed(self._feed("order_payments"))

    @cached_property
    def silver_payments_order_agg(self) -> DataFrame:
        return silver.payments_order_agg(silver.payments_typed(_unhashed(self._feed("order_payments")), **self._keeping))

    @cached_property
    def reviews_typed(self) -> DataFrame:
        return silver.reviews_typed(self._feed("order_reviews"))

    @cached_property
    def silver_reviews_order_agg(self) -> DataFrame:
        return silver.reviews_order_agg(silver.reviews_typed(_unhashed(self._feed("order_reviews")), **self._keeping))

    @cached_property
    def geolocation_typed(self) -> DataFrame:
        return silver.geolocation_typed(self._feed("geolocation"))

    @cached_property
    def silver_geolocation_zip_agg(self) -> DataFrame:
        return silver.geolocation_zip_agg(self.geolocation_typed)

    def _items_of_orders(self) -> DataFrame:
        """The items as they are grouped by order."""
        return self.silver_order_items

    @cached_property
    def silver_order_service(self) -> DataFrame:
        return silver.order_service(
            self.silver_orders,
            self.silver_customers,
            self._items_of_orders(),
            self.silver_payments_order_agg,
            self.silver_reviews_order_agg,
            self.silver_sellers,
            self.silver_geolocation_zip_agg,
        )

    @cached_property
    def silver_order_service_base(self) -> DataFrame:
        return silver.order_service_base(self.silver_order_service)

    # gold

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.silver_order_service)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.silver_order_service)

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.silver_products, self.silver_category_translation)

    @cached_property
    def dim_seller(self) -> DataFrame:
        return gold.dim_seller(self.silver_sellers, self.silver_order_items)

    @cached_property
    def dim_location(self) -> DataFrame:
        return gold.dim_location(self.silver_order_service)

    @cached_property
    def dim_service_band(self) -> DataFrame:
        return gold.dim_service_band(self.silver_order_service)

    @cached_property
    def fact_order_service(self) -> DataFrame:
        return gold.fact_order_service(self.silver_order_service)

    @cached_property
    def fact_order_item_sales(self) -> DataFrame:
        return gold.fact_order_item_sales(self.silver_order_items, self.silver_order_service)

    @cached_property
    def mart_logistics_performance(self) -> DataFrame:
        return gold.mart_logistics_performance(self.fact_order_service)

    @cached_property
    def mart_service_risk(self) -> DataFrame:
        return gold.mart_service_risk(self.mart_logistics_performance)

    @cached_property
    def mart_customer_experience(self) -> DataFrame:
        return gold.mart_customer_experience(self.fact_order_service)

    @cached_property
    def mart_monthly_operations(self) -> DataFrame:
        return gold.mart_monthly_operations(self.fact_order_service)


BRONZE_TABLES = tuple(feed.table for feed in FEEDS.values())
# In the order in which each layer is written: a table only reads those before it.
SILVER_TABLES = (
    "silver_customers",
    "silver_sellers",
    "silver_category_translation",
    "silver_products",
    "silver_orders",
    "silver_quarantine_orders",
    "silver_order_items",
    "silver_quarantine_order_items",
    "silver_payments_order_agg",
    "silver_reviews_order_agg",
    "silver_geolocation_zip_agg",
    "silver_order_service",
    "silver_order_service_base",
)
GOLD_TABLES = (
    "dim_date",
    "dim_customer",
    "dim_product",
    "dim_seller",
    "dim_location",
    "dim_service_band",
    "fact_order_service",
    "fact_order_item_sales",
    "mart_logistics_performance",
    "mart_service_risk",
    "mart_customer_experience",
    "mart_monthly_operations",
)
LAYERS = {"bronze": BRONZE_TABLES, "silver": SILVER_TABLES, "gold": GOLD_TABLES}


LAYER_OF = {name: layer for layer, names in LAYERS.items() for name in names}
#: Items that an order may have and still be grouped in one task without a step before the shuffle.
MOST_ITEMS = 10_000
#: Tables that may well be empty.
MAY_BE_EMPTY = ("silver_quarantine_orders", "silver_quarantine_order_items")


class WrittenLake(Lake):
    """A lake whose tables are read from where they were written: a folder, or any other store."""

    _keeping = {"once": keep_one_of_repeated}
    _keeping_items = {"once": keep_one_packed}

    def __init__(self, spark: SparkSession, where: str | Store):
        self.store = FolderStore(where) if isinstance(where, str) else where
        super().__init__(lambda name: self.store.read(spark, "bronze", FEEDS[name].table))
        self._spark = spark
        self.root = getattr(self.store, "root", None)
        #: Rows per table, as counted by the writes of ``build``.
        self.counts: dict[str, int] = {}

    def table(self, name: str) -> DataFrame:
        return self.store.read(self._spark, LAYER_OF[name], name)

    def pin(self, name: str) -> None:
        """Let later tables read the written one instead of its plan."""
        self.__dict__[name] = self.table(name)

    def tables(self) -> list[tuple[str, str, DataFrame]]:
        return [(layer, name, self.table(name)) for layer, names in LAYERS.items() for name in names]

    def judge(self, entity: str) -> None:
        """Write the typed rows once, partitioned by verdict; both sides then read their own files.

        For a bronze table that is dear to read. ``build`` reads its bronze tables once per side
        instead, which spares a copy of all their rows.
        """
        typed, rules, once = _JUDGED[entity]
        rows = judged(getattr(self, typed), rules())
        name = f"judged_{entity}"
        self.store.write(rows, "silver", name, by=[VERDICT])
        written = self.store.read(self._spark, "silver", name, schema=rows.schema)
        self.__dict__[f"silver_{entity}"] = once(accepted_side(written))
        self.__dict__[f"silver_quarantine_{entity}"] = rejected_side(written)

    def _items_of_orders(self) -> DataFrame:
        """Moved to their orders as they are, if no order can have many of them: item numbers are unique
        in an order, so it has no more items than the range of all item numbers.

        A row is a third of the half-made totals and sets of an order, of which there are nearly as
        many as items where those of an order do not lie together. Otherwise the totals are combined
        before the shuffle, so that an order of many items does not fill a task.
        """
        items, number = self.silver_order_items, F.col("order_item_id").cast("bigint")
        most = items.agg((F.max(number) - F.min(number) + 1).alias("most")).first()["most"]
        return items.repartition("order_id") if most is not None and most <= MOST_ITEMS else items

    def gate(self, layer: str) -> DataFrame:
        """The layer's tables with their rows and ``present`` or ``missing``."""
        return table_gate(self._spark, layer, LAYERS[layer], self.counts)


_JUDGED = {
    "orders": ("orders_typed", silver.order_rules, silver.orders_once),
    "order_items": ("items_typed", silver.item_rules, silver.order_items_once),
}


def table_gate(spark: SparkSession, layer: str, expected: Sequence[str], counts: dict[str, int]) -> DataFrame:
    """One row per expected table. A table without rows counts as missing, but for quarantines."""
    rows = []
    for name in expected:
        n = counts.get(name)
        present = n is not None and (n > 0 or name in MAY_BE_EMPTY)
        rows.append((layer, name, n or 0, "present" if present else "missing"))
    return spark.createDataFrame(rows, "layer string, table_name string, row_count bigint, status string")


def require_tables(layer: str, expected: Sequence[str], counts: dict[str, int]) -> None:
    """Stop if a table of the layer was not written or has no rows, and name all of them."""
    missing = [n for n in expected if n not in counts or (counts[n] == 0 and n not in MAY_BE_EMPTY)]
    if missing:
        raise ValueError(f"{layer}: {len(missing)} missing or empty tables: " + ", ".join(missing))


def build(
    spark: SparkSession,
    feed: Callable[[str], DataFrame],
    where: str | Store,
    run_id: str,
    run_ts: datetime | None = None,
) -> WrittenLake:
    """Write all bronze, silver and gold tables under a folder or into a catalog and return them.

    Rows are counted by the writes themselves. After each layer the build stops if one of its
    tables has none, before anything is built on it; after the last one it stops if a column has
    no meaning in the dictionary. Both sides of the quarantine come straight from bronze, by the
    same rules. What a write shuffles is removed when it ends.
    """
    lake = WrittenLake(spark, where)
    with shuffles_removed(spark):
        for source in FEEDS.values():
            stamped = bronze_plans.stamped(feed(source.name), source, run_id, run_ts)
            lake.counts[source.table] = lake.store.write(stamped, "bronze", source.table)
        require_tables("bronze", BRONZE_TABLES, lake.counts)
        stamps = {"silver": with_silver_lineage, "gold": with_gold_lineage}
        for layer, stamp in stamps.items():
            for name in LAYERS[layer]:
                lake.counts[name] = lake.store.write(stamp(getattr(lake, name), run_id, run_ts), layer, name)
                if not name.startswith("silver_quarantine"):
                    lake.pin(name)
            require_tables(layer, LAYERS[layer], lake.counts)
    for name in LAYER_OF:
        lake.pin(name)
    require_declared([(layer, name, df.columns) for layer, name, df in lake.tables()])
    return lake


def require_declared(tables: Sequence[tuple[str, str, Sequence[str]]]) -> None:
    """Stop if a written table has a column without a meaning, by the tables' schemas alone."""
    from bazarlake.plans import glossary  # the glossary is written in terms of this module's layers

    unknown = [
        f"{name}.{column}"
        for _, name, columns in tables
        for column in columns
        if column not in glossary.COMMON_GLOSSARY
        and not (column in glossary.TABLE_COLUMNS.get(name, ()) and glossary.GLOSSARY.get(column, "").strip())
    ]
    if unknown:
        raise ValueError(f"{len(unknown)} undocumented columns: " + ", ".join(unknown))
