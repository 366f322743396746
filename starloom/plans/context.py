"""Shared building blocks of the registered queries: the two-batch scenario over the
driver tables (feeds of batch 1 at D1, feeds of batch 2 at D2)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from starloom.operators import conform, facts, scd2
from starloom.session import scratch_path, write_staged
from starloom.sources import derived
from starloom.sources.derived import BATCH1_DATE, BATCH2_DATE
from starloom.sources.testdata import Tables


FEED_NAMES = ("customer", "customer_location", "customer_info", "product_categories", "product_info", "sales_details")


class Scenario:
    """Lazily built frames of the two-batch scenario for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)
        self._feeds: dict[tuple[str, int], DataFrame] = {}

    # ---- raw feeds -------------------------------------------------------------
    def feed(self, name: str, batch: int) -> DataFrame:
        """One raw feed of a batch. The sales feed, read by several passes (prefix
        check, date codes, lookups, key sampling), is landed once as Parquet, like the
        batch job lands its inputs, with a mark of the rows that batch 1 has, too; the
        small feeds stay lazy."""
        key = (name, batch)
        if key not in self._feeds:
            if name == "sales_details":
                marked = self._landed_sales
                rows = marked.where(derived.IN_BATCH1) if batch == 1 else marked
                self._feeds[key] = rows.drop(derived.IN_BATCH1)
            else:
                self._feeds[key] = self._build_feed(name, batch)
        return self._feeds[key]

    @cached_property
    def _landed_sales(self) -> DataFrame:
        return write_staged(derived.crm_sales_marked(self.t), scratch_path(self.spark, "landed-sales_details"))

    def _build_feed(self, name: str, batch: int) -> DataFrame:
        t = self.t
        return {
            "customer_info": lambda: derived.crm_customer(t, batch),
            "customer": lambda: derived.erp_customer(t, batch),
            "customer_location": lambda: derived.erp_location(t, batch),
            "product_info": lambda: derived.crm_product(t, batch),
            "product_categories": lambda: derived.product_categories(self.spark),
        }[name]()

    # ---- conformed dimensions ----------------------------------------------------
    def customers(self, batch: int) -> DataFrame:
        p = BATCH1_DATE if batch == 1 else BATCH2_DATE
        return conform.latest_customers(
            self.feed("customer_info", batch), self.feed("customer", batch), self.feed("customer_location", batch), p
        )

    def products(self, batch: int) -> DataFrame:
        return conform.conform_product(self.feed("product_info", batch), self.feed("product_categories", batch))

    # ---- SCD2 ------------------------------------------------------------------
    @cached_property
    def customer_snapshot_1(self) -> DataFrame:
        """dim_customer after the initial load of batch 1."""
        return scd2.initial_load(self.customers(1), scd2.CUSTOMER, BATCH1_DATE)

    @cached_property
    def product_snapshot_1(self) -> DataFrame:
        return scd2.initial_load(self.products(1), scd2.PRODUCT, BATCH1_DATE)

    @cached_property
    def customer_delta_2(self) -> scd2.Delta:
        return scd2.apply_batch(self.customer_snapshot_1, self.customers(2), scd2.CUSTOMER, BATCH2_DATE)

    @cached_property
    def product_delta_2(self) -> scd2.Delta:
        return scd2.apply_batch(self.product_snapshot_1, self.products(2), scd2.PRODUCT, BATCH2_DATE)

    # ---- a first load of the full feeds ----------------------------------------
    @cached_property
    def customer_snapshot_full(self) -> DataFrame:
        """dim_customer after a first load of all members."""
        return scd2.initial_load(self.customers(2), scd2.CUSTOMER, BATCH2_DATE)

    @cached_property
    def product_snapshot_full(self) -> DataFrame:
        return scd2.initial_load(self.products(2), scd2.PRODUCT, BATCH2_DATE)

    @cached_property
    def dim_date_full(self) -> DataFrame:
        return conform.dim_date_build(self.feed("sales_details", 2))

    def fact_full(self, **options) -> DataFrame:
        """fact_sales of all sales, looked up in dimensions loaded from the full feeds."""
        self.feed("sales_details", 2)
        self.prepare("customer_snapshot_full", "product_snapshot_full", "dim_date_full")
        return facts.build_fact_sales(
            self.feed("sales_details", 2),
            self.customer_snapshot_full,
            self.product_snapshot_full,
            self.dim_date_full,
            BATCH2_DATE,
            **options,
        )

    # ---- dates and facts -------------------------------------------------------
    @cached_property
    def dim_date_1(self) -> DataFrame:
        return conform.dim_date_build(self.feed("sales_details", 1))

    def prepare(self, *names: str) -> None:
        """Build independent cached frames concurrently (each is its own Spark jobs)."""
        from starloom.plans.parallel import run_parallel

        run_parallel({n: (lambda n=n: getattr(self, n)) for n in names})

    def fact_batch_1(self, **options) -> DataFrame:
        """fact_sales of batch 1, looked up after the batch-1 dimension loads."""
        self.feed("sales_details", 1)
        self.prepare("customer_snapshot_1", "product_snapshot_1", "dim_date_1")
        return facts.build_fact_sales(
            self.feed("sales_details", 1),
            self.customer_snapshot_1,
            self.product_snapshot_1,
            self.dim_date_1,
            BATCH1_DATE,
            **options,
        )

    @cached_property
    def fact_1(self) -> DataFrame:
        return self.fact_batch_1()

    @cached_property
    def new_dates_2(self) -> DataFrame:
        """Batch-2 dates not yet in the batch-1 dimension, keys continuing."""
        from starloom.operators import incremental
        from starloom.operators.keys import assign_dense_keys, next_key_start

        rows = conform.dim_date_rows(self.feed("sales_details", 2))
        fresh = incremental.dates_not_loaded(rows, self.dim_date_1)
        start = next_key_start(self.dim_date_1, "date_sk", "DATE")
        return assign_dense_keys(fresh, conform.date_order(), "date_sk", "DATE", start)

    @cached_property
    def dim_date_2(self) -> DataFrame:
        return self.dim_date_1.unionByName(self.new_dates_2)

    def fact_rows_2(self, sales: DataFrame | None = None, packed: bool = False) -> DataFrame:
        """Unkeyed batch-2 fact rows against the dimensions after the batch-2 merge."""
        return facts.build_fact_sales(
            sales if sales is not None else self.feed("sales_details", 2),
            self.customer_delta_2.merged,
            self.product_delta_2.merged,
            self.dim_date_2,
            BATCH2_DATE,
            with_keys=False,
            packed=packed,
        )


# ---- a warehouse loaded by the real batch job (shared by the queries of one app) ----------

_WAREHOUSES: dict[tuple[str, str], str] = {}


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Run batch 1 (D1) and batch 2 (D2) of the scenario into a fresh warehouse folder
    under the shared checkpoint folder, once per application and scale factor."""
    from starloom.plans.batch import run_batch

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        wh = scratch_path(spark, "warehouse")
        s = Scenario(spark, sf_dir)
        for batch, p in ((1, BATCH1_DATE), (2, BATCH2_DATE)):
            feeds = {n: s.feed(n, batch) for n in FEED_NAMES}
            run_batch(spark, feeds, wh, p, landed=True)
        _WAREHOUSES[key] = wh
    return _WAREHOUSES[key]
