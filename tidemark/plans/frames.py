"""The standard tables of the model, built lazily from a data directory.

Every registered query starts here, so each reads the driver's parquet (through the adapter)
and its work grows with the data. Broadcast decisions for the two dimensions are checked once
per directory (bounded count) and reused by all queries on it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ensure_defaults
from tidemark.sources import testdata
from tidemark.operators import alerts, enrich, windows

_SMALL: dict[tuple[str, str], bool] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = ensure_defaults(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def _small(self, name: str, df: DataFrame) -> bool:
        key = (self.sf_dir, name)
        if key not in _SMALL:
            _SMALL[key] = enrich.fits_broadcast(df)
        return _SMALL[key]

    @cached_property
    def raw(self) -> DataFrame:
        return testdata.orders_raw(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:
        return testdata.product_catalog(self.spark, self.sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return testdata.customer_profile(self.spark, self.sf_dir)

    @property
    def small_products(self) -> bool:
        return self._small("products", self.products.select("product_id", "product_name",
                                                            "brand", "category"))

    @property
    def small_customers(self) -> bool:
        return self._small("customers", self.customers.select("customer_id", "customer_name",
                                                              "loyalty_tier"))

    def enriched_with(self, on_miss: str = "null", flags: bool = False) -> DataFrame:
        return enrich.enrich(self.raw, self.customers, self.products, on_miss=on_miss,
                             small_customers=self.small_customers,
                             small_products=self.small_products, flags=flags)

    @cached_property
    def enriched(self) -> DataFrame:
        return self.enriched_with("null")

    def revenue(self, width: str = "5 minutes") -> DataFrame:
        return windows.revenue_by_window(self.raw, self.products, width,
                                         small_products=self.small_products)

    @cached_property
    def revenue_5min(self) -> DataFrame:
        return self.revenue("5 minutes")

    @cached_property
    def city_revenue_5min(self) -> DataFrame:
        return windows.city_revenue_by_window(self.raw, "5 minutes")

    @cached_property
    def kpis_1min(self) -> DataFrame:
        return windows.kpis(self.raw, "1 minute")

    @cached_property
    def high_value(self) -> DataFrame:
        return alerts.high_value(self.enriched)

    @cached_property
    def suspicious(self) -> DataFrame:
        return alerts.suspicious(self.enriched)
