"""Name resolution — a database in the session catalog and one view per table.

Log tables are views over their parquet directory (explicit schema); upsert tables are views
over their merge-on-read state as of the registration: a temp view holds a resolved plan. Call
``register_tables`` again to see later writes, and before reading after compaction with expiry;
a view over files that are gone fails, it does not come out empty.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark import schemas
from tidemark.sources.log import read_log
from tidemark.sources.upsert import UpsertTable, fs_exists

LOG_TABLES = ["orders_raw", "error_events"]
UPSERT_TABLES = list(schemas.KEYS)


def register_tables(spark: SparkSession, root: str, database: str = "ecommerce") -> list[str]:
    """Create the database if needed, make it current, and (re)create temp views."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.catalog.setCurrentDatabase(database)
    names = []
    for name in LOG_TABLES:
        path = f"{root.rstrip('/')}/{name}"
        df = (read_log(spark, path, schemas.SCHEMAS[name]) if fs_exists(spark, path)
              else spark.createDataFrame([], schemas.SCHEMAS[name]))
        df.createOrReplaceTempView(name)
        names.append(name)
    for name in UPSERT_TABLES:
        UpsertTable.named(spark, root, name).read_current().createOrReplaceTempView(name)
        names.append(name)
    return names
