"""Writers of landed ERP sections and of the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import month_of
from ..operators.asof import MONTH, monthly_intervals
from ..operators.gates import GateError, RowRule, Watch
from ..schemas import BUCKET_KEYS, ERP_SECTIONS, INTERVALS, INTERVAL_SCHEMA, MODEL, MODEL_KEYS, MONTH_PARTITIONS
from ..session import delete
from .documents import NO_LIST, same_chunks, split_document
from .readers import LAYOUT, SECTION_FOLDER, Erp, catalog_name, read_erp

# Row order inside the files, for tight min/max statistics.
SORTED_BY = {
    "fact_sales": ("product_id", "sold_at"),
    "fact_inventory": ("product_id", "store_id", "date"),
    "fact_product_cost": ("product_id", "effective_date"),
    "fact_exchange_rate": ("rate_date", "currency"),
}


#: Records of a file of landed lines, which one task parses.
LINES_PER_FILE = 500_000


def land_erp(erp: Erp, root: str) -> None:
    """Write each ERP section once as Parquet, spread over files of even size."""
    for name in ERP_SECTIONS:
        getattr(erp, name).hint("rebalance").write.mode("overwrite").parquet(f"{root}/{name}")


def land_document(spark: SparkSession, path: str, root: str) -> Erp:
    """Land a single ERP document: all sections are cut into JSON Lines, which are then stored as Parquet.

    ``path`` is a file, or a folder of the parts of one document (see :func:`documents.split_document`). The document is
    never held or read whole, by a task or the driver: its chunks and the parsing of its records are spread over tasks. An absent
    section or field raises ``GateError``, a malformed document or record fails the job.
    """
    lines = f"{root}/_lines"
    with same_chunks(spark):
        found = split_document(spark, path, {name: where for name, (where, _) in ERP_SECTIONS.items()})
        found.write.mode("overwrite").partitionBy(SECTION_FOLDER).option("maxRecordsPerFile", LINES_PER_FILE).text(lines)
    landed = spark.read.text(lines)
    no_list: dict[str, bool] = {}
    if SECTION_FOLDER in landed.columns:  # else there is no section at all
        no_list = {row[0]: row[1] for row in landed.groupBy(SECTION_FOLDER).agg(F.max(F.col("value") == NO_LIST)).collect()}
    for name, (where, _) in ERP_SECTIONS.items():
        if name not in no_list:
            raise GateError(f"the ERP document has no section {where}")
        if no_list[name]:
            raise GateError(f"the ERP document's section {where} is no list")
    land_erp(read_erp(spark, lines, "lines"), root)
    return read_erp(spark, root, "parquet")


def write_model(
    model: Mapping[str, DataFrame],
    root: str,
    rules: Mapping[str, Sequence[RowRule]] | None = None,
    buckets: int | None = None,
) -> None:
    """Overwrite every table of the model under ``root``, and the intervals of its costs.

    The large facts are partitioned by month. REBALANCE lets the adaptive planner merge small
    months and split large ones, so no month is one task and no task writes a file per month.

    ``rules`` by table are counted in the pass that writes it; a broken one raises ``GateError`` after that pass.

    ``buckets`` also buckets the large facts by (store, product), so that turnover groups and joins them without a
    shuffle. All rows of a pair and month then go through one task and file: choose it where a pair's rows are
    bounded, as in a daily panel, and not where a pair, or the sales without a store of a product, may hold much of a fact.
    """
    spark = next(iter(model.values())).sparkSession if model else None
    for name in MODEL_KEYS:
        if name not in model:
            continue
        watch = Watch(model[name], (rules or {}).get(name, ()))
        df = watch.frame
        order = [c for c in SORTED_BY.get(name, ()) if c in df.columns]
        if name in MONTH_PARTITIONS:
            day, month = MONTH_PARTITIONS[name]
            df = df.withColumn(month, month_of(day))
            layout = f"{root}/{LAYOUT}/{name}"
            delete(df.sparkSession, layout)  # a write that stops halfway leaves a table that is read without buckets
            if buckets:
                _write_buckets(df, f"{root}/{name}", month, buckets, order)
                spark.createDataFrame([(buckets,)], "buckets INT").coalesce(1).write.parquet(layout)
            else:
                df = df.hint("rebalance", F.col(month)).sortWithinPartitions(month, *order)
                df.write.mode("overwrite").partitionBy(month).parquet(f"{root}/{name}")
        else:
            df = df.sortWithinPartitions(*order) if order else df
            df.write.mode("overwrite").parquet(f"{root}/{name}")
        watch.check()
    if "fact_sales" in model and "fact_product_cost" in model:
        write_intervals(spark, root)


def _write_buckets(df: DataFrame, path: str, month: str, buckets: int, order: Sequence[str]) -> None:
    """One task per bucket, so that a month has one file per bucket; the catalog entry is of no use after the write."""
    spark, name = df.sparkSession, catalog_name(path) + "_write"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    delete(spark, path)  # a table is only created over an empty folder
    writer = df.repartition(buckets, *BUCKET_KEYS).write.partitionBy(month).bucketBy(buckets, *BUCKET_KEYS)
    writer.sortBy(*order).format("parquet").option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def write_intervals(spark: SparkSession, root: str) -> None:
    """Store the costs of a stored model as intervals, over the months that its sales have.

    The months are partition values, so the facts are not read. A history has few rows per product and month.
    """
    sales = spark.read.schema(f"{MODEL['fact_sales']}, sale_month DATE").parquet(f"{root}/fact_sales")
    sold = sales.agg(F.min("sale_month").alias("a"), F.max("sale_month").alias("b")).first()
    if sold.a is None:
        rows = spark.createDataFrame([], INTERVAL_SCHEMA)
    else:
        last = (sold.b.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        costs = spark.read.parquet(f"{root}/fact_product_cost")
        rows = monthly_intervals(costs, ["product_id"], "effective_date", ["cost_mxn"], (sold.a, last))
    rows = rows.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, "product_id", "_from")
    rows.write.mode("overwrite").partitionBy(MONTH).parquet(f"{root}/{INTERVALS}")
