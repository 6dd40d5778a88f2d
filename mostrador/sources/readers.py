"""Readers of the raw feeds and of the stored star schema. All are lazy."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import text_is_missing
from ..operators.gates import GateError, require_columns
from ..schemas import BUCKET_KEYS, ERP_SECTIONS, FX_RATES, INTERVALS, INTERVAL_SCHEMA, MODEL, MONTH_PARTITIONS, POS_SALES


@dataclass(frozen=True)
class Erp:
    """The four tables of the ERP export."""

    stores: DataFrame
    mappings: DataFrame
    products: DataFrame
    snapshots: DataFrame


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header. Columns are matched by name, extra ones are ignored; all stay text.

    Quotes inside a quoted field are doubled. Several files must share one header.
    """
    wanted = [f.name for f in T.StructType.fromDDL(schema)]
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"')
    raw = reader.option("mode", "FAILFAST").csv(path)
    return raw.select(*[text_is_missing(F.col(c)).alias(c) for c in raw.columns if c in wanted])


def read_pos(spark: SparkSession, path: str) -> DataFrame:
    """Point-of-sale transactions (CSV)."""
    return _csv(spark, path, POS_SALES)


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """Daily exchange rates (CSV)."""
    return _csv(spark, path, FX_RATES)


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Web-shop orders (Parquet)."""
    return spark.read.parquet(path)


#: Folders of the sections of a document that was cut into JSON Lines are named ``section=<name>``.
SECTION_FOLDER = "section"

#: Records of a JSON Lines section that are looked at before its whole content is.
FIRST_RECORDS = 1000


def _nested(path: str, rows: str) -> T.StructType:
    """Schema of a document that holds only the array at ``path``."""
    kind: T.DataType = T.ArrayType(T.StructType.fromDDL(rows))
    for name in reversed(path.split(".")):
        kind = T.StructType([T.StructField(name, kind)])
    return kind


def section(document: DataFrame, path: str) -> DataFrame:
    """One row per element of an array of structs inside a nested document."""
    return document.select(F.explode(path).alias("_row")).select("_row.*")


def _fields(rows: str) -> set[str]:
    return {f.name for f in T.StructType.fromDDL(rows)}


def _require_fields(found: T.DataType, rows: str, name: str) -> None:
    """Every field occurs in some record; a section without records has none to show."""
    if isinstance(found, T.StructType) and (absent := sorted(_fields(rows) - set(found.names))):
        raise GateError(f"{name} is missing required columns: {absent}")


def _require_sections(document: T.StructType) -> None:
    """The document has each section, as an array of records with the fields the star schema needs."""
    for path, rows in ERP_SECTIONS.values():
        kind: T.DataType = document
        for step in path.split("."):
            if not isinstance(kind, T.StructType) or step not in kind.names:
                raise GateError(f"the ERP document has no section {path}")
            kind = kind[step].dataType
        if not isinstance(kind, T.ArrayType):
            raise GateError(f"the ERP document's section {path} is no list")
        _require_fields(kind.elementType, rows, path)


def _require_lines(spark: SparkSession, where: str, rows: str, name: str) -> None:
    """Fields of a JSON Lines section: by its first records, by all of them only if a field is not among those."""
    lines = spark.read.text(where).where("trim(value) <> ''")
    first = [row.value for row in lines.limit(FIRST_RECORDS).collect()]
    try:
        found = {key for line in first for key in json.loads(line)}
    except ValueError:
        return  # a malformed record fails the reader, which names it
    if first and not _fields(rows) <= found:
        _require_fields(spark.read.json(where).schema, rows, name)


def _exists(spark: SparkSession, folder: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_erp(spark: SparkSession, path: str, layout: str = "document") -> Erp:
    """The ERP export. An absent section or field raises ``GateError`` here, by its name.

    ``layout="document"``: one JSON document; its structure is looked up once, and each section is parsed with a
    schema that holds that section only. That holds the document in one task, so large exports should be landed with
    :func:`writers.land_document`, which reads them once and piece by piece, and read as ``layout="parquet"``, or
    delivered as JSON Lines (``layout="lines"``), both with one folder per section under ``path``.
    """
    if layout == "document":
        _require_sections(spark.read.option("multiLine", True).option("mode", "FAILFAST").json(path).schema)

    def one(name: str) -> DataFrame:
        where, rows = ERP_SECTIONS[name]
        if layout == "document":
            reader = spark.read.schema(_nested(where, rows)).option("multiLine", True)
            return section(reader.option("mode", "FAILFAST").json(path), where)
        if layout == "lines":
            folder = f"{path}/{name}"
            if not _exists(spark, folder) and _exists(spark, cut := f"{path}/{SECTION_FOLDER}={name}"):
                folder = cut
            _require_lines(spark, folder, rows, where)
            return spark.read.schema(rows).option("mode", "FAILFAST").json(folder)
        if layout == "parquet":
            require_columns(spark.read.parquet(f"{path}/{name}"), _fields(rows), where)
            return spark.read.schema(rows).parquet(f"{path}/{name}")
        raise ValueError(f"unknown layout {layout!r}")

    return Erp(**{name: one(name) for name in ERP_SECTIONS})


def read_sources(
    spark: SparkSession, sales: str, ecommerce: str, inventory: str, exchange_rates: str, erp_layout: str = "document"
) -> dict[str, DataFrame | Erp]:
    """All four feeds; a missing path fails here with Spark's PATH_NOT_FOUND."""
    return {
        "sales": read_pos(spark, sales),
        "ecommerce": read_orders(spark, ecommerce),
        "inventory": read_erp(spark, inventory, erp_layout),
        "exchange_rates": read_rates(spark, exchange_rates),
    }


#: Folder beside the model that holds the number of buckets of each bucketed fact.
LAYOUT = "_layout"


def catalog_name(path: str) -> str:
    """A name for a stored table in the session's catalog, the same for the same path."""
    return "mostrador_" + hashlib.md5(path.encode()).hexdigest()


def _buckets(spark: SparkSession, root: str, name: str) -> int | None:
    path = f"{root}/{LAYOUT}/{name}"
    return spark.read.schema("buckets INT").parquet(path).first().buckets if _exists(spark, path) else None


def _bucketed(spark: SparkSession, path: str, schema: str, month: str, buckets: int) -> DataFrame:
    """A bucketed fact, registered under its path's name: only a catalog entry tells Spark of buckets."""
    name, keys = catalog_name(path), ", ".join(BUCKET_KEYS)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    where = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet LOCATION '{where}' "
        f"PARTITIONED BY ({month}) CLUSTERED BY ({keys}) INTO {buckets} BUCKETS"
    )
    spark.catalog.recoverPartitions(name)
    return spark.table(name)


def read_model(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored star schema, one lazy frame per table, with the month columns of the large facts.

    A stored table that lacks a column raises ``GateError`` here.
    """

    def one(name: str) -> DataFrame:
        schema = MODEL[name]
        if name in MONTH_PARTITIONS:
            schema += f", {MONTH_PARTITIONS[name][1]} DATE"
        require_columns(spark.read.parquet(f"{root}/{name}"), _fields(schema), name)
        if name in MONTH_PARTITIONS and (buckets := _buckets(spark, root, name)):
            return _bucketed(spark, f"{root}/{name}", schema, MONTH_PARTITIONS[name][1], buckets)
        return spark.read.schema(schema).parquet(f"{root}/{name}")

    return {name: one(name) for name in MODEL}


def read_intervals(spark: SparkSession, root: str) -> DataFrame:
    """The stored costs of a model as intervals, for every report that needs costs by day."""
    return spark.read.schema(INTERVAL_SCHEMA).parquet(f"{root}/{INTERVALS}")
