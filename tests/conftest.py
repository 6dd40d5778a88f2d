import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mostrador.schemas import MODEL  # noqa: E402
from mostrador.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests",
        "local[4]",
        **{
            "spark_sql_shuffle_partitions": "4",
            "spark_checkpoint_dir": tempfile.mkdtemp(prefix="mostrador-tests-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def frame(spark):
    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


MODEL_SCHEMAS = MODEL | {"dim_product": "product_id STRING, product_name STRING, category STRING"}


def day(text):
    return dt.date.fromisoformat(text)


def stamp(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def model(frame):
    """Model tables from short rows; tables that are not given are empty."""

    def make(**tables):
        built = {}
        for name, schema in MODEL_SCHEMAS.items():
            rows = []
            for row in tables.get(name, []):
                row = list(row)
                for i, column in enumerate(schema.split(", ")):
                    if isinstance(row[i], str) and column.endswith(" DATE"):
                        row[i] = day(row[i])
                    elif isinstance(row[i], str) and column.endswith("TIMESTAMP_NTZ"):
                        row[i] = stamp(row[i])
                rows.append(tuple(row))
            built[name] = frame(schema, *rows)
        return built

    return make


def sale(ident, when, product, store, quantity, amount, channel="physical", currency="MXN", document="I"):
    if channel == "ecommerce":
        store, document = None, None
    return (ident, when, product, channel, store, quantity, float(amount), currency, document)


def records(df, *columns):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()]
