"""Reading and creating the customer, prediction and performance tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbline.fixed_values import KEY
from ebbline.functions.expressions import named
from ebbline.operators.keyed import add_defaults
from ebbline.schemas import ATTRIBUTE_NAMES, CHURN_TABLE, CUSTOMERS, MODEL_PERFORMANCE, PREDICTIONS

TABLES = {"customers": CUSTOMERS, "churn_predictions": PREDICTIONS, "model_performance": MODEL_PERFORMANCE}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The headed churn CSV with its fixed schema."""
    return spark.read.schema(CHURN_TABLE).option("header", True).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def read_jdbc(
    spark: SparkSession, table: str, options: dict[str, str], split_by: str, bounds: tuple[str, str], parts: int
) -> DataFrame:
    """A table of a configured database, read by `parts` tasks over ranges of `split_by` between `bounds`.

    The bounds only place the ranges; rows outside are read, too. Spark pushes filters and columns down.
    Credentials come as options.
    """
    ranges = {"partitionColumn": split_by, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**options, **ranges).option("dbtable", table).load()


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], connections: int, batch_rows: int = 10_000) -> None:
    """Append to a table of a configured database, in batches, over `connections` connections at most."""
    df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch_rows).option(
        "numPartitions", connections
    ).mode("append").save()


def create_tables(spark: SparkSession, root: str, prefix: str = "") -> dict[str, str]:
    """Create the three tables under `root` if absent; returns their names."""
    names = {}
    for name, schema in TABLES.items():
        names[name] = prefix + name
        if not spark.catalog.tableExists(names[name]):
            spark.catalog.createTable(names[name], path=f"{root}/{names[name]}", source="parquet", schema=nullable(schema))
    return names


def nullable(schema: StructType) -> StructType:
    out = StructType()
    for field in schema.fields:
        out.add(field.name, field.dataType, True)
    return out


def customers_from(records: DataFrame, at: Column) -> DataFrame:
    """Records as rows of the customers table, active and stamped with `at`."""
    empty = records.sparkSession.createDataFrame([], CUSTOMERS)
    return add_defaults(records, empty, {"active": F.lit(True), "created_at": at, "updated_at": at})


def active_customers(customers: DataFrame) -> DataFrame:
    """Key and attributes of the active customers."""
    return customers.where("active").select(KEY, *[named(c) for c in ATTRIBUTE_NAMES])


def reload_customers(customers: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Replace the customers table by `customers` and empty the predictions that depend on it.

    Both go into a new version folder under `root`, and the pointer to the current version moves last, by a
    single row that is appended. A failure before leaves the old version current; `customers` may be read from it.
    """
    spark = customers.sparkSession
    version = uuid.uuid4().hex
    customers.write.parquet(f"{root}/version={version}/customers")
    spark.createDataFrame([], PREDICTIONS).write.parquet(f"{root}/version={version}/churn_predictions")
    pointer = spark.createDataFrame([(version,)], "version string").withColumn("since", F.current_timestamp())
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/current")
    return current_table(spark, root, "customers"), current_table(spark, root, "churn_predictions")


def current_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table of the version that the newest pointer row names."""
    version = spark.read.parquet(f"{root}/current").orderBy(F.desc("since"), "version").head()["version"]
    return spark.read.parquet(f"{root}/version={version}/{name}")
