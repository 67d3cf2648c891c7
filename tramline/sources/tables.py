"""Stored tables: readers that prune folders, and the seed rows of an empty store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.clock import AsOf, recent
from tramline.functions.measures import row_count
from tramline.schemas import TABLES
from tramline.sinks.commits import unpublished


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def create_tables(spark: SparkSession, root: str) -> None:
    """Empty folders for the tables that a store does not have yet."""
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(table_path(root, name))


def read_table(
    spark: SparkSession, root: str, name: str, as_of: AsOf = None, hours: float | None = None,
) -> DataFrame:
    """A stored table with its declared schema, whole batches only; a window also prunes its date folders."""
    df = spark.read.schema(TABLES[name]).parquet(table_path(root, name))
    for batch in unpublished(spark, root.rstrip("/"), name):
        df = df.where(~F.col("_metadata.file_name").startswith(batch))
    return recent(df, as_of, hours)


def read_newest(spark: SparkSession, root: str, name: str, n: int) -> DataFrame:
    """The days of a fact table that are certain to hold its ``n`` newest rows.

    The rows per day come from the file footers alone, one number per calendar
    day. Every row of a later day is newer than any row of an earlier one, so
    the days from the newest on that hold ``n`` rows between them are enough.
    """
    df = read_table(spark, root, name)
    per_day = df.groupBy("partition_date").agg(row_count().alias("rows")).orderBy(F.desc("partition_date"))
    held, first = 0, None
    for day in per_day.collect():
        held, first = held + day["rows"], day["partition_date"]
        if held >= n:
            break
    return df if first is None else df.where(F.col("partition_date") >= first)


#: Days that are looked up one by one; rows of more days are searched for in the whole table.
MOST_DAYS = 400


def read_days(spark: SparkSession, root: str, name: str, column: str, rows: DataFrame) -> DataFrame:
    """The part of a table that lies in the day folders of ``rows``; only those folders are listed.

    One value per day comes to the driver. ``column`` names the outermost folders.
    """
    days = [r[0] for r in rows.select(column).distinct().limit(MOST_DAYS + 1).collect()]
    if len(days) > MOST_DAYS:
        return read_table(spark, root, name)
    top = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, name))
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f"{table_path(root, name)}/{column}={day}" for day in days if day is not None]
    there = [f for f in folders if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f))]
    if not there:
        return spark.createDataFrame([], TABLES[name])
    return spark.read.schema(TABLES[name]).option("basePath", table_path(root, name)).parquet(*there)


# The routes of a new store, in display order.
_SEED_COLUMNS = (
    "id string, route_name string, route_type int, route_color string, route_text_color string, "
    "route_sort_order int, route_long_name string, route_desc string")
SEED_ROUTES = [
    ("Red", "Red Line", 1, "DA291C", "FFFFFF", 1, "Red Line Subway",
     "Rapid transit service between Alewife and Ashmont/Braintree"),
    ("Orange", "Orange Line", 1, "FF8C00", "FFFFFF", 2, "Orange Line Subway",
     "Rapid transit service between Oak Grove and Forest Hills"),
    ("Blue", "Blue Line", 1, "003DA5", "FFFFFF", 3, "Blue Line Subway",
     "Rapid transit service between Wonderland and Bowdoin"),
    ("Green-B", "Green Line B", 0, "00843D", "FFFFFF", 4, "Green Line B Branch",
     "Light rail service between Government Center and Boston College"),
    ("Green-C", "Green Line C", 0, "00843D", "FFFFFF", 5, "Green Line C Branch",
     "Light rail service between Government Center and Cleveland Circle"),
    ("Green-D", "Green Line D", 0, "00843D", "FFFFFF", 6, "Green Line D Branch",
     "Light rail service between Government Center and Riverside"),
    ("Green-E", "Green Line E", 0, "00843D", "FFFFFF", 7, "Green Line E Branch",
     "Light rail service between Government Center and Heath Street"),
    ("CR-Fairmount", "Fairmount Line", 2, "000000", "FFFFFF", 8, "Fairmount Commuter Rail Line",
     "Commuter rail service between South Station and Readville"),
]


def seeded(routes: DataFrame) -> DataFrame:
    """The seed rows when ``routes`` is empty, else nothing."""
    names = [c.split()[0] for c in _SEED_COLUMNS.split(", ")]
    row = lambda values: F.struct(*[F.lit(v).alias(n) for n, v in zip(names, values)])
    held = routes.limit(1).agg(row_count().alias("n"))
    return held.where("n = 0").select(F.inline(F.array(*[row(r) for r in SEED_ROUTES])))
