"""Readers and writers for taxi-shaped data with declared schemas.

Schemas are explicit at every text source (no ``inferSchema`` pass over
the data); Parquet keeps its footer schema, raw files whose footers disagree
are brought to one schema by name, and the partitioned clean table
is read with ``pickup_month`` typed as a string partition column, so a month
filter becomes a partition filter and prunes whole directories.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ZONES_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)


# Types of raw columns whose files disagree; any other column takes the widest of its files' numeric types.
RAW_TYPES: dict[str, str] = {
    "VendorID": "bigint",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "passenger_count": "double",
}


def schema_groups(spark: SparkSession, files: list[str]) -> list[tuple[list[str], T.StructType]]:
    """``files`` in groups of Parquet files whose footers merge, each with its merged schema.

    Spark reads and merges the footers of a whole list in one distributed job;
    a list that does not merge is halved.  Files that changed type once cost a
    few such jobs (names in order of time), files that alternate one per file.
    """
    try:
        return [(files, spark.read.option("mergeSchema", "true").parquet(*files).schema)]
    except (PySparkException, Py4JJavaError) as e:
        if len(files) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
    half = len(files) // 2
    found: dict[str, tuple[list[str], T.StructType]] = {}
    for part, schema in schema_groups(spark, files[:half]) + schema_groups(spark, files[half:]):
        known = found.setdefault(schema.json(), ([], schema))
        known[0].extend(part)
    return list(found.values())


def _one_type(name: str, kinds: list[T.DataType], types: dict[str, str]) -> T.DataType:
    """The type of a column that files hold as ``kinds``."""
    if len(set(kinds)) == 1:
        return kinds[0]
    if name in types:
        return T.StructType.fromDDL(f"v {types[name]}")["v"].dataType
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return T.LongType()
    if all(isinstance(k, T.NumericType) for k in kinds):
        return T.DoubleType()
    raise ValueError(f"files hold column {name} as {sorted({k.simpleString() for k in kinds})}: name its type in `types`")


def _cast_or_name_file(column: Column, held: T.DataType, wanted: T.DataType, name: str) -> Column:
    """``column`` as ``wanted``; a value that does not survive the cast fails the job with its file's name."""
    if held == wanted:
        return column
    cast = column.try_cast(wanted)
    lost = column.isNotNull() & cast.isNull()
    if isinstance(held, T.NumericType) and isinstance(wanted, T.NumericType):
        lost = lost | ~column.eqNullSafe(cast.try_cast(held))
    text = F.concat(
        F.lit(f"column {name}: "), column.cast("string"), F.lit(f" is no {wanted.simpleString()} in "), F.col("_metadata.file_path")
    )
    return F.when(lost, F.raise_error(text).cast(wanted)).otherwise(cast)


def read_raw_trips(spark: SparkSession, glob: str, types: dict[str, str] = RAW_TYPES) -> DataFrame:
    """Raw trip Parquet files matching ``glob`` (e.g. ``.../yellow_tripdata_2024-*.parquet``).

    Footers are compared first (no data is read).  Files that agree are one
    scan.  Files that do not are one scan per distinct schema, matched by column
    name (in any case), cast and united: a column that a file lacks is NULL, a
    column of mixed types takes the one in ``types`` or the widest numeric type,
    and a value that this type cannot hold fails the job with the file's name.
    """
    files = sorted(unquote(f) for f in spark.read.parquet(glob).inputFiles())
    groups = schema_groups(spark, files) if files else []
    if len(groups) <= 1:
        return spark.read.schema(groups[0][1]).parquet(glob) if groups else spark.read.parquet(glob)
    names: dict[str, str] = {}
    kinds: dict[str, list[T.DataType]] = {}
    for _, schema in groups:
        for f in schema.fields:
            names.setdefault(f.name.lower(), f.name)
            kinds.setdefault(f.name.lower(), []).append(f.dataType)
    wanted = {low: _one_type(names[low], kinds[low], types) for low in names}

    def scan(part: list[str], schema: T.StructType) -> DataFrame:
        held = {f.name.lower(): f for f in schema.fields}
        df = spark.read.schema(schema).parquet(*part)
        return df.select(
            *(
                _cast_or_name_file(F.col(f"`{held[low].name}`"), held[low].dataType, t, names[low]).alias(names[low])
                if low in held
                else F.lit(None).cast(t).alias(names[low])
                for low, t in wanted.items()
            )
        )

    return reduce(DataFrame.union, (scan(part, schema) for part, schema in groups))


def read_zones(spark: SparkSession, path: str, schema: T.StructType = ZONES_SCHEMA) -> DataFrame:
    """Zone lookup CSV with a header row, typed by ``schema``."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_clean_trips(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned table written by :func:`write_partitioned`, month partitions as strings."""
    return spark.read.option("basePath", path).parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with ``df`` as Parquet."""
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, column: str = "pickup_month") -> None:
    """Overwrite ``path`` with ``df``, one directory per value of ``column``.

    The ``rebalance`` hint lets AQE hash rows by ``column`` while splitting
    oversized partitions and merging small ones, so each directory gets files
    of about the advisory size: no task writes a file for every month it
    happens to see, and a month holding a third of the rows is written by many
    tasks, not one.  Static overwrite: the whole directory is replaced, so
    months that vanished from the input vanish from the output too.
    """
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)
