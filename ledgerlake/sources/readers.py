"""Readers for relational tables, documents, files, Bronze folders and change topics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.conform import convert

# The columns a topic delivers, whether it is read from a broker or from its file copy.
TOPIC = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    partition: tuple[str, int, int, int] | None = None,
    predicates: Sequence[str] = (),
) -> DataFrame:
    """Snapshot of a table; `partition` is (column, lower, upper, number of readers).

    `predicates`, as `key_ranges` makes them, give each reader its rows instead. With neither,
    one task reads the whole table, which is for small tables only.
    """
    if predicates:
        rest = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(options["url"], table, predicates=list(predicates), properties=rest)
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition:
        reader = reader.options(**jdbc_split(*partition))
    return reader.load()


def jdbc_split(column: str, lower: int, upper: int, readers: int) -> dict[str, str]:
    """Options that read a table with several connections; bounds only shape the ranges."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(readers),
    }


def key_ranges(known: DataFrame, column: str, readers: int) -> list[str]:
    """At most `readers` predicates on an integral or date column, disjoint and complete.

    Equal steps between the least and the largest key leave most readers idle where keys are
    sparse or in clusters, so the bounds are quantiles of the keys in `known`, such as the
    last snapshot. Every row of the table, also one with a newer, a smaller or a null key,
    meets exactly one predicate; only how even the ranges are depends on `known`. They are
    plain comparisons, so a database can use its index.
    """
    kind = known.schema[column].dataType
    if not isinstance(kind, T.IntegralType | T.DateType):
        raise ValueError(f"{column} is neither integral nor a date")
    steps = [i / readers for i in range(1, readers)]
    bounds = []
    if steps:
        # more accurate than a reader's share, so that no range takes the keys of several
        accuracy = max(10_000, 20 * readers)
        cut = F.percentile_approx(column, steps, accuracy)
        bounds = sorted(set(known.select(cut.alias("cut")).first().cut or ()))
    if not bounds:
        return ["1 = 1"]
    texts = [f"DATE '{bound}'" if isinstance(kind, T.DateType) else str(bound) for bound in bounds]
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(texts, texts[1:], strict=False)]
    return [f"{column} < {texts[0]} OR {column} IS NULL", *between, f"{column} >= {texts[-1]}"]


def read_documents(
    spark: SparkSession, location: str | Mapping[str, str], schema: T.StructType | None = None
) -> DataFrame:
    """Nested documents from a collection (options for its connector) or from JSON files."""
    if not isinstance(location, str):
        return spark.read.format("mongodb").options(**location).load()
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(location)


def read_variants(spark: SparkSession, location: str, name: str = "document") -> DataFrame:
    """Documents of JSON lines as variants in column `name`, beside their text in `raw`.

    A variant keeps whatever a document has, so nothing is inferred from all files before
    the job starts, and a field that is a number in one document and a text in the next is
    no error. A line that is not JSON has a null variant and is still there in `raw`.
    """
    lines = spark.read.text(location).where("trim(value) <> ''")
    return lines.select(F.try_parse_json("value").alias(name), F.col("value").alias("raw"))


def take(document: Column | str, kind: str, *paths: str) -> Column:
    """The first of the fields at `paths` that is there and can be read as `kind`, else null.

    Nested values are read as text by `kind` "string", which gives their JSON.
    """
    given = F.col(document) if isinstance(document, str) else document
    return F.coalesce(*[F.try_variant_get(given, path, kind) for path in paths])


def flatten(documents: DataFrame, fields: Mapping[str, tuple[str, ...]], name: str = "document") -> DataFrame:
    """Columns from (type, path, …) of each field; unreadable documents are left out.

    They are counted and set aside by `unreadable`.
    """
    readable = documents.where(F.col(name).isNotNull())
    return readable.select([take(name, kind, *paths).alias(to) for to, (kind, *paths) in fields.items()])


def unreadable(documents: DataFrame, name: str = "document") -> DataFrame:
    """Lines that are no documents, with the reason dead letters are written with."""
    bad = documents.where(F.col(name).isNull())
    return bad.select(F.col("raw"), F.lit("not a JSON document").alias("reason"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema, so that codes keep their zeros."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def scan_bronze(spark: SparkSession, base: str, load_date: str | None = None) -> DataFrame:
    """One day of a snapshot table, or all, with load_date.

    Sources drift: a score is a whole number on one day and has decimals on the next, a
    place is a document and then text. Days of one schema are one scan, known by one footer
    of each day; a column whose type differs between them is widened where both are numbers
    and becomes text otherwise (JSON for a nested value), which conforming reads again.
    """
    days = _days(spark, base) if load_date is None else [load_date]
    groups: dict[str, list[str]] = {}
    for day in days:
        groups.setdefault(spark.read.parquet(f"{base}/load_date={day}").schema.json(), []).append(day)
    scans = []
    for some in groups.values():
        df = spark.read.option("basePath", base).parquet(*[f"{base}/load_date={day}" for day in some])
        scans.append(df.withColumn("load_date", F.col("load_date").cast("string")))
    if not scans:
        return spark.read.parquet(base)  # the reader's own error for a missing or empty table
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), _same_types(scans))


def _days(spark: SparkSession, base: str) -> list[str]:
    location = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(location):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(location))
    return sorted(name.removeprefix("load_date=") for name in names if name.startswith("load_date="))


def _same_types(scans: Sequence[DataFrame]) -> list[DataFrame]:
    kinds: dict[str, set[T.DataType]] = {}
    for df in scans:
        for f in df.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType)
    mixed = {name: found for name, found in kinds.items() if len(found) > 1}
    out = []
    for df in scans:
        columns = {}
        for name in mixed.keys() & set(df.columns):
            if all(isinstance(kind, T.NumericType) for kind in mixed[name]):
                whole = all(isinstance(kind, T.IntegralType) for kind in mixed[name])
                columns[name] = F.col(name).cast("long" if whole else "double")
            else:
                columns[name] = convert(F.col(name), df.schema[name].dataType, T.StringType())
        out.append(df.withColumns(columns) if columns else df)
    return out


def scan_bronze_day(spark: SparkSession, base: str, load_date: str) -> DataFrame:
    """One day without listing the other days' folders."""
    df = spark.read.option("basePath", base).parquet(f"{base}/load_date={load_date}")
    return df.withColumn("load_date", F.lit(load_date))


def scan_existing(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The tables that exist; a missing path is skipped, every other error is raised."""
    found = {name: if_exists(lambda p=path: spark.read.parquet(p)) for name, path in paths.items()}
    return {name: df for name, df in found.items() if df is not None}


def if_exists(scan: Callable[[], DataFrame]) -> DataFrame | None:
    """The scan's result, or None where its path does not exist."""
    try:
        return scan()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_changes(
    spark: SparkSession, options: Mapping[str, str], schema: T.StructType = TOPIC
) -> DataFrame:
    """Stream of change messages from the earliest one: a broker topic or its file copy."""
    if "kafka.bootstrap.servers" in options:
        reader = spark.readStream.format("kafka").options(**options)
        return reader.option("startingOffsets", "earliest").load()
    rest = {k: v for k, v in options.items() if k != "path"}
    return spark.readStream.schema(schema).options(**rest).parquet(options["path"])


def read_archive(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Archived topic with year/month/day folders and a declared schema."""
    days = T.StructType([T.StructField(name, T.StringType()) for name in ("year", "month", "day")])
    return spark.read.schema(T.StructType([*schema.fields, *days.fields])).parquet(path)


def register_views(frames: Mapping[str, DataFrame]) -> list[str]:
    """Make tables known to SQL by name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
