"""Warehouse access on the Spark catalog: DDL, append, insert with errors, SQL.

A table's REQUIRED fields are kept with the table (a table property), since file formats and the catalog drop
nullability. Every append reads them there and checks the rows in its own write plan.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


# Table property with the paths of the REQUIRED fields, a JSON list in schema order.
REQUIRED = "spindle.required"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(spark: SparkSession, name: str, schema: T.StructType | None,
                 partition_by: list[str] | None = None, fmt: str = "parquet", path: str | None = None) -> None:
    """Create the table from an explicit schema if it does not exist (idempotent); with ``path`` its files lie there."""
    if schema is None:
        raise ValueError("schema is required to create a table")
    if table_exists(spark, name):
        return
    empty = spark.createDataFrame([], schema)
    writer = empty.write.format(fmt).mode("ignore")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    require(spark, name, required_paths(schema))


def required_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Paths of the non-nullable fields, in schema order, also inside structs (where the struct is present)."""
    out = []
    for f in schema.fields:
        if not f.nullable:
            out.append(f"{prefix}{f.name}")
        if isinstance(f.dataType, T.StructType):
            out += required_paths(f.dataType, f"{prefix}{f.name}.")
    return out


def require(spark: SparkSession, name: str, paths: list[str]) -> None:
    """Store the REQUIRED fields with the table; this replaces those that it had."""
    told = json.dumps(paths).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{REQUIRED}' = '{told}')")


def required_of(spark: SparkSession, name: str) -> list[str]:
    """The REQUIRED fields of a table; none for tables that were made elsewhere."""
    for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect():
        if row["key"] == REQUIRED:
            return json.loads(row["value"])
    return []


def missing_required(schema: T.StructType, paths: list[str]) -> F.Column:
    """The first of ``paths`` that a row of ``schema`` leaves NULL (a JSON null counts), else NULL. A field in a
    struct that is NULL is only missed where the struct itself is not. A path that the schema lacks is always missed."""
    checks = []
    for path in paths:
        parts, kind, parent = path.split("."), schema, None
        for i, part in enumerate(parts):
            if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
                kind = None
                break
            kind = kind[part].dataType
            if i < len(parts) - 1:
                here = _column(parts[:i + 1]).isNotNull()
                parent = here if parent is None else parent & here
        if kind is None:
            checks.append(F.lit(path))
            continue
        absent = _column(parts).isNull()
        if isinstance(kind, T.VariantType):
            absent = absent | F.is_variant_null(_column(parts))
        checks.append(F.when(absent if parent is None else parent & absent, F.lit(path)))
    return F.coalesce(*checks, F.lit(None).cast("string"))


def _column(parts: list[str]) -> F.Column:
    return F.col(".".join(f"`{p}`" for p in parts))


def checked(df: DataFrame, name: str, paths: list[str]) -> DataFrame:
    """``df``, whose rows fail the query that reads them where they leave a REQUIRED field of table ``name`` NULL."""
    if not paths:
        return df
    gone = missing_required(df.schema, paths)
    error = F.raise_error(F.concat(F.lit(f"required field is null in an append to {name}: "), gone))
    first = df.columns[0]
    return df.withColumn(first, F.when(gone.isNull(), F.col(f"`{first}`")).otherwise(error.cast(df.schema[first].dataType)))


def append(df: DataFrame, name: str, schema: T.StructType | None = None,
           partition_by: list[str] | None = None) -> None:
    """Append rows, creating the table from ``schema`` when it is missing. A row that leaves a REQUIRED
    field of the table NULL fails the append as a whole; columns that the rows lack become NULL."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        create_table(spark, name, schema or df.schema, partition_by)
    fields = spark.table(name).schema.fields
    rows = df.select(*[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in fields])
    checked(rows, name, required_of(spark, name)).write.insertInto(name)


def required_violation(schema: T.StructType, prefix: str = "") -> F.Column:
    """Name of the first non-nullable (possibly nested) field that is NULL, else NULL.

    Fields are checked in schema order; fields inside a struct only where the
    struct itself is present; a JSON null in a VARIANT column counts as NULL.
    """
    checks = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        absent = F.col(path).isNull()
        if isinstance(f.dataType, T.VariantType):
            absent = absent | F.is_variant_null(F.col(path))
        if not f.nullable:
            checks.append(F.when(absent, F.lit(path)))
        if isinstance(f.dataType, T.StructType):
            checks.append(F.when(~absent, required_violation(f.dataType, f"{path}.")))
    return F.coalesce(*checks, F.lit(None).cast("string"))


def insert_rows(df: DataFrame, schema: T.StructType, name: str | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, errors) by the REQUIRED fields: those kept with table ``name`` where it
    exists, else those of the schema.

    ``errors`` carries every input column plus ``error`` and ``error_field``;
    an empty errors frame means the insert was clean. Good rows are appended
    to ``name`` when given. Unknown columns are an error for the whole call,
    as the warehouse rejects them.
    """
    unknown = [c for c in df.columns if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"unknown fields for table schema: {unknown}")
    if name is not None and table_exists(df.sparkSession, name):
        violation = missing_required(df.schema, required_of(df.sparkSession, name))
    else:
        violation = required_violation(schema)
    marked = df.withColumn("error_field", violation)
    good = marked.where(F.col("error_field").isNull()).drop("error_field")
    bad = marked.where(F.col("error_field").isNotNull()).withColumn("error", F.lit("required_null"))
    if name is not None:
        append(good, name, schema)
    return good, bad


def fit_to_table(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Split rows by whether the *stored* table takes them: (rows cast to its columns, dead letters).

    A row is a dead letter when a value has no representation in the column's type (``cast_failed``, the value would
    become NULL), or leaves a REQUIRED field NULL (``required_null``); ``error_field`` is the first such column of
    the table. Dead letters keep the row as it came, as JSON text in ``row``. Nothing is written.
    """
    spark = df.sparkSession
    fields, required = spark.table(name).schema.fields, required_of(spark, name)
    given = {c: F.col(f"`{c}`") for c in df.columns}
    unknown = [c for c in df.columns if c not in {f.name for f in fields}]
    if unknown:
        raise ValueError(f"unknown fields for {name}: {unknown}")
    cast, failed = [], []
    for f in fields:
        value = given.get(f.name, F.lit(None))
        fitted = value if f.name in given and df.schema[f.name].dataType == f.dataType else value.try_cast(f.dataType)
        cast.append(fitted.alias(f.name))
        if f.name in given:
            failed.append(F.when(value.isNotNull() & fitted.isNull(), F.lit(f.name)))
    row = F.to_json(F.struct(*given.values()))
    marked = df.select(F.struct(*cast).alias("fitted"), row.alias("row"), F.coalesce(*failed, F.lit(None).cast("string")).alias("cast_field"))
    fitted = marked.select("fitted.*", "row", "cast_field")
    gone = missing_required(T.StructType(fields), required)
    checked_rows = (fitted.withColumn("error_field", F.coalesce("cast_field", gone))
                    .withColumn("error", F.when(F.col("cast_field").isNotNull(), F.lit("cast_failed"))
                                .when(F.col("error_field").isNotNull(), F.lit("required_null"))))
    good = checked_rows.where("error IS NULL").select(*[F.col(f"`{f.name}`") for f in fields])
    return good, checked_rows.where("error IS NOT NULL").select("row", "error", "error_field")


def store_batch(batch: DataFrame, batch_id: int, name: str, path: str, dead_letters: str) -> None:
    """The sink of a micro-batch (``foreachBatch``): rows that table ``name`` takes go to ``path``, the others to
    ``dead_letters``, each to the folder of its batch, so that a retried batch rewrites what it wrote."""
    kept = batch.persist()
    try:
        good, bad = fit_to_table(kept, name)
        good.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        bad.write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")
    finally:
        kept.unpersist()


def query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """Run SQL with named, typed parameters (``:name`` markers)."""
    return spark.sql(sql, args=params or None)


def _by_date(df: DataFrame, date: F.Column, key: str, files_per_date: int | None) -> DataFrame:
    """Add ``date``; with ``files_per_date`` rows are first hash-partitioned on
    (date, hash(key) mod files_per_date): each date is spread over that many
    tasks (a hot date still splits) and each task writes one file for one date,
    instead of every task writing a small file for every date it holds."""
    out = df.withColumn("date", date)
    if files_per_date:
        salt = F.pmod(F.xxhash64(F.col(key)), F.lit(files_per_date))
        out = out.repartition(F.col("date"), salt)
    return out


def write_landed(landed_df: DataFrame, path: str, mode: str = "append",
                 files_per_date: int | None = None) -> None:
    """Store landed rows as parquet partitioned by event date (UTC).

    Readers then prune partitions on ``date`` and push ``event_id`` /
    ``timestamp`` predicates into the parquet scan.
    """
    (_by_date(landed_df, F.to_date(F.col("timestamp")), "event_id", files_per_date)
     .write.mode(mode).partitionBy("date").parquet(path))


def write_points(points: DataFrame, path: str, mode: str = "append",
                 files_per_date: int | None = None) -> None:
    """A12/A13 store: metric points as parquet partitioned by the UTC date of
    ``end_time``, so interval scans (``metrics.scan``) prune partitions."""
    (_by_date(points, F.to_date(F.col("end_time")), "end_time", files_per_date)
     .write.mode(mode).partitionBy("date").parquet(path))
