"""Typed reads and writes of the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspan.model import ClaimsModel
from claimspan.schema import DIAGNOSIS_REFERENCE, TABLES
from claimspan.sources.scratch import written
from claimspan.sources.versions import current
from claimspan.sources.years import read_manifest, read_years

_BAD_ROW = "_bad_row"


def schema_of(name: str) -> T.StructType:
    return DIAGNOSIS_REFERENCE if name == "diagnosis_reference" else TABLES[name]


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "csv") -> DataFrame:
    """Read one table with its declared types; a bad row or missing file raises.

    Only the columns a query uses are parsed; ``load_all`` uses them all.
    """
    if fmt == "csv":
        # Only an empty field is NULL, so the text "None" stays a value, and
        # every number keeps its declared type.
        return (
            spark.read.schema(schema_of(name))
            .option("header", True)
            .option("enforceSchema", False)  # the header must name these columns
            .option("mode", "FAILFAST")
            .csv(f"{root}/{name}.csv")
        )
    if fmt == "parquet":
        years = read_manifest(spark, root) if name == "fact_claims" else None
        return spark.read.parquet(f"{root}/{name}") if years is None else read_years(spark, root, years)
    raise ValueError(f"unknown format {fmt!r}")


def read_with_rejects(
    spark: SparkSession, root: str, name: str
) -> tuple[DataFrame, DataFrame]:
    """Good rows of a CSV table, and the raw text of the rows that do not parse."""
    schema = T.StructType([*schema_of(name).fields, T.StructField(_BAD_ROW, T.StringType())])
    # A query that needs few columns parses only those and would miss errors in
    # the others, so the whole rows are parsed and stored first.
    parsed = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # the header must name these columns, in this order
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD_ROW)
        .csv(f"{root}/{name}.csv")
    )
    rows = written(parsed, f"parsed-{name}")
    good = rows.where(F.col(_BAD_ROW).isNull()).drop(_BAD_ROW)
    rejects = rows.where(F.col(_BAD_ROW).isNotNull()).select(
        F.lit(name).alias("table"), F.col(_BAD_ROW).alias("raw_row")
    )
    return good, rejects


def conform(df: DataFrame, name: str) -> DataFrame:
    """Bring loosely typed columns to the declared types; what cannot be read
    as its type becomes NULL (and then fails the quality checks)."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema_of(name).fields]
    )


def read_model(spark: SparkSession, root: str, fmt: str = "parquet") -> ClaimsModel:
    """All tables of one published version."""
    if fmt == "parquet":
        root = current(spark, root)
    return ClaimsModel.from_tables({t: read_table(spark, root, t, fmt) for t in TABLES})


def read_catalog_model(spark: SparkSession, catalog: str) -> ClaimsModel:
    """The tables that ``load_all`` registered in a database, with the statistics collected for them.

    With ``spark.sql.cbo.enabled`` (set by ``session``) Spark then sizes filtered tables by the
    histograms of their columns, and chooses broadcasts and the order of joins by that.
    """
    return ClaimsModel.from_tables({t: spark.table(f"{catalog}.{t}") for t in TABLES})


def with_claim_year(claims: DataFrame, dates: DataFrame, how: str = "inner") -> DataFrame:
    """Add the year a claim falls in, the column the stored fact is split by."""
    years = dates.select("date_key", F.col("year").alias("claim_year"))
    return claims.join(years, "date_key", how).select(*claims.columns, "claim_year")


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace the table stored at ``path``.

    Rows of a partitioned table are gathered by partition value; adaptive
    execution then splits a large value over many tasks and joins small ones,
    so files have an even size whatever the spread of the values.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def save_table(
    df: DataFrame,
    name: str,
    partition_by: tuple[str, ...] = (),
    bucket_by: str | None = None,
    buckets: int = 0,
) -> None:
    """Replace a catalog table. Bucketed by patient, the per-patient reports
    need no shuffle of the fact; leave it off where one patient dominates,
    since a bucket is one task."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], batch_rows: int = 5000
) -> None:
    """Full refresh of a database table in batches; the table itself is kept.
    Address and credentials come from the caller."""
    (
        df.write.mode("overwrite")
        .option("truncate", True)
        .jdbc(url, table, properties={**properties, "batchsize": str(batch_rows)})
    )


def verify_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for each table, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


def refresh_statistics(spark: SparkSession, *names: str) -> None:
    """Collect table and column statistics of catalog tables, with histograms of the columns."""
    setting = "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        for name in names:
            spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    finally:
        spark.conf.set(setting, before)
