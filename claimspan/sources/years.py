"""The stored fact year by year, shared between versions.

Every load writes the years it changed to a folder of its own. A version names, in
a manifest, the folder that each of its years stands in, with the number of rows and
two checksums that do not depend on their order (sum and xor of row hashes). A year
whose figures are those of the last version is not written again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspan.schema import TABLES
from claimspan.sources.versions import files_of, read_text, remove, write_text

YEAR = "claim_year"


def _root(version: str) -> str:
    return f"{version.rsplit('/', 1)[0]}/years"


def folder(version: str, load: str) -> str:
    """Where a load writes the years it changed."""
    return f"{_root(version)}/load={load}"


def _manifest(version: str) -> str:
    return f"{version}/fact_claims.json"


def checksums(claims: DataFrame) -> dict[int | None, list[int]]:
    """Rows, sum and xor of row hashes of each year; one row per year comes to the driver."""
    columns = [c for c in claims.columns if c != YEAR]
    # A hash skips nulls, so where they stand is hashed too.
    row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    found = claims.groupBy(YEAR).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(20,0)")).alias("sum"), F.bit_xor(row).alias("xor")
    )
    return {r[YEAR]: [r["n"], int(r["sum"]), r["xor"]] for r in found.collect()}


def read_manifest(spark: SparkSession, version: str) -> list[dict] | None:
    """The years of a version, or None if it has no manifest."""
    text = read_text(spark, _manifest(version))
    return None if text is None else json.loads(text)


def write_manifest(spark: SparkSession, version: str, years: list[dict]) -> None:
    write_text(spark, _manifest(version), json.dumps(years))


def path_of(version: str, year: dict) -> str:
    name = "__HIVE_DEFAULT_PARTITION__" if year["year"] is None else year["year"]
    return f"{folder(version, year['load'])}/{YEAR}={name}"


def read_years(spark: SparkSession, version: str, years: list[dict]) -> DataFrame:
    """The fact of a version."""
    paths = [path_of(version, y) for y in years]
    if not paths:  # a fact without rows
        return spark.createDataFrame([], TABLES["fact_claims"]).withColumn(YEAR, F.lit(None).cast("int"))
    return spark.read.option("basePath", _root(version)).parquet(*paths).drop("load")


def sweep(spark: SparkSession, target: str) -> None:
    """Delete the loads that no version under ``target`` names any more."""
    fs, where = files_of(spark, target)
    used = set()
    for status in fs.listStatus(where):
        if status.getPath().getName().startswith("version="):
            used |= {y["load"] for y in read_manifest(spark, f"{target}/{status.getPath().getName()}") or []}
    _, years = files_of(spark, f"{target}/years")
    if fs.exists(years):
        for status in fs.listStatus(years):
            if status.getPath().getName().removeprefix("load=") not in used:
                remove(spark, f"{target}/years/{status.getPath().getName()}")
