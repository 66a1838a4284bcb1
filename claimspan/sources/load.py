"""Load the star from CSV: read, check, then publish."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspan.model import ClaimsModel
from claimspan.operators.quality import findings
from claimspan.schema import TABLES
from claimspan.sources import years
from claimspan.sources.clustering import write_clustered
from claimspan.sources.scratch import shuffles_freed
from claimspan.sources.tables import read_table, refresh_statistics, verify_counts, with_claim_year, write_table
from claimspan.sources.versions import current, new_version, publish, remove


class QualityError(ValueError):
    """Loaded tables break a rule; the published tables were left as they were."""


def load_all(
    spark: SparkSession, source: str, target: str, catalog: str | None = None, clustered: bool = False
) -> DataFrame:
    """Refresh every table under ``target`` from the CSV files under ``source``.

    The tables are written to a folder of their own, checked as a whole, and
    published together by switching a pointer, so a failure at any point leaves
    the published tables as they were. Of the fact only the years that changed
    are written; the others are shared with the version before. A missing file or a bad row raises.
    ``catalog``, if given, is a database in which the new version's tables are
    registered and their statistics collected. ``clustered`` writes the years that changed
    clustered by patient and day (``sources.clustering``). Returns (table, rows) of what is
    now published.
    """
    version, load = new_version(target), uuid.uuid4().hex
    try:
        with shuffles_freed(spark):
            _write(spark, source, version, current(spark, target), load, clustered)
        publish(spark, target, version)
    except Exception:
        remove(spark, version)
        remove(spark, years.folder(version, load))
        raise
    years.sweep(spark, target)
    if catalog:
        _register(spark, version, catalog)
    return verify_counts({name: read_table(spark, version, name, "parquet") for name in TABLES})


def _write(spark: SparkSession, source: str, version: str, last: str, load: str, clustered: bool) -> None:
    """Write and check a version. Dimensions are checked as they are stored, the fact
    as the years it is made of."""
    for name in TABLES:
        if name != "fact_claims":
            write_table(read_table(spark, source, name), f"{version}/{name}")
    dims = {name: read_table(spark, version, name, "parquet") for name in TABLES if name != "fact_claims"}
    # Claims of unknown days are kept here, for the checks to find.
    claims = with_claim_year(read_table(spark, source, "fact_claims"), dims["dim_date"], "left")
    years.write_manifest(spark, version, _write_years(spark, claims, version, last, load, dims["dim_date"] if clustered else None))
    stored = {**dims, "fact_claims": read_table(spark, version, "fact_claims", "parquet")}
    broken = findings(ClaimsModel.from_tables(stored)).where(F.col("violations") > 0)
    # At most one row per rule, whatever the size of the data.
    problems = [f"{r['check']} {r['table']}.{r['rule']}: {r['violations']}" for r in broken.collect()]
    if problems:
        raise QualityError("; ".join(sorted(problems)))


def _write_years(
    spark: SparkSession, claims: DataFrame, version: str, last: str, load: str, cluster_by: DataFrame | None
) -> list[dict]:
    """Write the years of ``claims`` that differ from those of the last version; the manifest of all.
    ``cluster_by`` is the calendar, where they are to be clustered.

    Without a version before, claims are parsed once, and summed up as they are stored.
    """
    before = {y["year"]: y for y in years.read_manifest(spark, last) or []}
    shared = []
    if before:
        sums = years.checksums(claims)
        shared = [before[y] for y, figures in sums.items() if y in before and before[y]["sums"] == figures]
        same = [y["year"] for y in shared]
        if len(shared) == len(sums):
            return shared
        claims = claims.where(~F.coalesce(F.col(years.YEAR).isin([y for y in same if y is not None]), F.lit(False)))
        if None in same:
            claims = claims.where(F.col(years.YEAR).isNotNull())
    folder = years.folder(version, load)
    if cluster_by is None:
        write_table(claims, folder, (years.YEAR,))
    else:
        write_clustered(claims, cluster_by, folder)
    if not before and spark.read.schema(claims.schema).parquet(folder).isEmpty():
        return []
    sums = years.checksums(spark.read.schema(claims.schema).parquet(folder).select(claims.columns))
    return shared + [{"year": y, "load": load, "sums": figures} for y, figures in sums.items()]


def _register(spark: SparkSession, version: str, catalog: str) -> None:
    """Point the database's tables at a version and collect their statistics."""
    for name in TABLES:
        table = f"{catalog}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        if name == "fact_claims":
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[name])
            spark.sql(
                f"CREATE TABLE {table} ({columns}, {years.YEAR} int) USING parquet"
                f" PARTITIONED BY ({years.YEAR}) LOCATION '{version}/{name}'"
            )
            for year in years.read_manifest(spark, version):
                spark.sql(f"ALTER TABLE {table} ADD PARTITION ({years.YEAR} = {year['year']}) LOCATION '{years.path_of(version, year)}'")
        else:
            spark.catalog.createTable(table, path=f"{version}/{name}", source="parquet")
        refresh_statistics(spark, table)
