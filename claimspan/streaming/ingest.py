"""Append newly arrived claims to a stored fact, each claim once."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimspan.model import ClaimsModel
from claimspan.operators.groups import rows_within
from claimspan.operators.quality import value_rules
from claimspan.schema import FOREIGN_KEYS, TABLES
from claimspan.sources.scratch import released, shuffles_freed
from claimspan.streaming.id_index import IdIndex, digest, id_hash

_Store = Callable[[DataFrame, str], DataFrame]

BAD_ROW = "_bad_row"
#: Why a row was refused.
REASONS = "_reasons"
#: When and with which file a row arrived.
ARRIVED = "_arrived"
#: With more unknown keys of one dimension the rows of a batch are judged once and stored; fewer are broadcast.
MANY_UNKNOWN = 500_000


class RejectedClaims(ValueError):
    """Rows arrived that cannot be stored, and there is no place to set them aside."""


def claim_files(spark: SparkSession, inbox: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the claim CSV files that arrive in a folder. Rows that do not
    parse keep their text in ``_bad_row``; ``_arrived`` orders the files."""
    schema = T.StructType([*TABLES["fact_claims"].fields, T.StructField(BAD_ROW, T.StringType())])
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # the header must name these columns, in this order
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(inbox)
        .select("*", F.struct("_metadata.file_modification_time", "_metadata.file_path").alias(ARRIVED))
    )


def _apart(batch: DataFrame, index: IdIndex, store: _Store) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows whose id occurs once in ``batch`` and is not stored, and the others; None where there are none.

    Told from hashes of the ids, so rows are not moved for it: the fewer of both kinds
    of hashes meet the batch, and are broadcast unless they are many. A hash that two
    ids share makes both doubtful, no more.
    """
    here = batch.select(id_hash().alias("_hash"), F.lit(1).alias("_here"))
    stored = index.near(batch).select(F.col("id_hash").alias("_hash"), F.lit(0).alias("_here"))
    counted = here.unionByName(stored).groupBy("_hash").agg(F.sum("_here").alias("here"), F.count(F.lit(1)).alias("rows"))
    hashes = counted.where("here > 0").select("_hash", (F.col("rows") > 1).alias("_doubtful"))
    # Batches of one kind are the rule, and need no hash stored.
    many = {r["_doubtful"]: r["count"] for r in hashes.groupBy("_doubtful").count().collect()}  # at most two rows
    if len(many) < 2:
        return (None, batch) if True in many else (batch, None)
    fewer = many[True] <= many[False]
    few = store(hashes.where(F.col("_doubtful") == F.lit(fewer)).select("_hash"), "few-hashes")
    match = id_hash() == F.col("_hash")
    named, others = batch.join(few, match, "left_semi"), batch.join(few, match, "left_anti")
    return (others, named) if fewer else (named, others)


def _sorted_out(batch: DataFrame, index: IdIndex, store: _Store) -> tuple[DataFrame, DataFrame] | None:
    """The rows of ``batch`` that are new, and those that contradict a stored or an earlier row; None without rows."""
    content = [c for c in batch.columns if c not in (ARRIVED, REASONS)]
    out = [*[c for c in batch.columns if c != REASONS], REASONS]
    reason = F.array(F.lit("differs from an earlier row of its claim_id"))
    if batch.isEmpty():
        return None
    index.repair(content)
    sure, doubtful = _apart(batch, index, store)
    none = batch.where(F.lit(False))
    new = none.select(content) if sure is None else sure.select(content)
    if doubtful is None:
        return new, none.withColumn(REASONS, reason).select(out)
    # A digest covers the id, so copies of stored rows are found on digests alone.
    digests = doubtful.select(digest(content).alias("_digest"))
    unlike = store(digests.join(index.near(doubtful).select("digest"), F.col("_digest") == F.col("digest"), "left_anti"), "unlike")
    arrived = F.min(ARRIVED) if ARRIVED in batch.columns else F.lit(0)
    if unlike.isEmpty():
        return new, none.withColumn(REASONS, reason).select(out)
    left = doubtful.join(unlike, digest(content) == F.col("_digest"), "left_semi")
    # Stored: the rows are used several times, and their size becomes known.
    rows = store(left.groupBy(*content).agg(arrived.alias(ARRIVED)), "batch")
    known = store(index.lookup(rows).select(F.col("claim_id").alias("known_id"), F.lit(True).alias("known")), "known")
    order = F.struct(ARRIVED, *[c for c in content if c != "claim_id"])
    first = rows.groupBy(F.col("claim_id").alias("first_id")).agg(F.min(order).alias("first"))
    judged = store(
        rows.join(known, F.col("claim_id").eqNullSafe(F.col("known_id")), "left")
        .join(first, F.col("claim_id").eqNullSafe(F.col("first_id")))
        .withColumn("new", F.col("known").isNull() & order.eqNullSafe(F.col("first")))
        .select(*content, ARRIVED, "new"),
        "sorted",
    )
    refused = judged.where("not new").withColumn(REASONS, reason).select(out)
    found = judged.where("new").select(content)
    return (found if sure is None else new.unionByName(found)), refused


def append_new_claims(batch: DataFrame, target: str, aside: Callable[[DataFrame | None], None] | None = None) -> None:
    """Append the claims of ``batch`` that ``target`` does not hold yet.

    Several equal rows become one. A claim is known by its id alone: a row that
    differs from the stored one of its id, or from the one that arrived first,
    is not stored but handed to ``aside`` (called before anything is stored,
    with None for a batch without rows); without it such rows stop the run.
    Comparing with all that is stored, rather than remembering keys for a
    while, has no horizon: a claim may arrive any time later, and a batch that
    is run again after a failure adds nothing twice. The comparison opens the
    matching buckets of the id index, not the fact.
    """
    index = IdIndex(batch.sparkSession, target)
    with released(batch.sparkSession) as store, shuffles_freed(batch.sparkSession):
        found = _sorted_out(batch, index, store)
        if aside:
            aside(found and found[1])
        elif found and not found[1].isEmpty():
            raise RejectedClaims("rows differ from an earlier row with the same claim_id")
        if found:
            new = found[0]
            index.append(new, new.columns)


def _reasons(batch: DataFrame, dims: ClaimsModel | None, store: _Store) -> DataFrame:
    """``batch``, a stored table, with ``_reasons``: why a row cannot be stored, empty where it can.

    The keys of the batch are held against the dimensions, each once; the rows meet only
    the unknown ones, so they are not moved unless those are many.
    """
    checks = [F.when(F.col("claim_year").isNull(), F.lit("unknown day"))]
    if BAD_ROW in batch.columns:
        checks.append(F.when(F.col(BAD_ROW).isNotNull(), F.lit("unreadable")))
    columns, many = batch.columns, False
    if dims:
        tables, arrived = dims.tables(), batch
        for key, table in FOREIGN_KEYS.items():
            if key == "date_key":
                continue
            used = arrived.where(F.col(key).isNotNull()).select(key).distinct()
            unknown = store(used.join(tables[table].select(key), key, "left_anti"), f"unknown-{key}")
            many = many or not rows_within(unknown, MANY_UNKNOWN)
            batch = batch.join(unknown.select(F.col(key).alias(f"_unknown_{key}")), F.col(key) == F.col(f"_unknown_{key}"), "left")
            checks.append(F.when(F.col(f"_unknown_{key}").isNotNull(), F.lit(f"unknown {key}")))
        checks += [F.when(broken, F.lit(rule)) for rule, broken in value_rules("fact_claims").items()]
    out = batch.select(*columns, F.array_compact(F.array(*checks)).alias(REASONS))
    return store(out, "judged") if many else out


def ingest(
    claims: DataFrame,
    dates: DataFrame,
    target: str,
    checkpoint: str,
    rejects: str | None = None,
    dims: ClaimsModel | None = None,
) -> StreamingQuery:
    """Process what has arrived and stop; a restart goes on from ``checkpoint``.

    Rows that do not parse, whose day is not in the calendar or that differ from
    an earlier row with their id go to ``rejects`` with their ``_reasons``, one
    folder per query and batch; without that folder they stop the run. With
    ``dims``, so do rows that refer to an unknown patient, hospital or policy, or
    break a value rule of the fact.
    """
    years = dates.select("date_key", F.col("year").alias("claim_year"))

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with released(spark) as store:
            # Stored with all columns: a query on a few would parse only those.
            dated = batch.join(years, "date_key", "left").select(*batch.columns, "claim_year")
            arrived = _reasons(store(dated, "arrived"), dims, store)
            bad = F.size(REASONS) > 0
            refused = arrived.where(bad)
            # A checkpoint that is begun anew counts from 0 again, but has another id.
            query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]

            def aside(conflicts: DataFrame | None) -> None:
                every = refused if conflicts is None else refused.unionByName(conflicts, allowMissingColumns=True)
                every.write.mode("overwrite").parquet(f"{rejects}/query={query}/batch={number}")

            if not rejects and not refused.isEmpty():
                raise RejectedClaims(f"batch {number} has rows that cannot be stored")
            append_new_claims(arrived.where(~bad).drop(BAD_ROW, REASONS), target, aside if rejects else None)

    # The query takes the settings of its session over as it starts.
    with shuffles_freed(claims.sparkSession):
        return (
            claims.writeStream.foreachBatch(keep)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
