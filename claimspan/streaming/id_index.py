"""An index of the claims that are stored: what a batch opens to learn which of its claims are new.

Beside the stored fact stands one row per claim: its id, a 64-bit hash of the id,
and a digest of the whole row. Entries are dealt to buckets by the hash, sorted by
it and written with bloom filters, so a batch opens the buckets of its own ids
alone, and of them only the row groups that can hold an id. The digest tells a
copy of a stored claim from a contradiction, so the fact itself is not read.
Digests have 16 bytes; an index of an older layout (``entries`` and ``digests``, with
longer ones) is not used, and one is made from the fact in its place.

``open`` holds a mark for each append that has begun and not ended. An append that
broke off is found by its mark, and its entries are held against the fact.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspan.sources.versions import files_of, remove

BUCKETS = 64
#: Up to so many ids are named to the scan, which then skips row groups by their bloom filters.
NAMED_IDS = 1_000
# Spark hands a list of more values to the files as a range only.
_LIST = 10

_ENTRY = "id_hash long, claim_id string, digest binary, bucket int, load string"


def digest(content: list[str]) -> Column:
    """A digest of a row (128 bits of its SHA-256); equal for equal rows alone (nulls included)."""
    return F.substring(F.unhex(F.sha2(F.to_json(F.struct(*sorted(content))), 256)), 1, 16)


def id_hash() -> Column:
    return F.xxhash64("claim_id")


def _bucket() -> Column:
    return F.pmod(F.shiftright(id_hash(), 20), F.lit(BUCKETS)).cast("int")


class IdIndex:
    """The index of the fact stored at ``target``."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        self.root = f"{self.target}_ids"
        self.entries = f"{self.root}/digests16"

    # -- looking up -------------------------------------------------------

    def files(self, ids: DataFrame) -> DataFrame:
        """The entries of the buckets that the ids fall into, and of no other."""
        buckets = [r[0] for r in ids.select(_bucket()).distinct().collect()]  # at most BUCKETS numbers
        there = [f"{self.entries}/bucket={b}" for b in buckets if self._exists(f"{self.entries}/bucket={b}")]
        if not there:
            return self.spark.createDataFrame([], _ENTRY)
        return self.spark.read.schema(_ENTRY).option("basePath", self.entries).parquet(*there)

    def near(self, ids: DataFrame) -> DataFrame:
        """The entries that may belong to the ids of ``ids``: those of their buckets, of few ids those with their hashes."""
        if not self._exists(self.entries):
            return self.spark.createDataFrame([], _ENTRY)
        entries = self.files(ids)
        # Many ids are not shuffled to learn that they are many.
        if ids.agg(F.approx_count_distinct(id_hash())).first()[0] > 2 * NAMED_IDS:
            return entries
        some = ids.select(id_hash().alias("h")).distinct().limit(NAMED_IDS + 1).collect()
        if len(some) <= NAMED_IDS:
            hashes = sorted(r[0] for r in some)
            lists = [F.col("id_hash").isin(hashes[i : i + _LIST]) for i in range(0, len(hashes), _LIST)]
            entries = entries.where(reduce(Column.__or__, lists, F.lit(False)))
        return entries

    def lookup(self, ids: DataFrame) -> DataFrame:
        """(claim_id, digests): what is stored under the ids of ``ids``, a stored table with a column ``claim_id``."""
        entries = self.near(ids)
        asked = ids.select(F.col("claim_id").alias("_asked"), id_hash().alias("_hash")).distinct()
        return (
            entries.join(asked, (F.col("id_hash") == F.col("_hash")) & F.col("claim_id").eqNullSafe(F.col("_asked")), "left_semi")
            .groupBy("claim_id")
            .agg(F.collect_set("digest").alias("digests"))
        )

    # -- writing ----------------------------------------------------------

    def enter(self, rows: DataFrame, load: str) -> None:
        """Add the entries of ``rows`` (claim_id, digest)."""
        (
            # Only what cannot be derived again is moved.
            rows.select("claim_id", "digest")
            .repartition(_bucket())
            .select(id_hash().alias("id_hash"), "claim_id", "digest", _bucket().alias("bucket"), F.lit(load).alias("load"))
            .sortWithinPartitions("bucket", "id_hash")
            .write.mode("append")
            .option("compression", "zstd")
            .option("parquet.bloom.filter.enabled#id_hash", "true")
            .option("parquet.block.size", str(8 << 20))
            .partitionBy("bucket", "load")
            .parquet(self.entries)
        )

    def append(self, rows: DataFrame, content: list[str]) -> None:
        """Store new claims in the fact and enter them; a break at any point is mended by ``repair``."""
        load = uuid.uuid4().hex
        self._mark(load)
        self.enter(rows.select("claim_id", digest(content).alias("digest")), load)
        rows.select(content).write.mode("append").option("compression", "zstd").partitionBy("claim_year").parquet(self.target)
        self._unmark(load)

    def repair(self, content: list[str]) -> None:
        """Bring the index to what the fact holds: after an append that broke off, or where there is none yet.

        Only then the ids of the fact are scanned.
        """
        if not self._exists(self.entries):
            if self._exists(self.target):
                held = self._held(content)
                self.enter(held.select("claim_id", digest(content).alias("digest")), uuid.uuid4().hex)
            return
        for load in self._open():
            named = self.spark.read.schema(_ENTRY).parquet(self.entries).where(F.col("load") == load)
            stored = self._held(content).select("claim_id", digest(content).alias("digest"))
            kept = named.select(F.col("claim_id").alias("_id"), F.col("digest").alias("_digest"))
            same = F.col("claim_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
            self.enter(stored.join(kept, same, "left_semi").distinct(), uuid.uuid4().hex)
            for bucket in self._list(self.entries):
                remove(self.spark, f"{self.entries}/{bucket}/load={load}")
            self._unmark(load)

    def compact(self) -> None:
        """Merge the entries of all appends into one sorted run per bucket. A break leaves entries twice, which changes nothing."""
        old = {b: self._list(f"{self.entries}/{b}") for b in self._list(self.entries) if b.startswith("bucket=")}
        self.enter(self.spark.read.schema(_ENTRY).parquet(self.entries).select("claim_id", "digest").distinct(), uuid.uuid4().hex)
        for bucket, loads in old.items():
            for load in loads:
                remove(self.spark, f"{self.entries}/{bucket}/{load}")

    # -- files ------------------------------------------------------------

    def _held(self, content: list[str]) -> DataFrame:
        return self.spark.read.parquet(self.target).select(content)

    def _exists(self, path: str) -> bool:
        fs, where = files_of(self.spark, path)
        return fs.exists(where)

    def _list(self, path: str) -> list[str]:
        fs, where = files_of(self.spark, path)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def _open(self) -> list[str]:
        return self._list(f"{self.root}/open")

    def _mark(self, load: str) -> None:
        fs, where = files_of(self.spark, f"{self.root}/open/{load}")
        fs.create(where, True).close()

    def _unmark(self, load: str) -> None:
        remove(self.spark, f"{self.root}/open/{load}")
