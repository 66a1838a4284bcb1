"""The stored fact clustered by patient and day, so that reading few of either opens few files.

Within a year, claims lie along a curve that takes the bits of a hash of the patient and
of the day in turn. A file then holds a small square of patients and days, sorted by
patient: the range of its days rules it out for other days, its dictionaries and bloom
filters for other patients, and its page index leads to the pages of the wanted ones.
With n files a year, a patient or a day is found in about the square root of n.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspan.sources.years import YEAR

#: Bits of the patient and of the day that a cell is made of.
CELL_BITS = 10
ROW_GROUP_BYTES = 32 << 20
PAGE_ROWS = 5_000


def interleaved(first: Column, second: Column, bits: int = CELL_BITS) -> Column:
    """The bits of two whole numbers below 2 ** ``bits`` in turn, the highest of ``first`` leading."""
    taken = []
    for i in range(bits):
        taken.append(F.shiftleft(F.shiftright(first, i).bitwiseAND(1), 2 * i + 1))
        taken.append(F.shiftleft(F.shiftright(second, i).bitwiseAND(1), 2 * i))
    return reduce(Column.bitwiseOR, taken)


def cell() -> Column:
    """The place on the curve of a claim of ``patient_id`` on ``_day_of_year`` (1 to 366; NULL counts as 1)."""
    patient = F.pmod(F.xxhash64("patient_id"), F.lit(1 << CELL_BITS)).cast("int")
    day = F.coalesce(F.col("_day_of_year") - 1, F.lit(0)) * (1 << CELL_BITS)
    return interleaved(patient, F.floor(day / 366).cast("int"))


def write_clustered(
    claims: DataFrame,
    dates: DataFrame,
    path: str,
    partitions: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Replace the fact at ``path``; ``claims`` have the column ``claim_year``.

    ``partitions`` is the number of ranges the curve is cut into (default: the session's
    shuffle partitions); each gives one file, or one a year where it reaches over years. Ranges
    also follow a hash of the claim, so that one patient's claims of one day, however
    many, can be cut. Claims of unknown days are kept.
    """
    days = dates.select("date_key", F.dayofyear("full_date").alias("_day_of_year"))
    placed = claims.join(days, "date_key", "left").select(*claims.columns, cell().alias("_cell"))
    ranges = [F.col(YEAR), F.col("_cell"), F.xxhash64("claim_id")]
    spread = placed.repartitionByRange(partitions, *ranges) if partitions else placed.repartitionByRange(*ranges)
    (
        spread.drop("_cell")
        .sortWithinPartitions(YEAR, "patient_id", "date_key")
        .write.mode("overwrite")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.bloom.filter.enabled#patient_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy(YEAR)
        .parquet(path)
    )
