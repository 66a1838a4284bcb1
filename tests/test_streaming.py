import datetime as dt
import glob
import os

import pytest

from claimspan.schema import TABLES
from claimspan.sources.calendar import date_dim
from claimspan.sources.scratch import shared_folder
from claimspan.streaming import alerts, daily_counts, ingest
from claimspan.streaming.id_index import IdIndex
from tests.conftest import CLAIM, rows


def _drop(folder, name, *claims):
    columns = TABLES["fact_claims"].names
    lines = [",".join(columns)]
    for c in claims:
        row = {**CLAIM, **c}
        lines.append(",".join("" if row.get(k) is None else str(row[k]) for k in columns))
    (folder / name).write_text("\n".join(lines) + "\n")


def test_ingest_keeps_each_claim_once(spark, tmp_path):
    inbox, target, state = tmp_path / "in", str(tmp_path / "claims"), str(tmp_path / "state")
    inbox.mkdir()
    dates = date_dim(spark, "2022-01-01", "2023-12-31")

    def run(checkpoint=state):
        ingest.ingest(ingest.claim_files(spark, str(inbox)), dates, target, checkpoint).awaitTermination()
        return sorted((r["claim_id"], r["claim_year"]) for r in rows(spark.read.parquet(target)))

    a, b = dict(claim_id="A", date_key=1), dict(claim_id="B", date_key=400)
    _drop(inbox, "1.csv", a, b, a)
    assert run() == [("A", 2022), ("B", 2023)]
    assert run() == [("A", 2022), ("B", 2023)]  # nothing new
    # A copy of an old claim, and a claim dated long before the newest one.
    _drop(inbox, "2.csv", a, dict(claim_id="C", date_key=2))
    assert run() == [("A", 2022), ("B", 2023), ("C", 2022)]
    # All files again, as after a lost checkpoint.
    assert run(str(tmp_path / "other")) == [("A", 2022), ("B", 2023), ("C", 2022)]


def test_ingest_sets_rejects_aside(spark, tmp_path):
    inbox, target, rejects = tmp_path / "in", str(tmp_path / "claims"), str(tmp_path / "rejects")
    inbox.mkdir()
    dates = date_dim(spark, "2022-01-01", "2022-12-31")
    _drop(inbox, "1.csv", dict(claim_id="A", date_key=1), dict(claim_id="B", date_key=9999),
          dict(claim_id="C", date_key=2, claim_amount="many"))

    def run(name, **kw):
        stream = ingest.claim_files(spark, str(inbox))
        ingest.ingest(stream, dates, target, str(tmp_path / name), **kw).awaitTermination()

    with pytest.raises(Exception, match="cannot be stored"):
        run("strict")
    run("lenient", rejects=rejects)
    run("lenient", rejects=rejects)
    assert [r["claim_id"] for r in rows(spark.read.parquet(target))] == ["A"]
    refused = {r["claim_id"]: r["_bad_row"] for r in rows(spark.read.parquet(rejects))}
    assert set(refused) == {"B", "C"} and refused["B"] is None and "many" in refused["C"]


@pytest.mark.parametrize("files", [1, 1000])
def test_ingest_sets_other_rows_of_an_id_aside(spark, tmp_path, files):
    """The same rows are stored and refused, however the files are cut into batches."""
    inbox, target, rejects = tmp_path / "in", str(tmp_path / "claims"), str(tmp_path / "rejects")
    inbox.mkdir()
    dates = date_dim(spark, "2022-01-01", "2023-12-31")
    a = dict(claim_id="A", date_key=400)
    arriving = [[a, a], [dict(claim_id="A", date_key=1), dict(claim_id="B", date_key=1)], [a],
                [dict(claim_id="B", date_key=1, claim_amount=7), dict(claim_id="C", date_key=2)]]
    for i, claims in enumerate(arriving):
        _drop(inbox, f"{9 - i}.csv", *claims)
        os.utime(inbox / f"{9 - i}.csv", (1_700_000_000 + i,) * 2)

    def run(state, **kw):
        stream = ingest.claim_files(spark, str(inbox), files)
        ingest.ingest(stream, dates, target, str(tmp_path / state), **kw).awaitTermination()
        return sorted((r["claim_id"], r["claim_year"], r["claim_amount"]) for r in rows(spark.read.parquet(target)))

    if files > 1:
        with pytest.raises(Exception, match="same claim_id"):
            run("strict")
    kept = [("A", 2023, 1000), ("B", 2022, 1000), ("C", 2022, 1000)]
    for state in ("one", "again"):
        assert run(state, rejects=f"{rejects}-{state}") == kept
        refused = rows(spark.read.parquet(f"{rejects}-{state}"))
        assert sorted((r["claim_id"], r["claim_year"], r["claim_amount"]) for r in refused) == [("A", 2022, 1000), ("B", 2022, 7)]


def test_ingest_adds_an_empty_batch(spark, tmp_path):
    schema = spark.createDataFrame([], "claim_id string, claim_year int, amount long")
    ingest.append_new_claims(schema, str(tmp_path / "t"))


def test_alerts_count_closed_windows(spark, tmp_path):
    folder = tmp_path / "events"
    start = dt.datetime(2022, 1, 1, 12)
    days = [0, 1, 2, 2, 40]  # the last event closes the earlier windows
    spark.createDataFrame(
        [("P1", start + dt.timedelta(days=d)) for d in days] + [("P2", start)], "patient_id string, event_time timestamp"
    ).write.parquet(str(folder))
    stream = spark.readStream.schema("patient_id string, event_time timestamp").parquet(str(folder))
    found = alerts.frequency_alerts(stream, days=3, threshold=3, lateness="1 day")
    out = str(tmp_path / "out")
    q = (found.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r["before_day"], r["claims"]) for r in rows(spark.read.parquet(out)))
    # Windows of three days end before day 3 (days 0-2) and day 4 (days 1-3).
    assert got == [(dt.date(2022, 1, 4), 4), (dt.date(2022, 1, 5), 3)]


def _ids(spark, target):
    return sorted(r["claim_id"] for r in rows(spark.read.parquet(target)))


def _claims(spark, ids, **kw):
    row = {"amount": 1, "claim_year": 2022, **kw}
    return spark.createDataFrame([(i, row["amount"], row["claim_year"]) for i in ids], "claim_id string, amount long, claim_year int")


def test_a_batch_opens_its_own_buckets_of_the_index(spark, tmp_path):
    target = str(tmp_path / "t")
    ingest.append_new_claims(_claims(spark, [f"C{i}" for i in range(3000)]), target)
    index = IdIndex(spark, target)
    size = lambda files: sum(os.path.getsize(f.removeprefix("file://")) for f in files)
    every = spark.read.parquet(index.entries).inputFiles()
    asked = _claims(spark, ["C7", "C8", "new"])
    opened = index.files(asked).inputFiles()
    assert 0 < len(opened) <= 3 and size(opened) < size(every) / 15
    assert {r["claim_id"] for r in rows(index.lookup(asked))} == {"C7", "C8"}
    assert "PushedFilters: [In(id_hash" in index.lookup(asked)._jdf.queryExecution().toString()
    ingest.append_new_claims(asked, target)
    ingest.append_new_claims(_claims(spark, ["C9", None, None], amount=1), target)
    assert len(_ids_or_null(spark, target)) == 3002
    # the fact is not read to know what it holds
    known = index.lookup(_claims(spark, [None]))
    assert [r["claim_id"] for r in rows(known)] == [None]
    with pytest.raises(ingest.RejectedClaims):
        ingest.append_new_claims(_claims(spark, ["C9"], amount=2), target)


def _ids_or_null(spark, target):
    return [r["claim_id"] for r in rows(spark.read.parquet(target))]


@pytest.mark.parametrize("stop", ["enter", "append", "unmark"])
def test_an_append_that_broke_off_is_mended(spark, tmp_path, monkeypatch, stop):
    target = str(tmp_path / "t")
    ingest.append_new_claims(_claims(spark, ["A", "B"]), target)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if stop == "enter":
            patch.setattr(IdIndex, "enter", broken)
        elif stop == "append":
            patch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", _failing_at(target))
        else:
            patch.setattr(IdIndex, "_unmark", broken)
        with pytest.raises(OSError):
            ingest.append_new_claims(_claims(spark, ["B", "C", "D"]), target)
    ingest.append_new_claims(_claims(spark, ["C", "D", "E"]), target)
    assert _ids(spark, target) == ["A", "B", "C", "D", "E"]
    index = IdIndex(spark, target)
    assert index._open() == []
    index.compact()
    ingest.append_new_claims(_claims(spark, ["A", "E", "F"]), target)
    assert _ids(spark, target) == ["A", "B", "C", "D", "E", "F"]


def _failing_at(target):
    from pyspark.sql.readwriter import DataFrameWriter

    real = DataFrameWriter.parquet

    def parquet(self, path, *args, **kw):
        if path == target:
            raise OSError("lost")
        return real(self, path, *args, **kw)

    return parquet


def test_a_fact_without_an_index_gets_one(spark, tmp_path):
    target = str(tmp_path / "t")
    _claims(spark, ["A", "B"]).write.partitionBy("claim_year").parquet(target)
    ingest.append_new_claims(_claims(spark, ["B", "C"]), target)
    assert _ids(spark, target) == ["A", "B", "C"]


def test_ingest_refuses_orphans_and_broken_rules(spark, tmp_path, make_model):
    inbox, target, rejects = tmp_path / "in", str(tmp_path / "claims"), str(tmp_path / "rejects")
    inbox.mkdir()
    dates = date_dim(spark, "2022-01-01", "2022-12-31")
    dims = make_model([{}])
    _drop(inbox, "1.csv", dict(claim_id="A", date_key=1), dict(claim_id="B", date_key=1, patient_id="P9"),
          dict(claim_id="C", date_key=1, approved_amount=2000, status="Odd"), dict(claim_id="D", date_key=1, policy_id=None, provider_id="H7"))
    before = set(os.listdir(shared_folder(spark)))
    for state in ("one", "two"):  # a second checkpoint counts its batches from 0 again
        ingest.ingest(ingest.claim_files(spark, str(inbox)), dates, target, str(tmp_path / state), rejects, dims).awaitTermination()
        _drop(inbox, "2.csv", dict(claim_id="E", date_key=1, provider_id="H8"))
    assert _ids(spark, target) == ["A"]
    refused = {(r["claim_id"], tuple(sorted(r["_reasons"]))) for r in rows(spark.read.parquet(rejects))}
    assert refused == {("B", ("unknown patient_id",)), ("C", ("approved above claimed", "status unknown")),
                       ("D", ("policy_id missing", "unknown provider_id")), ("E", ("unknown provider_id",))}
    assert len(os.listdir(rejects)) == 2
    assert set(os.listdir(shared_folder(spark))) == before  # nothing is left behind


EVENT = "patient_id string, event_time timestamp"


def _watched(spark, tmp_path, batches, **kw):
    """The alerts of each batch, given as lists of (patient, day)."""
    inbox, target = tmp_path / "in", str(tmp_path / "watched")
    inbox.mkdir()
    found = []
    for claims in batches:
        at = [(p, None if d is None else DAY + dt.timedelta(days=d)) for p, d in claims]
        spark.createDataFrame(at, EVENT).coalesce(1).write.mode("append").parquet(str(inbox))
        stream = spark.readStream.schema(EVENT).parquet(str(inbox))
        before = set(glob.glob(f"{target}/alerts/*/*"))
        daily_counts.watch(stream, target, str(tmp_path / "state"), **kw).awaitTermination()
        new = [f for f in glob.glob(f"{target}/alerts/*/*") if f not in before]
        found.append(sorted((r["patient_id"], (r["from_day"] - DAY.date()).days, (r["before_day"] - DAY.date()).days, r["claims"])
                            for f in new for r in rows(spark.read.parquet(f))))
    return target, found


DAY = dt.datetime(2022, 1, 20, 12)


def test_alerts_look_back_on_daily_counts(spark, tmp_path):
    batches = [
        [("A", 0), ("A", 0), ("A", 5), ("B", 0), ("C", 300), (None, 1), ("A", None)],
        [("B", 9), ("B", 10), ("C", 302)],  # B reaches 3 within 10 days only from day 1 on
        [("B", 9), ("D", 1)],
        [("A", 20)],  # too late for the others
        [("C", 301)],  # late, between two stored days
    ]
    target, found = _watched(spark, tmp_path, batches, days=10, threshold=3)
    assert found == [[("A", -4, 6, 3)], [], [("B", 0, 10, 3)], [], [("C", 293, 303, 3)]]
    counts = spark.read.parquet(f"{target}/counts")
    assert counts.count() == 11  # one row per batch, key and day, whatever the span
    daily = sorted(map(tuple, daily_counts.daily_counts(spark, f"{target}/counts", "patient_id").collect()))
    assert sum(n for *_, n in daily) == 12 and len(daily) == 10
    daily_counts.compact(spark, f"{target}/counts", "patient_id")
    assert sorted(map(tuple, daily_counts.daily_counts(spark, f"{target}/counts", "patient_id").collect())) == daily


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    batch = spark.createDataFrame([("A", DAY)] * 2 + [("B", DAY)], EVENT)
    counts = str(tmp_path / "counts")
    for _ in range(2):
        daily = daily_counts.add_batch(batch, counts, "q-0", "patient_id", "event_time")
    day = (DAY.date() - dt.date(1970, 1, 1)).days
    want = [("A", day, 2), ("B", day, 1)]
    assert sorted(map(tuple, daily_counts.daily_counts(spark, counts, "patient_id").collect())) == want
    assert sorted(map(tuple, daily.collect())) == want
    # the look-back opens only the months in reach
    daily_counts.add_batch(spark.createDataFrame([("A", DAY + dt.timedelta(days=800))], EVENT), counts, "q-1", "patient_id", "event_time")
    found = daily_counts.alerts_of(spark, daily, counts, "patient_id", 10, 2)
    assert [r["claims"] for r in found.collect()] == [2]
    (scan,) = [line for line in found._jdf.queryExecution().toString().splitlines() if "FileScan" in line and "PartitionFilters" in line][:1]
    assert "month" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_new_claims_and_copies_are_not_stored_on_the_way(spark, tmp_path):
    """Telling new claims from stored ones moves hashes and digests; whole rows only where an id is contested."""
    target, index = str(tmp_path / "t"), IdIndex(spark, str(tmp_path / "t"))
    widths = []

    def store(df, label):
        path = str(tmp_path / f"s{len(widths)}")
        df.write.parquet(path)
        widths.append(("amount" in df.columns, spark.read.parquet(path).count()))
        return spark.read.schema(df.schema).parquet(path)

    def sorted_out(batch):
        widths.clear()
        new, refused = ingest._sorted_out(batch, index, store)
        return len(rows(new)), sorted(r["amount"] for r in rows(refused)), sum(n for whole, n in widths if whole)

    tmp_path = tmp_path / "first"
    assert sorted_out(_claims(spark, [f"C{i}" for i in range(500)])) == (500, [], 0)
    ingest.append_new_claims(_claims(spark, [f"C{i}" for i in range(500)]), target)
    tmp_path = tmp_path / "copies"
    assert sorted_out(_claims(spark, [f"C{i}" for i in range(500)])) == (0, [], 0)
    tmp_path = tmp_path / "mixed"
    mixed = _claims(spark, [f"C{i}" for i in range(400, 600)]).unionByName(_claims(spark, ["C7", "D", "D", None, None]))
    mixed = mixed.unionByName(_claims(spark, ["C7", "D"], amount=2))
    # 100 new ids, D and the claim without an id; only contested rows are stored whole
    found = sorted_out(mixed)
    assert found[:2] == (102, [2, 2]) and 0 < found[2] < 12


def test_digests_have_16_bytes(spark):
    from claimspan.streaming.id_index import digest

    d = [r["d"] for r in rows(_claims(spark, ["A", "B", "A", None]).select(digest(["claim_id", "amount"]).alias("d")))]
    assert {len(x) for x in d} == {16} and len(set(d)) == 3 and d[0] == d[2]


def test_many_ids_are_not_shuffled_to_learn_that_they_are_many(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    ingest.append_new_claims(_claims(spark, [f"C{i}" for i in range(300)]), target)
    index, asked = IdIndex(spark, target), []
    real = type(spark.range(1)).distinct
    monkeypatch.setattr(type(spark.range(1)), "distinct", lambda df: asked.append(df.columns) or real(df))
    monkeypatch.setattr("claimspan.streaming.id_index.NAMED_IDS", 20)
    for n, exactly in ((300, 0), (10, 1)):
        asked.clear()
        near = index.near(_claims(spark, [f"C{i}" for i in range(n)]))
        assert asked.count(["h"]) == exactly
        assert {f"C{i}" for i in range(n)} <= {r["claim_id"] for r in rows(near)}
