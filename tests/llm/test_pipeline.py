"""The pipeline's stages, each on what the one before kept."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm import brute


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "src1", 0), (10**6 + 1, "12 !", "en", "src1", 4)], docs.schema)
    docs = docs.union(odd)
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        rows = out.collect()
        seen[name] = rows
        docs = spark.createDataFrame(rows, out.schema)
        if name != "sharding":
            assert out.columns == columns
    ids = {name: [r["doc_id"] for r in rows] for name, rows in seen.items()}
    text = {r["doc_id"]: r["text"] for r in seen["language"]}

    assert len(ids["language"]) == 200 and max(ids["language"]) < 10**6
    kept = [i for i, _, _, alone in brute.near_duplicates(sorted(text.items())) if alone]
    assert sorted(ids["near duplicates"]) == kept
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = [i for i, n, hit, _ in brute.passages([(i, text[i]) for i in kept], items) if not (hit and 20 * hit >= n)]
    assert sorted(ids["decontamination"]) == clean
    assert set(ids["mixing"]) <= set(clean) and max(Counter(ids["mixing"]).values()) <= 3
    assert Counter(ids["sharding"]) == Counter(ids["mixing"])
    slots = defaultdict(list)
    for r in seen["sharding"]:
        slots[r["shard"]].append(r["slot"])
        assert r["text"] == text[r["doc_id"]]
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run(spark):
    first, again = (corpus_pipeline.run(spark, SMALL).select("doc_id", "shard", "slot").collect() for _ in range(2))
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
