"""Sharding, mixing and the style tree against plain Python, given the seeded positions of the rows."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from claimspan.llm import html_tree, interleave, main_text, mixture
from claimspan.llm.slices import hashable, position
from tests.llm import brute
from tests.llm.test_operators import DOCS, prose


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randrange(0, 60)) or None, "en", rng.choice(["hot", "hot", "hot", "b", "c", None]), None) for i in range(160)]
    rows += [(i, prose(rng, 900), "en", "d", None) for i in range(200, 203)] + [(300, "", "en", "empty", None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def _placed(docs, seed):
    """{source: its rows as (position, tie, id, words)} in their seeded order."""
    every = hashable(docs)
    found = docs.select("doc_id", "source", "text", position(seed, *every).alias("at"), F.xxhash64(F.lit(seed + 1), *every).alias("tie"))
    by = defaultdict(list)
    for r in found.collect():
        by[r["source"]].append((r["at"], r["tie"], r["doc_id"], len(brute.NOT_SPACE.findall(r["text"] or ""))))
    return {s: sorted(rows) for s, rows in by.items()}


@pytest.mark.parametrize("shards", [1, 7, 8])
def test_interleaving(docs, shards):
    ranked = []
    for source, rows in _placed(docs, interleave.SEED).items():
        key = "" if source is None else "=" + source
        ranked += [((k + 0.5) / len(rows), key, k, r[2]) for k, r in enumerate(rows)]
    want = {}
    for place, (*_, i) in enumerate(sorted(ranked)):
        shard = place * shards // len(ranked)
        want[i] = (shard, place - -(-shard * len(ranked) // shards))
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in interleave.interleave(docs, shards).collect()} == want


def _mixed(docs):
    """{id: times taken}, source by source: whole rounds, then the first ones once more, then one document moved."""
    by = _placed(docs, mixture.SEED)
    order = sorted(s for s in by if s is not None) + [None]
    sizes = [sum(r[3] for r in by[s]) for s in order]
    aims = mixture.targets(sizes, [(5.0, 2.0, 1.0)[k % 3] for k in range(len(order))])
    out = {}
    for source, size, aim in zip(order, sizes, aims, strict=True):
        full = min(int(aim // size), 3) if size else 0
        need = max(0.0, aim - full * size) if full < 3 else 0.0
        again, before = [], 0
        for *_, n in by[source]:
            again.append(n > 0 and before + n / 2 <= need)
            before += n
        gap = need - sum(r[3] for r, a in zip(by[source], again, strict=True) if a)
        helps = [
            (abs(r[3] - abs(gap)), r[0], r[1], k)
            for k, (r, a) in enumerate(zip(by[source], again, strict=True))
            if r[3] > 0 and need > 0 and abs(r[3] - abs(gap)) < abs(gap) and a == (gap < 0)
        ]
        if helps:
            k = min(helps)[3]
            again[k] = not again[k]
        for (_, _, i, n), a in zip(by[source], again, strict=True):
            out[i] = full + a if n else 0
    return out


def test_mixing(docs):
    planned = mixture.plan(docs).collect()
    assert {r["doc_id"]: len(r["copies"]) for r in planned} == _mixed(docs)
    assert all(r["taken"] == r["size"] * len(r["copies"]) for r in planned)


def _tree(pages):
    """{(host, path): (pages, importance)} from one parse per page, each text of a host once."""
    hosts = defaultdict(dict)
    for host, html in pages:
        elements, blocks = html_tree.read(html)
        hosts[host].setdefault("\n\n".join(t for e, t in blocks if not e.noise), (elements, blocks))
    out = {}
    for host, held in hosts.items():
        stands, styles, texts = defaultdict(int), defaultdict(lambda: defaultdict(int)), defaultdict(lambda: defaultdict(int))
        for elements, blocks in held.values():
            for path in {e.path for e in elements}:
                stands[path] += 1
            for path, kids in {(e.path, tuple(e.kids)) for e in elements if not e.parent or e.path != e.parent.path}:
                styles[path][kids] += 1
            for path, text in {(e.path, t) for e, t in blocks}:
                texts[path][text] += 1
        for path, n in stands.items():
            if n == 1:
                out[host, path] = (1, 1.0)
                continue
            whole = sum(styles[path].values())
            style = -sum(c / whole * math.log(c / whole) for c in styles[path].values()) / math.log(n)
            size = known = 0.0
            for below, found in texts.items():
                if below == path or below.startswith(path + "/"):
                    weight = sum(len(t) * c for t, c in found.items())
                    size += weight
                    if stands[below] > 1:
                        known += sum(len(t) * c * math.log(c) for t, c in found.items()) / math.log(stands[below])
            content = 1 - known / size if size else 0.0
            out[host, path] = (n, (1 - main_text.CONTENT) * style + main_text.CONTENT * content)
    return out


def test_style_tree(spark):
    rng = random.Random(5)
    pages = []
    for host, n in (("one", 1), ("three", 3), ("many", 25), ("copies", 12)):
        for k in range(n):
            own = prose(rng, 12) if host != "copies" or k % 4 == 0 else "The same story."
            extra = "<div class=box><p>Now and then.</div>" if rng.random() < 0.4 else ""
            pages.append((host, f"<body><div class=top>Same banner<p>of {host}</div>{extra}<div class=body><h1>{k % 3}</h1><p>{own}</div></body>"))
    pages += pages[:4] + [("odd", ""), ("odd", "just text")]
    got = {(r["host"], r["path"]): (r["pages"], r["importance"]) for r in main_text.style_tree(spark.createDataFrame(pages, "host string, html string")).collect()}
    want = _tree(pages)
    assert set(got) == set(want) and len(want) > 20
    for key, (n, importance) in want.items():
        assert got[key][0] == n and got[key][1] == pytest.approx(importance, abs=1e-9), key
