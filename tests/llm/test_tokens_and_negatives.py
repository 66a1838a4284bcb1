"""Hard negatives, SentencePiece coding and token alignment against plain Python and the libraries."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimspan.llm import align_tokens, hard_negatives, piece_bpe
from claimspan.llm.common import CHUNK_BYTES
from tests.llm import brute
from tests.llm.test_operators import DOCS, prose

VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers as public

    return public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model(paths):
    return piece_bpe.PieceModel(paths[1])


@pytest.fixture(scope="module")
def library(paths):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=paths[1])


# -- hard negatives ------------------------------------------------------


@pytest.mark.parametrize("leaf", [1, 2, 16])
def test_strassen_is_exact(monkeypatch, leaf):
    monkeypatch.setattr(hard_negatives, "LEAF", leaf)
    rng = np.random.default_rng(3)
    for shape in ((1, 1, 1), (3, 5, 7), (16, 16, 16), (33, 64, 70), (5, 0, 4), (0, 3, 2), (40, 1, 40)):
        a = rng.integers(-(2**29), 2**29, shape[:2])
        b = rng.integers(-(2**29), 2**29, shape[1:])
        want = np.array([[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T] for r in a], np.int64).reshape(shape[0], shape[2])
        assert (hard_negatives.strassen(a, b) == want).all()
    # sums in between may leave 64 bits; what fits in the end is right
    big = np.full((20, 20), 2**31 - 1, np.int64)
    assert (hard_negatives.strassen(big, np.eye(20, dtype=np.int64)) == big).all()


def _vectors(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-2.0, -0.01, 0.0, 0.5, 1.0, 3.25]) for _ in range(5)], rng.choice([1, 1, 2, 3])) for i in range(90)]
    rows += [(10, rows[10][1], 2), (7, rows[7][1], rows[7][2]), (5, None, 1), (15, [None] + [1.0] * 4, 1), (None, [1.0] * 5, 1)]
    rows += [(20, [float("nan")] + [1.0] * 4, 1), (25, [1.0], 1), (26, [2.0], 2), (27, [3.0], 1), (30, [], 1), (31, [], 1), (32, [], 2), (35, [1.0] * 5, None)]
    rows += [(200 + i, [1.0] * 5, 1 + i % 2) for i in range(12)]  # ties
    return rows, spark.createDataFrame(rows, VECTORS).repartition(3)


@pytest.mark.parametrize(("block", "chunk"), [(8_192, 48 << 20), (4, 3_000)])
def test_hard_negatives(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "CHUNK_BYTES", chunk)
    rows, frame = _vectors(spark)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = hard_negatives.mine(frame.withColumn("rank", F.lit("mine")).withColumn("own", F.lit(0)), F.col("vec_id") % 5 == 0, 3, 4)
    want = brute.hard_negatives(rows, 5, 3, 4)
    assert len(want) > 150
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(want)


def test_hard_negatives_of_text_labels_and_nothing(spark):
    rows, frame = _vectors(spark)
    ids = lambda df: sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 10 == 0).collect()))
    assert ids(frame.withColumn("label", F.concat(F.lit("l"), F.col("label")))) == ids(frame) != []
    assert ids(frame.limit(0)) == [] and ids(frame.where("vec_id = 30")) == []
    assert hard_negatives.mine(frame, F.lit(None).cast("boolean")).collect() == []
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.mine(frame.withColumn("embedding", F.array(F.lit(3e8))), F.lit(True))


# -- SentencePiece -------------------------------------------------------


def _odd_texts():
    return ["", " ", "a", "  a  b ", "▁▁x", "\x00\x01 é", "日本語 텍스트 😀", "<s> </s> <0x41>", "a" * 3000, " " * 2000, "  \t\n" * 300, "=" * 999 + "-" * 333]


def test_encoding_is_the_library_s(model, library):
    rng = random.Random(1)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32_000)]
    texts = _odd_texts() + ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60))) for _ in range(800)]
    texts += ["".join(rng.choice("aab  ▁\nxé日😀\U0010ffff=-.") for _ in range(rng.randrange(1, 200))) for _ in range(400)]
    flat, at = model.encode(texts)
    for k, want in enumerate(library.encode(texts)):
        assert flat[at[k] : at[k + 1]].tolist() == want, texts[k][:80]
        assert model.decode(want) == library.decode(want)


def test_parts_of_long_texts(model, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "PART_CHARS", 40)
    rng = random.Random(2)
    texts = _odd_texts() + ["".join(rng.choice("ab  ▁\né") for _ in range(rng.randrange(1, 500))) for _ in range(200)]
    flat, at = model.encode(texts)
    for k, want in enumerate(library.encode(texts)):
        assert flat[at[k] : at[k + 1]].tolist() == want, texts[k][:80]


def test_queue_and_rounds_agree(model, monkeypatch):
    texts = [" " * n + "x" * (n % 3) for n in range(1, 80)]
    rounds = model.encode(texts)[0].tolist()
    monkeypatch.setattr(piece_bpe, "LONG_WORD", 0)
    assert model.encode(texts)[0].tolist() == rounds


def test_decoding_of_any_ids(model, library):
    rng = random.Random(3)
    for _ in range(1500):
        ids = [rng.choice([1, 2, 0, 28705, 259, *[rng.randrange(3, 259)] * 4, *[rng.randrange(259, 32_000)] * 4]) for _ in range(rng.randrange(12))]
        assert model.decode(ids) == library.decode(ids), ids


@pytest.fixture(scope="module")
def documents(spark):
    """Odd, repeated and long texts, under names that results and intermediates bear."""
    rng = random.Random(6)
    texts = [None, *_odd_texts(), "It's 12 <|endoftext|> o'clock", *[prose(rng, rng.randrange(80)) for _ in range(60)], prose(rng, CHUNK_BYTES // 3)]
    rows = list(enumerate(texts)) + [(3, "a"), (None, "b c")]
    frame = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS).repartition(3)
    names = ["ids", "Decoded", "n_a", "pairs", "times", "groups", "_row", "_at", "best", "_rare", "_best", "_column_0", "n_best", "pair"]
    return rows, frame.select("*", *[F.lit(f"my {n}").alias(n) for n in names])


def test_coded_documents(documents, paths, library):
    rows, frame = documents
    found = piece_bpe.decoded(piece_bpe.encoded(frame, paths[1]), paths[1]).collect()
    got = sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in found), key=repr)
    want = [(i, [*library.encode(t or ""), 2]) for i, t in rows]
    assert got == sorted(((i, ids, library.decode(ids)) for i, ids in want), key=repr)
    assert {r["n_a"] for r in found} == {"my n_a"} and {r["_column_0"] for r in found} == {"my _column_0"}
    assert piece_bpe.encoded(frame.limit(0), paths[1]).collect() == []
    both = piece_bpe.encoded(frame, paths[1], back="decoded").collect()
    assert sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in both), key=repr) == got
    odd = piece_bpe.decoded(frame.sparkSession.createDataFrame([(None,), ([],), ([None, 259, 2],)], "ids array<int>"), paths[1])
    assert [r["decoded"] for r in odd.collect()] == ["", "", library.decode([259, 2])]


def test_other_models_are_refused(paths):
    with pytest.raises(Exception):  # noqa: B017
        piece_bpe.PieceModel(paths[0])


# -- alignment -----------------------------------------------------------


def test_align_by_runs():
    rng = random.Random(2)
    for k in range(1500):
        n = rng.randrange(1, 400 if k % 9 == 0 else 40)
        a = sorted({*rng.sample(range(1, n + 1), rng.randrange(1, n + 1)), n})
        other = rng.sample(range(1, n + 1), min(n, rng.randrange(1, 4)))
        b = sorted({*(set(a) ^ set(other)), n}) if k % 2 else sorted({*rng.sample(range(1, n + 1), rng.randrange(1, n + 1)), n})
        group_a, group_b, link_a, link_b = align_tokens.align(np.array(a), np.array(b))
        common = [x for x in a if x in set(b)]
        assert group_a.tolist() == [a.index(x) + 1 for x in common] and group_b.tolist() == [b.index(x) + 1 for x in common]
        links = [(i, j) for i in range(len(a)) for j in range(len(b)) if max([0, *a][i], [0, *b][j]) < min(a[i], b[j])]
        assert sorted(zip(link_a.tolist(), link_b.tolist())) == links


@pytest.mark.parametrize(("common", "held"), [(1 << 19, 1 << 20), (40, 1 << 20), (0, 10)])
def test_alignment(documents, paths, library, monkeypatch, common, held):
    monkeypatch.setattr(align_tokens, "COMMON", common)
    monkeypatch.setattr(align_tokens, "HELD", held)
    rows, frame = documents
    got = align_tokens.link_scores(frame, *paths)
    assert set(frame.columns) - {"text"} <= set(got.columns)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = got.collect()
    assert {r["_row"] for r in found} == {"my _row"} and {r["best"] for r in found} == {"my best"}
    want = brute.alignment(rows, paths[0], library)
    assert sum(r[4] for r in want) > 1000 and [r for r in want if r[0] == 5][0][1:] == (0, 0, 0, 0, 0, 0, "")
    assert sorted((tuple(r[n] for n in names) for r in found), key=repr) == sorted(want, key=repr)


def test_groups_are_spelled(spark, paths):
    row = align_tokens.aligned(spark.createDataFrame([(1, "ab")], "doc_id long, text string"), *paths).first()
    sides = [g.split("|") for g in row["groups"].split(";")]
    assert [sum(s[k].count(",") + 1 for s in sides) for k in (0, 1)] == [row["n_a"], row["n_b"]]
    assert sum(row["times"]) == row["n_links"] and row["pairs"] == sorted(row["pairs"])
    assert align_tokens.link_scores(spark.createDataFrame([], "doc_id long, text string"), *paths).collect() == []
