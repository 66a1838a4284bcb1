"""One query per operator, over whole tables, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspan.llm.align_tokens import link_scores
from claimspan.llm.bit_sliced import top_k
from claimspan.llm.common import read
from claimspan.llm.decontaminate import contaminated, passages
from claimspan.llm.hard_negatives import mine
from claimspan.llm.interleave import interleave
from claimspan.llm.line_dedup import without_common_lines
from claimspan.llm.main_text import main_text
from claimspan.llm.mixture import plan
from claimspan.llm.near_dup import near_duplicates
from claimspan.llm.oracles import SQL
from claimspan.llm.piece_bpe import encoded
from claimspan.llm.rank_order import held_out, identified
from claimspan.llm.token_counts import token_counts
from claimspan.llm.token_files import ids_crc32, stored_tokens

#: The public tokenizer that the contracts of the token operators name, and the id it ends documents with there.
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
PIECES = "piece_bpe_32k.model"


def _tokenizer(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_common_lines(read(spark, sf_dir, "documents"))
    sha = F.sha2(F.col("kept").cast("binary"), 256)
    return cleaned.select("doc_id", "n_lines", "n_dropped", sha.alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), _tokenizer(), limit=512)


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = interleave(read(spark, sf_dir, "documents"), shards=8)
    text = F.coalesce("text", F.lit(""))
    return sharded.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = stored_tokens(read(spark, sf_dir, "documents"), _tokenizer(), END_ID)
    return ids_crc32(files.select("doc_id", "start", "n_tokens", "ids"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def op7_rank_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identified(read(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = plan(read(spark, sf_dir, "documents"), shards=8, texts=False)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = encoded(docs, _tokenizer(PIECES), back="decoded")
    spelled = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(spelled.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = link_scores(docs, _tokenizer(), _tokenizer(PIECES))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_line_dedup,
        op2_token_counts,
        op3_main_text,
        op4_interleave,
        op5_token_files,
        op6_decontaminate,
        op7_rank_order,
        op8_bit_sliced,
        op9_mixture,
        op10_near_dup,
        op11_hard_negatives,
        op12_piece_bpe,
        op13_token_alignment,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
