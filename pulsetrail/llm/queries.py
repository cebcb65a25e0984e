"""The corpus operators as queries over whole tables; ``oracle`` has SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.llm.bpe import decode, encode
from pulsetrail.llm.chat import format_paths, read_formatted, reply_paths, turns_as_tree
from pulsetrail.llm.common import table
from pulsetrail.llm.decontam import find_items
from pulsetrail.llm.divergence import source_divergence
from pulsetrail.llm.html_extract import main_text
from pulsetrail.llm.mixing import mix
from pulsetrail.llm.passages import near_passages
from pulsetrail.llm.quality import METRICS, quality
from pulsetrail.llm.shared_keys import sized
from pulsetrail.llm.simhash import near_groups
from pulsetrail.llm.substrings import cut_repeats
from pulsetrail.llm.token_store import read_tokens, write_tokens
from pulsetrail.llm.vector_codes import vector_codes
from pulsetrail.llm.warc import read_warc, resolve_revisits, write_warc

# A conversation whose texts look like the template.
TRICKY = "\\### Assistant: </turn> ok"

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    return {
        "op1_simhash": _simhash,
        "op2_suffix_array": _repeats,
        "op3_warc": _warc,
        "op4_token_store": _tokens,
        "op5_mixing": _mixing,
        "op6_quality_rules": _quality,
        "op7_decontamination": _decontamination,
        "op8_compact_windows": _passages,
        "op9_html_extraction": _html,
        "op10_chat": _chat,
        "op11_source_divergence": _divergence,
        "op12_vector_codes": _vector_codes,
        "op13_bpe": _bpe,
    }


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("_row.doc_id", "size", "source_size", "target", "taken")


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select("_row.doc_id", *METRICS, "base_failed", "kept")


def _warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_warc(table(spark, sf_dir, "pages"))
    records = resolve_revisits(read_warc(spark, files, with_payload=False))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = write_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    return read_tokens(spark, store, with_ids=False)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], given.schema)
    nodes = turns_as_tree(given.unionByName(tricky))
    conversations = format_paths(nodes, reply_paths(nodes))
    return read_formatted(conversations).drop("leaf")


def _simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("_row.doc_id", "item_id", "n_shared", "n_shingles", "containment")


def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return found.select("_row.page_id", "_row.url", "text", F.length("text").cast("bigint").alias("n_chars"))


def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents"))


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_passages(table(spark, sf_dir, "documents"))


def _divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def _vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes(table(spark, sf_dir, "embeddings"), carry=["vec_id", "label"])
    codes = found.codes.select("_row.vec_id", "_row.label", "code", "error")
    of_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(sized(of_label, 16), F.col("label").eqNullSafe(F.col("_label")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


def _bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = word_tokenizer_path()
    found = decode(encode(table(spark, sf_dir, "documents"), path, carry=["doc_id"]), path)
    return found.select(
        "_row.doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
