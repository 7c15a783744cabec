"""Driver queries of this subpackage: one thin query per operator over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_spark.llm import ann, chat, decontaminate, fingerprints, line_dedup, minhash, mixing, repair, suffix_dedup, tokens, toxicity, warc, whitening

#: Public byte-level BPE ranks; a parameter of the token operators.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets reach Jaccard 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after three edits each: a deletion in the second quarter, an insertion, an
    appended text."""
    trees = tokens.count_tokens(table(spark, sf_dir, "documents"), VOCABULARY)
    n = F.length("text")
    at = lambda share: F.floor(n * share).cast("int")
    edit = lambda start, stop, new: F.struct(start.alias("start"), stop.alias("stop"), new.alias("replacement"))
    edits = F.array(edit(at(0.25), F.least(at(0.25) + 12, at(0.5)), F.lit("")), edit(at(0.5), at(0.5), F.substring("text", 1, 40)), edit(n, n, F.lit(" The end.")))
    before = trees.select("*", edits.alias("edits"))
    after = tokens.apply_edits(before, "edits", VOCABULARY, carry=["n_tokens"])
    return after.select("doc_id", F.col("carried.n_tokens").alias("n_tokens"), "n_pretokens", F.col("n_tokens").alias("edited_tokens"),
                        F.sha2("text", 256).alias("edited_sha256"), "reencoded")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated 200-byte strings."""
    out = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, and how alike they are."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_warc_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the archive of all pages that a damaged replica does not share."""
    return warc.drill(table(spark, sf_dir, "pages"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 13-word windows of benchmark items."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tkey")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a classifier learnt from positive and unlabelled texts."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reads back from the formatted conversations, and from one made of control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    extra = [spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"),
                                   F.lit(hard).alias("text")) for k, role in enumerate(("user", "assistant"))]
    return chat.digests(chat.format_conversations(rows.unionByName(extra[0]).unionByName(extra[1])))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines and the text left without later copies of repeated line runs."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
                      F.sha2(F.coalesce("__text", F.lit("")), 256).alias("kept_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of all conversations after damage."""
    rows = repair.damage(table(spark, sf_dir, "conversations"))
    return repair.digests(rows, repair.plan_repairs(rows))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest embeddings of every embedding whose id is divisible by 50, among all."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings on their four leading components, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_minhash_near_dedup, op2_token_counts, op3_suffix_array_dedup, op4_document_fingerprints, op5_warc_fixity_audit,
                            op6_source_mixing, op7_benchmark_decontamination, op8_toxicity, op9_chat_formatting, op10_line_dedup,
                            op11_conversation_repair, op12_nearest_neighbours, op13_embedding_whitening)}

#: DuckDB SQL over the same tables, where SQL can express the operator.
ORACLE_SQL: dict[str, str] = {
    "op5_warc_fixity_audit": warc.ORACLE_SQL,
    "op6_source_mixing": mixing.ORACLE_SQL,
    "op7_benchmark_decontamination": decontaminate.ORACLE_SQL,
    "op10_line_dedup": line_dedup.ORACLE_SQL,
}
