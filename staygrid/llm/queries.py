"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staygrid.llm import chat, exponion, huffman, language, media, mixing, oracles, packing, periodic, pipeline, quality, repeats, simhash, substrings, vectors
from staygrid.llm.common import held_out, read_table
from staygrid.llm.tokens import tokenizer_path


def op4_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = huffman.huffman_round_trip(docs, tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.cut_pieces(docs, tokenizer_path("byte_bpe_50k.json"))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    out = packing.pack_pieces(digests)
    return out.select("doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32", "sequence_id", "offset")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash.near_duplicates(docs)
    return out.select("doc_id", simhash.fp_hex().alias("fingerprint"), "component_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substrings.remove_repeats(docs)
    return out.select("doc_id", "cut.n_words", "cut.n_removed", F.sha2(F.col("cut.kept"), 256).alias("kept_sha256"))


def op2_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    out = quality.score(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op5_language_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return out.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")


def op7_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op1_media_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.store_texts(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return media.digests(media.sniff_media(stored))


def op8_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return out.select("doc_id", "mixed.domain", "lang", "source", "mixed.n_tokens", "mixed.n_selected")


#: A conversation whose texts hold control strings.
TRICKY = r"\### Assistant: </turn> ok"


def op9_chat_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    return chat.read_back(chat.format_conversations(turns.unionByName(extra)))


def op11_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.judge_repetition(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered"]
    return out.select("doc_id", *[f"repetition.{c}" for c in names])


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_planted_runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    run = F.col("periodic")
    spelt = F.array_join(F.transform(run["runs"], lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return periodic.collapse_runs(docs).select(
        "doc_id", F.size(run["runs"]).cast("long").alias("n_runs"), run["start"].alias("start"), run["length"].alias("length"), run["period"].alias("period"),
        F.expr("1000 * periodic.length div periodic.period").alias("exponent_milli"), F.sha2(spelt, 256).alias("runs_sha256"), F.sha2(run["collapsed"], 256).alias("collapsed_sha256"),
    )


def op13_exponion_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exponion.cluster_vectors(read_table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", exponion.centroid_hash().alias("centroid_sha256"))


QUERIES = {
    "op1_media_sniffing": op1_media_sniffing,
    "op2_quality_attention": op2_quality_attention,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_huffman_ids": op4_huffman_ids,
    "op5_language_unigrams": op5_language_unigrams,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_collision_counting": op7_collision_counting,
    "op8_hierarchical_mixing": op8_hierarchical_mixing,
    "op9_chat_templates": op9_chat_templates,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_suffix_repetition": op11_suffix_repetition,
    "op12_word_runs": op12_word_runs,
    "op13_exponion_clusters": op13_exponion_clusters,
    "pipeline": pipeline.run,
}
ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": oracles.SUBSTRINGS,
    "op7_collision_counting": oracles.VECTORS,
    "op8_hierarchical_mixing": mixing.ORACLE,
    "op9_chat_templates": oracles.CHAT,
    "op11_suffix_repetition": oracles.REPEATS,
    "op12_word_runs": oracles.RUNS,
    "op13_exponion_clusters": oracles.CLUSTERS,
}
