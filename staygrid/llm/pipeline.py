"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is
written as Parquet and read again as the next one's docs. All but the last return the columns of
`docs`. Stages decide:

- quality: documents that the classifier rejects go (labels of `labels`, never of held-out rows);
  without labels of both kinds nothing is known of quality, and all stay;
- near_dedup: of each group of linked documents (one of simhash.TABLES fingerprints within
  simhash.WIDE bits and Jaccard similarity of the five-word shingles 0.8 or more) that of the
  smallest doc_id stays; rows of a null doc_id stay; rows that share a doc_id are one document, of which the row of the smallest text stays;
- substring_dedup: repeated passages are cut out of texts (their words then joined by one
  blank); texts without any stay as they are, and documents that lose every word go;
- mixing: documents come as often as the budget of their source takes them;
- packing: pieces of token sequences with their ids and places.

ORACLE_SQL is None: fingerprints, a trained model and packing aren't SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staygrid.llm import mixing, packing, quality, simhash, substrings
from staygrid.llm.common import drop_table, materialize, read_table, restored
from staygrid.llm.tokens import tokenizer_path

#: Tokens that mixing may hand out, as a part of all tokens that reach it.
MIX_SHARE = (1, 1)


def _columns(docs: DataFrame, frame: DataFrame) -> DataFrame:
    return frame.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (name,) = _free(docs, "quality")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    if model.weights is None:
        return docs
    return _columns(docs, quality.score(docs, model, name).where(F.col(name) >= quality.THRESHOLD))


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Column names like `names` that `docs` doesn't have."""
    return [next(n for k in range(1, len(docs.columns) + 2) if (n := "_" * k + name) not in docs.columns) for name in names]


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, component, rows, rank = _free(docs, "id", "component", "rows", "rank")
    found = simhash.similar_documents(docs).where("doc_id is not null").groupBy(F.col("doc_id").alias(own))
    marks = found.agg(F.min("component_id").alias(component), F.count("*").alias(rows))
    marks = materialize(marks.where((F.col(component) != F.col(own)) | (F.col(rows) > 1)), "marks")
    joined = docs.join(marks, F.col("doc_id") == F.col(own), "left")
    single = joined.where(F.col(own).isNull())
    first = Window.partitionBy(own).orderBy("text")
    several = joined.where(F.col(component) == F.col(own)).withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1)
    return _columns(docs, single).unionByName(_columns(docs, several))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (name,) = _free(docs, "cut")
    cut = substrings.remove_repeats(docs, output=name)
    removed = F.col(f"{name}.n_removed")
    cut = cut.where((removed == 0) | (removed < F.col(f"{name}.n_words")))
    out = cut.withColumn("text", F.when(removed > 0, F.col(f"{name}.kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return _columns(docs, out)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name, time = _free(docs, "mixed", "time")
    mixed = mixing.mix(docs, share=MIX_SHARE, output=name)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{name}.n_selected")))
    return _columns(docs, mixed.where(F.col(f"{name}.n_selected") > 0).withColumn(time, times))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.cut_pieces(docs, tokenizer_path("byte_bpe_50k.json"))
    return packing.pack_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; tables between the stages are deleted once they are used."""
    first = docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        with restored(spark, lambda: docs):
            docs = materialize(stage(spark, before, sf_dir), name)
        if before is not first:
            drop_table(before)
    return docs
