"""A training corpus from raw documents, in stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each stage's rows as Parquet in the shared folder and rereads them as
the next stage's documents, so a lost executor never costs more than one
stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm import decontaminate, mixing, near_dup, quality_mil
from wardstat.llm.components import written
from wardstat.llm.queries import held_out, label_weights, table, token_rows
from wardstat.session import scratch_path

# the score below which a document is rejected, as in op7's ``predicted``
QUALITY_CUT = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = quality_mil.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    scored = quality_mil.score(docs, model, out_col="_quality_score")
    return scored.filter(f"_quality_score >= {QUALITY_CUT}").select(*docs.columns)


def unused(docs: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, 0.8): the one
    with the smallest id, rows without an id last, then the first stored.
    Rows are told apart by a number of their own, so rows that share an id, or
    have none, but hold different texts all stay, and copies among them do not.
    """
    row = unused(docs, "row_number")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "corpus-rows")
    found = near_dup.near_duplicates(numbered.select(row, "text"), id_col=row, shingle_words=5, percent=80)
    ids = numbered.select(F.col(row).alias("n"), "doc_id")
    named = found.select(F.col(row).alias("n"), "component_id").join(ids, "n")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "n")).alias("first"))
    return numbered.join(first.select(F.col("first.n").alias(row)), row, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Sizes, weights and the cuts need no texts: those meet the decisions in
    one join.  Rows that share id and source are taken alike.
    """
    sizes = docs.select("doc_id", "source", mixing.word_count().alias("_n"))
    weighted = label_weights(sizes, table(spark, sf_dir, "labels"))
    mixed = mixing.mix_sizes(weighted, F.col("_n"), F.col("_weight"))
    i, s, n, k = (unused(docs, c) for c in ("mix_id", "mix_source", "mix_copies", "mix_copy"))
    one = mixed.groupBy(F.col("doc_id").alias(i), F.col("source").alias(s)).agg(F.max("copies").alias(n))
    same = docs["doc_id"].eqNullSafe(F.col(i)) & docs["source"].eqNullSafe(F.col(s))
    repeated = F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))
    return docs.join(one.filter(F.col(n) > 0), same).select(*docs.columns, repeated.alias(k)).drop(k)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's ids stand in the written token blocks."""
    return token_rows(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("token-ID / binary output", tokens),
]

# a trained model, a byte-pair tokenizer and a coder: not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_path(spark, "corpus-stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
