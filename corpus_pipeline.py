"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and, but for the last,
returns documents again (the same columns, whatever further ones there are).
``run`` writes every stage's result to the shared folder and reads it back for
the next one.

Null and empty texts are clean, link with nothing, have nothing to cut, are
never taken by the mix and so end there.  A null doc_id is an id of its own.  Rows
that repeat a doc_id are one document: the near-copy stage keeps one of them.
Ties between copies go to the least doc_id.  An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroute.llm import mixture, packing, prefixjoin, suffixtrees
from stockroute.llm import toxicity as tox
from stockroute.llm.staging import stage, table

#: Near copies of the pipeline: a Jaccard similarity of 0.8 on five-word shingles.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80

#: A classifier and the near-duplicate join are beyond SQL; the pipeline is
#: tested against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a classifier fitted on ``labels``."""
    model = tox.fit(docs, table(spark, sf_dir, "labels"))
    scored = tox.score(docs, model, docs.columns)
    return scored.where(F.col("pu_score") < tox.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near copies, once."""
    found = prefixjoin.near_duplicates(docs, percent=NEAR_PERCENT, shingle=NEAR_SHINGLE)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("kept_id")).distinct()
    kept = docs.join(first, docs["doc_id"].eqNullSafe(first["kept_id"]), "left_semi")
    # narrow, and mostly empty: only ids that repeat are put together
    again = stage(docs.groupBy(docs["doc_id"].alias("again_id")).count().where(F.col("count") > 1).select("again_id"),
                  "pipeline-repeated")
    if again.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(again["again_id"])
    return kept.join(again, same, "left_anti").unionByName(
        kept.join(again, same, "left_semi").dropDuplicates(["doc_id"]))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that also start earlier; emptied documents go."""
    out = suffixtrees.remove_repeats(docs, keep=docs.columns)
    cut = F.col("sf_n_removed") > 0
    changed = {"text": F.when(cut, F.col("sf_kept")).otherwise(F.col("text")),
               "n_chars": F.when(cut, F.length("sf_kept").cast("long")).otherwise(F.col("n_chars"))}
    return (out.where(~cut | (F.col("sf_n_removed") < F.col("sf_n_words")))
            .select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each repetition that a document gets."""
    return mixture.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("source_mix", mix_sources),
    ("bestfit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
