"""Mixing sources to target weights by capped water-filling.

Sources are rated by code point (null last) and get the weights 3, 1, 2 in
turn.  A budget of words is shared by weight; a source whose share passes its
cap (``max_epochs`` times its size) is clamped, and the excess is shared again
by weight among the others until none is above.  A target is then met by whole
repetitions of every document and one fractional repetition: documents in a
seeded order get one more copy until the words are used up; the document at the
border is taken in part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroute.llm.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
SEED = "17:"
BUCKET_HEX = 3          # the seeded order is counted in 16 ** 3 buckets a source


def _size(docs: DataFrame):
    return F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("size")


def _place(docs: DataFrame):
    return F.md5(F.concat(F.lit(SEED), F.coalesce(docs["doc_id"].cast("string"), F.lit("null")))).alias("u")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, its source and size (words; null text 0), and its seeded place u."""
    return docs.select(docs["doc_id"], docs["source"], _size(docs), _place(docs))


def targets(sizes: DataFrame, share_pct: int = 150, max_epochs: int = 2) -> DataFrame:
    """(source, source_size, target) by water-filling over the source totals.

    With sources above their caps set aside, the level (words per weight) only
    rises, so the rounds end after at most as many steps as there are sources;
    each step is one small aggregate over the table of sources.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_point = Window.orderBy(F.col("source").asc_nulls_last())     # one row a source
    rated = (total.withColumn("i", F.row_number().over(by_point))
             .withColumn("weight", F.element_at(F.array(F.lit(3), F.lit(1), F.lit(2)),
                                                F.pmod(F.col("i") - 1, F.lit(3)) + 1)))
    rated = stage(rated, "mix-sources")
    cap = F.col("source_size") * max_epochs
    level, above = None, F.lit(False)
    while True:
        s = rated.agg(
            (F.sum("source_size") * share_pct / 100.0).alias("budget"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weights")).first()
        if not s["weights"] or s["budget"] is None:
            break
        now = (s["budget"] - s["held"], s["weights"])
        if now == level:
            break
        level = now
        above = F.col("weight") * F.lit(now[0]) / F.lit(now[1]) >= cap
    share = (F.col("weight") * F.lit(float(level[0])) / F.lit(level[1]) if level
             else cap.cast("double"))
    return rated.select("source", "source_size",
                        F.least(share, cap.cast("double")).alias("target"))


def _with_need(rows: DataFrame, goals: DataFrame) -> DataFrame:
    g = goals.select(
        F.col("source").alias("g_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(F.lit(0)).alias("whole"))
    g = g.withColumn("extra", F.floor("target") - F.col("whole") * F.col("source_size"))
    return rows.join(g, rows["source"].eqNullSafe(g["g_source"])).drop("g_source")


def _bucket(u):
    return F.substring(u, 1, BUCKET_HEX)


def decide(rows: DataFrame, sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """``rows`` (with source, size, u) plus source_size, target, whole, part.

    whole: full repetitions; part: words of the one fractional repetition.
    Per source only the bucket in which the extra words end is put in order;
    the buckets before it are taken in full, those after it not at all.
    """
    counts = sizes.groupBy("source", _bucket(F.col("u")).alias("bucket")).agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
    last = (_with_need(buckets, goals)
            .where((F.col("before") < F.col("extra")) & (F.col("before") + F.col("words") >= F.col("extra")))
            .groupBy(F.col("source").alias("l_source"))
            .agg(F.min("bucket").alias("l_bucket"), F.min("before").alias("l_before")))
    # written, so that their size is known when they meet the documents
    last = stage(last, "mix-last")
    keys = sizes.join(last, sizes["source"].eqNullSafe(last["l_source"])
                      & (_bucket(sizes["u"]) == last["l_bucket"]))
    keys = keys.groupBy("l_source", "l_before", "u").agg(F.sum("size").alias("k_size"))
    inner = Window.partitionBy("l_source").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)
    keys = keys.select(
        F.col("l_source").alias("k_source"), F.col("u").alias("k_u"), "k_size",
        (F.col("l_before") + F.coalesce(F.sum("k_size").over(inner), F.lit(0))).alias("k_before"))
    keys = stage(keys, "mix-keys")
    out = _with_need(rows, goals)
    out = out.join(last, out["source"].eqNullSafe(last["l_source"]), "left")
    out = out.join(keys, out["source"].eqNullSafe(keys["k_source"]) & (out["u"] == keys["k_u"]), "left")
    part = (F.when((F.col("extra") <= 0) | (F.col("size") == 0), 0)
            .when(F.col("l_bucket").isNull() | (_bucket(F.col("u")) < F.col("l_bucket")), F.col("size"))
            .when(_bucket(F.col("u")) > F.col("l_bucket"), 0)
            # rows that share a place share what is left of it
            .otherwise(F.expr("size * least(greatest(extra - k_before, 0), k_size) div k_size")))
    return (out.withColumn("part", part.cast("long"))
            .drop("l_source", "l_bucket", "l_before", "k_source", "k_u", "k_size", "k_before", "extra"))


def mix_plan(docs: DataFrame, share_pct: int = 150, max_epochs: int = 2) -> DataFrame:
    """doc_id, size, source_size, target, taken, whole, part for every document.

    Null texts have size 0 and are never taken; a null source is a source of
    its own; repeated rows are documents of their own that share a place in the
    seeded order; an empty table gives no rows.
    """
    sizes = stage(sized(docs), "mix-sizes")
    plan = decide(sizes, sizes, targets(sizes, share_pct, max_epochs))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("whole") * F.col("size") + F.col("part")).alias("taken"),
                       "whole", "part")


def mix_documents(docs: DataFrame, share_pct: int = 150, max_epochs: int = 2) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each repetition.

    A fractional repetition keeps the document's first words, joined by a space;
    ``n_chars``, where present, follows the text.
    """
    own = docs.columns
    sizes = stage(sized(docs), "mix-sizes")
    rows = docs.select(F.struct(*[docs[c] for c in own]).alias("doc"),
                       docs["source"], _size(docs), _place(docs))
    out = decide(rows, sizes, targets(sizes, share_pct, max_epochs))
    whole = F.array_repeat(F.col("size"), F.col("whole").cast("int"))
    copies = F.filter(F.concat(whole, F.array(F.col("part"))), lambda n: n > 0)
    out = out.select("doc", "size", F.explode(copies).alias("words"))
    first = F.slice(F.regexp_extract_all("doc.text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("words").cast("int"))
    cut = F.array_join(first, " ")
    text = F.when(F.col("words") >= F.col("size"), F.col("doc.text")).otherwise(cut)
    new = {"text": text}
    if "n_chars" in own:
        new["n_chars"] = F.when(F.col("words") >= F.col("size"), F.col("doc.n_chars")).otherwise(
            F.length(cut).cast("long"))
    return out.select(*[new.get(c, F.col("doc")[c]).cast(docs.schema[c].dataType).alias(c) for c in own])
