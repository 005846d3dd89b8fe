"""Document fingerprints: a Merkle tree over sections, paragraphs and clauses.

A text is cut into sections (up to a blank line), paragraphs (lines) and
clauses (up to punctuation, at most three words); the parts of a level join up
to the text again.  A clause's digest is its md5, a
paragraph's and a section's the md5 of its children's digests, the root the
sha256 of the sections'.  Equal roots mean equal texts; otherwise the branches
whose digests differ tell where the texts do.

Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECTION = r"(?s).*?\n\n|(?s).+"
PARAGRAPH = r"[^\n]*\n|[^\n]+"
_GAP, _INK = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
CLAUSE = _GAP + "*(?:" + _INK + r"*[^\x20\x09-\x0D.!?,;:]" + _GAP + "+){0,2}" + _INK + "+" + _GAP + "*|" + _GAP + "+"
LEAF_DIGITS = 8             # of a clause's digest in the fingerprint
LEAST = -(1 << 63)


def _parts(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def tree(text: Column) -> Column:
    """Clause digests by section and paragraph: array<array<array<string>>>."""
    clauses = lambda p: F.transform(_parts(p, CLAUSE), lambda c: F.md5(c))
    return F.transform(_parts(text, SECTION), lambda s: F.transform(_parts(s, PARAGRAPH), clauses))


def root(levels: Column) -> Column:
    joined = lambda digests: F.md5(F.array_join(digests, ""))
    sections = F.transform(levels, lambda s: joined(F.transform(s, joined)))
    return F.sha2(F.array_join(sections, ""), 256)


def leaves(levels: Column) -> Column:
    return F.transform(F.flatten(F.flatten(levels)), lambda d: F.substring(d, 1, LEAF_DIGITS))


def paragraphs(levels: Column) -> Column:
    return F.transform(F.flatten(levels), lambda p: F.md5(F.array_join(p, "")))


def fingerprint(root_: Column, leaves_: Column) -> Column:
    """Root and clause digests: enough for equality and for ``likeness``."""
    return F.concat(root_, F.lit(":"), F.array_join(leaves_, ""))


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    """1 for equal roots, else the larger of two shares: of distinct clauses in
    common (Dice), and of places with the same clause."""
    n = F.size(F.array_distinct(leaves_a)) + F.size(F.array_distinct(leaves_b))
    common = F.size(F.array_intersect(leaves_a, leaves_b))
    in_place = F.size(F.filter(F.zip_with(leaves_a, leaves_b, lambda x, y: x == y), lambda same: same))
    return (F.when(root_a == root_b, F.lit(1.0)).when(n == 0, F.lit(0.0))
            .otherwise(F.greatest(F.lit(2.0) * common / n,
                                  F.lit(1.0) * in_place / F.greatest(F.size(leaves_a), F.size(leaves_b)))))


def _splits(keys: DataFrame, rows_per_bucket: int) -> list[int]:
    n = keys.count()
    buckets = max(1, min(4096, n // rows_per_bucket))
    if not n:
        return [LEAST]
    got = keys.agg(F.min("k").alias("least"), F.percentile_approx(
        "k", [i / buckets for i in range(buckets)], 20 * buckets).alias("cuts")).first()
    return sorted({got["least"], *got["cuts"]})


def with_next_text(docs: DataFrame, rows_per_bucket: int = 512) -> DataFrame:
    """doc_id, text, levels (tree) and the next document's text and root and leaves.

    Documents go by doc_id (null first; equal ids by text hash) to buckets of
    neighbours, with one exchange of the texts; the first document of a bucket
    is also sent to the bucket before it (the first of all to the last).
    """
    rows = docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"),
                       F.coalesce(docs["doc_id"].cast("long"), F.lit(LEAST)).alias("k"))
    cuts = _splits(rows.select("k"), rows_per_bucket)
    m = len(cuts)
    steps = [1 << i for i in reversed(range(m.bit_length()))]
    at = F.array(*[F.lit(c) for c in cuts])
    # binary search: the number of cuts not above k
    bucket = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda i, s: F.when((i + s <= m) & (F.get(at, F.least(i + s, F.lit(m)) - 1) <= F.col("k")), i + s).otherwise(i))
    dealt = rows.withColumn("b", bucket)
    before = F.when(F.col("b") == 1, F.lit(m)).otherwise(F.col("b") - 1)
    places = F.when(F.get(at, F.col("b") - 1) == F.col("k"),
                    F.array(F.struct(F.col("b").alias("bucket"), F.lit(False).alias("guest")),
                            F.struct(before.alias("bucket"), F.lit(True).alias("guest")))) \
        .otherwise(F.array(F.struct(F.col("b").alias("bucket"), F.lit(False).alias("guest"))))
    dealt = dealt.select("doc_id", "text", "k", F.explode(places).alias("p")).select(
        "doc_id", "text", "k", "p.bucket", "p.guest").repartition(F.col("bucket"))
    known = dealt.withColumn("levels", tree(F.col("text"))).select(
        "*", root(F.col("levels")).alias("root"), leaves(F.col("levels")).alias("leaves"))
    order = Window.partitionBy("bucket").orderBy("guest", "k", F.xxhash64("text"))
    return (known.select(
        "doc_id", "text", "root", "leaves", "guest",
        F.lead("text").over(order).alias("next_text"), F.lead("root").over(order).alias("next_root"),
        F.lead("leaves").over(order).alias("next_leaves"))
        .where(~F.col("guest")).drop("guest"))


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last half replaced by the beginning of the next
    document.  Null texts count as empty (no clause); an empty text is like
    another empty text only.  Repeated rows are documents of their own; an
    empty table gives no rows.
    """
    d = with_next_text(docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    d = d.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half),
                                        F.substring("next_text", F.lit(1), half)))
    d = d.withColumn("e_levels", tree(F.col("edited")))
    d = d.withColumn("e_root", root(F.col("e_levels"))).withColumn("e_leaves", leaves(F.col("e_levels")))
    return d.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("root"), F.col("leaves")).alias("fingerprint"),
        fingerprint(F.col("e_root"), F.col("e_leaves")).alias("edited_fingerprint"),
        likeness(F.col("root"), F.col("leaves"), F.col("e_root"), F.col("e_leaves")).alias("near_edited"),
        likeness(F.col("root"), F.col("leaves"), F.col("next_root"), F.col("next_leaves")).alias("near_next"))


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Numbers of the paragraphs of text ``a`` whose digest no paragraph of ``b`` has."""
    other = paragraphs(tree(F.coalesce(b, F.lit(""))))
    mine = paragraphs(tree(F.coalesce(a, F.lit(""))))
    return F.filter(F.transform(mine, lambda d, i: F.when(~F.array_contains(other, d), i)),
                    lambda i: i.isNotNull())
