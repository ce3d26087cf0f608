"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Each document draws the key ``-ln(u) / weight`` from a hash of its id; small keys go first. A
source's target is taken as whole epochs of all its documents and then, in the order of keys, as
many words as are left. The running sum is a distributed one: totals of key ranges first, then
the order within the one range in which a source's budget ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.text import free_prefix
from candlemill.sources.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
CYCLE = (1, 2, 3)
CAP = 3
SEED = "mix-1"
# Documents of one key range, about; more of them make more ranges, not longer ones.
RANGE_DOCS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_weight(text: Column, size: Column) -> Column:
    """Quality weight: 1 less the symbols per word, 0.1 at least."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(SYMBOL)), F.lit(0))
    return F.greatest(F.lit(0.1), 1.0 - symbols / F.greatest(size, F.lit(1)))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number between 0 and 1, both excluded, from 52 bits of a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(2**52))


def targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, cap: int = CAP) -> DataFrame:
    """``sizes (source, source_size)`` with ``target``.

    Sources by code point, null last, weigh as the cycle says. Targets share all sizes by weight,
    stop at ``cap`` times a source's size, and the excess is shared anew until none is above: in
    the order of cap to weight, a source is capped if the level of those not capped before it is
    higher than its own. Works on one row per source, never on documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(cycle)
    weight = F.element_at(F.array(*[F.lit(c) for c in cycle]), (place + 1).cast("int")).cast("long")
    rows = sizes.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("most") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    open_level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    rows = rows.withColumn("open_level", open_level)
    target = F.when(F.col("level") > F.col("ratio"), F.col("most").cast("double")).otherwise(
        F.col("open_level") * F.col("weight")
    )
    return rows.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame, cycle: tuple[int, ...] = CYCLE, cap: int = CAP, seed: str = SEED
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    size counts words (null text: 0); taken is the words that the mix takes of the document,
    repeats counted: ``target div source_size`` whole epochs, then the rest in key order, where
    the last document may be taken in part. A source's taken words are its target, rounded, and no
    document gives more than ``cap`` times its size. Null sources are one source, the last. Rows
    that repeat a doc_id are documents of their own; ties of keys go by id, size and a hash of the
    text. Other columns are not read. Reruns agree.
    """
    size = word_count(F.col("text"))
    slim = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.col("text").cast("string").alias("text"),
        )
        .withColumn("size", size)
        .withColumn("key", -F.ln(uniform(F.col("doc_id"), seed)) / document_weight(F.col("text"), F.col("size")))
        .select("doc_id", "source", "size", "key", F.xxhash64("text").alias("tie")),
        "sizes",
    )
    per_source = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    per_source = stage(per_source, "sources")
    largest = per_source.agg(F.max("docs")).first()[0] or 0
    ranges = max(16, -(-largest // RANGE_DOCS) * 4)
    # key / (1 + key) spreads keys of any weight over 0 to 1 and keeps their order.
    slim = slim.withColumn("range", F.floor(F.col("key") / (1 + F.col("key")) * ranges).cast("int"))

    budget = targets(per_source.select("source", "source_size"), cycle, cap)
    budget = budget.withColumn("words", F.floor(F.col("target") + 0.5)).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0)
    )
    budget = budget.withColumn("rest", F.col("words") - F.col("epochs") * F.col("source_size")).drop("words")
    totals = slim.groupBy("source", "range").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    plan = totals.alias("t").join(budget.alias("b"), F.col("t.source").eqNullSafe(F.col("b.source"))).select(
        F.col("t.source").alias("p_source"),
        F.col("t.range").alias("p_range"),
        "source_size",
        "target",
        "epochs",
        "rest",
        "before",
        "total",
    )
    rows = slim.join(
        plan, slim["source"].eqNullSafe(plan["p_source"]) & (slim["range"] == plan["p_range"])
    ).drop("p_source", "p_range")
    ends_here = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("total") > F.col("rest"))
    whole = rows.where(~ends_here).withColumn(
        "part", F.when(F.col("before") < F.col("rest"), F.col("size")).otherwise(0)
    )
    order = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", "tie")
    cut = rows.where(ends_here).withColumn(
        "prior", F.col("before") + F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    cut = cut.withColumn(
        "part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("prior")))
    ).drop("prior")
    return whole.unionByName(cut).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"),
    )


def apply_mix(docs: DataFrame, cycle: tuple[int, ...] = CYCLE, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each time a document is taken.

    The last one may hold the first words only, where a source's budget ends. A document without
    words is in no row. Rows of one doc_id and text are taken alike.
    """
    p = free_prefix(docs)
    same = [f"{p}id", f"{p}source", f"{p}size"]
    taken = mix_sources(docs, cycle, cap, seed).where("taken > 0").select("doc_id", "source", "size", "taken")
    # Repeated rows of an id are matched by their rank among equals, not multiplied.
    takes = taken.toDF(*same, f"{p}taken")
    rank = Window.partitionBy(*same).orderBy(F.col(f"{p}taken").desc())
    takes = takes.withColumn(f"{p}rank", F.row_number().over(rank))
    rows = docs.withColumns(
        {
            same[0]: F.col("doc_id").cast("long"),
            same[1]: F.col("source").cast("string"),
            same[2]: word_count(F.col("text")),
        }
    )
    rows = rows.withColumn(f"{p}rank", F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64("text"))))
    on = [rows[c].eqNullSafe(takes[c]) for c in [*same, f"{p}rank"]]
    joined = rows.join(takes, on).select(*[rows[f"`{c}`"] for c in docs.columns], rows[same[2]], f"{p}taken")
    size, left = F.col(same[2]), F.col(f"{p}taken")
    last = F.expr(f"cast(({p}taken - 1) div {same[2]} as int)")
    copies = joined.withColumn(f"{p}copy", F.explode(F.sequence(F.lit(0), last)))
    here = F.least(size, left - F.col(f"{p}copy") * size)
    # Only one document of a source is cut; its words are joined by single spaces.
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), here.cast("int")), " ")
    text = F.when(here == size, F.col("text")).otherwise(cut)
    return copies.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])
