"""Sources mixed to target shares of all tokens.

Each page gets a hash-random key.  Within a source, pages are ordered by key: the key's high
bits are the page's *slot*, slots are summed by themselves, the sums are prefix-summed (one
row per source and slot), and only inside a slot rows are ordered.  So the running total of a
source is exact although no task ever holds a source; a source with a third of all pages is
spread over as many slots as any other rows.

The total is the largest at which every delivered source can reach its share within its
cap of repeats (or a total that is asked for).  A source's budget is its share of it: whole
*epochs* of all its pages as often as they fit, then the pages in key order up to the page
whose end is nearest to the budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossweave.llm.tokens import count_tokens
from glossweave.session import cut_lineage

#: Pages that a slot holds on average, far below what a task can order.
PAGES_PER_SLOT = 50_000
MAX_SLOT_BITS = 20
#: Bits of a page's key; slots are its leading bits.
KEY_BITS = 53


def sized_pages(documents: DataFrame, targets: DataFrame, seed: int, vocabulary=None) -> DataFrame:
    """``(doc_id, source, n_tokens, key)`` of the pages of targeted sources that have any token; computed once."""
    wanted = targets.select("source").where("source is not null").distinct()
    pages = documents.select("doc_id", "source", "text").where("text is not null and text <> ''").join(wanted, "source")
    counted = count_tokens(pages, "text", vocabulary=vocabulary).where("n_tokens > 0")
    return cut_lineage(counted.select("doc_id", "source", "n_tokens", F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 64 - KEY_BITS).alias("key")))


def budgets(pages: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """One row per target: its source, share and cap, the tokens it has, and the tokens it is to give.

    Repeated targets of a source add up their shares and keep the highest cap; null shares
    count as 0, null caps as 1.
    """
    asked = (
        targets.where("source is not null")
        .groupBy("source")
        .agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    )
    has = pages.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("pages"))
    rows = asked.join(has, "source", "left").na.fill(0, ["tokens", "pages"])
    reach = F.when((F.col("target_share") > 0) & (F.col("tokens") > 0), F.col("tokens") * F.col("max_repeats") / F.col("target_share"))
    if total_tokens is None:
        total_tokens = rows.agg(F.min(reach)).first()[0] or 0
    asked_for = F.round(F.col("target_share") * F.lit(float(total_tokens)))
    capped = F.least(asked_for, (F.col("tokens") * F.col("max_repeats")).cast("double")).cast("long")
    return rows.withColumn("budget", F.coalesce(capped, F.lit(0).cast("long")))


def placed(pages: DataFrame, per_source: DataFrame, slot_bits: int) -> DataFrame:
    """Each page with the exact tokens of its source before it in key order."""
    keyed = pages.withColumn("_slot", F.shiftright("key", KEY_BITS - slot_bits).cast("int"))
    sums = keyed.groupBy("source", "_slot").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "_slot", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("source", "_slot").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    within = keyed.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return within.join(starts, ["source", "_slot"]).join(per_source, "source").withColumn("before", F.col("_start") + F.col("_inside"))


def mix(documents: DataFrame, targets: DataFrame, *, total_tokens: int | None = None, seed: int = 7, vocabulary=None) -> tuple[DataFrame, DataFrame]:
    """(the mixed set, the shares reached).

    The set has a row per page and copy: ``doc_id, source, copy_no`` (from 1), ``n_tokens,
    target_share, reached_share``; ``copy_no`` never exceeds the source's ``max_repeats``.
    The shares have a row per target: ``source, target_share, max_repeats, tokens_available,
    budget, tokens_taken, pages_taken, copies_taken, reached_share, share_of_delivered``.

    * A source that was never delivered is reported with 0; the others keep their shares to
      one another (``share_of_delivered`` is the target among delivered sources).
    * Null, empty and untargeted pages are in no set.  Pages with the same id are told apart
      by nothing, so ids are expected to be unique; ties of keys are ordered by id.
    * A total beyond a source's cap takes all copies the cap allows and reports the rest as a
      smaller share.  The result depends on ``seed`` and the pages, not on their order.
    """
    pages = sized_pages(documents, targets, seed, vocabulary)
    per_source = budgets(pages, targets, total_tokens)
    slot_bits = min(MAX_SLOT_BITS, (pages.count() // PAGES_PER_SLOT).bit_length())
    at = placed(pages, per_source, slot_bits)
    epochs = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0)
    rest = F.col("budget") - epochs * F.col("tokens")
    # the page that crosses the budget is taken if its end is nearer to the budget than its start
    last = F.when(F.col("before") + F.col("n_tokens") <= rest, 1).when(
        (F.col("before") < rest) & (F.col("before") + F.col("n_tokens") - rest <= rest - F.col("before")), 1
    ).otherwise(0)
    copies = F.least(epochs + last, F.col("max_repeats")).cast("int")
    chosen = cut_lineage(at.select("doc_id", "source", "n_tokens", "target_share", copies.alias("_copies")).where("_copies > 0"))
    taken = chosen.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("_copies")).alias("tokens_taken"), F.count(F.lit(1)).alias("pages_taken"), F.sum("_copies").alias("copies_taken")
    )
    per_target = per_source.join(taken, "source", "left").na.fill(0, ["tokens_taken", "pages_taken", "copies_taken"])
    sums = per_target.agg(F.sum(F.when(F.col("tokens") > 0, F.col("target_share"))), F.sum("tokens_taken")).first()
    delivered, every = (F.lit(x).cast("double") for x in sums)
    shares = per_target.select(
        "source",
        "target_share",
        "max_repeats",
        F.col("tokens").alias("tokens_available"),
        "budget",
        "tokens_taken",
        "pages_taken",
        "copies_taken",
        F.coalesce(F.try_divide(F.col("tokens_taken"), every), F.lit(0.0)).alias("reached_share"),
        F.coalesce(F.try_divide(F.when(F.col("tokens") > 0, F.col("target_share")), delivered), F.lit(0.0)).alias("share_of_delivered"),
    )
    reached = shares.select("source", "reached_share")
    rows = chosen.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("_copies")))).join(reached, "source")
    return rows.select("doc_id", "source", "copy_no", "n_tokens", "target_share", "reached_share"), shares
