"""Mixing sources to target weights by hash-random order and distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.llm._text import carried
from terrapulse.session import materialise

WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, *, seed: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """One small row per document: id, source, number of words and a random, repeatable key."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text"), F.lit("")))))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", *carry, size.alias("size"), key.alias("key"))


def targets(per_source: DataFrame, *, weights: tuple[int, ...], share: float, max_repeat: int) -> DataFrame:
    """Words to take of each source (input: ``source``, ``source_size``; one row per source).

    Sources in code-point order, null last, get the weights in turn.  The level at which targets stop growing is
    found in closed form: sources are ordered by the ratio cap / weight, those before the cut get their cap, the rest
    divide what is left by weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ratio = Window.orderBy("ratio", "rank")
    everything = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    t = per_source.withColumn("rank", F.row_number().over(order)).withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    t = t.withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("want", F.sum("source_size").over(everything) * F.lit(float(share)))
    before = F.coalesce(F.sum("cap").over(ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(ratio.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("level", (F.col("want") - before) / after).withColumn("at", F.row_number().over(ratio))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level"))).over(everything)["level"]
    return t.withColumn("target", F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))).select("source", "source_size", "target", "n_docs")


def mix_sources(docs: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeat: int = 2, seed: int = 17, carry: tuple[str, ...] = ()) -> DataFrame:
    """Words that a mix takes of each document.

    Returns per row: ``doc_id``, ``source``, the columns named in ``carry``, ``size``, ``source_size``, ``target``,
    ``epochs`` (whole repeats of the source) and ``taken``.  Every source gives exactly ``floor(target)`` words: all
    documents are taken in each whole epoch, then documents in the order of their keys until the budget is spent; the
    last one may be cut.  A null text has size 0 and nothing is taken of it; a null source is a source; equal rows
    have equal keys and are interchangeable; an empty table gives no rows.

    The n documents of a source are range-split by key into about sqrt(n) buckets of sqrt(n) documents, so a source
    with a third of all rows is many buckets; sums of buckets, not documents, are accumulated per source.  The prefix
    sums end in one row per source, the key at which its budget is spent; only that row meets the carried columns, so
    texts are not shuffled.  Equal rows share a key; if the budget ends among them, they share the rest, rounded down.
    Carried columns named like a result give way to it.
    """
    carry = carried(carry, "doc_id", "source", "size", "source_size", "target", "epochs", "taken", "key")
    rows = materialise(sized(docs, seed=seed, carry=carry))
    small = rows.select("source", "size", "key")
    per_source = targets(small.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), weights=weights, share=share, max_repeat=max_repeat)
    budget = F.floor("target").cast("long")
    per_source = per_source.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.lit(max_repeat), F.floor(budget / F.col("source_size")))).otherwise(0).cast("long"))
    per_source = materialise(per_source.withColumn("rest", budget - F.col("epochs") * F.col("source_size")).withColumn("buckets", F.ceil(F.sqrt("n_docs"))))
    same = F.col("r.source").eqNullSafe(F.col("s.source"))
    bucket = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)) * F.col("buckets")).cast("long")
    dealt = small.alias("r").join(per_source.alias("s"), same).select("r.*", "rest", bucket.alias("bucket"))
    keys = dealt.groupBy("source", "bucket", "key", "rest").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    sums = keys.groupBy("source", "bucket", "rest").agg(F.sum("size").alias("b_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("b_before", F.coalesce(F.sum("b_size").over(earlier), F.lit(0)))
    # the budget ends in one bucket of each source; only its documents are ordered
    last = sums.where("b_before <= rest AND rest < b_before + b_size").select("source", "bucket", "b_before")
    inner = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    ends = keys.alias("r").join(last.alias("s"), same & (F.col("r.bucket") == F.col("s.bucket"))).select("r.source", "r.key", "r.size", "r.n", "r.rest", "b_before")
    ends = ends.withColumn("before", F.col("b_before") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
    ends = ends.where("before <= rest AND rest < before + size").select("source", F.col("key").alias("cut"), F.floor((F.col("rest") - F.col("before")) / F.col("n")).cast("long").alias("part"))
    # written, so that its size is known: a row a source is sent to the texts, not the texts dealt out by source
    cuts = materialise(per_source.alias("r").join(ends.alias("s"), same, "left").select("r.source", "source_size", "target", "epochs", "cut", "part"))
    # without a cut the whole epochs are the whole target
    more = F.when(F.col("key") < F.col("cut"), F.col("size")).when(F.col("key") == F.col("cut"), F.col("part")).otherwise(F.lit(0))
    done = rows.alias("r").join(cuts.alias("s"), same).select("r.*", "source_size", "target", "epochs", "cut", "part")
    return done.select("doc_id", "source", *carry, "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size") + more).cast("long").alias("taken"))
