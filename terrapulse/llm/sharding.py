"""Sharding by proportional stratified interleaving: every shard holds every source in the corpus's proportions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.llm._text import carried
from terrapulse.session import materialise

#: Bytes that a row costs beside its text.
ROW_BYTES = 8


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) and a fixed cost for the row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")


def text_crc(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; that of no bytes (0) for a null text."""
    return F.crc32(F.coalesce(text.cast("binary"), F.lit(b"")))


def shuffled(docs: DataFrame, *, seed: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """One small row per document: id, stratum, size, checksum, and a repeatable random key."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text"), F.lit("")))))
    # a null source is a stratum of its own, behind all others
    stratum = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))
    return docs.select("doc_id", *carry, text_size(F.col("text")).alias("size"), text_crc(F.col("text")).alias("text_crc32"), stratum.alias("stratum"), key.alias("key"))


def fraction_of(key: Column) -> Column:
    """The first 52 bits of a hexadecimal key as a number in [0, 1)."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _numbered(rows: DataFrame, groups: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """Rows with their 0-based place in each group's order, where ``bucket`` already follows that order.

    Buckets, not rows, are accumulated: a group of n rows in sqrt(n) buckets costs a window over sqrt(n) rows and one
    over each bucket.
    """
    keys = [*groups, bucket]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys).orderBy(*order)
    return rows.join(starts, keys).withColumn(out, F.col("_start") + F.row_number().over(within) - 1).drop("_start", bucket)


def interleave(docs: DataFrame, *, shards: int = 24, seed: int = 29, carry: tuple[str, ...] = ()) -> DataFrame:
    """The shard of every document, and its place there.

    Rows of each source are shuffled by a seeded key and ranked; rank r of n rows stands at the fraction (2r + 1) / 2n.
    All rows are sorted by that fraction and cut into ``shards`` runs whose lengths differ by one at most (law
    ``rows``).  Up to a fraction f a source has given n * f rows, half a row off at most; with S sources, cuts
    stand within S / 2 rows of their fraction, so a shard holds each source's share within 1 + S n / N rows.

    Returns per row: ``doc_id``, the columns named in ``carry`` (those named like a result give way), ``source``,
    ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32`` (unsigned), ``law``, ``shard``, ``slot`` (gapless from 0
    in each shard, in the order of the fractions) and ``grown_shard`` (null: under this law more shards are another
    cut).  Groups of equal texts are not kept together: one may hold more rows than a shard.  A null text is empty, a
    null source is a source, equal rows are interchangeable, fewer rows than shards leave shards empty, and an empty
    table gives no rows.  Reruns agree.

    Both ranks come from bucketed prefix sums.  The first deals each source out by key into the root of its rows;
    the second deals all rows out by fraction, which is even by construction.  Two shuffles of small rows; texts are
    never shuffled here, unless carried.
    """
    own = ("doc_id", "source", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "stratum", "key", "n", "rank", "fraction", "place", "total", "_n", "_start", "_bucket")
    carry = carried(carry, *own)
    rows = materialise(shuffled(docs, seed=seed, carry=carry))
    sources = materialise(rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")))
    total = sources.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    dealt = rows.join(sources, "stratum").withColumn("_bucket", F.floor(fraction_of(F.col("key")) * F.ceil(F.sqrt("n"))).cast("long"))
    ranked = _numbered(dealt, ["stratum"], "_bucket", ["key", "doc_id", "text_crc32"], "rank")
    fraction = (2 * F.col("rank") + 1) / (2 * F.col("n"))
    buckets = max(1, round(total**0.5))
    placed = ranked.withColumn("fraction", fraction).withColumn("_bucket", F.floor(F.col("fraction") * buckets).cast("long"))
    placed = _numbered(placed, [], "_bucket", ["fraction", "stratum", "key", "doc_id"], "place")
    shard = F.expr(f"(place * {shards}) div {max(1, total)}")
    # the first place of shard s is ceil(s * total / shards)
    out = placed.withColumn("shard", shard.cast("int"))
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    source = F.when(F.col("stratum") != "1", F.expr("substring(stratum, 2)"))
    return out.select("doc_id", *carry, source.alias("source"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("place") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """Writes a folder ``shard=k`` for each shard, rows in the order of their slots (Parquet)."""
    assigned.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
