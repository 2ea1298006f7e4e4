"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapulse.llm._text import FOLD, carried
from terrapulse.session import materialise

#: Test strings are broadcast in blocks of at most so many bytes of item text; a larger set takes several passes.
BLOCK_BYTES = 32 << 20


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def windows_of(words: list[bytes], width: int) -> Iterable[tuple[bytes, ...]]:
    """All runs of ``width`` words; fewer words, but not none, are one window."""
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else ()


class WuManber:
    """Shift tables over blocks of two words, suffix-and-prefix buckets, direct comparison; one table per length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]]):
        self.tables = []
        by_length = defaultdict(dict)
        for p, ids in patterns.items():
            by_length[len(p)][p] = ids
        for m, group in sorted(by_length.items()):
            block = min(2, m)
            shift: dict[tuple[bytes, ...], int] = {}
            bucket = defaultdict(list)
            for p, ids in group.items():
                for end in range(block, m + 1):
                    b = p[end - block : end]
                    shift[b] = min(shift.get(b, m), m - end)
                bucket[p[-block:] + p[:block]].append((list(p), ids))
            self.tables.append((m, block, shift, dict(bucket), m - block + 1))

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(merged hit runs as [start, end), ids of the items found)."""
        runs: list[tuple[int, int]] = []
        ids: set[str] = set()
        n = len(words)
        for m, block, shift, bucket, skip in self.tables:
            i = m
            if block == 2:
                while i <= n:
                    s = shift.get((words[i - 2], words[i - 1]), skip)
                    if s:
                        i += s
                        continue
                    a = i - m
                    for p, found in bucket.get((words[i - 2], words[i - 1], words[a], words[a + 1]), ()):
                        if words[a:i] == p:
                            runs.append((a, i))
                            ids.update(found)
                    i += 1
            else:
                for i, w in enumerate(words):
                    if (w,) in shift:
                        runs.append((i, i + 1))
                        ids.update(bucket[w, w][0][1])
        return merged(runs), ids


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = WuManber(broadcast.value)
        for batch in batches:
            n, runs, items = [], [], []
            old_runs, old_items = batch.column("_runs").to_pylist(), batch.column("_items").to_pylist()
            for text, r, k in zip(batch.column("_text"), old_runs, old_items, strict=True):
                w = words_of(text.as_py())
                found, ids = finder.search(w)
                n.append(len(w))
                runs.append([x for run in merged(found + list(zip(r[0::2], r[1::2], strict=True))) for x in run])
                items.append(sorted(ids | set(k)))
            keep = {"n_words": pa.array(n, pa.int64()), "_runs": pa.array(runs, pa.list_(pa.int64())), "_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([keep[c] if c in keep else batch.column(c) for c in batch.schema.names], schema=batch.schema)

    return run


def find_contamination(
    docs: DataFrame, items: DataFrame, *, width: int = 13, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Words of each document that lie in a window of ``width`` words of a test item.

    Returns per row of ``docs``: ``id_col``, the columns named in ``carry``, ``n_words``, ``hit_runs``
    (array of word positions: start, end, start, end ...), ``n_hit`` and ``item_ids`` (sorted strings).
    A null or empty text has no words and no hits; an item without words is ignored; an item shorter than the
    window is one window; items with equal windows are all reported; repeated rows are judged one by one; a null
    item id is reported as an empty string; carried columns named like a result give way to it; empty tables give no
    rows or no hits.  The documents are scanned once for every ``block_bytes`` of test
    text, without a shuffle; no more than one block is ever on the driver or in a task.
    """
    spark = docs.sparkSession
    carry = carried(carry, id_col, "n_words", "hit_runs", "n_hit", "item_ids", "_text", "_runs", "_items")
    items = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(item_text).cast("binary").alias("t")).where(F.col("t").isNotNull())
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * total // block_bytes))
    none = F.array().cast("array<bigint>")
    df = docs.select(F.col(id_col), *carry, F.col(text_col).cast("binary").alias("_text"), F.lit(0).cast("long").alias("n_words"), none.alias("_runs"), F.array().cast("array<string>").alias("_items"))
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        patterns: dict[tuple[bytes, ...], list[str]] = defaultdict(list)
        for row in part.toLocalIterator():
            for w in windows_of(words_of(bytes(row.t)), width):
                patterns[w].append(row.i)
        df = df.mapInArrow(_scan(spark.sparkContext.broadcast(dict(patterns))), df.schema)
        if k + 1 < blocks:
            df = materialise(df)
    hit = F.when(F.size("_runs") > 0, F.aggregate(F.transform(F.filter(F.sequence(F.lit(0), F.size("_runs") - 1), lambda i: i % 2 == 1), lambda i: F.get("_runs", i) - F.get("_runs", i - 1)), F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0).cast("long"))
    return df.select(id_col, *carry, "n_words", F.col("_runs").alias("hit_runs"), hit.alias("n_hit"), F.col("_items").alias("item_ids"))


def is_contaminated(n_words, n_hit):
    """At least a twentieth of a document's words, and at least one, lie in test windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns from :func:`find_contamination`."""
    return df.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))
