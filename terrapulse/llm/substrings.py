"""Repeated byte strings of a minimum length, by suffix arrays of buckets.

Equal strings of ``length`` bytes share an anchor: of their 32-byte grams the one with the least hash (the leftmost, if
several).  So the strings can be dealt out by anchor.

1.  A scan cuts every text into runs of window starts with one anchor.  A run's context is the bytes that its windows
    span.  Of contexts with equal hashes only the first can hold first occurrences; the others are taken for copies of
    it, within a slice of the scan before the shuffle, then across slices.  Every such copy is compared with its first
    as bytes: neighbouring copies with one source are joined to spans first, so the bytes of a span move once.
2.  Anchors with one context hold no repeat that is left.  The contexts of the others are dealt out by anchor, and a
    task builds the Burrows-Wheeler transform of a bounded batch of them.  Breadth-first backward extension from the
    empty string gives longest common prefixes by increasing value and stops at ``length``: neighbours in the suffix
    array without a value by then share a string.  Of each such set all but the first are marked.
3.  The windows of an anchor with very many different contexts are dealt out by their whole strings, so that no task
    gets all of them.

Hashes only deal out work: nothing is removed that was not compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from terrapulse.llm._text import mix, slices
from terrapulse.session import materialise

GRAM = 32
#: A batch of contexts for one suffix array, bytes; and contexts of one anchor beyond which it is dealt out further.
BATCH_BYTES, HOT_CONTEXTS = 1 << 20, 4096
#: Bytes of text that are scanned at once.
SCAN_BYTES = 1 << 20
#: What is cut out of a text: the context of a cool or a hot anchor, a copy, a source of copies.
COOL, HOT, COPY, SOURCE = 0, 1, 2, 3
MARK = "doc long, tag long, s long, e long"
COLLISION = "two different strings have one 128-bit hash"
_P = 0x9E3779B97F4A7C15


def doubled(data: np.ndarray, steps: int) -> Iterator[np.ndarray]:
    """Hashes of all strings of 2, 4, 8 ... bytes; the last ones of each array reach past the end."""
    h, p = data.astype(np.uint64) + np.uint64(1), _P
    for k in range(steps):
        n = 1 << k
        nxt = h.copy()
        nxt[:-n] += h[n:] * np.uint64(p)
        h, p = nxt, p * p % (1 << 64)
        yield h


def windowed_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for every i with a whole window."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(-1, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - width + 1], head[width - 1 : n])


def anchored_runs(texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """Runs of window starts with one anchor: text, first start, end of the last window, anchor's offset, keys."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = {k: np.zeros(0, np.int64) for k in ("doc", "s", "e", "off", "key", "ctx")}
    if len(data) < length:
        return none
    h32, h64 = list(doubled(data, 6))[4:]
    bits = max(23, int(len(data)).bit_length())
    order = mix(h32)
    packed = order >> np.uint64(bits) << np.uint64(bits) | np.arange(len(data), dtype=np.uint64)
    anchor = (windowed_min(packed[: len(data) - GRAM + 1], length - GRAM + 1) & np.uint64((1 << bits) - 1)).astype(np.int64)
    del packed
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    valid = np.arange(len(anchor)) + length <= ends[doc]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(anchor)) - 1
    keep = valid[a]
    a, b = a[keep], b[keep]
    if not len(a):
        return none
    e = b + length
    middle = a + (e - a - 64) // 2
    ctx = mix(mix(mix(h64[a] + (e - a).astype(np.uint64)) + h64[middle]) + h64[e - 64])
    begin = (ends - sizes)[doc[a]]
    return {"doc": doc[a], "s": a - begin, "e": e - begin, "off": anchor[a] - a, "key": order[anchor[a]].view(np.int64), "ctx": ctx.view(np.int64)}


def merged(doc: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of each text joined; the input is in order of text and start, ends do not fall."""
    if not len(s):
        return doc, s, e
    first = np.ones(len(s), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (s[1:] > e[:-1])
    last = np.append(np.flatnonzero(first)[1:], len(s)) - 1
    return doc[first], s[first], e[last]


def parts_of(texts: list[bytes], length: int, limit: int = SCAN_BYTES) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (place in ``texts``, offset, bytes), all texts in one; a long text alone, cut so that each string of ``length`` bytes is whole in one part."""
    if len(texts) == 1 and len(texts[0]) > limit:
        for at in range(0, len(texts[0]) - length + 1, limit):
            yield [(0, at, texts[0][at : at + limit + length - 1])]
    else:
        yield [(i, 0, t) for i, t in enumerate(texts)]


def _scan(length: int):
    names = ["key", "ctx", "doc", "tag", "s", "e", "done"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag"))
            for start, texts in slices(batch.column("text"), SCAN_BYTES):
                here = slice(start, start + len(texts))
                order = np.lexsort((tags[here], ids[here]))
                i, t = ids[here][order], tags[here][order]
                for parts in parts_of([texts[k] for k in order], length):
                    which, offset = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
                    x = anchored_runs([p[2] for p in parts], length)
                    both = mix(x["key"].view(np.uint64) + mix(x["ctx"].view(np.uint64)))
                    # of repeated rows the same places are equal, not earlier
                    _, at, back = np.unique(both, return_index=True, return_inverse=True)
                    first = at[back]
                    d0, s0 = x["doc"], x["s"]
                    same = (i[which[d0]] == i[which[d0[first]]]) & (t[which[d0]] == t[which[d0[first]]]) & (s0 == s0[first]) if len(first) else np.zeros(0, bool)
                    own = np.zeros(len(first), bool)
                    own[at] = True
                    again = np.flatnonzero(~own & ~same)
                    for a, b in zip(again.tolist(), first[again].tolist(), strict=True):
                        if parts[d0[a]][2][s0[a] : x["e"][a]] != parts[d0[b]][2][s0[b] : x["e"][b]]:
                            raise RuntimeError(COLLISION)
                    s1, e1 = (x[c] + offset[d0] if len(d0) else x[c] for c in ("s", "e"))
                    d, s, e = merged(d0[again], s1[again], e1[again])
                    k, doc = len(s), which[d0] if len(d0) else d0
                    dd = which[d] if k else d
                    cols = [np.concatenate(p) for p in ((x["key"][own], mix(np.arange(k, dtype=np.uint64) + i[dd].astype(np.uint64)).view(np.int64)), (x["ctx"][own], np.zeros(k, np.int64)), (i[doc[own]], i[dd]), (t[doc[own]], t[dd]), (s1[own], s), (e1[own], e))]
                    yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int64)) for c in cols], pa.array(np.arange(len(cols[0])) >= int(own.sum()))], names=names)

    return run


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, by prefix doubling."""
    n = len(symbols)
    rank, step = symbols.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1 if step < n else 0
        pair = rank * (n + 300) + after
        order = np.argsort(pair, kind="stable")
        sorted_ = pair[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], sorted_[1:] != sorted_[:-1])))
        step *= 2
        if step >= depth or step >= n or rank[order[-1]] == n - 1:
            return order


def repeated(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, group of each entry): entries of a group share their first ``length`` symbols.

    ``symbols`` are at least 1, with 0 between strings; only entries with ``length`` symbols before the next 0 mean
    anything.  Intervals of the suffix array start with that of the empty string; extending one by the symbols that
    precede it gives intervals of strings longer by one.  The entry after a new interval's end gets its common prefix
    with the one before, unless a shorter string gave it already; then the interval needs no extension.
    """
    n = len(symbols)
    order = suffix_order(symbols, length)
    bwt = symbols[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[by_symbol] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    lo, hi = np.array([0]), np.array([n - 1])
    for _ in range(length):
        if not len(lo):
            break
        size = hi - lo + 1
        which = np.repeat(np.arange(len(lo)), size)
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + lo[which]
        keep = bwt[at] > 0
        which, to, sym = which[keep], lf[at[keep]], bwt[at[keep]]
        # the entries of one interval with one symbol map to neighbours, in order
        o = np.argsort(which * 512 + sym, kind="stable")
        pair, to = (which * 512 + sym)[o], to[o]
        start = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, np.int64)
        lo, hi = to[start], to[np.append(start[1:], len(pair)) - 1] if len(pair) else to[:0]
        new = ~known[hi + 1]
        lo, hi = lo[new], hi[new]
        known[hi + 1] = True
    return order, np.cumsum(known[:n])


def later_windows(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """Of each context the window starts whose string starts earlier in the list, too."""
    sizes = np.fromiter((len(c) + 1 for c in contexts), np.int64, len(contexts))
    symbols = np.zeros(int(sizes.sum()), np.int64)
    inside = np.ones(len(symbols), bool)
    inside[np.cumsum(sizes) - 1] = False
    symbols[inside] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int64) + 1
    order, group = repeated(symbols, length)
    which = np.repeat(np.arange(len(contexts)), sizes)
    left = np.repeat(np.cumsum(sizes) - 1, sizes) - np.arange(len(symbols))
    valid = left[order] >= length
    at, g = order[valid], group[valid]
    first = np.full(int(group[-1]) + 1, len(symbols), np.int64)
    np.minimum.at(first, g, at)
    late = np.sort(at[at != first[g]])
    own = late - (np.cumsum(sizes) - sizes)[which[late]]
    return np.split(own, np.searchsorted(which[late], np.arange(1, len(contexts))))


def _mark_batch(length: int):
    def marks(held: list[tuple]) -> pa.RecordBatch:
        rows = [(d, t, s + int(x), s + int(y)) for (d, t, s, _), w in zip(held, later_windows([h[3] for h in held], length), strict=True) for x, y in zip(*merged(np.zeros(len(w)), w, w + length)[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["doc", "tag", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc", "tag", "s", "context")), strict=True):
                if size > BATCH_BYTES and key != last:
                    yield marks(held)
                    held, size = [], 0
                held.append(tuple(row))
                size += len(row[3]) + 1
                last = key
        if held:
            yield marks(held)

    return run


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "tag", "fdoc", "ftag", "fs", "s", "e"]
    for batch in batches:
        out = []
        for doc, tag, fdoc, ftag, shift, x in zip(*(batch.column(c).to_pylist() for c in ("doc", "tag", "fdoc", "ftag", "shift", "x")), strict=True):
            s, e = (np.array([r[c] for r in x]) for c in ("s", "e"))
            out += [(doc, tag, fdoc, ftag, int(a) + shift, int(a), int(b)) for a, b in zip(*merged(np.zeros(len(s)), s, e)[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(7)], names=names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["kind", "key", "doc", "tag", "s", "e", "context"]
    for batch in batches:
        for doc, tag, text, runs in zip(batch.column("doc").to_pylist(), batch.column("tag").to_pylist(), batch.column("text"), batch.column("runs").to_pylist(), strict=True):
            text = text.as_py()
            for at in range(0, len(runs), 4096):
                some = runs[at : at + 4096]
                # a copy goes under the place of its source
                rows = [(r["kind"], r["key"], r["fdoc"], r["ftag"], r["fs"], r["fs"] + r["e"] - r["s"], text[r["s"] : r["e"]]) if r["kind"] == COPY else (r["kind"], r["key"], doc, tag, r["s"], r["e"], text[r["s"] : r["e"]]) for r in some]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int32(), *[pa.int64()] * 5, pa.binary()), strict=True)], names=names)


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, tag, s, c in zip(*(batch.column(c).to_pylist() for c in ("doc", "tag", "s", "context")), strict=True):
                out += [(c[i : i + length], doc, tag, s + i) for i in range(len(c) - length + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.int64()))], names=["w", "doc", "tag", "s"])

    return run


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "spans")), strict=True):
            text, kept, at, removed, n = text or b"", hashlib.sha256(), 0, 0, 0
            runs: list[list[int]] = []
            for x in sorted((x["s"], x["e"]) for x in spans or ()):
                if runs and x[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], x[1])
                else:
                    runs.append(list(x))
            for s, e in runs:
                kept.update(text[at:s])
                at, removed, n = e, removed + e - s, n + 1
            kept.update(text[at:])
            rows.append((len(text), removed, n, kept.hexdigest(), [y for r in runs for y in r]))
        cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def remove_repeats(docs: DataFrame, *, length: int = 100) -> DataFrame:
    """Bytes of whole texts that are covered by a string of ``length`` bytes which also starts earlier.

    Returns per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``removed`` (array: start, end, start,
    end ... in bytes).  Earlier is a smaller id, or an earlier start in the same document; a null id comes last, and
    among rows of one id with different texts a hash of the text decides; of equal rows neither is earlier.  A null
    text is empty; a text shorter than ``length`` keeps all; an empty table gives no rows; long texts are scanned in
    parts; other columns are not read.  Ids must be integers.  Two strings with one 128-bit hash would stop the job.
    """
    if length < 64 + GRAM or length > 192 - GRAM:
        raise ValueError("length must be from 96 to 160")
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("doc_id must be of an integer type")
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("tag"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    runs = base.where(F.length("text") >= length).select("doc", "tag", "text").mapInArrow(_scan(length), "key long, ctx long, doc long, tag long, s long, e long, done boolean")
    one = Window.partitionBy("key", "ctx")
    place = F.struct("doc", "tag", "s")
    anchor = Window.partitionBy("key")
    seen = runs.withColumn("from", F.min(place).over(one)).withColumn("several", F.min("ctx").over(anchor) != F.max("ctx").over(anchor))
    later = ~F.col("done") & (F.col("from") != place)
    seen = seen.withColumn("from", F.when(later, F.col("from"))).where(F.col("done") | F.col("from").isNotNull() | F.col("several"))
    seen = materialise(seen.select("key", "doc", "tag", "s", "e", "done", "from"))
    marks = seen.where("done").select("doc", "tag", "s", "e")
    # copies side by side with one source are one span; a run's windows end before the next run's last
    copies = seen.where("from IS NOT NULL").select("doc", "tag", "s", "e", F.col("from.doc").alias("fdoc"), F.col("from.tag").alias("ftag"), (F.col("from.s") - F.col("s")).alias("shift")).distinct()
    copies = copies.groupBy("doc", "tag", "fdoc", "ftag", "shift").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("x"))
    copies = materialise(copies.select("doc", "tag", "fdoc", "ftag", "shift", "x").mapInArrow(_spans, "doc long, tag long, fdoc long, ftag long, fs long, s long, e long"))
    left = seen.where("NOT done AND from IS NULL").select("key", "doc", "tag", "s", "e").distinct()
    left = left.join(left.groupBy("key").agg(F.when(F.count(F.lit(1)) > HOT_CONTEXTS, HOT).otherwise(COOL).alias("kind")), "key")
    nothing = [F.lit(0).cast("long").alias(c) for c in ("fdoc", "ftag", "fs")]
    zero = F.lit(0).cast("long").alias("key")
    sources = copies.select(F.lit(SOURCE).alias("kind"), zero, F.col("fdoc").alias("doc"), F.col("ftag").alias("tag"), F.col("fs").alias("s"), (F.col("fs") + F.col("e") - F.col("s")).alias("e"), *nothing).distinct()
    asked = left.select("kind", "key", "doc", "tag", "s", "e", *nothing).union(copies.select(F.lit(COPY).alias("kind"), zero, "doc", "tag", "s", "e", "fdoc", "ftag", "fs")).union(sources)
    asked = asked.groupBy("doc", "tag").agg(F.collect_list(F.struct("kind", "key", "s", "e", "fdoc", "ftag", "fs")).alias("runs"))
    cut = base.select("doc", "tag", "text").join(asked, ["doc", "tag"]).select("doc", "tag", "text", "runs")
    cut = materialise(cut.mapInArrow(_cut, "kind int, key long, doc long, tag long, s long, e long, context binary"))
    source = cut.where(F.col("kind") == SOURCE).select("doc", "tag", "s", "e", F.col("context").alias("was")).distinct()
    compared = cut.where(F.col("kind") == COPY).join(source, ["doc", "tag", "s", "e"], "left")
    differ = compared.where("was IS NULL OR was <> context").limit(1)
    if not differ.isEmpty():
        raise RuntimeError(COLLISION)
    marks = marks.union(copies.select("doc", "tag", "s", "e"))
    contexts = cut.where(F.col("kind").isin(COOL, HOT)).distinct()
    cool = contexts.where(F.col("kind") == COOL).repartition(tasks, "key").sortWithinPartitions("key", "doc", "tag", "s")
    marks = marks.union(cool.select("key", "doc", "tag", "s", "context").mapInArrow(_mark_batch(length), MARK))
    spread = contexts.where(F.col("kind") == HOT).select("doc", "tag", "s", "context").mapInArrow(_windows(length), "w binary, doc long, tag long, s long")
    hot = spread.withColumn("later", F.min(place).over(Window.partitionBy("w")) != place).where("later")
    marks = marks.union(hot.select("doc", "tag", "s", (F.col("s") + length).alias("e")))
    spans = marks.groupBy("doc", "tag").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    kind = dict(base.dtypes)["doc_id"]
    return base.join(spans, ["doc", "tag"], "left").select("doc_id", "text", "spans").mapInArrow(_keep, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<bigint>")
