"""Near-duplicates by improved consistent weighted sampling over TF-IDF weighted shingles.

1.  Document frequencies are counted exactly over all documents for every shingle that a hundredth of them hold; rarer
    ones share the largest weight.  Counts of 2^18 hashed features, which are never too low, tell which shingles can be
    as frequent; only those are counted by themselves.
2.  Each text gets K consistent weighted samples: for element k with weight S the sampler draws r, c ~ Gamma(2, 1) and
    b ~ U(0, 1) from k alone, sets t = floor(ln S / r + b) and a = ln c - r (t - b) - r; the element with the least a,
    together with its t, is the sample.  Two texts share a sample with the probability of their weighted Jaccard
    similarity.  The draws come from a table; of elements with the same least a the one with the least hash is the
    sample, so that long texts, in which many elements share a draw, do not agree by chance.
3.  Samples are banded.  Texts with equal words collapse to one before anything is compared.  Every member of a band is
    compared with the band's most central member.  The members that are not near it are then held, in blocks, against
    all members of the band: pairs whose shares of equal samples leave no real chance of a link are dropped, the rest
    are compared.  Two members near the centre are in one class anyway, so no pair that matters is left out.
4.  Each comparison is verified by the exact weighted Jaccard similarity, and verified links are closed to classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapulse.llm._text import FOLD, hashed_words, mix, shingles, slices
from terrapulse.operators.components import connected_components
from terrapulse.session import materialise

#: Counters that tell which shingles can be frequent; they decide on no weight.
FEATURES = 1 << 18
#: Draws of (r, ln c, b); an element picks one for each of its K samples.
DRAWS = 1 << 16
BANDS, ROWS = 25, 5
#: Shingles of fewer documents than this share count as rare; the weight of a shingle that all documents hold is
#: 1 and that of a rare one 1 + DAMPING.  Undamped, a group of copies would raise the frequency of its own text until
#: its few edited words outweigh the rest.
RARE, DAMPING, STEPS = 0.01, 0.25, 8
#: Pairs of a band whose share of equal samples is so far below the threshold are not compared: 3.3 deviations of 125
#: samples at 0.8.
SLACK = 0.12
#: Members of a band that are held against the others at a time.
BLOCK = 256
#: Shingles of heavy features that a task holds before it passes their counts on.
HELD = 1 << 21


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    u = [(mix(np.arange(DRAWS, dtype=np.uint64) + np.uint64(j * DRAWS + 1)) >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54 for j in range(5)]
    return -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), u[4]


R, LN_C, B = _draws()


def sample_value(weight: float | np.ndarray, at: np.ndarray) -> np.ndarray:
    """a of the sampler for the draws at ``at``; it names (element, t), as it depends on the weight through t only."""
    t = np.floor(np.log(weight) / R[at] + B[at])
    return LN_C[at] - R[at] * (t - B[at]) - R[at]


def sortable(a: np.ndarray) -> np.ndarray:
    """Single-precision numbers as integers of the same order."""
    bits = np.ascontiguousarray(a, np.float32).view(np.uint32)
    return np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31))


class Weights:
    """Weight of a shingle: tf times a damped, stepped idf.

    ``frequent``: sorted hashes of the shingles that are not rare (at most the mean number of shingles a document over
    ``RARE``), ``step`` their steps from 0 (in all documents) to ``STEPS``, which all others have.
    """

    def __init__(self, frequent: np.ndarray, step: np.ndarray):
        self.frequent, self.step = frequent.astype(np.uint64), step
        self.values = 1.0 + DAMPING * np.arange(STEPS + 1) / STEPS
        self.tables = [sortable(sample_value(v, np.arange(DRAWS))) for v in self.values]

    def classes(self, shingle: np.ndarray) -> np.ndarray:
        out = np.full(len(shingle), STEPS, np.int64)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, shingle), len(self.frequent) - 1)
            hit = self.frequent[at] == shingle
            out[hit] = self.step[at[hit]]
        return out


def idf_steps(counts: np.ndarray, n_docs: int) -> np.ndarray:
    """Steps 0 (in all documents) to STEPS (rare) from document frequencies."""
    share = np.clip(counts / max(1, n_docs), RARE, 1.0)
    return np.rint(STEPS * np.log(1.0 / share) / math.log(1.0 / RARE)).astype(np.int64)


def feature_of(shingle: np.ndarray) -> np.ndarray:
    return (shingle & np.uint64(FEATURES - 1)).astype(np.int64)


def term_counts(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order of text, their counts, and the text of each."""
    words, n_words = hashed_words(texts)
    sh, n = shingles(words, n_words, width)
    doc = np.repeat(np.arange(len(texts)), n)
    _, first, tf = np.unique(mix(sh + doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), return_index=True, return_counts=True)
    order = np.argsort(first)
    first = first[order]
    return sh[first], tf[order], doc[first]


def _count_features(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES, np.int64)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                sh, _, _ = term_counts(texts, width)
                total += np.bincount(feature_of(sh), minlength=FEATURES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["f", "n"])

    return run


def _count_shingles(width: int, sent):
    """(shingle, documents) of the shingles whose feature is heavy, summed over a piece of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, held, size = sent.value, [], 0

        def batch() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

        for b in batches:
            for _, texts in slices(b.column(0)):
                sh, _, _ = term_counts(texts, width)
                held.append(sh[heavy[feature_of(sh)]])
                size += len(held[-1])
                if size > HELD:
                    yield batch()
                    held, size = [], 0
        if held:
            yield batch()

    return run


def frequent_shingles(texts: DataFrame, width: int) -> Weights:
    """Exact document frequencies of all shingles that at least ``RARE`` of the texts (one binary column) hold."""
    spark = texts.sparkSession
    counted = texts.mapInArrow(_count_features(width), "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).toPandas()
    n_docs = texts.count()
    heavy = np.zeros(FEATURES, bool)
    heavy[counted["f"].to_numpy(np.int64)[counted["n"].to_numpy(np.int64) >= RARE * n_docs]] = True
    if not heavy.any():
        return Weights(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    found = texts.mapInArrow(_count_shingles(width, spark.sparkContext.broadcast(heavy)), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    # a document holds each of its shingles once, so they are at most the mean number of shingles over RARE
    found = found.where(F.col("n") > RARE * n_docs).toArrow()
    shingle, n = found.column("shingle").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(shingle)
    return Weights(shingle[order], idf_steps(n[order], n_docs))


def signatures(texts: list[bytes], weights: Weights, width: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts, K) sample names (element and t, folded to 32 bits) and the number of distinct shingles; a text without words has none."""
    sh, tf, doc = term_counts(texts, width)
    n = np.bincount(doc, minlength=len(texts))
    out = np.zeros((len(texts), k), np.uint32)
    if not len(sh):
        return out, n
    cls = weights.classes(sh)
    h1 = (sh >> np.uint64(18)).astype(np.uint32) & np.uint32(DRAWS - 1)
    h2 = (sh >> np.uint64(40)).astype(np.uint32) | np.uint32(1)
    element = mix(sh) & np.uint64(0xFFFFFFFF)
    flat = np.concatenate(weights.tables)
    base = (cls * DRAWS).astype(np.uint32)
    several = np.flatnonzero(tf > 1)
    heavy = weights.values[cls[several]] * tf[several]
    with_any = np.flatnonzero(n)
    begin = (np.cumsum(n) - n)[with_any]
    for j in range(k):
        at = (h1 + h2 * np.uint32(j)) & np.uint32(DRAWS - 1)
        a = flat[base + at].astype(np.uint64)
        if len(several):
            a[several] = sortable(sample_value(heavy, at[several]))
        a <<= np.uint64(32)
        a |= element
        out[with_any, j] = mix(np.minimum.reduceat(a, begin)).astype(np.uint32)
    return out, n


def _sign(sent, width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        seen: dict[bytes, tuple[int, list[int], bytes]] = {}  # copies are common: a text's samples are kept for its next copy
        for batch in batches:
            same, sizes, keys, samples = [], [], [], []
            for _, texts in slices(batch.column("_text")):
                digest = [hashlib.md5(b" ".join(t.translate(FOLD).split())).digest() for t in texts]
                new = list({d: i for i, d in enumerate(digest) if d not in seen}.items())
                if len(seen) + len(new) > 20_000:
                    seen = {}
                    new = list({d: i for i, d in enumerate(digest)}.items())
                if new:
                    sig, n = signatures([texts[i] for _, i in new], weights, width, bands * rows)
                    bits = sig.astype(np.uint64).reshape(len(new), bands, rows)
                    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(new), bands)).copy()
                    for r in range(rows):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, r])
                    for (d, _), m, row, own in zip(new, n, key.astype(np.int64), sig, strict=True):
                        seen[d] = (int(m), row.tolist() if m else [], own.tobytes())
                for d in digest:
                    m, b, own = seen[d]
                    samples.append(own)
                    same.append(d)
                    sizes.append(m)
                    keys.append(b)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(same, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(samples, pa.binary())], names=["doc_id", "tag", "same", "n_shingles", "bands", "samples"])

    return run


def weighted_bag(text: bytes, weights: Weights, width: int) -> tuple[np.ndarray, np.ndarray]:
    sh, tf, _ = term_counts([text], width)
    order = np.argsort(sh)
    return sh[order], (weights.values[weights.classes(sh)] * tf)[order]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over the sum of the larger ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    union = a[1].sum() + b[1].sum() - shared
    return float(shared / union) if union else 0.0


def _verify(sent, width: int, threshold: float):
    """Rows come sorted by (centre, part), the centre's own row first; only one centre is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, held, bag, out = sent.value, None, None, []
        for batch in batches:
            for centre, part, member, text in zip(*(batch.column(c).to_pylist() for c in ("centre", "part", "id")), batch.column("text"), strict=True):
                own = weighted_bag(text.as_py() or b"", weights, width)
                if member == centre:
                    held, bag = (centre, part), own
                elif held == (centre, part):
                    out.append((centre, member, weighted_jaccard(bag, own) >= threshold))
                else:
                    raise RuntimeError("a centre's text is missing")
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))], names=["centre", "id", "near"])
            out = []

    return run


def _alike(sent, width: int, k: int, rows: int, threshold: float):
    """Rows come sorted by (band, part), the part's open members first; emits the pairs (open member, member) that are near.

    Pairs whose samples leave no real chance are dropped, the others are compared exactly, each in the first band that
    both share.  A task holds the bags of one part's open members, BLOCK at most on average.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, held, ids, open_, bags = sent.value, None, [], [], []
        block = np.zeros((0, k), np.uint32)
        for batch in batches:
            band, part, slot, member, is_open, far = (batch.column(c).to_pylist() for c in ("band", "part", "slot", "id", "open", "far"))
            sig = np.frombuffer(b"".join(batch.column("samples").to_pylist()), np.uint32).reshape(-1, k)
            text = batch.column("text")
            found: list[tuple[int, int]] = []
            for i in range(len(band)):
                if held != (band[i], part[i]):
                    held, ids, open_, bags = (band[i], part[i]), [], [], []
                own = None
                if is_open[i]:
                    own = weighted_bag(text[i].as_py() or b"", weights, width)
                    ids.append(member[i])
                    open_.append(sig[i])
                    bags.append(own)
                if len(block) != len(open_) or is_open[i]:
                    block = np.array(open_, np.uint32).reshape(-1, k)
                equal = block == sig[i]
                for x in np.flatnonzero(equal.mean(1) >= threshold - SLACK):
                    if ids[x] == member[i] or far[i] and ids[x] > member[i] and not is_open[i]:
                        continue
                    if int(equal[x].reshape(-1, rows).all(1).argmax()) == slot[i]:
                        own = own or weighted_bag(text[i].as_py() or b"", weights, width)
                        if weighted_jaccard(bags[x], own) >= threshold:
                            found.append((ids[x], member[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["centre", "id"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, sent, width: int, threshold: float) -> DataFrame:
    """``pairs`` (centre, id) with ``near``: texts meet by centre, in parts of about 64 members, so a centre with very many members is many tasks' work."""
    n = pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / 64).cast("int")
    members = pairs.join(n, "centre").select("centre", "id", F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"))
    own = members.select("centre", "part").distinct().select("centre", F.col("centre").alias("id"), "part")
    met = texts.select("id", "text").join(members.union(own).hint("merge"), "id").select("centre", "part", "id", "text")
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(tasks, "centre", "part").sortWithinPartitions("centre", "part", F.col("id") != F.col("centre"))
    return met.mapInArrow(_verify(sent, width, threshold), "centre long, id long, near boolean")


def _linked(texts: DataFrame, sent, width: int, threshold: float, bands: int, rows: int) -> DataFrame:
    """Verified links ``centre, id`` between the texts (``id, bands, samples, text``) that share a band."""
    buckets = materialise(texts.select("id", F.posexplode("bands").alias("slot", "band")).where("band IS NOT NULL"))
    sizes = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    degree = buckets.join(sizes, "band").groupBy("id").agg(F.sum("n").alias("degree"))
    centres = buckets.join(degree, "id").groupBy("band").agg(F.max_by("id", F.struct("degree", -F.col("id"))).alias("centre"))
    buckets = materialise(buckets.join(centres, "band"))
    seen = materialise(_verified(buckets.where("id <> centre").select("centre", "id").distinct(), texts, sent, width, threshold))
    near = seen.where("near").select("centre", "id")
    far = buckets.where("id <> centre").join(near, ["centre", "id"], "left_anti").select("band", "id")
    far = far.join(far.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")), "band")
    far = materialise(far.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")))
    spread = buckets.select("band", "slot", "id").join(far.select("band", "parts").distinct(), "band").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    marked = spread.join(far.select("band", "id", "own"), ["band", "id"], "left")
    marked = marked.select("band", "slot", "part", "id", F.coalesce(F.col("own") == F.col("part"), F.lit(False)).alias("open"), F.col("own").isNotNull().alias("far"))
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = texts.select("id", "text", "samples").join(marked.hint("merge"), "id")
    met = met.select("band", "part", "slot", "id", "open", "far", "samples", "text").repartition(tasks, "band", "part").sortWithinPartitions("band", "part", F.desc("open"), "id")
    return near.union(met.mapInArrow(_alike(sent, width, bands * rows, rows, threshold), "centre long, id long"))


def find_groups(docs: DataFrame, *, width: int = 5, threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS, with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (smallest id of its class), ``n_shingles`` (distinct).

    ``with_text`` adds ``tag``, the 64-bit hash of the row's text, and ``class_tag``, the smallest among the texts of
    the class's smallest id.

    Two texts are linked if their weighted Jaccard similarity over ``width``-word shingles is at least ``threshold``;
    classes are the connected sets of texts.  Texts with the same words are always linked.  Ids may have any type that
    sorts; rows with one id and different texts are judged by their texts, each row by itself.  A text without words,
    or null, is alone in its class; one with fewer words than ``width`` is one shingle; a null id is alone, with a null
    class; repeated rows share a class and each keeps its row; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tag"), F.col("text").cast("binary").alias("_text"))
    sent = spark.sparkContext.broadcast(frequent_shingles(base.select("_text"), width))
    kind = base.schema["doc_id"].dataType.simpleString()
    signed = materialise(base.mapInArrow(_sign(sent, width, bands, rows), f"doc_id {kind}, tag long, same binary, n_shingles long, bands array<bigint>, samples binary"))
    known = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # equal texts have equal bands and samples, whichever copy they are taken from; a node is a text, not an id
    nodes = known.groupBy("same").agg(F.min(F.struct("doc_id", "tag")).alias("least"), F.first("bands").alias("bands"), F.first("samples").alias("samples"))
    nodes = materialise(nodes.withColumn("id", F.monotonically_increasing_id()))
    shared = nodes.select("id", F.explode("bands").alias("band"))
    several = shared.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    alone = shared.join(several.hint("merge"), "band").groupBy("id").agg(F.collect_list("band").alias("open"))
    wanted = materialise(nodes.join(alone.hint("merge"), "id").select("id", "least.doc_id", "least.tag", F.transform("bands", lambda b: F.when(F.array_contains("open", b), b)).alias("bands"), "samples"))
    body = base.join(wanted.hint("merge"), ["doc_id", "tag"]).select("id", "bands", "samples", F.col("_text").alias("text")).dropDuplicates(["id"])
    body = materialise(body)
    edges = materialise(_linked(body, sent, width, threshold, bands, rows))
    classes = connected_components(edges, src="centre", dst="id")
    named = nodes.select("id", "same", "least").join(classes, "id", "left").withColumn("component", F.coalesce("component", "id"))
    heads = named.groupBy("component").agg(F.min("least").alias("head"))
    named = named.join(heads, "component").select("same", "head")
    joined = signed.join(named, "same", "left")
    member = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    own = [F.when(member, F.col("head")["tag"]).otherwise(F.col("tag")).alias("class_tag")] if with_text else []
    return joined.select("doc_id", F.when(member, F.col("head")["doc_id"]).otherwise(F.col("doc_id")).alias("class_id"), "n_shingles", *(["tag"] if with_text else []), *own)
