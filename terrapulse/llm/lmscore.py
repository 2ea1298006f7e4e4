"""Cross-entropy difference of two word-bigram models that share a vocabulary.

All documents and all of the target are counted, every bigram by itself.  Bigrams are dealt by hash into parts, in training and
in scoring alike; a part is a row of sorted arrays, and the tokens of the documents go to the parts that hold their counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapulse.llm._text import hashed_words, mix, slices
from terrapulse.session import materialise

#: Words that occur so often are the vocabulary; all others are one unknown word.
MIN_COUNT = 2
#: Tokens of the corpus for each part of the bigram table.
PART_TOKENS = 800_000
#: So many target ids are sent to every task; more are joined by a shuffle of the texts, with the same result.
SENT_IDS = 2_000_000
#: Weight of the unigram estimate, in words.
PRIOR = 100.0
#: Distinct words, or bigrams, that a task holds before it passes their counts on.
HELD = 800_000


#: Texts that a task takes at once, bytes, in counting and in scoring.
PIECE, BLOCK = 1 << 20, 4 << 20


def _packed(x: np.ndarray) -> bytes:
    """Numbers compressed, byte by byte of their places, so that the leading zeros of all lie together; the size goes before."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unpacked(x: pa.Scalar, kind: type) -> np.ndarray:
    buffer = x.as_buffer()
    size = int.from_bytes(buffer[:8].to_pybytes(), "little")
    raw = pa.decompress(buffer[8:], decompressed_size=size, codec="zstd") if size else b""
    return np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _summed(key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of the rows of ``counts`` that belong to each."""
    if not len(key):
        return key, counts
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(counts[order], first, axis=0, dtype=counts.dtype)


def _joined(held: list) -> tuple[np.ndarray, np.ndarray]:
    return _summed(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))


def _combined(pieces: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counts of many pieces, summed as far as ``HELD`` keys allow."""
    held, size = [], 0
    for piece in pieces:
        held.append(_summed(*piece))
        size += len(held[-1][0])
        if size > 2 * HELD:
            held = [_joined(held)]
            size = len(held[0][0])
            if size > HELD:
                yield held[0]
                held, size = [], 0
    if held:
        yield _joined(held)


def _both(inside: np.ndarray) -> np.ndarray:
    return np.stack([inside.astype(np.int32), np.ones(len(inside), np.int32)], axis=1)


def _with_ends(inside: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of every word of texts with ``n`` words: target count and count, and both again where it ends its text."""
    both = _both(np.repeat(inside, n))
    last = np.zeros(len(both), np.int32)
    last[np.cumsum(n)[n > 0] - 1] = 1
    return np.concatenate([both, both * last[:, None]], axis=1)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for batch in batches:
        chosen = np.array([bool(x) for x in batch.column("in_target").to_pylist()], bool)
        for start, texts in slices(batch.column("text"), PIECE):
            yield texts, chosen[start : start + len(texts)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, target count, count, and both at the end of a text); the null word counts the texts that have words."""
    starts = np.zeros(2, np.int64)

    def pieces():
        for texts, chosen in _texts(batches):
            h, n = hashed_words(texts)
            starts[:] += _both(chosen[n > 0]).sum(0)
            yield h, _with_ends(chosen, n)

    def batch(words, counts):
        return pa.RecordBatch.from_arrays([words, *[pa.array(counts[:, m].astype(np.int64)) for m in range(4)]], names=["word", "t", "b", "te", "be"])

    for u, counts in _combined(pieces()):
        for i in range(0, len(u), 1 << 17):
            yield batch(pa.array(u[i : i + (1 << 17)].view(np.int64)), counts[i : i + (1 << 17)])
    yield batch(pa.array([None], pa.int64()), np.append(starts, [0, 0])[None])


@dataclass
class Vocabulary:
    """Words and their counts in both models: column 0 is the target, column 1 the background."""

    words: np.ndarray  # sorted hashes of the vocabulary
    unigrams: np.ndarray  # (vocabulary + 2, 2); the last two rows are the unknown word and the start of a text
    parts: int  # of the bigram table
    slots: int | None  # bigrams are folded into so many, where given
    ends: np.ndarray  # as ``unigrams``: how often each ends a text, and so is followed by nothing
    rank: np.ndarray  # the number of each word of ``words``: frequent words have small ones, so that numbers and bigrams pack well

    def __post_init__(self):
        self.total = self.unigrams[: len(self.words) + 1].sum(0)
        self.scale = np.array([1.0, self.total[0] / self.total[1] if self.total[0] else 1.0])

    def ids(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, words), max(0, len(self.words) - 1))
        return np.where(self.words[at] == words, self.rank[at], len(self.words)) if len(self.words) else np.zeros(len(words), np.int64)

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(previous word, word) of all tokens as numbers, and the number of tokens per text."""
        h, n = hashed_words(texts)
        w = self.ids(h)
        return self.before(w, n), w, n

    def before(self, w: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The word before each one of texts with ``n`` words, the start of the text before the first."""
        out = np.concatenate(([0], w[:-1])) if len(w) else w
        out[(np.cumsum(n) - n)[n > 0]] = len(self.words) + 1
        return out

    def key(self, before: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The bigram as one number, which is exact without ``slots``."""
        key = before.astype(np.int64) * (len(self.words) + 2) + w
        return (mix(key.view(np.uint64) + np.uint64(1)) & np.uint64(self.slots - 1)).astype(np.int64) if self.slots else key

    def part(self, key: np.ndarray) -> np.ndarray:
        return (mix(key.view(np.uint64) ^ np.uint64(0xB16)) % np.uint64(self.parts)).astype(np.int32)

    def by_part(self, key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each part that occurs, and where, in order."""
        part = self.part(key)
        order = np.argsort(part, kind="stable")
        used, first = np.unique(part[order], return_index=True)
        return zip(used.tolist(), np.split(order, first[1:]), strict=True) if len(used) else iter(())

    def bits(self, before: np.ndarray, w: np.ndarray, found: np.ndarray) -> np.ndarray:
        """(tokens, 2) bits under both models, of which the background is scaled to the size of the target."""
        total, scale = self.total, self.scale
        single = (self.unigrams[w] * scale + 1.0) / (total * scale + len(self.words) + 1.0)
        context = (self.unigrams[before] - self.ends[before]) * scale
        return -np.log2((np.minimum(found * scale, context) + PRIOR * single) / (context + PRIOR))


@dataclass
class Model:
    vocabulary: Vocabulary
    bigrams: DataFrame  # part, and the steps between its keys in order with their target and background counts, as packed 8-byte integers

    @property
    def unigrams(self) -> np.ndarray:
        return self.vocabulary.unigrams


def _sum_part(key: tuple, table: pa.Table) -> pa.Table:
    keys = np.concatenate([np.cumsum(_unpacked(x, np.int64)) for x in table.column("keys")])
    counts = [np.concatenate([_unpacked(x, np.int32) for x in table.column(c)]) for c in ("t", "b")]
    u, counts = _summed(keys, np.stack(counts, axis=1).astype(np.int64))
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "keys": [_packed(np.diff(u, prepend=0))], "t": [_packed(counts[:, 0])], "b": [_packed(counts[:, 1])]})


def train(docs: DataFrame, target: DataFrame, *, vocabulary: int | None = None, slots: int | None = None, min_count: int = MIN_COUNT, part_tokens: int = PART_TOKENS) -> Model:
    """Background counts of every document; target counts of every document whose ``doc_id`` is in ``target``.

    The vocabulary, every word that occurs ``min_count`` times, reaches the driver and the tasks with its counts; bigrams stay
    distributed.  ``vocabulary`` bounds it to the most frequent words and ``slots`` folds the bigrams, where they are given.
    """
    spark = docs.sparkSession
    target = target.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().withColumn("in_target", F.lit(True))
    target = F.broadcast(target) if target.count() <= SENT_IDS else target
    marked = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(target, "doc_id", "left").select("text", "in_target")
    counted = materialise(marked.mapInArrow(_count_words, "word long, t long, b long, te long, be long").groupBy("word").agg(*[F.sum(c).alias(c) for c in ("t", "b", "te", "be")]))
    named = counted.where("word IS NOT NULL")
    chosen = named.where(F.col("b") >= min_count)
    if vocabulary is not None:
        chosen = chosen.orderBy(F.desc("b"), "word").limit(vocabulary)
    chosen = chosen.toArrow()
    sums = lambda df: np.array([x or 0 for x in df.agg(*[F.sum(c) for c in ("t", "b", "te", "be")]).first()], float)
    total = sums(named)
    words = chosen.column("word").to_numpy().view(np.uint64)
    order = np.lexsort((words, -chosen.column("b").to_numpy()))  # by falling count
    counts = np.stack([chosen.column(c).to_numpy()[order] for c in ("t", "b", "te", "be")], axis=1).astype(float)
    del chosen
    unigrams = np.concatenate([counts, [total - counts.sum(0)], [sums(counted.where("word IS NULL"))]])
    words = words[order]
    rank = np.argsort(words)
    terms = Vocabulary(words[rank], unigrams[:, :2], max(1, -int(-total[1] // part_tokens)), slots, unigrams[:, 2:], rank.astype(np.int64))
    sent = spark.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value

        def pieces():
            for texts, inside in _texts(batches):
                before, w, n = v.tokens(texts)
                yield v.key(before, w), _both(np.repeat(inside, n))

        for key, counts in _combined(pieces()):
            rows = [(p, _packed(np.diff(key[at], prepend=0)), _packed(counts[at, 0]), _packed(counts[at, 1])) for p, at in v.by_part(key)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)], names=["part", "keys", "t", "b"])

    schema = "part int, keys binary, t binary, b binary"
    return Model(terms, materialise(marked.mapInArrow(run, schema).groupBy("part").applyInArrow(_sum_part, schema)))


_COUNTS, _ASKED, _TEXTS = 0, 1, 2


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``n_tokens``, bits per token under both models, and their difference ``score`` (lower: more like the target).

    Whole texts are read.  A text without words, or null, has 0 tokens and null figures; repeated rows are scored one by
    one; with an empty target its model is uniform.  A block of texts asks the parts of the bigram table for the counts of its distinct
    bigrams, each once; the parts follow their counts in the order of a partition, and the answers meet the block's words again.  So
    what is moved grows with the words, not with words times parts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.vocabulary)
    kept = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = dict(kept.dtypes)["doc_id"]
    schema = f"kind int, part int, block long, a binary, b binary, ids array<{kind}>"
    names = ["kind", "part", "block", "a", "b", "ids"]

    def batch_of(rows: list, ids: pa.DataType) -> pa.RecordBatch:
        types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), ids)
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, block = sent.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("doc_id")
            for start, texts in slices(batch.column("text"), BLOCK):
                before, w, n = v.tokens(texts)
                keys = np.unique(v.key(before, w))
                rows = [(_ASKED, p, block, _packed(np.diff(keys[at], prepend=0)), None, None) for p, at in v.by_part(keys)]
                rows.append((_TEXTS, block % v.parts, block, _packed(w.astype(np.int32)), n.astype(np.int64).tobytes(), ids[start : start + len(texts)].to_pylist()))
                yield batch_of(rows, pa.list_(ids.type))
                block += 1

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, none = -1, np.zeros(0, np.int64)
        keys, counts = none, [none, none]
        for batch in batches:
            rows = []
            for row_kind, part, block, a, b, ids in zip(*[batch.column(x) for x in names], strict=True):
                row_kind, part, block = row_kind.as_py(), part.as_py(), block.as_py()
                if part != held:
                    held, keys, counts = part, none, [none, none]
                if row_kind == _COUNTS:
                    # a part's row holds its keys and, one after the other, both counts
                    keys = np.cumsum(_unpacked(a, np.int64))
                    counts = np.split(_unpacked(b, np.int64), 2)
                elif row_kind == _TEXTS:
                    rows.append((_TEXTS, part, block, a.as_py(), b.as_py(), ids.as_py()))
                else:
                    key = np.cumsum(_unpacked(a, np.int64))
                    found = [np.zeros(len(key), np.int64)] * 2
                    if len(keys):
                        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                        found = [np.where(keys[at] == key, c[at], 0) for c in counts]
                    rows.append((_ASKED, part, block, *[_packed(c) for c in found], None))
            if rows:
                yield batch_of(rows, batch.column("ids").type)

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        v, answers, own = sent.value, {}, None
        for row_kind, part, a, b, ids in zip(*[table.column(x) for x in ("kind", "part", "a", "b", "ids")], strict=True):
            if row_kind.as_py() == _TEXTS:
                own = _unpacked(a, np.int32).astype(np.int64), np.frombuffer(b.as_py(), np.int64), ids.as_py()
            else:
                answers[part.as_py()] = [_unpacked(x, np.int64) for x in (a, b)]
        w, n, ids = own
        before = v.before(w, n)
        keys, place = np.unique(v.key(before, w), return_inverse=True)
        found = np.zeros((len(keys), 2))
        for p, at in v.by_part(keys):
            found[at, 0], found[at, 1] = answers[p]
        bits = v.bits(before, w, found[place])
        doc = np.repeat(np.arange(len(n)), n)
        sums = [np.bincount(doc, weights=bits[:, m], minlength=len(n)) / np.maximum(n, 1) for m in (0, 1)]
        cols = [pa.array(x, pa.float64(), mask=n == 0) for x in (sums[0], sums[1], sums[0] - sums[1])]
        return pa.Table.from_arrays([pa.array(ids, table.schema.field("ids").type.value_type), pa.array(n), *cols], names=["doc_id", "n_tokens", "target_bits", "background_bits", "score"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [_packed(np.concatenate([_unpacked(x, np.int64), _unpacked(y, np.int64)])) for x, y in zip(batch.column("t"), batch.column("b"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("keys"), pa.array(both, pa.binary())], names=["part", "a", "b"])

    table = model.bigrams.mapInArrow(joined, "part int, a binary, b binary")
    table = table.select(F.lit(_COUNTS).alias("kind"), "part", F.lit(-1).cast("long").alias("block"), "a", "b", F.lit(None).cast(f"array<{kind}>").alias("ids"))
    met = table.unionByName(kept.mapInArrow(deal, schema)).repartitionById(model.vocabulary.parts, "part").sortWithinPartitions("part", "kind")
    return met.mapInArrow(look_up, schema).groupBy("block").applyInArrow(gather, f"doc_id {kind}, n_tokens long, target_bits double, background_bits double, score double")
