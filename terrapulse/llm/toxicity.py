"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapulse.llm._text import hashed_words, slices
from terrapulse.llm.quality import labelled_sample
from terrapulse.session import materialise

#: Bound of the labelled sample, half of its documents.
TRAIN_DOCS = 6000
#: A word of the lexicon stands in so many toxic texts at least, with so large log odds.
SUPPORT, ODDS = 3, 2.0
#: Pronouns of the second person.
SECOND_PERSON = "you your yours yourself u ur tu te toi vous votre vos ton ta tes du dich dir dein deine euch ihr ti tú usted ustedes vosotros".split()
REACH = 4
FEATURES = ("lexicon", "lexicon_weight", "lexicon_any", "second_person", "near_second_person", "capitals", "punctuation", "exclamations", "obfuscated", "obfuscated_lexicon", "repeats", "log_words")

#: What stands for a letter in obfuscated words.
_PLAIN = bytes.maketrans(b"01345@$!7", b"oieasasit")


def revealed(text: bytes) -> bytes:
    """Stand-ins for letters undone, in place."""
    return text.translate(_PLAIN, b"*_")


def word_hashes(words: list[str]) -> np.ndarray:
    return np.sort(hashed_words([w.encode() for w in words])[0])


def within(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(words), bool)
    return table[np.minimum(np.searchsorted(table, words), len(table) - 1)] == words


def dense(texts: list[bytes], lexicon: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) figures of whole texts; an empty text has zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    words, n = hashed_words(texts)
    doc = np.repeat(np.arange(len(texts)), n)
    some = np.maximum(n, 1)
    rate = lambda x: np.bincount(doc, weights=x, minlength=len(texts)) / some
    hit = within(words, lexicon)
    you = within(words, word_hashes(SECOND_PERSON))
    if len(lexicon) and len(words):
        w = np.where(hit, weight[np.minimum(np.searchsorted(lexicon, words), len(lexicon) - 1)], 0.0)
        out[:, 0], out[:, 1] = rate(hit), rate(w)
        out[:, 2] = np.minimum(np.bincount(doc, weights=hit, minlength=len(texts)), 20)
    if len(words):
        out[:, 3] = rate(you)
        c = np.concatenate(([0], np.cumsum(you)))
        begin, end = (np.cumsum(n) - n)[doc], np.cumsum(n)[doc]
        at = np.arange(len(words))
        out[:, 4] = rate(hit & (c[np.minimum(at + REACH + 1, end)] > c[np.maximum(at - REACH, begin)]))
        again = np.zeros(len(words))
        again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
        out[:, 10] = rate(again)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    row = np.repeat(np.arange(len(texts)), size)
    share = lambda x: np.bincount(row, weights=x, minlength=len(texts)) / np.maximum(size, 1)
    letter = (data >= 97) & (data <= 122) | (data >= 128) | (data >= 65) & (data <= 90)
    out[:, 5] = share((data >= 65) & (data <= 90))
    out[:, 6] = share(~letter & (data > 32) & ~((data >= 48) & (data <= 57)))
    out[:, 7] = share(data == 33)
    if len(data) > 2:
        inner = np.zeros(len(data))
        mid = data[1:-1]
        inner[1:-1] = letter[:-2] & letter[2:] & np.isin(mid, np.frombuffer(b"01345@$!7*_", np.uint8)) & (row[:-2] == row[2:])
        out[:, 8] = share(inner)
        odd = np.flatnonzero(np.bincount(row, weights=inner, minlength=len(texts)) > 0)
        if len(odd):
            w2, n2 = hashed_words([revealed(texts[i]) for i in odd])
            plain = np.bincount(doc, weights=hit, minlength=len(texts))[odd] if len(words) else 0
            more = np.bincount(np.repeat(np.arange(len(odd)), n2), weights=within(w2, lexicon), minlength=len(odd)) - plain
            out[odd, 9] = np.maximum(more, 0)
    out[:, 11] = np.log1p(n)
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = batch.column("label").to_numpy(zero_copy_only=False)
        for start, texts in slices(batch.column("text")):
            words, n = hashed_words(texts)
            doc = np.repeat(np.arange(len(texts)), n)
            pair = np.unique(np.rec.fromarrays([words, doc]))
            w, at = np.unique(pair.f0, return_inverse=True)
            label = y[start : start + len(texts)][pair.f1]
            one = np.bincount(at, weights=label, minlength=len(w)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(one), pa.array(np.bincount(at, minlength=len(w)).astype(np.int64) - one)], names=["word", "toxic", "clean"])


def learn_lexicon(sample: DataFrame, *, support: int = SUPPORT, odds: float = ODDS) -> tuple[np.ndarray, np.ndarray]:
    """All words of the sample in ``support`` toxic texts at least whose smoothed log odds of standing in a toxic text exceed ``odds``."""
    n = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    seen = sample.select("label", F.col("text").cast("binary").alias("text")).mapInArrow(_count_words, "word long, toxic long, clean long")
    seen = seen.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= support)
    log_odds = F.log((F.col("toxic") + 0.5) / (n.get(1, 0) + 1.0)) - F.log((F.col("clean") + 0.5) / (n.get(0, 0) + 1.0))
    top = seen.withColumn("odds", log_odds).where(F.col("odds") > odds).select("word", "odds").collect()
    words = np.array([r.word for r in top], np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], np.array([r.odds for r in top], float)[order]


def featured(docs: DataFrame, lexicon: tuple[np.ndarray, np.ndarray], *, carry: tuple[str, ...] = ()) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [dense(texts, *lexicon) for _, texts in slices(batch.column("_text"))]
            x = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", *carry)), values], names=["doc_id", *carry, "x"])

    kept = docs.select("doc_id", *carry, F.col("text").cast("binary").alias("_text"))
    kinds = dict(kept.dtypes)
    return kept.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", *carry)) + ", x array<double>")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, *, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Toxicity of whole texts: ``doc_id``, ``score`` in [0, 1] (higher: label 1 likelier).

    Learns from at most about ``2 * train_docs`` labelled rows that are not held out, by a hash of the id; the lexicon
    and the trees see four fifths of them, the calibration the rest.  Very long texts are read in pieces of words.  A null text counts as
    empty; equal texts get equal scores; with labels of one class only, or none, every score is the share of ones (0
    if there are none).
    """
    sample = materialise(labelled_sample(docs, labels.where(~held_out()), "toxic", per_class=train_docs, seed=19, balanced=False).coalesce(4))
    fold = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(5))
    lexicon = learn_lexicon(sample.where(fold != 0))  # the calibration must not see features made from its own labels
    known = materialise(featured(sample, lexicon, carry=("label",)).coalesce(2)).select(array_to_vector("x").alias("features"), F.col("label").cast("double").alias("label"), fold.alias("fold"))
    kinds = {(r.fold == 0, r.label) for r in known.select("fold", "label").distinct().collect()}
    scored = featured(docs, lexicon).select("doc_id", array_to_vector("x").alias("features"))
    if not {(False, 0.0), (False, 1.0), (True, 0.0), (True, 1.0)} <= kinds:
        share = known.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
        return scored.select("doc_id", F.lit(float(share)).alias("score"))
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=3, maxBins=64).fit(known.where("fold <> 0"))
    raw = lambda df: trees.transform(df).withColumn("raw", vector_to_array("probability")[1])
    steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(raw(known.where("fold = 0")).select("raw", "label"))
    return steps.transform(raw(scored).select("doc_id", "raw")).select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))
