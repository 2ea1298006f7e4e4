"""Quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapulse.llm._text import hashed_words, mix, shingles, slices

#: Bound of the labelled sample, documents a class; shape terms, word terms, latent dimensions, neighbours that vote.
TRAIN_DOCS = 2500
TERMS, WORDS, RANK, NEIGHBOURS = 1024, 1024, 96, 15
#: Weight of the words beside the shape.
WORD_WEIGHT = 0.5
WIDTH = TERMS + 4 + WORDS
#: Texts that are held against the labelled vectors at once.
ROWS = 256
#: Power of the similarity in a neighbour's vote.
SHARPNESS = 8


def _shape_table() -> bytes:
    """Bytes by class: small letters and non-ASCII a, capitals A, digits 0; the rest stays."""
    return bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))


SHAPES = _shape_table()


def terms(texts: list[bytes]) -> np.ndarray:
    """(texts, WIDTH) term weights before idf: roots of shares.

    Terms are hashed 4-grams of the text's shape, in which runs of one class are one symbol; four markers: words
    equal to the one before, repeated 3-word runs, capitals among letters, and distinct words; and hashed words.
    """
    out = np.zeros((len(texts), WIDTH), np.float32)
    sizes = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(b"\n" + t.translate(SHAPES) + b"\n" for t in texts) + b"\n\n\n", np.uint8)
    row = np.repeat(np.arange(len(texts)), sizes)
    capital = np.bincount(row, weights=data[: len(row)] == 65, minlength=len(texts))
    letters = capital + np.bincount(row, weights=data[: len(row)] == 97, minlength=len(texts))
    keep = np.ones(len(row), bool)
    keep[1:] = (data[1 : len(row)] != data[: len(row) - 1]) | (row[1:] != row[:-1])
    d, r = data[: len(row)][keep].astype(np.uint64), row[keep]
    if len(d) > 3:
        gram = d[:-3] | d[1:-2] << np.uint64(8) | d[2:-1] << np.uint64(16) | d[3:] << np.uint64(24)
        whole = r[:-3] == r[3:]
        at = (mix(gram[whole]) & np.uint64(TERMS - 1)).astype(np.int64)
        counts = np.bincount(r[:-3][whole] * TERMS + at, minlength=len(texts) * TERMS).reshape(len(texts), TERMS)
        out[:, :TERMS] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    words, n = hashed_words(texts)
    doc = np.repeat(np.arange(len(texts)), n)
    again = np.zeros(len(words))
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    three, k = shingles(words, n, 3)
    distinct = lambda h, d: np.bincount(d[np.unique(mix(h + d.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), return_index=True)[1]], minlength=len(texts))
    some = np.maximum(n, 1)
    out[:, TERMS] = np.sqrt(np.bincount(doc, weights=again, minlength=len(texts)) / some)
    out[:, TERMS + 1] = np.sqrt(1 - distinct(three, np.repeat(np.arange(len(texts)), k)) / np.maximum(k, 1)) * (k > 0)
    out[:, TERMS + 2] = np.sqrt(capital / np.maximum(letters, 1))
    out[:, TERMS + 3] = np.sqrt(distinct(words, doc) / some)
    counts = np.bincount(doc * WORDS + (words >> np.uint64(40)).astype(np.int64) % WORDS, minlength=len(texts) * WORDS).reshape(len(texts), WORDS)
    out[:, TERMS + 4 :] = WORD_WEIGHT * np.sqrt(counts / some[:, None])
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Share of label 1 among the nearest neighbours, weighted by similarity; blocks of texts against all vectors.

        Similarities count in steps of 2^-16 and blocks have one size, so equal texts get equal scores; of equally near
        vectors the first counts.
        """
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        out = np.empty(len(texts))
        bits = len(self.labels).bit_length()
        for i in range(0, len(texts), ROWS):
            x = np.zeros((ROWS, WIDTH), np.float32)
            here = terms(texts[i : i + ROWS])
            x[: len(here)] = here
            cosine = unit(unit(x * self.idf) @ self.basis) @ self.vectors.T
            key = np.rint((np.clip(cosine, -1, 1) + 1) * 65536).astype(np.int64) << bits
            key |= np.arange(len(self.labels))[::-1]
            k = min(NEIGHBOURS, key.shape[1])
            best = -np.sort(-np.partition(key, key.shape[1] - k, axis=1)[:, -k:], axis=1)
            w = np.clip((best >> bits) / 65536 - 1, 1e-6, None) ** SHARPNESS
            y = self.labels[::-1][best & ((1 << bits) - 1)]
            out[i : i + ROWS] = ((w * y).sum(1) / w.sum(1))[: len(here)]
        return np.clip(out, 0, 1)


def fit(x: np.ndarray, labels: np.ndarray, rank: int = RANK) -> Model:
    """Latent space of the labelled texts' terms: idf, then the leading directions of the term matrix."""
    if not len(labels):
        return Model(np.ones(WIDTH), np.eye(WIDTH), np.zeros((0, WIDTH)), labels, 0.5)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1.0
    idf[TERMS : TERMS + 4] = 2.0
    x = unit(x * idf.astype(np.float32))
    _, vectors = np.linalg.eigh((x.T @ x).astype(float))
    basis = vectors[:, ::-1][:, :rank].astype(np.float32)
    return Model(idf.astype(np.float32), basis, unit(x @ basis).astype(np.float32), labels.astype(float), float(labels.mean()))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, texts in slices(batch.column("text")):
            rows = [x.tobytes() for x in terms(texts).astype(np.float16)]
            yield pa.RecordBatch.from_arrays([batch.column("label")[start : start + len(texts)], pa.array(rows, pa.binary())], names=["label", "x"])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, per_class: int, seed: int, balanced: bool = True) -> DataFrame:
    """About ``per_class`` labelled documents of each class, picked by a hash of the id: ``doc_id, text, label``.

    The picked labels are few, whatever the size of the tables, so they are broadcast and texts are not shuffled.
    """
    ok = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    n = {r.label: r["count"] for r in ok.groupBy("label").count().collect()}
    part = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    total = max(1, sum(n.values()))
    share = {y: min(1.0, (per_class / max(1, n.get(y, 0))) if balanced else 2 * per_class / total) for y in (0, 1)}
    picked = ok.where(part < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, *, per_class: int = TRAIN_DOCS) -> DataFrame:
    """Quality of whole texts: ``doc_id``, ``score`` in [0, 1] (higher: label 1 likelier).

    Learns from at most about ``per_class`` labelled rows of each class that are not held out, by a hash of the id;
    their term vectors, not their texts, reach the driver.  A null text counts as empty; empty texts are scored like
    any; rows with equal texts get equal scores; ties among neighbours go to the vector that sorts first; without
    labelled rows every score is 0.5; an empty table gives no rows; other columns are not read.
    """
    sample = labelled_sample(docs, labels.where(~held_out()), "quality", per_class=per_class, seed=13)
    rows = sample.select("label", F.col("text").cast("binary").alias("text")).mapInArrow(_terms, "label int, x binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["x"], r["label"]))
    matrix = np.frombuffer(b"".join(r["x"] for r in rows), np.float16).reshape(-1, WIDTH).astype(np.float32)
    model = fit(matrix, np.array([r["label"] for r in rows], float))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [sent.value.score(texts) for _, texts in slices(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(s) if s else np.zeros(0), pa.float64())], names=["doc_id", "score"])

    kept = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return kept.mapInArrow(run, f"doc_id {dict(kept.dtypes)['doc_id']}, score double")
