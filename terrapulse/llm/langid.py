"""Language identification by bit-sliced Bloom filters over byte n-grams.

One filter holds all languages: each slot is a bit mask with a bit per language.  Setting the slots of an n-gram
for a language sets that language's bit; the AND of an n-gram's slots is the set of all languages that contain it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapulse.llm._text import SLICE_BYTES, carried, mix, slices

#: Bound of the training sample, documents a language.
TRAIN_DOCS = 1500
#: Documents of the sample that must hold an n-gram for it to count as one of the language.
SUPPORT = 1
#: Slots of the filter for each n-gram of the largest language, and probes.
ROOM, PROBES = 12, 3
UNDETERMINED = "und"


def _letters_table() -> bytes:
    """ASCII letters are lower-cased, other ASCII becomes blank, bytes of other characters stay."""
    return bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


LETTERS = _letters_table()


def pieces(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[list[bytes], list[int]]]:
    """Padded texts, and the row of each, in lists of about ``limit`` bytes; a longer text is cut with an overlap of three bytes."""
    held, owner, size = [], [], 0
    for i, t in enumerate(texts):
        padded = b" " + t.translate(LETTERS) + b" "
        for at in range(0, max(1, len(padded) - 3), limit):
            piece = padded[at : at + limit + 3]
            if held and size + len(piece) > limit:
                yield held, owner
                held, owner, size = [], [], 0
            held.append(piece)
            owner.append(i)
            size += len(piece)
    if held:
        yield held, owner


def grams(padded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """4-byte grams within each piece (as 32-bit numbers), without those that hold two blanks, and the place of each one's piece in the list."""
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    data = np.frombuffer(b"".join(padded) + b"   ", np.uint8)
    blank = (data == 32).astype(np.uint8)
    wide = data.astype(np.uint32)
    n = len(data) - 3
    gram = wide[:n] | wide[1 : n + 1] << 8 | wide[2 : n + 2] << 16 | wide[3:] << 24
    keep = blank[:n] + blank[1 : n + 1] + blank[2 : n + 2] + blank[3:] < 2
    ends = np.cumsum(sizes)
    for j in range(3):  # grams must not reach into the next piece
        keep[np.maximum(ends - 1 - j, 0)] = False
    return gram[keep], np.repeat(np.arange(len(padded), dtype=np.int32), sizes)[keep]


def has_letters(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (words of 64 languages, slots)
    false_rate: np.ndarray

    def probes(self, gram: np.ndarray) -> list[np.ndarray]:
        h = mix(gram.astype(np.uint64))
        step = (h >> np.uint64(32)) | np.uint64(1)
        return [((h + step * np.uint64(j)) & np.uint64(self.table.shape[1] - 1)).astype(np.int64) for j in range(PROBES)]

    def score(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        n = np.zeros(len(texts))
        counts = np.zeros((len(self.languages), len(texts)))
        for padded, owner in pieces(texts):
            gram, piece = grams(padded)
            row = np.array(owner)[piece] if len(gram) else piece
            n += np.bincount(row, minlength=len(texts))
            at = self.probes(gram)
            for word, table in enumerate(self.table):
                mask = table[at[0]]
                for a in at[1:]:
                    mask = mask & table[a]
                for bit in range(min(64, len(self.languages) - 64 * word)):
                    found = row[(mask >> mask.dtype.type(bit)) & mask.dtype.type(1) > 0]
                    counts[64 * word + bit] += np.bincount(found, minlength=len(texts))
        fp = self.false_rate[:, None]
        true = np.clip((counts - n * fp) / (1 - fp), 0, None)
        best = true.argmax(0) if len(self.languages) else np.zeros(len(texts), int)
        share = np.where(n > 0, true[best, np.arange(len(texts))] / np.maximum(n, 1), 0.0) if len(self.languages) else np.zeros(len(texts))
        names = [self.languages[b] if self.languages and has_letters(t) else UNDETERMINED for b, t in zip(best, texts, strict=True)]
        return names, np.where([x == UNDETERMINED for x in names], 0.0, np.clip(share, 0, 1))


def build(profiles: dict[str, np.ndarray], slots: int | None = None) -> Model:
    """The filter of the given n-grams per language, sized by the largest."""
    languages = sorted(profiles)
    slots = slots or 1 << max(10, math.ceil(math.log2(ROOM * max([1, *map(len, profiles.values())]))))
    kind = next(k for k, w in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 1 << 30)) if len(languages) <= w)
    model = Model(languages, np.zeros((max(1, -(-len(languages) // 64)), slots), kind), np.zeros(len(languages)))
    for k, lang in enumerate(languages):
        row, bit = model.table[k // 64], kind(1) << kind(k % 64)
        for at in model.probes(np.asarray(profiles[lang], np.uint32)):
            row[at] |= bit
        model.false_rate[k] = ((row & bit) > 0).mean() ** PROBES
    return model


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, n-gram, texts that hold it)."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object).astype(str)
        for start, texts in slices(batch.column("text")):
            names, code = np.unique(langs[start : start + len(texts)], return_inverse=True)
            held = []
            for padded, owner in pieces(texts):
                gram, piece = grams(padded)
                row = np.array(owner, np.uint64)[piece] if len(gram) else np.zeros(0, np.uint64)
                held.append(np.unique(row << np.uint64(32) | gram))
            both = np.unique(np.concatenate(held))
            key, n = np.unique(code[(both >> np.uint64(32)).astype(int)].astype(np.uint64) << np.uint64(32) | both & np.uint64(0xFFFFFFFF), return_counts=True)
            lang = pa.DictionaryArray.from_arrays(pa.array((key >> np.uint64(32)).astype(np.int32)), pa.array(names.tolist(), pa.string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([lang, pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


def train(docs: DataFrame, *, train_docs: int = TRAIN_DOCS, support: int = SUPPORT) -> Model:
    """Fit on about ``train_docs`` documents of each language, picked by a hash of the id.

    ``docs`` has ``doc_id, text, lang`` and holds only rows that may be learned from.  Every n-gram that ``support``
    documents of a language's sample hold (one, if the sample has fewer documents than ten) enters the filter.
    """
    docs = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    if not totals:
        return build({})
    part = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    share, least = F.lit(0.0), F.lit(support)
    for lang, n in sorted(totals.items()):
        share = F.when(F.col("lang") == lang, min(1.0, train_docs / n)).otherwise(share)
        least = F.when(F.col("lang") == lang, support if n >= 10 else 1).otherwise(least)
    chosen = docs.where(part < share).select("lang", F.col("text").cast("binary").alias("text"))
    counts = chosen.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= least).select("lang", "gram").toArrow().to_pandas()
    by_lang = dict(iter(found.groupby("lang")["gram"]))
    return build({lang: by_lang[lang].to_numpy(np.uint32) if lang in by_lang else np.zeros(0, np.uint32) for lang in totals})


def predict(docs: DataFrame, model: Model, *, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns in ``carry``, ``lang_pred`` and ``score`` (share of the text's n-grams that the language holds).

    A text that is null, empty or without letters is ``und`` with score 0, and so is every text if nothing was learned;
    ties go to the first language by code point; repeated rows get equal results; an empty table gives no rows; carried
    columns named ``lang_pred`` or ``score`` give way to the results.  Whole texts are read in pieces, so that a batch
    or a very long text needs little memory.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    carry = carried(carry, "doc_id", "lang_pred", "score")
    # a carried text goes through Python once
    source = "text" if "text" in carry else "_text"
    kept = docs.select("doc_id", *carry, *([] if source == "text" else [F.col("text").cast("binary").alias("_text")]))
    names = ["doc_id", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs: list[str] = []
            scores = [np.zeros(0)]
            for _, texts in slices(batch.column(source)):
                a, b = sent.value.score(texts)
                langs += a
                scores.append(b)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(langs, pa.string()), pa.array(np.concatenate(scores), pa.float64())], names=[*names, "lang_pred", "score"])

    schema = kept.select(*names).schema.add("lang_pred", "string").add("score", "double")
    return kept.mapInArrow(run, schema)


def held_out():
    """Rows that the contract keeps from learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, *, carry: tuple[str, ...] = (), **options) -> DataFrame:
    """Learn from the rows that are not held out, predict every row."""
    model = train(docs.select("doc_id", "text", "lang").where(~held_out()), **options)
    return predict(docs, model, carry=carry)
