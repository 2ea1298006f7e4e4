"""Cross-tokenizer alignment: tokens of two tokenizers grouped by the byte offsets where both end.

Character offsets of the one tokenizer and the span proto of the other give coarse cuts; where these fall inside a
character (tokens of parts of a character, byte-fallback pieces), the bytes that the tokens decode to give the rest.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrapulse.llm._text import carried
from terrapulse.session import materialise

#: Where the vocabulary files are, on every machine.
FOLDER = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: A block of documents: so much text or so many rows at most (a longer text is a block of its own).
BLOCK_BYTES = 8 << 20
BLOCK_DOCS = 8192
#: Aligned chunks that a Python worker remembers, in bytes as estimated by :meth:`Memory.cost`.
MEMORY_BYTES = 192 << 20
#: Characters tokenized in one call, and links of documents counted at once.
CALL_CHARS = 1 << 16
STEP_LINKS = 1 << 21
#: An id pair as one number: A's id times this, plus B's.
PAIR = 1 << 20

#: A single blank between two characters that are no white space: both tokenizers start a new token there.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _byte_of_symbol() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the alignment of a text."""

    def __init__(self, folder: str, byte_bpe: str, pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{folder}/{byte_bpe}")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{pieces}")
        symbols = _byte_of_symbol()
        spec = json.loads(Path(folder, byte_bpe).read_text())
        self.a_bytes = {i: bytes(symbols[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        pre = spec.get("pre_tokenizer") or {}
        # whole texts are taken in chunks only where neither vocabulary can hold a token across the cut
        self.separable = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and spec.get("normalizer") is None and not any(re.search("[^▁]▁", p) for p in names)

    def chunks(self, text: str) -> list[str]:
        """Pieces of a text that tokenize on their own, with a blank before each."""
        if not self.separable:
            return [text]
        parts = text.split(" ")
        if any(not p or p[0].isspace() or p[-1].isspace() for p in parts):
            return _CUT.split(text)
        return parts

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of both and the byte offsets, in blank + text, where their tokens end; None if bytes differ."""
        whole = " " + text
        raw = whole.encode()
        e = self.a.encode(whole, add_special_tokens=False)
        a, chars = e.ids, np.array([hi for _, hi in e.offsets], np.int64)
        pieces = self.b.encode(text, return_type="proto").pieces
        b, spans = [p.id for p in pieces], np.array([p.end for p in pieces], np.int64)
        own_a, own_b = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(own_a) != raw or b"".join(own_b) != raw:
            return None
        if not raw.isascii():
            points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
            chars = np.concatenate(([0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))))[chars]
        return np.array(a, np.int64), _refined(chars, own_a), np.array(b, np.int64), _refined(spans + 1, own_b)


def _refined(ends: np.ndarray, own: list[bytes]) -> np.ndarray:
    """Byte offsets where tokens end.

    ``ends`` are coarse: tokens of parts of one character all end with it, and byte pieces but the last are empty.  An
    end that agrees with the bytes of the tokens so far is taken as it is; all others come from the decoded bytes.
    """
    decoded = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)))
    return np.where(ends == decoded, ends, decoded)


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets where tokens of both end, and the number of the group of each A and each B token."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return common, np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)


@lru_cache(maxsize=2)
def tokenizers(folder: str, byte_bpe: str, pieces: str) -> Tokenizers:
    return Tokenizers(folder, byte_bpe, pieces)


class Memory:
    """Aligned chunks by number: what documents made of them need to know.

    Chunks are numbered when they are first seen and aligned together, before their numbers are used.
    """

    def __init__(self, both: Tokenizers):
        self.both = both
        self.number: dict[str, int] = {}
        self.todo: list[str] = []
        self.text: list[str | None] = []
        self.counts = np.zeros((0, 3), np.int64)  # tokens of A, of B, groups
        self.hits = np.zeros(0, np.int64)
        self.ends, self.pairs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held = 0

    def cost(self, chunk: str) -> int:
        return 400 + 30 * len(chunk)

    def see(self, chunk: str) -> int:
        k = self.number.get(chunk)
        if k is None:
            k = self.number[chunk] = len(self.number)
            self.todo.append(chunk)
            self.held += self.cost(chunk)
        return k

    def learn(self) -> None:
        """Aligns what has been seen."""
        if not self.todo:
            return
        counts, links = [], []
        run: list[str] = []
        chars = 0

        def aligned(chunks: list[str]) -> None:
            found = self.both.encoded(" ".join(chunks))
            if found is None and len(chunks) > 1:  # one of them cannot be aligned: look for it
                aligned(chunks[: len(chunks) // 2])
                aligned(chunks[len(chunks) // 2 :])
            elif found is None:
                self.text.append(None)
                counts.append(np.zeros((1, 3), np.int64))
                links.append([np.zeros(1, np.int64), np.zeros(0, np.int64)])
            else:
                text, n, width, pairs = _described(found, np.cumsum([len(c.encode()) + 1 for c in chunks]))
                self.text += text
                counts.append(n)
                links.append([width, pairs])

        for c in self.todo:
            alone = not c or c[0].isspace() or c[-1].isspace() or "\u2581" in c or not self.both.separable
            if run and (alone or chars > CALL_CHARS):
                aligned(run)
                run, chars = [], 0
            run.append(c)
            chars += len(c) + 1
            if alone:
                aligned(run)
                run, chars = [], 0
        if run:
            aligned(run)
        widths = np.concatenate([x[0] for x in links])
        start = self.ends[-1] if len(self.ends) else 0
        self.counts = np.concatenate([self.counts, *counts])
        self.ends = np.concatenate([self.ends, start + np.cumsum(widths)])
        self.pairs = np.concatenate([self.pairs, *(x[1] for x in links)])
        self.hits = np.concatenate([self.hits, np.zeros(len(self.todo), np.int64)])
        self.todo = []

    def links(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many links each of these chunks has, and their id pairs one after another."""
        ends = self.ends[numbers]
        starts = np.where(numbers > 0, self.ends[np.maximum(numbers, 1) - 1], 0)
        width = ends - starts
        return width, self.pairs[_runs(starts, width)]

    def trimmed(self) -> Memory:
        """A memory of the chunks that came more than once, so long as they take half of the room."""
        out = Memory(self.both)
        keep = np.flatnonzero(self.hits > 1)
        names = list(self.number)
        keep = keep[np.cumsum([self.cost(names[k]) for k in keep]) < MEMORY_BYTES // 2] if len(keep) else keep
        for k in keep:
            out.number[names[k]] = len(out.number)
            out.held += self.cost(names[k])
        out.text = [self.text[k] for k in keep]
        out.counts, out.hits = self.counts[keep], np.zeros(len(keep), np.int64)
        width, out.pairs = self.links(keep)
        out.ends = np.cumsum(width)
        return out


def _runs(starts: np.ndarray, width: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after another."""
    return np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width - starts, width)


def _described(found: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], chunk_ends: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of each chunk: its groups as text, its counts, its number of links; and all links as id pairs."""
    a, a_ends, b, b_ends = found
    common, of_a, of_b = groups_of(a_ends, b_ends)
    n_a, n_b = np.bincount(of_a, minlength=len(common)), np.bincount(of_b, minlength=len(common))
    chunk_of = lambda ends: np.searchsorted(chunk_ends, ends)
    n = len(chunk_ends)
    counts = np.stack([np.bincount(chunk_of(e), minlength=n) for e in (a_ends, b_ends, common)], 1)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    size = n_a * n_b
    within = _runs(np.zeros(len(size), np.int64), size)
    across = np.repeat(n_b, size)
    pairs = a[np.repeat(first_a, size) + within // across] * PAIR + b[np.repeat(first_b, size) + within % across]
    width = np.bincount(chunk_of(common), weights=size, minlength=n).astype(np.int64)
    # ids and separators in the order of the text: a group's A tokens, then its B tokens
    shift = np.cumsum(n_a + n_b) - n_a - n_b
    at_a = np.repeat(shift, n_a) + _runs(np.zeros(len(n_a), np.int64), n_a)
    at_b = np.repeat(shift + n_a, n_b) + _runs(np.zeros(len(n_b), np.int64), n_b)
    ids, mark = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
    ids[at_a], ids[at_b] = a, b
    mark[at_a[np.cumsum(n_a) - 1]] = 1
    last = at_b[np.cumsum(n_b) - 1]
    mark[last] = np.where(np.isin(common, chunk_ends), 3, 2)
    text = "".join([f"{i}{',|;_'[m]}" for i, m in zip(ids.tolist(), mark.tolist(), strict=True)])
    return text.split("_")[:-1], counts, width, pairs


def _block(memory: Memory, held: list[list[int]]) -> dict:
    """Of each document (a list of chunk numbers) counts, groups and links; of the block its id pairs."""
    memory.learn()
    sizes = np.fromiter(map(len, held), np.int64, len(held))
    chunks = np.fromiter(chain.from_iterable(held), np.int64, int(sizes.sum()))
    hits = np.bincount(chunks, minlength=len(memory.text))
    memory.hits += hits
    known = np.flatnonzero(hits)
    local = np.zeros(len(memory.text), np.int64)
    local[known] = np.arange(len(known))
    bad = np.array([memory.text[k] is None for k in known], bool)
    ends = np.cumsum(sizes)
    sums = lambda values: np.diff(np.concatenate(([0], np.cumsum(values)))[np.concatenate(([0], ends))])
    ok = sums(bad[local[chunks]]) == 0 if len(chunks) else np.ones(len(held), bool)
    out = {c: sums(memory.counts[chunks, k]) * ok for k, c in enumerate(("n_a", "n_b", "n_groups"))}
    text = memory.text
    out["groups"] = [";".join([text[k] for k in h]) if good else "" for h, good in zip(held, ok, strict=True)]
    width, pairs = memory.links(known)
    names, place = np.unique(pairs, return_inverse=True)
    begin = np.cumsum(width) - width
    links = sums(width[local[chunks]]) * ok if len(chunks) else np.zeros(len(held), np.int64)
    used = np.zeros(len(names), np.int64)
    out["n_links"], packed = links, []
    step = np.concatenate(([0], np.cumsum(links))) // STEP_LINKS
    cuts = [*np.flatnonzero(np.append(True, step[1:-1] != step[:-2])), len(held)] if len(held) > 1 else [0, len(held)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        own = local[chunks[ends[lo] - sizes[lo] : ends[hi - 1]]]
        doc = np.repeat(np.arange(hi - lo), sizes[lo:hi])
        own, doc = own[ok[lo:hi][doc]], doc[ok[lo:hi][doc]]
        w = width[own]
        link = np.repeat(doc, w) * len(names) + place[_runs(begin[own], w)]
        link.sort()
        first = np.flatnonzero(np.append(link[:1] >= 0, link[1:] != link[:-1]))
        count = np.diff(first, append=len(link))
        link = link[first]
        whose, which = link // max(1, len(names)), link % max(1, len(names))
        used += np.bincount(which, minlength=len(names))
        at = np.searchsorted(whose, np.arange(hi - lo + 1))
        packed += [(which[i:j], count[i:j]) for i, j in zip(at, at[1:], strict=False)]
    place = np.cumsum(used > 0) - 1  # pairs of documents without tokens are none
    out["links"] = [pack_links(place[w], c) for w, c in packed]
    out["pairs"], out["docs"] = names[used > 0], used[used > 0]
    return out


def pack_links(which: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending places in the block's pairs as differences, then how often each pair is linked; 4 bytes each, compressed."""
    both = np.concatenate([np.diff(which, prepend=0), times]).astype(np.uint32).tobytes()
    return len(which).to_bytes(8, "little") + bytes(pa.compress(both, codec="zstd", asbytes=True)) if len(which) else b""


def unpack_links(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not packed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = int.from_bytes(packed[:8], "little")
    both = np.frombuffer(pa.decompress(packed[8:], decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint32).astype(np.int64)
    return np.cumsum(both[:n]), both[n:]


_OWN = T.StructType([T.StructField(c, t) for c, t in (("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()), ("groups", T.StringType()), ("block", T.LongType()), ("links", T.BinaryType()), ("pairs", T.ArrayType(T.LongType())), ("docs", T.ArrayType(T.LongType())))])


#: A worker's memory outlives its tasks; it changes no result.
_MEMORIES: dict[tuple[str, str, str], Memory] = {}


def _scan(files: tuple[str, str, str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(*files)
        memory = _MEMORIES.get(files) or Memory(both)
        base, seq = TaskContext.get().partitionId() << 32, 0
        held: list[list[int]] = []
        kept: list[pa.RecordBatch] = []
        n_bytes = 0

        def block() -> Iterator[pa.RecordBatch]:
            found = _block(memory, held)
            rows = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            own = {"block": base + seq, "pairs": found.pop("pairs"), "docs": found.pop("docs")}
            found["block"] = np.full(len(held), base + seq)
            cols = [pa.array(found[f.name], f.type) if f.name in found else pa.nulls(len(held), f.type) if f.name in own else rows.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)
            yield pa.RecordBatch.from_arrays([pa.array([own[f.name]], f.type) if f.name in own else pa.nulls(1, f.type) for f in schema], schema=schema)

        for batch in batches:
            rest = batch.select([c for c in batch.schema.names if c != "_text"])
            begun = 0
            for i, value in enumerate(batch.column("_text")):
                raw = value.as_py() or b""
                text = raw.decode(errors="replace")
                see, get = memory.see, memory.number.get
                held.append([k if (k := get(p)) is not None else see(p) for p in both.chunks(text)] if text else [])
                n_bytes += len(raw)
                if len(held) >= BLOCK_DOCS or n_bytes >= BLOCK_BYTES or memory.held > MEMORY_BYTES:
                    kept.append(rest.slice(begun, i + 1 - begun))
                    yield from block()
                    begun, held, kept, n_bytes, seq = i + 1, [], [], 0, seq + 1
                    if memory.held > MEMORY_BYTES:
                        memory = memory.trimmed()
            if begun < batch.num_rows:
                kept.append(rest.slice(begun))
        if held:
            yield from block()
        _MEMORIES[files] = memory

    return run


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def align(docs: DataFrame, *, folder: str = FOLDER, byte_bpe: str = BYTE_BPE, pieces: str = PIECES, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Tokens of A (byte-level BPE, of blank + text) and B (pieces, of text) in groups that end at common byte offsets.

    A row per document: ``id_col``, the columns named in ``carry`` (those named like a result give way), ``n_a``,
    ``n_b``, ``n_groups``, ``n_links`` (A-B token pairs that share a group), ``groups`` (``a1,a2|b1;a3|b2,b3``: ids in
    order), and its links packed for :func:`count_links` (``block``, ``links``); and a row for each
    block of documents with the id pairs linked there (``pairs``) and the number of documents that hold each
    (``docs``), in which all else is null.  :func:`documents` leaves the documents' rows only.

    A text that is null, empty, or whose tokens of A or B do not join to blank + text (the pieces write U+2581 like a
    blank, and invalid UTF-8 is replaced) has no tokens: counts of 0 and an empty ``groups``.  Special tokens' strings
    are plain text.  Repeated rows are aligned one by one.  Whole texts are tokenized; they are cut at single blanks
    between other characters, where both vocabularies begin a token, so that a chunk that comes again is taken from
    the task's memory.
    """
    carry = carried(carry, id_col, "_text", *_OWN.fieldNames())
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.select(id_col, *carry).schema] + _OWN.fields)
    rows = docs.select(id_col, *carry, F.col(text_col).cast("binary").alias("_text"))
    return rows.mapInArrow(_scan((folder, byte_bpe, pieces), _arrow(schema)), schema)


def documents(aligned: DataFrame) -> DataFrame:
    return aligned.where("pairs IS NULL").drop("pairs", "docs")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair`` (A's id times :data:`PAIR` plus B's), ``n_docs``: documents that hold it linked; ``best``: as many as any pair of its A id."""
    counts = aligned.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("n_docs"))
    counts = materialise(counts.withColumn("a", F.floor(F.col("pair") / PAIR)))
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _summed(schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        order = np.argsort(right.column("pair").to_numpy())
        counts, best = right.column("n_docs").to_numpy()[order], right.column("best").to_numpy(zero_copy_only=False)[order]
        n_best, total = [], []
        for at, times in map(unpack_links, left.column("links").to_pylist()):
            n_best.append(int(times[best[at]].sum()) if len(at) else 0)
            total.append(int((times * counts[at]).sum()) if len(at) else 0)
        made = {"n_best": n_best, "count_sum": total}
        return pa.Table.from_arrays([pa.array(made[f.name], f.type) if f.name in made else left.column(f.name) for f in schema], schema=schema)

    return run


def count_links(aligned: DataFrame) -> DataFrame:
    """The documents of :func:`align` with ``n_best`` (links whose pair is as frequent as any of its A id) and ``count_sum``
    (over links, in how many documents of the whole corpus their pair is linked).

    Blocks, not documents, ask for the counts of their pairs: a pair that every document holds is asked for once a
    block.  The answers meet the block's documents by a cogroup.  Columns of ``aligned`` that should not travel (such
    as ``groups``) are to be dropped before.
    """
    rows = materialise(aligned)
    asked = rows.where("pairs IS NOT NULL").select(F.col("block").alias("asker"), F.explode("pairs").alias("pair"))
    answers = asked.join(pair_counts(rows), "pair")
    docs = documents(rows)
    keep = [f for f in docs.schema.fields if f.name not in ("block", "links")]
    shape = T.StructType(keep + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return docs.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_summed(_arrow(shape)), shape)


def digest(docs: DataFrame, **options) -> DataFrame:
    """The contract's columns, from :func:`align` and :func:`count_links`."""
    sha = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    aligned = align(docs, **options)
    found = count_links(aligned.select(*[c for c in aligned.columns if c != "groups"], sha))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
