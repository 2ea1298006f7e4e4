"""Ranked lexical search by pipelined term partitioning.

Terms are owned by stages.  A bundle of items visits the owners one after another and carries a sparse accumulator of
document scores; each owner adds the integer contributions of its terms by a cogroup, and the last one selects.
Documents are worked on in blocks, so that a bundle's accumulators and an owner's postings of one block fit in a task
whatever the size of the corpus or the frequency of a term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrapulse.llm._text import hashed_words, slices
from terrapulse.session import materialise

#: Distinct item terms sent to the tasks at once, 8 bytes each; items with more in all take several passes.
PASS_TERMS = 2_000_000
#: Items of a bundle and documents of a block: what a task holds is a multiple of their product.
BUNDLE_ITEMS = 128
BLOCK_DOCS = 8192
#: Documents that a task takes at once, so that a block of very short texts ends in time.
STEP_DOCS = 2048
#: Text of a block, bytes.
BLOCK_BYTES = 16 << 20
#: A term adds less than its weight times this.
UNIT = 1_000_000


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, int, np.ndarray, np.ndarray]]:
    """(id, text) rows -> ids, bytes of text, hashes of all their terms, and the number of terms of each."""
    for batch in batches:
        for start in range(0, batch.num_rows, STEP_DOCS):
            part = batch.slice(start, STEP_DOCS)
            for first, texts in slices(part.column(1)):
                yield part.column(0).slice(first, len(texts)), sum(map(len, texts)), *hashed_words(texts)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) rows -> (id, hash of a term)."""
    for ids, _, words, counts in _hashed(batches):
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.repeat(np.arange(len(ids)), counts))), pa.array(words.view(np.int64))], ["item_id", "term"])


def _ints(values: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _scan(broadcast, schema: pa.Schema):
    """(id, text) rows -> a row a block: its ids in order, their lengths in terms, and the postings of the item terms.

    Postings are sorted by term: ``terms`` holds the places of the block's terms in the broadcast list, ``ends`` where
    each term's postings end, ``at`` the documents (places in ``ids``) and ``tf`` how often the term occurs there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = broadcast.value
        base, seq = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []
        n_docs = n_bytes = 0

        def block() -> pa.RecordBatch:
            ids = pa.concat_arrays([h[0] for h in held])
            order = pc.array_sort_indices(ids, null_placement="at_end").to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            starts = np.cumsum([0, *(len(h[0]) for h in held)])
            doc = place[np.concatenate([h[2] + s for h, s in zip(held, starts, strict=False)])]
            term, tf = (np.concatenate([h[k] for h in held]) for k in (3, 4))
            by = np.lexsort((doc, term))
            term, doc, tf = term[by], doc[by], tf[by]
            last = np.flatnonzero(np.append(term[1:] != term[:-1], True)) if len(term) else np.zeros(0, np.int64)
            lengths = np.concatenate([h[1] for h in held])[order]
            row = {
                "block": [base + seq], "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order)), type=schema.field("ids").type), "lengths": [_ints(lengths, np.int64)],
                "terms": [_ints(term[last], np.int32)], "ends": [_ints(last + 1, np.int64)], "at": [_ints(doc, np.uint16)], "tf": [_ints(tf, np.int32)], "n_docs": [int((lengths > 0).sum())], "n_terms": [int(lengths.sum())],
            }
            return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, schema.field(c).type) for c, v in row.items()], schema=schema)

        for ids, size, words, counts in _hashed(batches):
            found = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
            known = vocabulary[found] == words
            doc = np.repeat(np.arange(len(ids), dtype=np.int64), counts)[known]
            pair, tf = np.unique(doc * len(vocabulary) + found[known], return_counts=True)
            held.append((ids, counts, pair // len(vocabulary), pair % len(vocabulary), tf))
            n_docs += len(ids)
            n_bytes += size
            if n_docs >= BLOCK_DOCS or n_bytes >= BLOCK_BYTES:
                yield block()
                held, n_docs, n_bytes, seq = [], 0, 0, seq + 1
        if held:
            yield block()

    return run


def _dealt(broadcast, schema: pa.Schema, n_stages: int):
    """Block rows -> a row for each owner that has postings there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner_of = broadcast.value
        for batch in batches:
            for row in batch.to_pylist():
                terms, ends = np.frombuffer(row["terms"], np.int32), np.frombuffer(row["ends"], np.int64)
                sizes = np.diff(ends, prepend=0)
                owner = owner_of[terms]
                each = np.repeat(owner, sizes)
                at, tf = np.frombuffer(row["at"], np.uint16), np.frombuffer(row["tf"], np.int32)
                for s in range(n_stages):
                    own = owner == s
                    if own.any():
                        made = (row["block"], s, _ints(terms[own], np.int32), _ints(np.cumsum(sizes[own]), np.int64), _ints(at[each == s], np.uint16), _ints(tf[each == s], np.int32))
                        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(made, schema, strict=True)], schema=schema)

    return run


class Accumulator:
    """Scores of a block's documents (columns) for a bundle's items (rows); sparse when it travels."""

    def __init__(self, n_items: int, n_docs: int):
        self.scores = np.zeros((n_items, n_docs), np.int64)

    @classmethod
    def unpacked(cls, n_items: int, n_docs: int, row: dict) -> Accumulator:
        out = cls(n_items, n_docs)
        ends = np.frombuffer(row["item_ends"], np.int64)
        if len(ends):
            item = np.repeat(np.arange(n_items), np.diff(ends, prepend=0))
            out.scores[item, np.frombuffer(row["docs"], np.uint16)] = np.frombuffer(row["scores"], np.int64)
        return out

    def packed(self) -> dict:
        item, doc = np.nonzero(self.scores)
        return {"item_ends": _ints(np.cumsum(np.bincount(item, minlength=len(self.scores))), np.int64), "docs": _ints(doc, np.uint16), "scores": _ints(self.scores[item, doc], np.int64)}

    def add(self, query: dict, postings: dict, norms: np.ndarray) -> None:
        """``norms``: 8 * m of each document."""
        terms, ends = np.frombuffer(postings["terms"], np.int32), np.frombuffer(postings["ends"], np.int64)
        at, tf = np.frombuffer(postings["at"], np.uint16), np.frombuffer(postings["tf"], np.int32).astype(np.int64)
        part = (1_000_000_000 * tf) // (1000 * tf + norms[at])
        items, wanted, weights = (np.frombuffer(query[c], np.int64) for c in ("items", "terms", "weights"))
        where = np.searchsorted(terms, wanted)
        for i, t, w, k in zip(items, wanted, weights, where, strict=True):
            if k < len(terms) and terms[k] == t:
                lo = ends[k - 1] if k else 0
                self.scores[i, at[lo : ends[k]]] += w * part[lo : ends[k]]

    def forget(self, left: np.ndarray, k: int) -> None:
        """Drops documents that the weights still to come cannot lift to the k-th best score of this block."""
        if self.scores.shape[1] > k:
            kth = np.partition(self.scores, -k, axis=1)[:, -k]
            # a score of exactly the bound can still tie, and win by its id
            self.scores[self.scores + left[:, None] < kth[:, None]] = 0

    def best(self, k: int) -> Iterator[tuple[int, np.ndarray]]:
        """Of each item the documents with the k highest scores above 0, equal scores by place (that is, by id)."""
        for i, s in enumerate(self.scores):
            d = np.flatnonzero(s)
            if len(d) > k:
                d = d[s[d] >= np.partition(s[d], -k)[-k]]
            yield i, d[np.lexsort((d, -s[d]))][:k]


def _stage(schema: pa.Schema, k: int, last: bool):
    """(bundle's state in a block, the owner's postings and the bundle's terms there) -> state, or the best of the block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        row = left.to_pylist()[0]
        norms = np.frombuffer(row["norms"], np.int64)
        todo = np.frombuffer(row["left"], np.int64).copy()
        acc = Accumulator.unpacked(row["n_items"], len(norms), row)
        for r in right.to_pylist():
            acc.add({"items": r["q_items"], "terms": r["q_terms"], "weights": r["q_weights"]}, r, norms)
            np.subtract.at(todo, np.frombuffer(r["q_items"], np.int64), UNIT * np.frombuffer(r["q_weights"], np.int64))
        if last:
            found = [(i, d, acc.scores[i, d]) for i, d in acc.best(k)]
            item = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
            doc = np.concatenate([f[1] for f in found]).astype(np.int64)
            ids = left.column("ids").combine_chunks().values
            return pa.Table.from_arrays([pa.array(np.full(len(item), row["bundle"])), pa.array(item), ids.take(pa.array(doc)).cast(schema.field("doc_id").type), pa.array(np.concatenate([f[2] for f in found]))], schema=schema)
        acc.forget(todo, k)
        made = left.to_pydict() | {c: [v] for c, v in acc.packed().items()} | {"left": [todo.tobytes()]}
        return pa.table({f.name: pa.array(made[f.name], f.type) for f in schema}, schema=schema)

    return run


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _pack(column: str):
    """Aggregate: the numbers of a group, ordered by term, as little-endian 8-byte integers."""
    return F.transform(F.array_sort(F.collect_list(F.struct("term_at", "slot", "weight"))), lambda x: x[column])


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of longs as their bytes."""
    for batch in batches:
        cols = [pa.array([_ints(np.asarray(v, np.int64), np.int64) for v in c.to_pylist()], pa.binary()) if pa.types.is_list(c.type) else c for c in batch.columns]
        yield pa.RecordBatch.from_arrays(cols, batch.schema.names)


def search(docs: DataFrame, items: DataFrame, *, k: int = 10, stages: int = 4, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", pass_terms: int = PASS_TERMS) -> DataFrame:
    """The ``k`` documents with the highest scores for each item.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.  With N documents that hold a
    term, L terms in them, n in one document, and df documents that hold a given term, the term weighs
    w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's norm is m = 10 + (90 n N) div L, and a document scores the
    sum over the item's distinct terms of w * ((10^9 tf) div (1000 tf + 8 m)), all in 64-bit integers.

    Returns ``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` (above 0); equal scores by ascending ``doc_id``, null
    ids last.  Null and empty texts hold no terms and are never found; rows of one item id are one item, a null id
    included; repeated documents are ranked one by one; an item without terms, or whose terms no document holds, gives no row, as
    do empty tables.  Other columns are not looked at.

    Owners hold the terms in the order of their document frequency, rarest first, with about equal numbers of
    postings, so accumulators start small; documents that the terms still to come cannot lift to the block's own k-th
    score are forgotten, which loses no result.  Terms are told apart by 64-bit hashes.  Item terms reach the
    tasks as one sorted array of at most ``pass_terms`` numbers; more of them take another pass over the documents.
    """
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("binary").alias("t")).where(F.col("t").isNotNull())
    kind = asked.schema["item_id"].dataType
    terms = materialise(asked.mapInArrow(_terms, T.StructType([T.StructField("item_id", kind), T.StructField("term", T.LongType())])).distinct())
    passes = max(1, -(-terms.count() // pass_terms))
    out = None
    for p in range(passes):
        own = terms if passes == 1 else terms.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p)
        found = _pass(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("t")), own, k, stages)
        out = found if out is None else out.union(found)
    return out


def _pass(docs: DataFrame, terms: DataFrame, k: int, stages: int) -> DataFrame:
    spark = docs.sparkSession
    sc = spark.sparkContext
    # at most pass_terms numbers
    vocabulary = np.sort(np.asarray(terms.select("term").distinct().toArrow().column(0).to_numpy()).view(np.uint64))
    if not len(vocabulary):
        vocabulary = np.zeros(1, np.uint64)  # without item terms the rest runs over nothing
    n_words = len(vocabulary)
    id_type = docs.schema["doc_id"].dataType
    binary, number = T.BinaryType(), T.LongType()
    field = lambda **f: T.StructType([T.StructField(c, t) for c, t in f.items()])
    shape = field(block=number, ids=T.ArrayType(id_type), lengths=binary, terms=binary, ends=binary, at=binary, tf=binary, n_docs=number, n_terms=number)
    blocks = materialise(docs.mapInArrow(_scan(sc.broadcast(vocabulary), _arrow(shape)), shape))
    total = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    n, length = int(total[0]), int(total[1])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.zeros(n_words, np.int64)
            for t, e in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[np.frombuffer(t, np.int32)] += np.diff(np.frombuffer(e, np.int64), prepend=0)
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["term_at", "df"])

    counted = blocks.select("terms", "ends").mapInArrow(frequencies, "term_at long, df long").groupBy("term_at").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(n_words, np.int64)
    df[counted.column("term_at").to_numpy()] = counted.column("df").to_numpy()
    order = np.argsort(df, kind="stable")
    owner = np.empty(len(df), np.int8)
    owner[order] = np.minimum(stages - 1, (np.cumsum(df[order]) - df[order]) * stages // max(1, int(df.sum())))
    weight = np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)

    n_bundles = max(1, -(-terms.select("item_id").distinct().count() // BUNDLE_ITEMS))
    bundle = F.pmod(F.xxhash64("item_id"), F.lit(n_bundles))
    slot = F.row_number().over(Window.partitionBy("bundle").orderBy("item_id")) - 1
    names = materialise(terms.select("item_id").distinct().withColumn("bundle", bundle).withColumn("slot", slot.cast("long")))
    listed = sc.broadcast((vocabulary, owner, weight, df))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, owners, weights, counts = listed.value
        for batch in batches:
            at = np.searchsorted(words, batch.column(2).to_numpy().view(np.uint64))
            keep = pa.array(counts[at] > 0)
            made = [batch.column(0), batch.column(1), pa.array(at.astype(np.int64)), pa.array(owners[at].astype(np.int32)), pa.array(weights[at])]
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in made], ["bundle", "slot", "term_at", "owner", "weight"])

    same = F.col("a.item_id").eqNullSafe(F.col("b.item_id"))
    asked = terms.alias("a").join(names.alias("b"), same).select("bundle", "slot", "term").mapInArrow(weighed, "bundle long, slot long, term_at long, owner int, weight long")
    asked = materialise(asked)
    queries = asked.groupBy("bundle", "owner").agg(_pack("slot").alias("q_items"), _pack("term_at").alias("q_terms"), _pack("weight").alias("q_weights"))
    queries = materialise(queries.mapInArrow(_bytes_of, "bundle long, owner int, q_items binary, q_terms binary, q_weights binary"))
    sizes = names.groupBy("bundle").agg(F.count(F.lit(1)).alias("n_items"))
    per_item = asked.groupBy("bundle", "slot").agg((F.sum("weight") * UNIT).alias("todo"))
    left = names.join(per_item, ["bundle", "slot"], "left").groupBy("bundle").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", F.coalesce("todo", F.lit(0)).alias("todo")))), lambda x: x["todo"]).alias("left"))
    bundles = materialise(sizes.join(left, "bundle").mapInArrow(_bytes_of, "bundle long, n_items long, left binary"))

    postings_shape = field(block=number, owner=T.IntegerType(), terms=binary, ends=binary, at=binary, tf=binary)
    postings = materialise(blocks.select("block", "terms", "ends", "at", "tf").mapInArrow(_dealt(sc.broadcast(owner), _arrow(postings_shape), stages), postings_shape))
    norms = lambda x: _ints(8 * (10 + 90 * np.frombuffer(x, np.int64) * n // max(1, length)), np.int64)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            empty = pa.array([b""] * batch.num_rows, pa.binary())
            cols = {c: batch.column(c) for c in ("bundle", "block", "ids", "n_items", "left")} | {"norms": pa.array([norms(x) for x in batch.column("lengths").to_pylist()], pa.binary()), "item_ends": empty, "docs": empty, "scores": empty}
            yield pa.RecordBatch.from_arrays([cols[f.name] for f in state_shape.fields], [f.name for f in state_shape.fields])

    state_shape = field(bundle=number, block=number, ids=T.ArrayType(id_type), n_items=number, left=binary, norms=binary, item_ends=binary, docs=binary, scores=binary)
    # each bundle starts in each block: the query set against all rows, in blocks
    started = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_bundles - 1).cast("long"))).alias("bundle")
    state = blocks.where("n_docs > 0").select("block", "ids", "lengths", started).join(bundles, "bundle").mapInArrow(opened, state_shape)
    best_shape = field(bundle=number, slot=number, doc_id=id_type, score=number)
    for s in range(stages):
        final = s == stages - 1
        shape = best_shape if final else state_shape
        here = postings.where(F.col("owner") == s).join(queries.where(F.col("owner") == s), "owner").drop("owner")
        state = state.groupBy("bundle", "block").cogroup(here.groupBy("bundle", "block")).applyInArrow(_stage(_arrow(shape), k, final), shape)
    ranked = Window.partitionBy("bundle", "slot").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = state.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.join(names, ["bundle", "slot"]).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
