"""Exact top-k search over binary codes by incremental multi-index hashing."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapulse.session import materialise

#: Bits of a code column.
BITS = 64
#: Segments of a code column, at most: few distinct codes must not make many tiny segments.
MOST_SEGMENTS = 16


def binary_codes(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, components: int = BITS) -> DataFrame:
    """``id`` and the code of a vector of up to ``components``: one column ``code``, or ``code0, code1 ...`` of 64 bits each.

    Bit i is set where component i is above zero.  Rows without an id or a vector are left out; a missing or NaN
    component counts as not above zero; a longer vector is refused by an error in the task.
    """
    kept = rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    words = -(-components // BITS)
    up = lambda i: (F.get(vector_col, i) > 0) & ~F.isnan(F.get(vector_col, i).cast("double"))

    def word(w: int) -> Column:
        bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.when(up(i + w * BITS), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
        return F.when(F.size(vector_col) <= components, code).otherwise(F.raise_error(F.lit(f"a vector has more than {components} components")).cast("long"))

    return kept.select(F.col(id_col).alias("id"), *[word(w).alias("code" if words == 1 else f"code{w}") for w in range(words)])


def widths(n: int) -> list[int]:
    """Widths of the segments of a code column for ``n`` codes, as equal as can be.

    A key of w bits meets n / 2^w codes by chance.  A key costs a row that is made, dealt and sorted, as a candidate does,
    so segments are two bits shorter than log2(n): each key brings a few candidates instead of one or none.
    """
    parts = min(MOST_SEGMENTS, max(1, round(BITS / max(1.0, math.log2(n) - 2))))
    return [BITS // parts + (j < BITS % parts) for j in range(parts)]


def segments(codes: list, bits: list[int]) -> list[Column]:
    """The segments of all code columns, each from its lowest bits on; ``bits`` are the widths of one column's."""
    return [F.shiftrightunsigned(c, sum(bits[:j])).bitwiseAND(F.lit((1 << b) - 1 if b < BITS else -1).cast("long")) for c in codes for j, b in enumerate(bits)]


def steps(bits: list[int], most: int = 256):
    """``(radius, first segment, after the last)`` in order: segments of one radius together while they make up to ``most`` keys a query."""
    for r in range(max(bits) + 1):
        at = 0
        while at < len(bits):
            end = at + 1
            while end < len(bits) and sum(math.comb(b, r) for b in bits[at : end + 1]) <= most:
                end += 1
            yield r, at, end
            at = end


def search(rows: DataFrame, queries: DataFrame, *, k: int = 10) -> DataFrame:
    """The ``k`` nearest codes of each query: ``query_id, rank, neighbour_id, hamming``.

    ``rows`` and ``queries`` have ``id`` and the same code columns, whose names start with ``code``.  Ties in distance
    go to the smaller id; a query does not find rows of its own id; fewer than ``k`` rows give fewer neighbours;
    repeated rows count one by one, repeated queries are one; rows without an id or a code are left out; no queries, or
    no rows, give no rows.

    A code is cut into m segments.  The radius grows segment by segment: a step looks up some segments of every open
    query with exactly r bits flipped.  After segment a of radius r, all codes at a distance of up to m r + a have been
    seen: a code further off in every segment looked up so far differs in more bits.  A query closes when its k-th
    verified distance is within that.  A code is taken only from its nearest segment (the first, if several are equally
    near), so none is seen twice in any step, and only if it is no further than the k-th verified so far.
    Equal codes are one entry with its k + 1 smallest distinct ids and the number of rows of each, so a code that a
    third of all rows share is one candidate, and a query's own rows take no neighbour's place.
    All joins are merge joins: every side grows with the rows or the queries, and hash tables sent anew in each step
    pile up on the driver.
    """
    codes = [c for c in rows.columns if c.startswith("code")]
    whole = lambda df: df.select("id", *codes).dropna()
    counted = whole(rows).groupBy(*codes, "id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("n"))
    ranked = F.row_number().over(Window.partitionBy(*codes).orderBy("id"))
    index = counted.withColumn("_n", ranked).where(F.col("_n") <= k + 1).groupBy(*codes).agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("ids"))
    index = materialise(index)
    per_code = widths(max(2, index.count()))
    bits = per_code * len(codes)
    parts, length = len(bits), BITS * len(codes)
    keyed = lambda names, js: F.explode(F.array(*[F.struct(F.lit(j).alias("part"), segments(names, per_code)[j].alias("key")) for j in js]))
    entries = materialise(index.select(*codes, keyed(codes, range(parts)).alias("e")).select(*codes, "e.part", "e.key"))
    own = [f"q_{c}" for c in codes]
    query = ["query_id", *own]
    open_ = materialise(whole(queries).select(F.col("id").alias("query_id"), *[F.col(c).alias(q) for c, q in zip(codes, own, strict=True)], F.lit(length).alias("bound")).distinct())
    done, state = [], None
    for r, begin, end in steps(bits):
        if not any(math.comb(b, r) for b in bits[begin:end]):
            continue
        flips = F.array(*[F.lit([sum(1 << x for x in c) for c in itertools.combinations(range(b), r)]).cast("array<bigint>") for b in bits[begin:end]])
        probes = open_.select(*query, "bound", keyed(own, range(begin, end)).alias("e"))
        probes = probes.select(*query, "bound", "e.part", F.col("e.key").alias("own"), F.explode(F.get(flips, F.col("e.part") - begin)).alias("flip"))
        probes = probes.select(*query, "bound", "part", F.col("own").bitwiseXOR(F.col("flip")).alias("key"))
        met = probes.join(entries.where(F.col("part").between(begin, end - 1)).hint("merge"), ["part", "key"])
        differ = [F.col(q).bitwiseXOR(F.col(c)) for c, q in zip(codes, own, strict=True)]
        distance = sum((F.bit_count(d) for d in differ[1:]), F.bit_count(differ[0]))
        near = [F.bit_count(x) for x in segments(differ, per_code)]
        first = F.coalesce(*[F.when(near[j] == (F.least(*near) if parts > 1 else near[0]), F.lit(j)) for j in range(parts)])
        met = met.where((distance <= F.col("bound")) & (F.col("part") == first)).select(*query, *codes, distance.alias("hamming"))
        found = met.join(index.hint("merge"), codes).select(*query, "hamming", F.explode("ids").alias("x")).where("x.id <> query_id")
        found = found.select(*query, "hamming", F.col("x.id").alias("neighbour_id"), F.explode(F.sequence(F.lit(1), F.col("x.n"))).alias("_copy")).drop("_copy")
        if state is not None:
            found = found.union(state.select(found.columns))
        order = Window.partitionBy(*query).orderBy("hamming", "neighbour_id")
        best = materialise(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        kth = best.where(F.col("rank") == k).select(*query, F.col("hamming").alias("bound"))
        covered = parts * r + end - 1
        closed = kth.where(F.col("bound") <= covered)
        seen = open_.drop("bound").join(kth.hint("merge"), query, "left").withColumn("bound", F.coalesce("bound", F.lit(length)))
        open_ = materialise(seen.where(F.col("bound") > covered))
        done.append(best.join(closed.hint("merge"), query, "left_semi"))
        state = best.join(closed.hint("merge"), query, "left_anti")
        if open_.isEmpty():
            break
    if state is None:
        raise ValueError("a code column has no bits")
    out = state
    for d in done:
        out = out.unionByName(d)
    return out.select("query_id", "rank", "neighbour_id", F.col("hamming").cast("int").alias("hamming"))
