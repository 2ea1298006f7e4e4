"""Ranked search against plain scores, whatever the number of stages and passes; edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np

from terrapulse.llm import lexsearch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = {}
    for i, words in asked.items():
        scored = []
        for d, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n) // max(1, total)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if w in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        if scored:
            out[i] = [(d, -s) for s, _, _, d in sorted(scored)[:k]]
    return out


def found(df, k=10):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


def case(seed=3, n=260):
    rng = random.Random(seed)
    word = lambda: f"w{min(rng.randrange(200), rng.randrange(200), rng.randrange(200))}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(n)]
    docs += [(900, None), (901, ""), (902, "..."), (None, "w1 w2 w3"), (5, docs[5][1]), (903, "É é W1-W2,w2"), (904, docs[7][1]), (905, "common " * 3000)]
    items = [(j, " ".join(word() for _ in range(12))) for j in range(9)] + [(20, None), (21, ""), (22, "absent"), (3, "w150 w151"), (None, "w3 É"), (23, docs[7][1]), (24, "é common")]
    return docs, items


def test_against_plain_scores(spark, monkeypatch):
    docs, items = case()
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert found(lexsearch.search(d, q)) == plain(docs, items)
    # several owners, passes, bundles and blocks make no difference
    assert found(lexsearch.search(d.repartition(3), q, stages=1, k=3)) == plain(docs, items, 3)
    monkeypatch.setattr(lexsearch, "BUNDLE_ITEMS", 4)
    assert found(lexsearch.search(d.repartition(5), q, stages=7, pass_terms=60)) == plain(docs, items)


def test_small_blocks(monkeypatch):
    """Blocks end in time: very short texts, many of them."""
    import pyarrow as pa

    monkeypatch.setattr(lexsearch, "STEP_DOCS", 4)
    rows = pa.RecordBatch.from_arrays([pa.array(range(11)), pa.array([b"a", b"", None] * 3 + [b"b", b"a b"])], ["doc_id", "t"])
    parts = list(lexsearch._hashed(iter([rows])))
    assert [len(p[0]) for p in parts] == [4, 4, 3] and sum(p[3].sum() for p in parts) == 6


def test_forgetting_loses_nothing():
    """A score that can just reach the k-th stays, one below goes."""
    acc = lexsearch.Accumulator(1, 4)
    acc.scores[0] = [10, 7, 6, 0]
    acc.forget(np.array([3]), 1)
    assert acc.scores[0].tolist() == [10, 7, 0, 0]
    same = lexsearch.Accumulator.unpacked(1, 4, acc.packed())
    assert (same.scores == acc.scores).all()


def test_string_ids_other_columns_and_no_rows(spark):
    d = spark.createDataFrame([("b", "x y", 1), ("a", "x y", 2), ("c", "z", 3)], "doc_id string, text string, rank int")
    q = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [(r["rank"], r.doc_id) for r in lexsearch.search(d, q).orderBy("rank").collect()] == [(1, "a"), (2, "b")]
    assert lexsearch.search(d.where("false"), q).count() == 0
    assert lexsearch.search(d, q.where("false")).count() == 0
