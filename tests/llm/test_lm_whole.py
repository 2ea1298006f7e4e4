"""The language models count everything: against plain counts, whatever the number of parts."""

import math
from collections import Counter

from terrapulse.llm import lmscore


def test_counts_every_document(spark):
    texts = ["a b a b c", "a b c d", "d c b a", None, "", "once a b", "b b b"] + [f"w{i % 7} w{i % 5} a b w{i % 3}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    good = {i for i in range(len(texts)) if i % 3}
    words = [(t or "").split() for t in texts]
    n = Counter(w for t in words for w in t)
    name = lambda w: w if n[w] >= 2 else "?"
    v = len({w for w in n if n[w] >= 2})
    uni, bi = [Counter(), Counter()], [Counter(), Counter()]
    pairs = [list(zip(["^", *map(name, t)], map(name, t), strict=False)) for t in words]
    for i, p in enumerate(pairs):
        for m in (0, 1):
            if m or i in good:
                bi[m].update(p)
                uni[m].update([w for _, w in p] + ["^"] * bool(p))
    # what follows a word: its occurrences but for those at the end of a text
    follows = [Counter(), Counter()]
    for m in (0, 1):
        for (a, _), k in bi[m].items():
            follows[m][a] += k
    total = [sum(c for w, c in u.items() if w != "^") for u in uni]
    scale = [1.0, total[0] / total[1]]

    def bits(p, m):
        single = lambda w: (uni[m][w] * scale[m] + 1) / (total[m] * scale[m] + v + 1)
        return sum(-math.log2((bi[m][a, w] * scale[m] + 100 * single(w)) / (follows[m][a] * scale[m] + 100)) for a, w in p) / len(p)

    for part_tokens in (20, 10**6):
        model = lmscore.train(docs, docs.where("doc_id % 3 > 0"), part_tokens=part_tokens)
        got = {r.doc_id: r for r in lmscore.score(docs, model).collect()}
        assert len(got) == len(texts) and got[3].score is None and got[4].n_tokens == 0
        for i, p in enumerate(pairs):
            if p:
                assert abs(got[i].target_bits - bits(p, 0)) < 1e-9 and abs(got[i].background_bits - bits(p, 1)) < 1e-9


def test_probabilities_add_up_to_one(spark):
    """Over all words, after each word that something follows, and at the start, in both models."""
    docs = spark.createDataFrame([(1, "a b a b c a"), (2, "a b c c a"), (3, "b a c b")], "doc_id long, text string")
    model = lmscore.train(docs, docs.where("doc_id < 3").select("doc_id"))
    v = model.vocabulary
    words = [w.split() for w in ("a b a b c a", "a b c c a", "b a c b")]
    number = {w: int(v.ids(lmscore.hashed_words([w.encode()])[0])[0]) for w in "abc"} | {"^": len(v.words) + 1}
    counts = [Counter(), Counter()]
    for i, t in enumerate(words):
        for p in zip(["^", *t], t, strict=False):
            counts[1][p] += 1
            counts[0][p] += i < 2
    for before in "abc^":
        after = [*"abc"]
        found = lmscore.np.array([[float(counts[m][before, w]) for m in (0, 1)] for w in after] + [[0.0, 0.0]])
        w = lmscore.np.array([number[x] for x in after] + [len(v.words)])
        bits = v.bits(lmscore.np.full(4, number[before]), w, found)
        assert abs((2.0**-bits).sum(0) - 1).max() < 1e-9


def test_target_is_not_sampled(spark):
    """More than 20,000 labelled documents: all of them are in the target."""
    docs = spark.range(30_000).selectExpr("id AS doc_id", "'a b' AS text")
    assert lmscore.train(docs, docs.select("doc_id")).unigrams[:-1, 0].sum() == 60_000
