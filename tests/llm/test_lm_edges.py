"""Cases that gave wrong answers once: repeated rows, few codes, several texts of one id, long texts, hot anchors, the pipeline's stages."""

import random

import numpy as np
import pytest

import corpus_pipeline
from terrapulse.llm import contamination, hamming, langid, neardup, pii, substrings
from terrapulse.llm._text import hashed_words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text_of(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def nearest(codes, queries, k):
    out = {}
    for q, c in queries:
        near = sorted((sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(c, d, strict=True)), i) for i, d in codes if i != q)[:k]
        out[q] = near
    return out


def found(df, queries, k):
    got = {}
    for r in hamming.search(df, queries, k=k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.hamming, r.neighbour_id))
    return {q: [x[1:] for x in sorted(v)] for q, v in got.items()}


def test_repeated_rows_take_no_place(spark):
    rows = [(0, 7)] * 12 + [(i, 7) for i in range(1, 20)] + [(50, 6), (50, 6)]
    df = spark.createDataFrame(rows, "id long, code long")
    assert found(df, df.where("id = 0"), 10) == nearest([(i, (c,)) for i, c in rows], [(0, (7,))], 10)


def test_few_codes_and_wide_codes(spark):
    two = spark.createDataFrame([(i, 1 if i % 2 else -1) for i in range(50)], "id long, code long")
    assert found(two, two.where("id = 0"), 30) == nearest([(i, (1 if i % 2 else -1,)) for i in range(50)], [(0, (-1,))], 30)
    rng = np.random.default_rng(4)
    wide = rng.normal(size=(60, 70))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(wide)], "vec_id long, embedding array<double>")
    code = lambda v: tuple(sum(1 << i for i in range(64) if 64 * w + i < 70 and v[64 * w + i] > 0) for w in (0, 1))
    plain = [(i, code(v)) for i, v in enumerate(wide)]
    codes = hamming.binary_codes(df, components=70)
    assert found(codes, codes.where("id < 3"), 5) == nearest(plain, plain[:3], 5)
    with pytest.raises(Exception, match="more than 64"):
        hamming.binary_codes(df).collect()


def test_missing_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, float("nan")]), (2, None), (None, [1.0, 1.0]), (3, [1.0, -1.0])], "vec_id long, embedding array<double>")
    codes = hamming.binary_codes(df)
    assert sorted(map(tuple, codes.collect())) == [(1, 1), (3, 1)]
    assert hamming.search(codes, codes.where("id < 0")).count() == 0


def test_one_id_with_several_texts(spark):
    rng = random.Random(1)
    a, b = text_of(rng, 60), text_of(rng, 60)
    for kind, name in (("long", int), ("string", str), ("int", int)):
        rows = [(name(i), t) for i, t in ((5, a), (6, a), (5, b), (9, b))]
        df = spark.createDataFrame(rows, f"doc_id {kind}, text string")
        marked = neardup.find_groups(df, with_text=True).collect()
        classes = {(r.doc_id, r.tag): r.class_id for r in marked}
        assert len(classes) == 4 and {r.class_id for r in marked} == {name(5)} and len({r.class_tag for r in marked}) == 2


def test_near_copies_are_found(spark):
    """Recall of pairs at 0.8 or more, by the exact similarity of all pairs: the stated floor is 0.9."""
    rng = random.Random(3)
    rows = []
    for i in range(40):
        words = text_of(rng, 220).split()
        rows.append((2 * i, " ".join(words)))
        for at in rng.sample(range(len(words)), rng.choice((1, 2, 3, 4))):
            words[at] = "changed"
        rows.append((2 * i + 1, " ".join(words)))
    got = {r.doc_id: r.class_id for r in neardup.find_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    plain = neardup.Weights(np.zeros(0, np.uint64), np.zeros(0, np.int64))  # all shingles rare, as here
    bags = [neardup.weighted_bag(t.encode(), plain, 5) for _, t in rows]
    near = [(i, j) for i in range(80) for j in range(i) if neardup.weighted_jaccard(bags[i], bags[j]) >= 0.8]
    assert len(near) >= 20 and sum(got[i] == got[j] for i, j in near) >= 0.9 * len(near)
    assert all(i // 2 == j // 2 for i in got for j in got if got[i] == got[j])


def test_long_unrelated_texts_share_no_samples():
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 10**9, 60_000) + k * 10**9)).encode() for k in (0, 1)]
    own, n = zip(*(neardup.signatures([t], neardup.Weights(np.zeros(0, np.uint64), np.zeros(0, np.int64)), 5, 125) for t in texts), strict=True)
    assert min(x[0] for x in n) > 50_000 and (own[0] == own[1]).mean() < 0.02


def test_long_texts_are_read_in_pieces():
    rng = random.Random(6)
    text = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(400_000)).encode()
    whole, n = hashed_words([text, b"", b"one two"])
    assert n.tolist() == [400_000, 0, 2] and (whole[-2:] == hashed_words([b"one two"])[0]).all()
    model = langid.build({"x": np.unique(langid.grams([b" abcd "])[0])})
    names, score = model.score([text, b"abcd"])
    assert names == ["x", "x"] and score[1] > 0.9
    parts = [p for group in substrings.parts_of([text], 100, 1 << 16) for p in group]
    assert all(text[at : at + len(b)] == b for _, at, b in parts) and {at + i for _, at, b in parts for i in (0, len(b) - 100)} >= {0, len(text) - 100}


def test_hot_anchors(spark, monkeypatch):
    rng = random.Random(7)
    line = text_of(rng, 30)
    rows = [(i, f"{text_of(rng, 12)} {line} {text_of(rng, 12)}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    usual = sorted(map(str, substrings.remove_repeats(df).collect()))
    monkeypatch.setattr(substrings, "HOT_CONTEXTS", 2)
    assert sorted(map(str, substrings.remove_repeats(df).collect())) == usual
    with pytest.raises(TypeError):
        substrings.remove_repeats(df.selectExpr("cast(doc_id as string) doc_id", "text"))


def test_secrets_are_added(spark):
    rows = [(i, f'so it was token = "{"%040x" % random.Random(i).getrandbits(160)}" and more') for i in range(20)] + [(90, "plain words only"), (91, None)]
    got = {r.doc_id: r for r in pii.digest(pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(got[i].n_added >= 1 and "secret:" in got[i].spans for i in range(20)) and got[90].n_added == got[91].n_added == 0


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(8)
    a, b, c, item = (text_of(rng, 60) for _ in range(4))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, a), (5, a), (5, b), (7, c + " me@there.org"), (None, "w1 w2"), (8, None), (9, "12 34"), (10, item), (7, c + " me@there.org")]
    docs = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted((str(r.doc_id), r.text) for r in df.collect())
    # without any language to learn every text with letters stays
    first = stages["language_id"](spark, docs, str(tmp_path))
    assert ids(first) == sorted((str(i), t) for i, t in rows if t and any(x.isalpha() for x in t))
    second = stages["near_duplicates"](spark, first, str(tmp_path))
    assert ids(second) == sorted([("1", a), ("5", b), ("7", c + " me@there.org"), ("None", "w1 w2"), ("10", item)])
    third = stages["decontamination"](spark, second, str(tmp_path))
    assert ids(third) == sorted(x for x in ids(second) if x[0] != "10")
    fourth = stages["personal_data"](spark, third, str(tmp_path))
    assert dict(ids(fourth))["7"] == c + " [EMAIL]" and {r.doc_id: r.n_chars for r in fourth.collect()}[7] == len(c) + 8
    last = stages["source_mix"](spark, fourth, str(tmp_path))
    words = sum(len(t.split()) for _, t in ids(fourth))
    assert last.agg({"taken": "sum"}).first()[0] == int(1.5 * words) and set(ids(last)) <= set(ids(fourth))
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, last.collect()))
    none = docs.where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, none, str(tmp_path)).count() == 0, name


def test_document_frequencies_are_exact(spark):
    """Frequent shingles get their own steps, however long the texts; a shingle that shares a feature with them does not."""
    rng = random.Random(8)
    common, some = "this line is in every text", "that line is in a tenth"
    texts = [f"{text_of(rng, 400)} {common} {text_of(rng, 5)}" + (f" {some}" if i % 10 == 0 else "") for i in range(300)]
    df = spark.createDataFrame([(t.encode(),) for t in texts], "_text binary").repartition(3)
    weights = neardup.frequent_shingles(df, 5)
    held = {}
    for t in texts:
        for s in set(neardup.term_counts([t.encode()], 5)[0].tolist()):
            held[s] = held.get(s, 0) + 1
    want = {s: n for s, n in held.items() if n > 3}
    assert set(weights.frequent.tolist()) == set(want)
    steps = neardup.idf_steps(np.array([want[s] for s in weights.frequent.tolist()]), 300)
    assert weights.step.tolist() == steps.tolist() and weights.step.min() == 0
    rare = np.array([s for s in held if s not in want], np.uint64)
    assert (weights.classes(rare) == neardup.STEPS).all() and (weights.classes(weights.frequent) == weights.step).all()


def test_carried_columns_and_long_secrets(spark):
    docs = spark.createDataFrame([(1, "a b c", 7, "x"), (2, None, 8, "y")], "doc_id long, text string, n_words int, _text string")
    items = spark.createDataFrame([(5, "b")], "item_id long, text string")
    got = {r.doc_id: r for r in contamination.find_contamination(docs, items, carry=("n_words", "_text", "text")).collect()}
    assert got[1].n_words == 3 and got[1].n_hit == 1 and got[1].item_ids == ["5"] and got[1].text == "a b c" and got[2].n_words == 0
    assert contamination.find_contamination(docs.where("false"), items).count() == 0 and {r.n_hit for r in contamination.find_contamination(docs, items.where("false")).collect()} == {0}
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefghijkmnopqrstuvwxyz0123456789ABCDEFG") for _ in range(700))
    df = spark.createDataFrame([(1, f"api token = {long}"), (2, f"api token = {long[:24]}")], "doc_id long, text string")
    found = pii.candidates(df).collect()
    assert all(any(x.kind == "secret" and x.ok for x in r.spans) for r in found)


def test_very_long_text_has_hits(spark):
    docs = spark.createDataFrame([(1, "pad " * 400000 + "needle in hay")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "needle in hay")], "item_id long, text string")
    r = contamination.find_contamination(docs, items).first()
    assert r.n_words == 400003 and r.hit_runs == [400000, 400003]
