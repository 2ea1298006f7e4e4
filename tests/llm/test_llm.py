"""Operators on small fixtures with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from terrapulse.llm import contamination, hamming, langid, lmscore, mixing, neardup, pii, quality, substrings, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdeioénrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = [text(rng.randint(30, 120)) for _ in range(12)]
    out = [(i, t, "x" if i % 2 else "y", f"s{i % 3}") for i, t in enumerate(base)]
    out += [(20, base[0], "x", "s0"), (21, base[1] + " extra", "y", "s0"), (22, None, "x", None), (23, "", "y", "s1"), (24, "word", None, "s1"), (None, base[2], "x", "s2"), (3, base[3], "y", "s0"), (26, text(4000), "x", "s0")]
    return [(*r, None, 0.5) for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_contamination(spark, docs, rows):
    items = [(1, " ".join(words(rows[4][1])[5:25])), (2, "word"), (3, None), (4, "!!")]
    df = contamination.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=100)
    windows = {tuple(w[i : i + 13]) for _, t in items if (w := words(t)) for i in range(max(1, len(w) - 12))}
    want = []
    for r in rows:
        w, hit = words(r[1]), set()
        for p in windows:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
        want.append((str(r[0]), len(w), len(hit)))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit) for r in df.collect()) == sorted(want)


def test_substrings(spark, docs, rows):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(docs).collect())
    seen, place, want = {}, lambda i: (rows[i][0] is None, rows[i][0] or 0), []
    for i in sorted(range(len(rows)), key=place):
        b = (rows[i][1] or "").encode()
        gone = set()
        for s in range(len(b) - 99):
            first = seen.setdefault(b[s : s + 100], (rows[i][0], s))
            if first != (rows[i][0], s):
                gone |= set(range(s, s + 100))
        want.append((str(rows[i][0]), len(b), len(gone), hashlib.sha256(bytes(x for k, x in enumerate(b) if k not in gone)).hexdigest()))
    assert got == sorted(want)


def test_interval_expansion():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(30)]
    got = substrings.later_windows(texts, 8)
    seen = set()
    for t, late in zip(texts, got, strict=True):
        want = []
        for s in range(len(t) - 7):
            if t[s : s + 8] in seen:
                want.append(s)
            seen.add(t[s : s + 8])
        assert late.tolist() == want


def test_near_duplicates(docs):
    got = sorted((str(r.doc_id), str(r.class_id)) for r in neardup.find_groups(docs).collect())
    named = dict(got)
    assert named["20"] == "0" and named["21"] == "1" and named["22"] == "22" and named["23"] == "23" and named["None"] == "None"
    assert len(got) == docs.count() and named["5"] == "5"


def test_personal_data(spark):
    texts = [None, "", "mail a.b@c-d.org, 10.0.0.1 or 999.1.1.1", "4111 1111 1111 1111 and 4111 1111 1111 1112", "+1 (555) 555-0100 x +12", "1.2.3.4.5.6.7.8", "é a@b.c@d.ee +49 30 1234567", "7" * 30000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(x.kind, x.start, x.end) for x in r.base] for r in pii.find_pii(df).collect()}
    assert got[0] == got[1] == got[7] == []
    assert got[2] == [("email", 5, 16), ("ip", 18, 26)] and got[3] == [("card", 0, 19)] and got[4] == [("phone", 0, 17)]
    assert got[5] == [("ip", 0, 7), ("ip", 8, 15)] and got[6] == [("email", 2, 7), ("phone", 13, 27)]


def test_mixing(docs, rows):
    out = mixing.mix_sources(docs).collect()
    size = {s: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows if r[3] == s) for s in {r[3] for r in rows}}
    assert len(out) == len(rows) and all(0 <= r.taken <= 2 * r["size"] for r in out)
    for s in size:
        mine = [r for r in out if r.source == s]
        assert mine[0].source_size == size[s] and sum(r.taken for r in mine) == int(mine[0].target)
    assert abs(sum({r.source: r.target for r in out}.values()) - 1.5 * sum(size.values())) < 1e-6
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix_sources(docs.repartition(3)).collect()))


def test_top_k(spark):
    rng = np.random.default_rng(1)
    codes = [(i, int(c)) for i, c in enumerate(rng.integers(-(2**63), 2**63 - 1, 150))] + [(200 + i, 7) for i in range(30)]
    df = spark.createDataFrame(codes, "id long, code long")
    got = {}
    for r in hamming.search(df, df.where("id % 50 = 0"), k=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.hamming, r.neighbour_id))
    for q, c in codes:
        if q % 50 == 0:
            near = sorted((bin((c ^ d) & (2**64 - 1)).count("1"), i) for i, d in codes if i != q)[:4]
            assert [x[1:] for x in sorted(got[q])] == near


def test_language(spark, docs):
    en, de = "the cat sat on the mat and then the other one ", "der hund und die katze sind nicht hier oder dort "
    train = [(i, (en if i % 2 else de) * (1 + i % 3), "en" if i % 2 else "de") for i in range(60)] + [(90, None, "en"), (91, "123 !!", "en"), (92, "", None)]
    df = spark.createDataFrame(train, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(df).collect()}
    assert all(got[i] == ("en" if i % 2 else "de") for i in range(60)) and got[90] == got[91] == got[92] == "und"
    assert {r.lang_pred for r in langid.identify(df.where("lang is null and doc_id < 0")).collect()} == set()


def test_lm_score(spark, docs):
    model = lmscore.train(docs, docs.where("doc_id in (1, 2)"), vocabulary=64, slots=1 << 10)
    got = {str(r.doc_id): r for r in lmscore.score(docs, model).collect()}
    assert got["22"].n_tokens == 0 and got["22"].score is None and got["1"].score < got["7"].score
    assert model.unigrams[:-1, 1].sum() == sum(len(words(r.text)) for r in docs.collect())


@pytest.mark.parametrize("module", [quality, toxicity])
def test_no_labels(spark, docs, module):
    out = module.classify(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)


def test_empty_tables(docs):
    none = docs.where("doc_id < -1")
    for f in (neardup.find_groups, substrings.remove_repeats, mixing.mix_sources, pii.find_pii, langid.identify):
        assert f(none).count() == 0
