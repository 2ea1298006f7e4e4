"""Personal data against the contract's patterns in plain Python; language filters against plain sets, with more than 64 languages."""

import random
import re

import numpy as np

from terrapulse.llm import langid, pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_against_plain_patterns(spark):
    rng = random.Random(12)
    parts = ["a.b@c-d.org", "x@y", "x@y.z@w.v", "10.0.0.1", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "+49 (30) 1234-567", "+1 2", "+12345678901234567", "é", "ß👍", "word", "0", "00012.3.4.5", "--", "5500005555555559", "@", "+", ".", "(", "\n"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", ", ", "-"]) for _ in range(rng.randrange(1, 25))) for _ in range(250)] + ["", None, "9" * 40, "1.1.1.1" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(x.kind, x.start, x.end) for x in r.base] for r in pii.find_pii(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_spans(t or ""), t


def test_seventy_languages_against_plain_sets(spark):
    """Each language has words of its own and some that it shares; the filter's answer is that of plain sets of n-grams."""
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèñ"
    shared = ["".join(rng.choice(letters) for _ in range(5)) for _ in range(30)]
    own = {f"l{k:02d}": ["".join(rng.choice(letters) for _ in range(6)) for _ in range(25)] for k in range(70)}
    text = lambda k, n: " ".join(rng.choice(own[k] if rng.random() < 0.6 else shared) for _ in range(n))
    grams = lambda t: set(langid.grams(next(langid.pieces([t.encode()]))[0])[0].tolist())
    sets = {k: set().union(*(grams(text(k, 30)) for _ in range(6))) for k in own}
    model = langid.build({k: np.array(sorted(v), np.uint32) for k, v in sets.items()})
    assert model.table.shape[0] == 2
    sample = [(k, text(k, 12)) for k in own]
    names, scores = model.score([t.encode() for _, t in sample])
    for (k, t), name, score in zip(sample, names, scores, strict=True):
        every = langid.grams(next(langid.pieces([t.encode()]))[0])[0].tolist()
        share = {lang: sum(g in s for g in every) / len(every) for lang, s in sets.items()}
        assert name == max(sorted(share), key=share.get) == k and abs(score - share[k]) < 0.02
    # every language that holds an n-gram is named, none is lost
    gram = np.array(sorted(set().union(*sets.values())), np.uint32)
    at = model.probes(gram)
    for i, lang in enumerate(model.languages):
        table = model.table[i // 64]
        mask = table[at[0]] & table[at[1]] & table[at[2]]
        held = (mask >> mask.dtype.type(i % 64)) & mask.dtype.type(1) > 0
        assert all(held[np.isin(gram, np.fromiter(sets[lang], np.uint32, len(sets[lang])))])


def test_ties_and_letterless(spark):
    model = langid.build({"b": np.array([1], np.uint32), "a": np.array([1], np.uint32)})
    names, scores = model.score([b"qqqq", b"123", b""])
    assert names == ["a", "und", "und"] and scores.tolist()[1:] == [0.0, 0.0]
