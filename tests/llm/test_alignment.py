"""Alignment against whole texts tokenized and walked byte by byte; corpus-wide counts; edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from terrapulse.llm import alignment

ODD = [None, "", " ", "a", " a", "a ", "a  b", "x\n y", "<|endoftext|> <s> </s> <unk>", "héllo wörld 👍🏽 中文", "a▁b c", "tab\tx   y", "\x00 z", "a　 b", "don't I'll 's", "  lead", "trail  ", "👨‍👩 fam", "a " * 300, "word, word. (word) word"]


@pytest.fixture(scope="module")
def both():
    return alignment.tokenizers(alignment.FOLDER, alignment.BYTE_BPE, alignment.PIECES)


def plain(both, text):
    """(ids of A, ids of B, groups as lists of ids) of a whole text, or nothing."""
    raw = (" " + (text or "")).encode()
    a, b = both.a.encode(" " + (text or ""), add_special_tokens=False).ids, both.b.encode(text or "")
    if not text or b"".join(both.a_bytes[i] for i in a) != raw or b"".join(both.b_bytes[i] for i in b) != raw:
        return [], [], []
    groups, i, j, at_a, at_b, mine, other = [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            at_a += len(both.a_bytes[a[i]])
            mine.append(a[i])
            i += 1
        else:
            at_b += len(both.b_bytes[b[j]])
            other.append(b[j])
            j += 1
        if at_a == at_b:
            groups.append((mine, other))
            mine, other = [], []
    return a, b, groups


def expected(both, docs):
    found = [(i, *plain(both, t)) for i, t in docs]
    held = Counter(p for *_, g in found for p in {(x, y) for m, o in g for x in m for y in o})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for i, a, b, groups in found:
        links = [(x, y) for m, o in groups for x in m for y in o]
        text = ";".join(",".join(map(str, m)) + "|" + ",".join(map(str, o)) for m, o in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def test_whole_texts(spark, both, monkeypatch):
    rng = random.Random(5)
    words = ["the", "straße", "naïve,", "token.\nNext", "x1", "été", "中文", "(a)", "Q&A", "don't", "  two", "👍"]
    texts = ODD + [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 50))) for _ in range(60)]
    docs = list(enumerate(texts)) + [(7, "a  b"), (None, "the x1"), (3, "another text of id 3")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, alignment.digest(df.repartition(3)).collect()), key=key) == sorted(expected(both, docs), key=key)


def test_small_blocks_and_memory(both, monkeypatch):
    """Blocks, calls, steps and a forgetful memory change nothing."""
    docs = [t for t in ODD * 3 if t]

    def run(texts):
        memory = alignment.Memory(both)
        out = []
        for k in range(0, len(texts), 4):
            part = texts[k : k + 4]
            found = alignment._block(memory, [[memory.see(p) for p in both.chunks(t)] for t in part])
            names = found["pairs"]
            out += [(int(found["n_a"][i]), int(found["n_links"][i]), found["groups"][i], {int(names[w]): int(n) for w, n in zip(*alignment.unpack_links(found["links"][i]), strict=True)}) for i in range(len(part))]
            memory = memory.trimmed()
        return out

    usual = run(docs)
    monkeypatch.setattr(alignment, "STEP_LINKS", 3)
    monkeypatch.setattr(alignment, "CALL_CHARS", 5)
    monkeypatch.setattr(alignment, "MEMORY_BYTES", 2000)
    assert run(docs) == usual
    for (n_a, n_links, groups, links), t in zip(usual, docs, strict=True):
        a, _, g = plain(both, t)
        assert n_a == len(a) and groups == ";".join(",".join(map(str, m)) + "|" + ",".join(map(str, o)) for m, o in g)
        assert links == Counter(x * alignment.PAIR + y for m, o in g for x in m for y in o) and n_links == sum(links.values())


def test_refined_ends(both):
    """Four bytes of one character: coarse ends all lie behind it, decoded bytes tell them apart."""
    a, a_ends, b, b_ends = both.encoded("👍🏽\n")
    assert a_ends.tolist() == [sum(len(both.a_bytes[i]) for i in a[: k + 1]) for k in range(len(a))]
    assert b_ends.tolist() == [sum(len(both.b_bytes[i]) for i in b[: k + 1]) for k in range(len(b))]
    assert a_ends[-1] == b_ends[-1] == len(" 👍🏽\n".encode())


def test_other_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", 9, "x")], "doc_id long, text string, n_a int, block string")
    found = alignment.documents(alignment.align(df, carry=("n_a", "block", "text"))).first()
    assert found.text == "a b" and found.n_a == 2 and found.groups.count(";") == found.n_groups - 1
    assert alignment.digest(df.where("false")).count() == 0
    assert alignment.digest(df.withColumn("text", alignment.F.lit(None).cast("string"))).first().groups_sha256 == ""
