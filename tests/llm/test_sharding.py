"""Interleaving against a plain sort; the mixture of every shard; edge cases."""

import zlib
from collections import Counter

from terrapulse.llm import sharding

SCHEMA = "doc_id long, text string, source string, shard string, slot long"


def corpus(spark, n=500):
    """A hot source, a null source, null and empty texts, and columns named like results."""
    rows = [(i, None if i % 50 == 7 else "" if i % 50 == 8 else "é" * (i % 9) + "x" * (i % 31), "hot" if i % 3 == 0 else None if i % 7 == 0 else f"s{i % 11}", "mine", 5) for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_rows_law_slots_and_mixture(spark):
    rows, df = corpus(spark)
    got = sharding.interleave(df, shards=24, carry=("shard", "text")).collect()
    assert sorted(r.doc_id for r in got) == list(range(500))
    text = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(r["size"] == len(text[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id]) and r.law == "rows" and r.grown_shard is None for r in got)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(24):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    sources = Counter(r.source for r in got)
    assert sources == Counter(r[2] for r in rows)
    for source, n in sources.items():
        bound = 1 + len(sources) * n / 500
        for s in range(24):
            assert abs(sum(r.source == source and r.shard == s for r in got) - n / 24) <= bound


def test_order_is_that_of_the_fractions(spark):
    """Against a plain sort of fractional ranks by the same keys."""
    rows, df = corpus(spark, 300)
    keys = {r.doc_id: (r.key, r.stratum) for r in sharding.shuffled(df, seed=29).collect()}
    place = {}
    for stratum in {s for _, s in keys.values()}:
        own = sorted((k, i) for i, (k, s) in keys.items() if s == stratum)
        for rank, (k, i) in enumerate(own):
            place[i] = ((2 * rank + 1) / (2 * len(own)), stratum, k)
    order = sorted(place, key=place.get)
    got = sorted(sharding.interleave(df, shards=7).collect(), key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in got] == order


def test_few_rows_repeats_and_no_rows(spark):
    some = spark.createDataFrame([(1, "a", "s", "", 0)] * 5 + [(None, None, None, None, None)], SCHEMA)
    got = sharding.interleave(some, shards=24).collect()
    assert len(got) == 6 and len({r.shard for r in got}) == 6 and {r.slot for r in got} == {0}
    assert sharding.interleave(some.where("false")).count() == 0


def test_reruns_agree_and_folders(spark, tmp_path):
    _, df = corpus(spark, 120)
    pick = lambda d: {r.doc_id: (r.shard, r.slot) for r in d.collect()}
    assert pick(sharding.interleave(df.repartition(3))) == pick(sharding.interleave(df.coalesce(1)))
    sharding.write_shards(sharding.interleave(df, shards=5, carry=("text",)), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 120 and Counter(r.shard for r in back.collect()) == Counter(dict.fromkeys(range(5), 24))
