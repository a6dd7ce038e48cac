import heapq
from collections import Counter, defaultdict

import oracle
import pytest
from helpers import empty, odd, words

from camlytics.llm import mixing, queries
from camlytics.llm.common import stored


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * left / total >= 2 * sizes[s]}
        if not full:
            return target | {s: weight[s] * left / total for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def plain_quotas(targets, seats):
    heap = [(-t, i, 1) for i, t in enumerate(targets) if t > 0]
    heapq.heapify(heap)
    won = [0] * len(targets)
    for _ in range(seats if heap else 0):
        _, i, k = heapq.heappop(heap)
        won[i] += 1
        heapq.heappush(heap, (-targets[i] / (2 * k + 1), i, k + 1))
    return won


def totals(rows):
    taken, targets, sizes = Counter(), {}, {}
    for r in rows:
        taken[r.source] += r.taken
        targets[r.source], sizes[r.source] = r.target, r.source_size
    return taken, targets, sizes


@pytest.mark.parametrize("seats", [1_000_000, 5000, 300])
def test_sources_meet_their_targets(documents, texts, seats):
    rows = mixing.mix(documents, seats=seats).collect()
    size = {i: len(words(t)) for i, t, *_ in texts}
    assert {r.doc_id: r.size for r in rows} == size
    by_source = defaultdict(int)
    for i, _, _, s in texts:
        by_source[s] += size[i]
    taken, targets, sizes = totals(rows)
    expected = plain_targets(by_source)
    assert sizes == by_source
    block = max(1, -(-1.5 * sum(by_source.values()) // seats))
    for s, t in expected.items():
        assert targets[s] == pytest.approx(t)
        assert abs(taken[s] - t) <= 2 * block
    assert all(0 <= r.taken <= 2 * r.size and 0 <= r.copies <= 2 for r in rows)


@pytest.mark.parametrize("targets, seats", [([100.0, 80.0, 30.0, 20.0], 8), ([1.0, 1.0, 1.0], 2), ([5.5, 0.0, 2.25, 9.0, 0.01], 101)])
def test_quotas_are_those_of_the_highest_quotients(spark, targets, seats):
    from pyspark.sql import functions as F

    parties = spark.createDataFrame([(0, i, t) for i, t in enumerate(targets)], "g int, i int, t double")
    got = mixing.apportion(parties, ["g"], F.col("t"), F.lit(seats), "i").orderBy("i").collect()
    assert [r._quota for r in got] == plain_quotas(targets, seats)


def test_shards_split_the_quota(spark):
    sizes = spark.createDataFrame([("a", 5000), ("b", 900), (None, 70)], "source string, source_size long")
    rows = mixing.plan(sizes, 200, 8).collect()
    for r in rows:
        assert sum(r.shard_blocks) >= r._quota and min(r.shard_blocks) >= 0
        assert max(r.shard_blocks) - min(r.shard_blocks) <= 1 + len(rows)
    per_shard = [sum(r.shard_blocks[j] for r in rows) for j in range(8)]
    assert max(per_shard) - min(per_shard) <= 1


def test_reruns_agree(documents):
    assert sorted(mixing.mix(documents).collect(), key=repr) == sorted(mixing.mix(documents.repartition(3)).collect(), key=repr)


def test_odd_rows(spark):
    rows = mixing.mix(odd(spark)).collect()
    given = odd(spark).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((g.doc_id, g.source, len(words(g.text))) for g in given)
    taken, targets, _ = totals(rows)
    assert all(abs(taken[s] - t) <= 2 for s, t in targets.items())
    assert mixing.mix(empty(spark)).collect() == []
    none = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mixing.mix(none).collect()} == {(0.0, 0)}


def test_whole_documents(spark, documents):
    mixed = stored(mixing.mixed(documents), "mixed")
    assert mixed.schema == documents.schema
    copies = {r.doc_id: r.copies for r in mixing.mix(documents).collect() if r.copies}
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == copies
    again = mixing.mixed(odd(spark))
    assert again.columns == odd(spark).columns
    expected = sum(r.copies for r in mixing.mix(odd(spark)).collect())
    assert again.count() == expected


def test_matches_sql(spark, tiny):
    db = oracle.connect(tiny)
    assert oracle.compare(spark, db, tiny, "op6_mixing", queries.op6_mixing, mixing.ORACLE) == ""


def test_small_sources_beside_huge_ones(spark):
    """The block follows the smallest target, so that no source vanishes."""
    words = {"a": 4 * 10**9, "b": 9 * 10**8, "c": 20_000, "d": 2500, "e": 1500}
    sizes = spark.createDataFrame([(k, "0" + k, n) for k, n in words.items()], "source string, _key string, source_size long")
    for r in mixing.plan(sizes, None, 8).collect():
        assert r._quota * r._block == pytest.approx(r.target, rel=0.02)
