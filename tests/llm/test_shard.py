import zlib

from helpers import empty, odd

from camlytics.llm import shard


def plain(rows, shards=8):
    """Shard and slot by one running sum over sorted rows."""
    sized = sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]),
    )
    total, before, out, slots = sum(r[1] for r in sized), 0, [], [0] * shards
    for i, size, crc in sized:
        s = min(shards - 1, (2 * before + size) * shards // (2 * total))
        out.append((i, size, crc, s, slots[s]))
        slots[s] += 1
        before += size
    return sorted(out, key=repr)


def got(df, shards=8):
    rows = shard.assign(df, shards).collect()
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)
    return sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rows), key=repr)


def test_like_one_running_sum(documents, texts):
    assert got(documents) == plain([(i, t) for i, t, *_ in texts])


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    assert got(odd(spark), 3) == plain(rows, 3)
    assert got(empty(spark)) == []


def test_sizes_are_near_equal(documents):
    sizes = [r.bytes for r in shard.skew(shard.assign(documents)).collect()]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in shard.assign(documents).collect())


def test_written_shards_hold_every_row(spark, documents, tmp_path):
    shard.write(documents, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == documents.count()
    placed = {r.doc_id: r.shard for r in shard.assign(documents, 4).collect()}
    assert all(placed[r.doc_id] == r.shard for r in back.select("doc_id", "shard").collect())
