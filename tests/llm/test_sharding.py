import zlib
from collections import defaultdict

from arenalytics.llm import sharding


def test_shards_are_whole_even_and_gapless(edge_docs):
    docs, rows = edge_docs
    out = sharding.assign_shards(docs, 6).collect()
    size = {i: len((t or "").encode()) + 8 for i, t in rows}
    assert sorted((r.doc_id or -1, r.size) for r in out) == sorted((i or -1, size[i]) for i, _ in rows)
    crc = {i: zlib.crc32((t or "").encode()) for i, t in rows}
    assert all(r.text_crc32 == crc[r.doc_id] for r in out)
    slots, total = defaultdict(list), defaultdict(int)
    for r in out:
        slots[r.shard].append(r.slot)
        total[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # no cut can be nearer than half the document it falls into
    share, largest = sum(size[i] for i, _ in rows) / 6, max(size.values())
    assert all(abs(b - share) <= largest for b in total.values())


def test_even_shards_without_giants(spark):
    rows = [(i, "x" * (i * 37 % 400)) for i in range(5000)] + [(9000 + i, "copy " * 9) for i in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    total = defaultdict(int)
    for r in sharding.assign_shards(docs, 8).collect():
        total[r.shard] += r.size
    share = sum(total.values()) / 8
    # the group of copies (a third of all rows) is split, so shards stay even
    assert len(total) == 8 and max(abs(b - share) for b in total.values()) < 0.01 * share


def test_empty_single_and_equal_rows(spark, empty_docs):
    assert sharding.assign_shards(empty_docs, 4).collect() == []
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [(r.size, r.slot) for r in sharding.assign_shards(one, 4).collect()] == [(8, 0)]
    same = spark.createDataFrame([(1, "abc")] * 20, "doc_id long, text string")
    out = sharding.assign_shards(same, 4).collect()
    assert len(out) == 20 and len({r.shard for r in out}) == 1


def test_written_shards_hold_the_documents(spark, tmp_dir):
    docs = spark.createDataFrame([(i, f"text {i}" * 5) for i in range(300)], "doc_id long, text string")
    sharding.write_shards(docs, f"{tmp_dir}/shards", 5)
    back = spark.read.parquet(f"{tmp_dir}/shards")
    want = {r.doc_id: r.shard for r in sharding.assign_shards(docs, 5).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == want


def test_cuts_and_slots_match_a_plain_sort(spark):
    """Against all rows sorted on the driver: slots count up in key order, and
    every cut stands where the bytes before it are nearest to its share."""
    rows = [(i, "y" * (i * 53 % 300)) for i in range(1500)] + [(5000 + i, "copy " * 9) for i in range(700)] + [(7, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    keyed = sharding.sized_rows(docs).collect()
    total, n = sum(r["size"] for r in keyed), 7
    got = sorted((r.shard, r.slot, r.doc_id, r.size) for r in sharding.assign_shards(docs, n, tolerance=0.0).collect())
    order = sorted((int(r.key), r.doc_id, r["size"]) for r in keyed)
    assert [(d, s) for _, _, d, s in got] == [(d, s) for _, d, s in order]
    upto, last = [0], None
    for k, _, s in order:                                 # bytes up to each distinct key
        upto = upto[:-1] + [upto[-1] + s] if k == last else [*upto, upto[-1] + s]
        last = k
    for j in range(1, n):
        below = sum(s for shard, _, _, s in got if shard < j)
        assert abs(below - total * j / n) <= min(abs(u - total * j / n) for u in upto) + 1e-6


def test_written_shards_keep_clashing_columns(spark, tmp_dir):
    docs = spark.createDataFrame([(i, f"text {i}" * 5, "mine", 1.5) for i in range(200)],
                                 "doc_id long, text string, shard string, order_key double")
    sharding.write_shards(docs, f"{tmp_dir}/clash", 4)
    back = spark.read.parquet(f"{tmp_dir}/clash").collect()
    assert len(back) == 200 and {(r.shard, r.order_key) for r in back} == {("mine", 1.5)}
    assert len({r._shard for r in back}) == 4
