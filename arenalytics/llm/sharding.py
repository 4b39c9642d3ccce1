"""Sharding by histogram sort (DataFrame functions only).

Documents are ordered by (hash of the text, doc_id), so equal texts stand side
by side, and cut into shards of near equal bytes.  The cuts are found without
sorting: every round counts the exact bytes of the rows between candidate key
boundaries (probes), keeps per cut the one interval that still holds its
target, and probes that interval more finely, until each cut is within the
tolerance or falls on a single row.  Then the rows are exchanged once.

The order key is one number: 60 bits of the hash above 64 bits of the id.  A
group of copies holding a third of all rows is split by the id part.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, spare_name, text_or_empty

ROW_BYTES = 8          # fixed by the contract: bytes counted per row besides its text


def order_key() -> Column:
    """Decimal(38,0) sort key of a document (null text: empty, null id: lowest)."""
    high = F.shiftrightunsigned(F.xxhash64(text_or_empty()), 4).cast("decimal(38,0)")
    low = F.coalesce(F.col("doc_id").cast("long"), F.lit(-2 ** 63)).cast("decimal(38,0)")
    return (high * F.lit(Decimal(2 ** 64)).cast("decimal(20,0)")).cast("decimal(38,0)") \
        + (low + F.lit(Decimal(2 ** 63)).cast("decimal(20,0)")).cast("decimal(37,0)")


def _key(v: int) -> Column:
    return F.lit(Decimal(v)).cast("decimal(38,0)")


def sized_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key) of every document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_or_empty()).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text_or_empty().cast("binary")).cast("long").alias("text_crc32"),
        order_key().cast("decimal(38,0)").alias("key"))


def _probe(rows: DataFrame, intervals: list[tuple[int, int]], probes: int) -> dict:
    """Exact bytes per probe cell: {interval: [(bytes, least key, greatest
    key), ...] in key order}.  At most ``probes`` cells per interval reach the
    driver."""
    los = F.array(*[_key(lo) for lo, _ in intervals])
    his = F.array(*[_key(hi) for _, hi in intervals])
    steps = F.array(*[_key((hi - lo) // probes + 1) for lo, hi in intervals])
    # intervals are disjoint and ascending: the last one that begins at or below the key
    which = F.size(F.filter(los, lambda lo: lo <= F.col("key"))) - 1
    cell = F.expr("(key - lo) div step")
    rows = (rows.select(which.alias("i"), "size", "key").filter(F.col("i") >= 0)
            .select("i", "size", "key", los[F.col("i")].alias("lo"),
                    his[F.col("i")].alias("hi"), steps[F.col("i")].alias("step"))
            .filter(F.col("key") <= F.col("hi")))
    got = (rows.select("i", cell.alias("c"), "size", "key").groupBy("i", "c")
           .agg(F.sum("size").alias("b"), F.min("key").alias("lo"), F.max("key").alias("hi"))
           .collect())
    out: dict[int, list] = {}
    for r in sorted(got, key=lambda r: (r["i"], r["c"])):
        out.setdefault(r["i"], []).append((int(r["b"]), int(r["lo"]), int(r["hi"])))
    return out


def find_splitters(rows: DataFrame, n_shards: int, probes: int = 256,
                   tolerance: float = 0.0005, max_rounds: int = 40) -> list[int]:
    """``n_shards - 1`` ascending keys; shard s holds the keys from splitter
    s-1 (inclusive) to splitter s (exclusive).

    A cut stops as soon as the exact bytes below it are within ``tolerance``
    of a shard's share, or when a single key is left (rows that repeat one
    doc_id and text cannot be parted); then the nearer side is taken.
    """
    t = rows.agg(F.sum("size").alias("b"), F.min("key").alias("lo"),
                 F.max("key").alias("hi")).first()
    if t["b"] is None:
        return []
    total, slack = int(t["b"]), tolerance * int(t["b"]) / n_shards
    found: dict[int, int] = {}
    # per cut: interval that holds it, and exact bytes below that interval
    open_: dict[int, tuple[int, int, int]] = {
        j: (int(t["lo"]), int(t["hi"]), 0) for j in range(1, n_shards)}
    for _ in range(max_rounds):
        if not open_:
            break
        intervals = sorted({(lo, hi) for lo, hi, _ in open_.values()})
        cells = _probe(rows, intervals, probes)
        for j, (lo, hi, below) in list(open_.items()):
            target = total * j / n_shards
            for b, first, last in cells[intervals.index((lo, hi))]:
                if below + b >= target or last == hi:
                    break
                below += b
            if abs(target - below) <= slack or (first == last and target - below <= b / 2):
                found[j] = first
            elif abs(below + b - target) <= slack or first == last:
                found[j] = last + 1
            else:
                open_[j] = (first, last, below)
                continue
            del open_[j]
    else:
        raise RuntimeError("splitters did not settle")
    return [found[j] for j in range(1, n_shards)]


def shard_of(splitters: list[int], key: str = "key") -> Column:
    if not splitters:
        return F.lit(0)
    cuts = F.array(*[_key(s) for s in splitters])
    return F.size(F.filter(cuts, lambda s: s <= F.col(key)))


def numbered(rows: DataFrame, splitters: list[int]) -> DataFrame:
    """``rows`` (with ``key``) with ``shard`` and ``slot``, gapless from 0 in
    key order.

    The rows are range-partitioned on the key into as many tasks as the session
    shuffles to, however few shards there are, and numbered where they stand;
    one row per task and shard tells where its numbers begin."""
    placed = (rows.withColumn("shard", shard_of(splitters)).repartitionByRange("key").sortWithinPartitions("key")
              .withColumn("_at", F.monotonically_increasing_id()))
    # the task and the place in it: written once, as ranges are sampled anew by every run
    placed = materialize(placed.withColumn("_task", F.shiftright("_at", 33)), "shard-places")
    pieces = placed.groupBy("_task", "shard").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    return placed.join(pieces, ["_task", "shard"]).withColumn(
        "slot", F.col("_at") - F.col("_first") + F.col("_before")).drop("_task", "_at", "_first", "_before")


def assign_shards(docs: DataFrame, n_shards: int = 24, probes: int = 256,
                  tolerance: float = 0.0005) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every document in one shard,
    bytes near equal, slots gapless from 0 in key order.

    Null texts count 8 bytes; repeated rows each get their own slot; an empty
    table gives no rows; other columns are ignored.
    """
    rows = materialize(sized_rows(docs), "shard-keys")
    cuts = find_splitters(rows, n_shards, probes, tolerance)
    return numbered(rows, cuts).select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, n_shards: int = 24) -> list[int]:
    """Write the documents themselves, one folder per shard, its files and their
    rows in slot order; returns the splitters.  All columns are kept; the folder
    column is named ``shard``, with underscores before it if ``docs`` has one of
    that name."""
    shard, key = spare_name(docs, "shard"), spare_name(docs, "order_key")
    cuts = find_splitters(materialize(sized_rows(docs), "shard-keys"), n_shards)
    (docs.withColumn(key, order_key().cast("decimal(38,0)")).withColumn(shard, shard_of(cuts, key))
     .repartitionByRange(key).sortWithinPartitions(key).drop(key)
     .write.partitionBy(shard).parquet(path))
    return cuts
