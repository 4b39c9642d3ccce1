"""Near-duplicate documents by b-bit MinHash.

1. One pass over the texts gives per document: the number of distinct 5-word
   shingles, a 128-bit name of the set, a key per band of full minima, and the
   low bits of all minima packed into longs.
2. Documents with equal sets are one class (smallest id); only classes go on.
3. Classes that share a band key are candidates.  Within a bucket a hub (the
   member with most band collisions) is paired with the others, never all with
   all; pairs are screened by the collision-corrected similarity of the packed
   signatures and confirmed on the full shingle sets; links are merged into
   components.  Buckets whose members are then of one component need nothing
   more.
4. In the others a pair across components is tested once, in the first bucket
   that both share.  Each member has a bitmap of its hub's shingles, and the
   number of its further shingles that some other document has too: the common
   bits of two members, and the smaller of these numbers, bound their
   intersection.  So nearly all pairs are ruled out exactly without their
   texts.  A bucket is dealt to cells of two blocks of BLOCK members, so
   no task gets a whole bucket.

Only what could change a component is tested, so a group of thousands of near
copies costs about one test per member, and no link between components is
lost.  With 32 bands of 4 minima a pair at similarity 0.75 misses every band
with probability 5e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialize, spare_name
from .components import connected_components
from .wordhash import mix, shingle_sets

SHINGLE_WORDS, SIMILARITY = 5, (75, 100)      # fixed by the contract
BANDS, ROWS, LOW_BITS = 32, 4, 2
N = BANDS * ROWS
SIG_LONGS = N * LOW_BITS // 64
# A pair whose estimate is this far below the threshold is not confirmed: five
# standard deviations of the estimate at similarity 0.75.
SCREEN = 0.52
BLOCK = 256                # members on a side of a cell
CELL_ROWS = 4096           # rows of cells that are worked on together, about

_SEEDS = np.random.RandomState(20240917)
_MULT = _SEEDS.randint(1, 1 << 62, N).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _SEEDS.randint(0, 1 << 62, N).astype(np.uint64)
_SET_A, _SET_B = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)

SIGNATURE_SCHEMA = "doc_id long, n long, set_a long, set_b long, sig array<long>, bands array<long>"


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, N) minima; every set has a member."""
    x = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), N), np.uint64)
    v = np.empty_like(x)
    for k in range(N):
        np.multiply(x, _MULT[k], out=v)
        v += _ADD[k]
        out[:, k] = np.minimum.reduceat(v, at)
    return mix(out)


def _band_keys(minima: np.ndarray) -> np.ndarray:
    m = minima.reshape(len(minima), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), m.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + m[:, :, k])
    return key.view(np.int64)


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low bits of each minimum, ``64 / LOW_BITS`` to a long."""
    low = (minima & np.uint64((1 << LOW_BITS) - 1)).reshape(len(minima), SIG_LONGS, -1)
    shift = np.arange(low.shape[2], dtype=np.uint64) * np.uint64(LOW_BITS)
    return np.bitwise_or.reduce(low << shift, axis=2).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for first, sets in shingle_sets(batch.column("text"), SHINGLE_WORDS):
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            name = np.zeros((len(sets), 2), np.uint64)
            sig: list = [None] * len(sets)
            bands: list = [None] * len(sets)
            if len(full):
                own = [sets[i] for i in full]
                at = np.cumsum([0, *map(len, own[:-1])])
                x = np.concatenate(own)
                name[full, 0] = np.add.reduceat(mix(x ^ _SET_A), at)
                name[full, 1] = np.add.reduceat(mix(x ^ _SET_B), at)
                m = _minima(own)
                for i, s, k in zip(full, _packed(m), _band_keys(m)):
                    sig[i], bands[i] = s, k
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, len(sets)), pa.array(n), pa.array(name[:, 0].view(np.int64)),
                 pa.array(name[:, 1].view(np.int64)), pa.array(sig, pa.list_(pa.int64())),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n", "set_a", "set_b", "sig", "bands"])


def signatures(docs: DataFrame) -> DataFrame:
    """Shingle counts, set names, packed signatures and band keys."""
    return id_and_text(docs).mapInArrow(_sign, SIGNATURE_SCHEMA)


def estimated_similarity(a: str, b: str) -> Column:
    """Similarity from the number of equal low-bit groups, corrected for the
    1 / 2**b of unequal minima that agree in them."""
    equal = F.lit(0)
    ones = sum(1 << (i * LOW_BITS) for i in range(64 // LOW_BITS))
    ones = ones - (1 << 64) if ones >= 1 << 63 else ones
    for i in range(SIG_LONGS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        low = x
        for k in range(1, LOW_BITS):
            low = low.bitwiseOR(F.shiftrightunsigned(x, k))
        equal = equal + F.lit(64 // LOW_BITS) - F.bit_count(low.bitwiseAND(F.lit(ones)))
    chance = 1.0 / (1 << LOW_BITS)
    return (equal / F.lit(float(N)) - chance) / (1 - chance)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left = [s for _, part in shingle_sets(batch.column("text_a"), SHINGLE_WORDS) for s in part]
        right = [s for _, part in shingle_sets(batch.column("text_b"), SHINGLE_WORDS) for s in part]
        keep = []
        for a, b in zip(left, right):
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(SIMILARITY[1] * both >= SIMILARITY[0] * (len(a) + len(b) - both) and both > 0)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for first, sets in shingle_sets(batch.column("text"), SHINGLE_WORDS):
            n = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids[first:first + len(sets)], n)),
                 pa.array(np.concatenate(sets).view(np.int64))], names=["doc_id", "shingle"])


def _own_shingles(texts: DataFrame) -> DataFrame:
    """(doc_id, own): shingles that no other of these documents has."""
    rows = texts.select("doc_id", "text").mapInArrow(_shingle_rows, "doc_id long, shingle long")
    return (rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("doc_id"))
            .filter("docs = 1").groupBy("doc_id").agg(F.count(F.lit(1)).alias("own")))


def _to_hubs(members: DataFrame) -> DataFrame:
    """(a, b), a < b: a member and the hub of its bucket that pass the screen;
    the screen is part of the join, so nothing else leaves it."""
    is_hub = F.col("doc_id") == F.col("hub")
    def named(df: DataFrame, x: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{c}_{x}") for c in ("key", "doc_id", "sig")])
    x, y = named(members.filter(~is_hub), "x"), named(members.filter(is_hub), "y")
    close = estimated_similarity("sig_x", "sig_y") >= SCREEN
    return (x.join(y, (F.col("key_x") == F.col("key_y")) & close)
            .select(F.least("doc_id_x", "doc_id_y").alias("a"),
                    F.greatest("doc_id_x", "doc_id_y").alias("b")).distinct())


def _on_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmap of the hub's (sorted) shingles that a member has, and the number
    of its other shingles that are not its own alone."""
    for batch in batches:
        mine = [s for _, part in shingle_sets(batch.column("text"), SHINGLE_WORDS) for s in part]
        hubs = [s for _, part in shingle_sets(batch.column("text_hub"), SHINGLE_WORDS) for s in part]
        bits, more = [], []
        for x, hub, own in zip(mine, hubs, batch.column("own").to_pylist()):
            at = np.minimum(np.searchsorted(hub, x), len(hub) - 1)
            has = np.zeros(-(-len(hub) // 64) * 64, np.uint8)
            has[at[hub[at] == x]] = 1
            bits.append(np.packbits(has, bitorder="little").tobytes())
            more.append(len(x) - int(has.sum()) - own)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("hub"), pa.array(bits, pa.binary()), pa.array(more, pa.int64())],
            names=["doc_id", "hub", "bits", "more"])


def _may_link(x: dict, y: dict) -> np.ndarray:
    """(members x, members y): pairs of different components, not met in an
    earlier band, whose bound reaches the threshold and whose estimate is not
    far below it."""
    ok = x["comp"][:, None] != y["comp"][None, :]
    band = int(x["band"])
    for k in range(band):
        ok &= x["bands"][:, None, k] != y["bands"][None, :, k]
    if not ok.any():
        return ok
    both = np.minimum(x["more"][:, None], y["more"][None, :])
    for w in range(x["bits"].shape[1]):
        both += np.bitwise_count(x["bits"][:, None, w] & y["bits"][None, :, w])
    ok &= (SIMILARITY[1] * both >= SIMILARITY[0] * (x["n"][:, None] + y["n"][None, :] - both))
    i, j = np.nonzero(ok)
    if len(i):
        low = np.uint64(sum(1 << (k * LOW_BITS) for k in range(64 // LOW_BITS)))
        differ = x["sig"][i] ^ y["sig"][j]
        any_ = differ
        for k in range(1, LOW_BITS):
            any_ = any_ | (differ >> np.uint64(k))
        equal = N - np.bitwise_count(any_ & low).sum(axis=1)
        chance = 1.0 / (1 << LOW_BITS)
        ok[i, j] = (equal / N - chance) / (1 - chance) >= SCREEN
    return ok


def _cells(table: pa.Table) -> pa.Table:
    """Pairs that pass ``_may_link`` in some cells (key, gi, gj)."""
    table = table.sort_by([("key", "ascending"), ("gi", "ascending"), ("gj", "ascending")]).combine_chunks()
    column = {c: table.column(c).to_numpy() for c in ("key", "gi", "gj", "block", "doc_id", "comp", "n", "more")}
    bits = table.column("bits").to_pylist()
    sig, bands = (np.array(table.column(c).to_pylist(), np.int64).view(np.uint64).reshape(len(table), -1)
                  for c in ("sig", "bands"))
    new = np.flatnonzero((np.diff(column["key"]) != 0) | (np.diff(column["gi"]) != 0)
                         | (np.diff(column["gj"]) != 0)) + 1
    a, b = [], []
    for first, end in zip([0, *new.tolist()], [*new.tolist(), len(table)]):
        def members(block: int) -> dict:
            at = first + np.flatnonzero(column["block"][first:end] == block)
            out = {c: column[c][at] for c in ("doc_id", "comp", "n", "more")}
            out |= {"sig": sig[at], "bands": bands[at], "bits": np.frombuffer(
                b"".join([bits[k] for k in at.tolist()]), np.uint64).reshape(len(at), -1)}
            if len(at):
                out["band"] = np.flatnonzero(out["bands"][0].view(np.int64) == column["key"][first])[0]
            return out
        gi, gj = int(column["gi"][first]), int(column["gj"][first])
        x = members(gi)
        y = x if gi == gj else members(gj)
        if not len(x["doc_id"]) or not len(y["doc_id"]):
            continue
        i, j = np.nonzero(_may_link(x, y))
        u, v = x["doc_id"][i], y["doc_id"][j]
        keep = (u < v) if gi == gj else np.ones(len(u), bool)
        a.append(np.minimum(u, v)[keep])
        b.append(np.maximum(u, v)[keep])
    empty = np.empty(0, np.int64)
    return pa.table([pa.array(np.concatenate([empty, *a])), pa.array(np.concatenate([empty, *b]))], names=["a", "b"])


def _across(now: DataFrame) -> DataFrame:
    """(a, b), a < b: pairs of ``now`` (key, doc_id, n, more, bits, sig, bands,
    comp) across components that may link, each once."""
    sizes = now.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    cells = max(1, now.count() // CELL_ROWS)
    dealt = now.join(sizes, "key").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")) \
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumns({"gi": F.least("block", "other"), "gj": F.greatest("block", "other")}) \
        .withColumn("cell", F.pmod(F.xxhash64("key", "gi", "gj"), F.lit(cells)))
    return dealt.select("cell", "key", "gi", "gj", "block", "doc_id", "comp", "n", "more", "bits", "sig", "bands") \
        .groupBy("cell").applyInArrow(_cells, "a long, b long")


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that are links by the sets of their whole texts."""
    pairs = materialize(pairs, "minhash-pairs")
    wide = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return wide.mapInArrow(_confirm, "a long, b long")


def _merged(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """(doc_id, comp) of all linked documents, after ``links`` (a, b)."""
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    if comp is not None:
        edges = edges.union(comp.select("doc_id", "comp"))
    return connected_components(edges).toDF("doc_id", "comp")


def link_components(sigs: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, comp) of the documents in ``sigs`` that are linked with another."""
    bands = sigs.select("doc_id", F.explode("bands").alias("key"))
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    members = materialize(bands.join(sizes, "key"), "minhash-members")
    degree = members.groupBy("doc_id").agg(F.sum("size").alias("degree"))
    about = sigs.select("doc_id", "sig").join(degree, "doc_id")
    members = materialize(members.join(about, "doc_id"), "minhash-members")
    hubs = members.groupBy("key").agg(F.max_by("doc_id", "degree").alias("hub"))
    members = materialize(members.join(hubs, "key").select("key", "doc_id", "sig", "hub"), "minhash-members")

    # the texts of all candidates, moved once; the same plan at every size
    ids = members.select("doc_id").distinct().hint("merge")
    texts = materialize(id_and_text(docs).join(ids, "doc_id").dropDuplicates(["doc_id"]),
                        "minhash-texts")
    comp = materialize(_merged(None, _links(_to_hubs(members), texts)), "minhash-components")

    now = members.filter("doc_id <> hub").select("key", "doc_id", "hub").join(comp, "doc_id", "left") \
                 .withColumn("comp", F.coalesce("comp", "doc_id"))
    mixed = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
               .filter(F.col("lo") != F.col("hi")).select("key")
    now = materialize(now.join(mixed, "key"), "minhash-mixed")
    pairs = materialize(now.select("doc_id", "hub").distinct(), "minhash-hub-pairs")
    left = pairs.select("doc_id").union(pairs.select("hub")).distinct()
    own = _own_shingles(texts.join(left, "doc_id"))
    wide = pairs.join(texts, "doc_id").join(texts.toDF("hub", "text_hub"), "hub") \
                .join(own, "doc_id", "left").fillna({"own": 0})
    on_hub = materialize(wide.select("doc_id", "hub", "own", "text", "text_hub").mapInArrow(
        _on_hub, "doc_id long, hub long, bits binary, more long"), "minhash-bitmaps")
    now = now.join(on_hub, ["doc_id", "hub"]).join(sigs.select("doc_id", "n", "sig", "bands"), "doc_id")
    return _merged(comp, _links(_across(materialize(now, "minhash-mixed")), texts))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, kept).

    A null text is empty; documents without words are linked with nothing.  A
    row without doc_id is alone (component null) and kept.  Repeated rows get
    equal results.  An empty table gives no rows; other columns are ignored.
    """
    sigs = materialize(signatures(docs), "minhash-signatures")
    linked = sigs.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = linked.groupBy("n", "set_a", "set_b").agg(F.min("doc_id").alias("rep"))
    classes = materialize(classes, "minhash-classes")
    reps = materialize(linked.join(classes.select(F.col("rep").alias("doc_id")), "doc_id")
                       .dropDuplicates(["doc_id"]), "minhash-representatives")
    comp = link_components(reps, docs)
    # the smallest id of a component is that of its smallest class
    of_class = classes.join(comp.select(F.col("doc_id").alias("rep"), "comp"), "rep", "left") \
        .select("n", "set_a", "set_b", F.coalesce("comp", "rep").alias("comp"))
    out = sigs.select("doc_id", "n", "set_a", "set_b").join(of_class, ["n", "set_a", "set_b"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose document is the one
    kept of its component.  Rows that repeat one doc_id are one document."""
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    name = spare_name(docs, "dropped_id")
    return docs.join(gone.toDF(name), docs["doc_id"].cast("long") == F.col(name), "left_anti")
