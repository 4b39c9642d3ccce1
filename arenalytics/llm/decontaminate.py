"""Benchmark decontamination by spaced seeds.

A spaced seed is a window of word positions of which a fixed mask regards only
some.  Two windows with equal regarded words hit, whatever stands at the
ignored positions, so a substituted word does not hide an overlap.  The masks
of a window ignore every set of words that may differ in it, so any pattern of
substitutions that the overlap rule accepts leaves a hit.  Hits join test and
training text by hash; each is verified around its place: by laying the
benchmark item along the document, and, for words inserted or left out, by the
longest common subsequence of the two there.

Words are runs of letters, digits and non-ASCII bytes, lower-cased, so
punctuation does not matter.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmaps import BITS, MASK, bitmap, has, position_column
from .common import id_and_text, materialize, spare_name, text_or_empty
from .wordhash import mix, slices, texts_of, word_bounds, word_hashes

MIN_OVERLAP = 0.7        # share of equal words in an overlap
RUN_WORDS = 20           # equal words that make an overlap, however long the item
EXACT_WORDS = 4          # items of so many words or fewer are found word for word only
SLACK = 3                # words by which the place may shift around the hit
PLACE = 2 * SLACK + 1    # places of an item are named in steps of so many words
WEIGHT = 4               # words a mask regards


def _cover(span: int, changed: int) -> tuple[str, ...]:
    """Masks over ``span`` words, 1: regarded, such that any ``changed`` of the
    words are ignored together by one of them (greedy, always the same)."""
    todo = set(combinations(range(span), changed))
    blocks = [(b, set(combinations(b, changed))) for b in combinations(range(span), span - WEIGHT)]
    out = []
    while todo:
        best, covered = max(blocks, key=lambda x: len(x[1] & todo))
        todo -= covered
        out.append("".join("0" if k in best else "1" for k in range(span)))
    return tuple(out)


# An item of 7 or more words with at most 3 in 10 changed has a window of 7 with
# at most 2 changed, wherever they are, but for items of 10 and 11 words with 3
# changed: those are windows themselves as well, as are items of 5 and 6 and, with
# every word regarded, the shorter ones.
SPAN = 7
MASKS_OF = {k: ("1" * k,) for k in range(1, EXACT_WORDS + 1)} | {5: _cover(5, 1), 6: _cover(6, 1), SPAN: _cover(SPAN, 2),
            10: _cover(10, 3), 11: _cover(11, 3)}
MASKS = MASKS_OF[SPAN]


def _spans_of(words: int) -> list[int]:
    """The windows that an item of so many words is cut into."""
    return [k for k in MASKS_OF if k == words or k == SPAN < words]


SEED_SCHEMA = "seed long, id long, pos int"
WORDS_SCHEMA = "id long, words binary"


def _seeds(h: np.ndarray, woff: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(seeds of every window of ``span`` words under every mask, index of its
    first word) over all texts."""
    word = np.arange(len(h))
    last = np.repeat(woff[1:], np.diff(woff))      # end of the text of each word
    first = word[last - word >= span]
    out = []
    masks = MASKS_OF[span]
    for m, mask in enumerate(masks):
        seed = np.full(len(first), m * 16 + span, np.uint64)
        for k in (k for k in range(span) if mask[k] == "1"):
            seed = seed * np.uint64(0xD6E8FEB86659FD93) + h[first + k]
        out.append(mix(seed))
    return np.concatenate(out), np.tile(first, len(masks))


def _hashed(batch: pa.RecordBatch, limit: int = 1 << 20):
    """Slice by slice: (ids, word hashes, word offsets per text, starts, ends)."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    data, off = texts_of(pc.utf8_lower(batch.column(1)))
    for i, j in slices(off, limit):
        b, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        starts, ends, woff = word_bounds(b, o, loose=True)
        yield ids[i:j], word_hashes(b, starts, ends), woff, starts, ends


def _rows_of(seed: np.ndarray, at: np.ndarray, ids: np.ndarray, woff: np.ndarray) -> pa.RecordBatch:
    text = np.searchsorted(woff, at, "right") - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(seed.view(np.int64)), pa.array(ids[text], pa.int64()),
         pa.array((at - woff[text]).astype(np.int32))], names=["seed", "id", "pos"])


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of benchmark items."""
    for batch in batches:
        for ids, h, woff, _, _ in _hashed(batch):
            count = np.diff(woff)
            for span in MASKS_OF:
                seed, at = _seeds(h, woff, span)
                n = count[np.searchsorted(woff, at, "right") - 1]
                own = (n == span) | ((n > span) & (span == SPAN))
                yield _rows_of(seed[own], at[own], ids, woff)


def _text_seeds(spans: list[int], low, high):
    """Function for mapInArrow: a row per seed of the texts that the bitmaps of
    the test seeds let through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, h, woff, _, _ in _hashed(batch):
                for span in spans:
                    seed, at = _seeds(h, woff, span)
                    hit = np.flatnonzero(has(low.value, seed & MASK))
                    hit = hit[has(high.value, seed[hit] >> np.uint64(64 - BITS))]
                    yield _rows_of(seed[hit], at[hit], ids, woff)
    return run


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text: its word hashes."""
    for batch in batches:
        for ids, h, woff, _, _ in _hashed(batch):
            words = [h[a:z].tobytes() for a, z in zip(woff[:-1], woff[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(words, pa.binary())], names=["id", "words"])


def best_run(i: np.ndarray, j: np.ndarray, rate: float) -> tuple[int, int]:
    """(equal words, first word in the document) of the longest run of the
    aligned places (item, document; both rising) in which ``rate`` of the words
    passed, on either side, are equal."""
    best, place = 0, 0
    for a in range(len(i)):
        if len(i) - a <= best:
            break
        n = np.arange(best + 1, len(i) - a + 1)      # longer ones only
        end = a + n - 1
        good = np.flatnonzero(n >= rate * (np.maximum(i[end] - i[a], j[end] - j[a]) + 1) - 1e-9)
        if len(good):
            best, place = int(n[good[-1]]), int(j[a])
    return best, place


def common_places(item: list[int], doc: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``item``, in ``doc``) of a longest common subsequence."""
    where = defaultdict(list)
    for j, w in enumerate(doc):
        where[w].append(j)
    tails: list[int] = []
    nodes: list[tuple] = []
    for i, w in enumerate(item):
        for j in reversed(where.get(w, ())):
            k = bisect_left(tails, j)
            node = (i, j, nodes[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                nodes.append(node)
            else:
                tails[k], nodes[k] = j, node
    out = []
    node = nodes[-1] if nodes else None
    while node:
        out.append(node[:2])
        node = node[2]
    pairs = np.array(out[::-1], np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def overlap_at(doc: np.ndarray, item: np.ndarray, shifts: list[int],
               rate: float) -> tuple[int, int]:
    """(equal words, first word in the document) of the best overlap around the
    hits at ``shifts``; 0 when none is long enough."""
    n = len(item)
    rate = 1.0 if n <= EXACT_WORDS else rate
    need = min(ceil(rate * n - 1e-9), RUN_WORDS)
    best, place = 0, 0
    for s in sorted({x for shift in shifts for x in range(shift - SLACK, shift + SLACK + 1)}):
        a, z = max(s, 0), min(s + n, len(doc))
        if z > a:
            at = np.flatnonzero(doc[a:z] == item[a - s:z - s]) + a
            if len(at) >= rate * n - 1e-9:
                same = len(at), a
            elif len(at) >= need:
                same = best_run(at, at, rate)
            else:
                continue
            if same[0] > best:
                best, place = same
    if best >= rate * n - 1e-9:
        return best, place
    # words inserted or left out: align what lies around neighbouring hits
    wide = SLACK + ceil(n * (1 - rate) / rate)
    ends = sorted((max(0, s - wide), min(len(doc), s + n + wide)) for s in shifts)
    k = 0
    while k < len(ends):
        a, z = ends[k]
        while k + 1 < len(ends) and ends[k + 1][0] - ends[k][0] <= wide:
            k += 1
            z = max(z, ends[k][1])
        k += 1
        i, j = common_places(item.tolist(), doc[a:z].tolist())
        if len(i) >= need:
            same, at = best_run(i, j, rate)
            if same > best:
                best, place = same, a + at
    return (best, place) if best >= need else (0, 0)


def _verify(min_overlap: float):
    """Function for mapInArrow: (doc_id, k1, k2, text, item_id, places, words)
    rows to verified overlaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            items = batch.column("words").to_pylist()
            items_id = batch.column("item_id").to_pylist()
            doc_ids = batch.column("doc_id").to_pylist()
            places = batch.column("places").to_pylist()
            keys = [batch.column(c).to_pylist() for c in ("k1", "k2")]
            row = 0
            for ids, h, woff, _, _ in _hashed(batch.select(["k1", "text"])):
                for d in range(len(ids)):
                    item = np.frombuffer(items[row], np.uint64)
                    shifts = [x for p in sorted(places[row]) for x in range(p * PLACE, (p + 1) * PLACE)]
                    best, place = overlap_at(h[woff[d]:woff[d + 1]], item, shifts, min_overlap)
                    if best:
                        out.append((doc_ids[row], keys[0][row], keys[1][row], items_id[row],
                                    best, len(item), place))
                    row += 1
            cols = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.int32()] * 3)],
                names=["doc_id", "k1", "k2", "item_id", "same_words", "item_words", "first_word"])
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k1, k2): texts are named by a hash, as rows may have no id;
    what holds for a text holds for all its copies."""
    return id_and_text(docs).select("doc_id", "text", F.xxhash64("text").alias("k1"),
                                    F.xxhash64(F.lit(1), "text").alias("k2"))


def _items(benchmark: DataFrame) -> DataFrame:
    """(id, item_id, text): each item_id and text once, named by a hash of both."""
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")) \
        .select(F.xxhash64("item_id", "text").alias("id"), "item_id", "text").dropDuplicates(["id"])


def seed_hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(k1, item, places): texts (by hash) and items that share a seed, with
    the distinct word offsets of the item in the text, in steps of PLACE.

    Tasks keep two bitmaps of fixed size of the test seeds; the seeds that both
    let through are joined with the test seeds by a shuffle.
    """
    test = materialize(items.select("id", "text").mapInArrow(_item_seeds, SEED_SCHEMA), "benchmark-seeds")
    lengths = items.select("id", "text").mapInArrow(_word_rows, WORDS_SCHEMA).select(
        F.least(F.octet_length("words") / 8, F.lit(max(MASKS_OF) + 1)).cast("int").alias("n")) \
        .distinct().collect()                                # at most 13 values
    spans = sorted({k for r in lengths for k in _spans_of(r["n"])})
    low = bitmap(test, position_column("seed"))
    high = bitmap(test, F.shiftrightunsigned("seed", 64 - BITS))
    train = docs.select("k1", "text").mapInArrow(_text_seeds(spans, low, high), SEED_SCHEMA)
    return (train.select("seed", F.col("id").alias("k1"), "pos")
            .join(test.select("seed", F.col("id").alias("item"), F.col("pos").alias("at")), "seed")
            .groupBy("k1", "item")
            .agg(F.collect_set(F.floor((F.col("pos") - F.col("at")) / PLACE).cast("int")).alias("places")))


def _overlaps(docs: DataFrame, benchmark: DataFrame, min_overlap: float) -> DataFrame:
    """Verified overlaps of every row of ``docs`` (``_keyed``)."""
    items = materialize(_items(benchmark), "benchmark-items")
    hits = materialize(seed_hits(docs, items), "seed-hits")
    words = materialize(items.select("id", "text").mapInArrow(_word_rows, WORDS_SCHEMA), "benchmark-words") \
        .select(F.col("id").alias("item"), "words").join(
            items.select(F.col("id").alias("item"), "item_id"), "item")
    texts = docs.join(hits.select("k1").distinct(), "k1")
    wide = texts.join(hits, "k1").join(words, "item") \
        .select("doc_id", "k1", "k2", "text", "item_id", "places", "words")
    return wide.mapInArrow(_verify(min_overlap), "doc_id long, k1 long, k2 long, item_id long, "
                           "same_words int, item_words int, first_word int")


def contaminated(docs: DataFrame, benchmark: DataFrame,
                 min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """(doc_id, item_id, same_words, item_words, first_word, overlap): the
    documents that hold a benchmark item, substituted words allowed.

    An overlap is a run in which at least ``min_overlap`` of the words, on
    either side, are equal in order; words may be changed, inserted or left
    out.  It counts with ``min_overlap`` of the item's words or RUN_WORDS of
    them, so a long passage of a longer item counts too.  Items of at most
    EXACT_WORDS words count word for word.  Null texts and items without words
    hold nothing; rows without doc_id are searched and reported together under
    the null id, items without item_id likewise, and of items that share an
    item_id each text is searched; repeated rows and items are reported once;
    empty tables give no rows; other columns are ignored.
    """
    best = F.struct("same_words", "item_words", -F.col("first_word"))
    return (_overlaps(_keyed(docs), benchmark, min_overlap).groupBy("doc_id", "item_id")
            .agg(F.max(best).alias("b"))
            .select("doc_id", "item_id", "b.same_words", "b.item_words",
                    (-F.col("b.col3")).alias("first_word"))
            .withColumn("overlap", F.col("same_words") / F.col("item_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame,
                  min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text holds no item;
    rows without doc_id are judged like any other."""
    k1, k2 = (spare_name(docs, c) for c in ("dropped_k1", "dropped_k2"))
    bad = _overlaps(_keyed(docs), benchmark, min_overlap).select(
        F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct()
    text = text_or_empty()
    return docs.join(bad, (F.xxhash64(text) == F.col(k1)) & (F.xxhash64(F.lit(1), text) == F.col(k2)), "left_anti")
