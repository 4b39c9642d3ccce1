"""Phrase collocation mining by best-first branch and bound.

Phrases grow from their prefixes.  A node of the search is a prefix; the count
of its occurrences bounds the score of everything below it:

* a word ``w``: a phrase below it has a <= f(w), so only words (and next words)
  with f >= MIN_COUNT are grown.  The score bound of a bare word is the largest
  score there is, so the first round grows all of them: pairs of words.
* a pair ``w1 w2`` with count b: a phrase ``w1 w2 x`` has
  a <= m = min(b, the largest count of a pair that begins with w2), and its cut
  after ``w1`` scores at most m / f(w1), as the rest occurs a times at least.

Each further round fixes, per language, the key (score, count) of the best
``limit * WIDEN ** round`` candidates known, grows every pair whose bound
reaches it, and settles which of the candidates above it are dropped (which
needs the pair's extensions on both sides).  A language is settled when
``limit`` survivors are at or above the key: everything not grown lies below.
Otherwise the key is lowered.  Nothing is cut off: at worst a language grows
its whole frontier.

A round is one scan of the texts.  Tasks count the n-grams that bitmaps of
fixed size let through and send one row per distinct n-gram; the sums are
joined with the exact node sets.  Words are named by a 64-bit hash that
contains the language; two words with one hash would raise an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bitmaps import MASK, bitmap, has, pair_column, pair_position, position_column
from .common import materialize, text_or_empty
from .tokens import Held, byte_table, runs
from .wordhash import mix, slices, texts_of, word_hashes

# Fixed by the contract.
MIN_COUNT, MAX_WORDS, LIMIT = 10, 3, 2000
COVERED = (50, 100)             # dropped if COVERED[1] * f(longer) >= COVERED[0] * a
SCALE = 1_000_000
NO_LANGUAGE = "und"
_SPLIT = byte_table(*[ord(c) for c in ".,;:!?"], range(0x0A, 0x0E))      # False: ends a piece
_WORD = _SPLIT & byte_table(0x20, 0x09)

WIDEN = 4                       # growth of the frontier from round to round
HELD = 1 << 19                  # n-grams a task holds before it sends them on: summing them takes several times their bytes
SLICE = 1 << 18                 # bytes of text hashed at a time
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _lang_hash(lang: str) -> int:
    raw = lang.encode()
    x = np.frombuffer(raw + bytes(-len(raw) % 8) + len(raw).to_bytes(8, "little"), np.uint64)
    h = np.zeros(1, np.uint64)
    for v in x:
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + v + np.uint64(1))
    return int(h[0])


def _words(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Slice by slice: (bytes, starts, ends, word hashes, piece, lang index,
    langs); pieces are numbered, a text's pieces are its own."""
    langs = batch.column("lang").cast(pa.string()).dictionary_encode()
    names = langs.dictionary.to_pylist()
    seeds = np.array([_lang_hash(x) for x in names], np.uint64)
    of = langs.indices.to_numpy(zero_copy_only=False)
    data, off = texts_of(batch.column("text"))
    for i, j in slices(off, SLICE):
        b, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        starts, ends, text = runs(b, o, _WORD)
        if not len(starts):
            continue
        lang = of[i + text]
        h = mix(word_hashes(b, starts, ends) ^ seeds[lang])
        yield b, starts, ends, h, np.cumsum(~_SPLIT[b])[starts] + text, lang, names


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Held(["h", "lang", "word"], HELD // 2)
    for batch in batches:
        for b, starts, ends, h, _, lang, names in _words(batch):
            keys, first, n = np.unique(h, return_index=True, return_counts=True)
            low = b.tobytes().translate(_LOWER)
            words = [low[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
            yield from held.add([
                pa.array(keys.view(np.int64)), pa.array([names[k] for k in lang[first]], pa.string()),
                pa.array(words, pa.binary()).cast(pa.string())], [pa.array(n.astype(np.int64))])
    yield from held.send()


def _counter(names: list[str], picked: Callable) -> Callable:
    """A task function that counts the ``len(names)``-grams that lie in one
    piece and for which ``picked(*columns)`` holds."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = Held(names, HELD), len(names)
        for batch in batches:
            for _, _, _, h, piece, _, _ in _words(batch):
                if len(h) < n:
                    continue
                last = len(h) - n + 1
                columns = [h[k:last + k] for k in range(n)]
                keep = (piece[:last] == piece[n - 1:]) & picked(*columns)
                yield from held.add([pa.array(c[keep].view(np.int64)) for c in columns])
        yield from held.send()
    return count


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, lang, word, f) of every word of every language."""
    rows = docs.mapInArrow(_count_words, "h long, lang string, word string, c long")
    sums = rows.groupBy("h").agg(
        F.min("lang").alias("lang"), F.min("word").alias("word"), F.sum("c").alias("f"),
        F.max("lang").alias("lang_"), F.max("word").alias("word_"))
    same = (F.col("lang") == F.col("lang_")) & (F.col("word") == F.col("word_"))
    return sums.select("h", "lang", F.when(same, F.col("word")).otherwise(
        F.raise_error(F.lit("two words have one hash")).cast("string")).alias("word"), "f")


def _summed(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.groupBy(*names).agg(F.sum("c").alias("a")).filter(F.col("a") >= MIN_COUNT)


def pair_counts(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """(h1, h2, a): pairs of words that occur MIN_COUNT times or more."""
    words = bitmap(frequent, position_column("h"))

    def picked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        bits = words.value
        return has(bits, x & MASK) & has(bits, y & MASK)

    return _summed(docs.mapInArrow(_counter(["h1", "h2"], picked), "h1 long, h2 long, c long"),
                   ["h1", "h2"])


def triple_counts(docs: DataFrame, pairs: DataFrame, grown: DataFrame) -> DataFrame:
    """(h1, h2, h3, a): triples that occur MIN_COUNT times or more and begin
    with a pair of ``grown`` (h1, h2, settle) or end with one to settle; both
    their pairs are in ``pairs``."""
    at = pair_column("h1", "h2")
    known, begins, ends = (bitmap(x, at) for x in (pairs, grown, grown.filter("settle")))

    def picked(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
        left, right = pair_position(x, y), pair_position(y, z)
        return (has(known.value, left) & has(known.value, right)
                & (has(begins.value, left) | has(ends.value, right)))

    return _summed(docs.mapInArrow(_counter(["h1", "h2", "h3"], picked),
                                   "h1 long, h2 long, h3 long, c long"), ["h1", "h2", "h3"])


def score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exactly: with a <= left and
    a = q * left + s, the products stay within 38 digits up to counts of 10**15."""
    return F.expr(f"cast(cast(cast({a} as decimal(16,0)) * {a} as decimal(32,0)) * {SCALE} as decimal(38,0))"
                  f" div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))").cast("long")


def scored_pairs(pairs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Pairs with their cut's counts and score, the bound of what grows from
    them (``m`` occurrences, ``bound`` score), and their language."""
    f = frequent.select("h", "lang", "f")
    onward = pairs.groupBy(F.col("h1").alias("h2")).agg(F.max("a").alias("next"))
    p = (pairs.join(f.toDF("h1", "lang", "l"), "h1")
         .join(f.select("h", "f").toDF("h2", "r"), "h2").join(onward, "h2", "left"))
    p = p.withColumn("m", F.least("a", F.coalesce("next", F.lit(0))))
    return p.select("lang", "h1", "h2", "a", "l", "r", score("a", "l", "r").alias("score"), "m",
                    F.expr(f"cast(m as decimal(19,0)) * {SCALE} div cast(l as decimal(19,0))")
                    .cast("long").alias("bound"))


def scored_triples(triples: DataFrame, pairs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Triples with their lowest-scoring cut (the first of equal ones)."""
    f = frequent.select("h", "lang", "f")
    t = (triples.join(f.toDF("h1", "lang", "l1"), "h1")
         .join(pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("r1")),
               ["h2", "h3"])
         .join(pairs.select("h1", "h2", F.col("a").alias("l2")), ["h1", "h2"])
         .join(f.select("h", "f").toDF("h3", "r2"), "h3"))
    t = t.withColumn("s1", score("a", "l1", "r1")).withColumn("s2", score("a", "l2", "r2"))
    first = F.col("s1") <= F.col("s2")
    return t.select("lang", "h1", "h2", "h3", "a",
                    F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                    F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
                    F.least("s1", "s2").alias("score"))


def _step(a: str = "a") -> Column:
    """The power of two that a count reaches; ties in a score are told apart by it."""
    return F.floor(F.log2(F.col(a).cast("double")) + 1e-12).cast("int")


def best_keys(candidates: DataFrame, wanted: int) -> DataFrame:
    """(lang, key_score, key_step, all_in): the key that the ``wanted`` best
    candidates of each language reach, ties included; ``all_in`` if it has no
    more.  A language's window holds one row per distinct key, not per phrase."""
    keys = candidates.groupBy("lang", "score", _step().alias("step")).agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("step").desc())
    keys = keys.withColumn("upto", F.sum("n").over(down))
    low = F.struct("score", "step")
    return (keys.withColumn("before", F.col("upto") - F.col("n")).groupBy("lang")
            .agg(F.min(F.when(F.col("before") < wanted, low)).alias("k"), F.max("upto").alias("all"))
            .select("lang", F.col("k.score").alias("key_score"), F.col("k.step").alias("key_step"),
                    (F.col("all") <= wanted).alias("all_in")))


def _reaches(s: str, a: str) -> Column:
    return (F.col("all_in") | (F.col(s) > F.col("key_score"))
            | ((F.col(s) == F.col("key_score")) & (_step(a) >= F.col("key_step"))))


def mine(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per phrase: (lang, rank, phrase, a, l, r, n, score), the first
    ``limit`` of each language.

    A null text is empty, a null language is ``und``.  Repeated rows count as
    often as they occur.  An empty table, or a language without a phrase of ten
    occurrences, gives no rows; other columns are ignored.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                       text_or_empty().alias("text"))
    words = materialize(word_counts(docs), "phrases-words")
    frequent = materialize(words.filter(F.col("f") >= MIN_COUNT), "phrases-frequent")
    pairs = materialize(scored_pairs(materialize(pair_counts(docs, frequent), "phrases-pair-counts"),
                                     frequent), "phrases-pairs")
    covers = COVERED[1] * F.col("a") >= COVERED[0] * F.col("of")

    open_langs = pairs.select("lang").distinct()
    triples = dropped = None
    winners = []
    wanted = 2 * limit
    while True:
        # the key of this round, from what is known
        mine_ = pairs.join(open_langs, "lang")
        known = mine_.select("lang", "h1", "h2", F.lit(None).cast("long").alias("h3"), "a", "l", "r", "score")
        if dropped is not None:
            known = known.join(dropped, ["h1", "h2"], "left_anti")
            known = known.unionByName(triples.join(open_langs, "lang"))
        keys = materialize(best_keys(known, wanted), "phrases-keys")
        # grow the pairs whose bound reaches it, settle the candidates that do
        at = mine_.join(keys, "lang").withColumn("settle", _reaches("score", "a"))
        grow = (F.col("m") >= MIN_COUNT) & _reaches("bound", "m")
        grown = materialize(at.filter(grow | F.col("settle")).select("h1", "h2", "settle"), "phrases-grown")
        triples = materialize(scored_triples(triple_counts(docs, pairs, grown), pairs, frequent),
                              "phrases-triples")
        inside = triples.select("h1", "h2", F.col("a").alias("of3")).union(
            triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
        dropped = materialize(
            inside.groupBy("h1", "h2").agg(F.max("of3").alias("a"))
            .join(pairs.select("h1", "h2", F.col("a").alias("of")), ["h1", "h2"])
            .filter(covers).select("h1", "h2"), "phrases-dropped")
        alive = (known.filter("h3 is null").join(dropped, ["h1", "h2"], "left_anti")
                 .unionByName(triples).join(keys, "lang").filter(_reaches("score", "a")))
        alive = materialize(alive, "phrases-alive")
        enough = alive.groupBy("lang").agg(F.count(F.lit(1)).alias("alive"))
        done = materialize(keys.join(enough, "lang", "left").filter(
            F.col("all_in") | (F.col("alive") >= limit)).select("lang"), "phrases-done")
        winners.append(alive.join(done, "lang", "left_semi")
                       .select("lang", "h1", "h2", "h3", "a", "l", "r", "score"))
        open_langs = materialize(open_langs.join(done, "lang", "left_anti"), "phrases-open")
        if open_langs.isEmpty():
            break
        wanted *= WIDEN
    out = winners[0]
    for w in winners[1:]:
        out = out.unionByName(w)
    name = frequent.select("h", "word")
    for k in ("1", "2", "3"):
        out = out.join(name.toDF(f"h{k}", f"w{k}"), f"h{k}", "left" if k == "3" else "inner")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    out = out.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3")).join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return (out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
