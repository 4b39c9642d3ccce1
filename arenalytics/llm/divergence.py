"""Source divergence audit by three-dimensional cube partitioning.

Term counts per group (language, source) are a sparse matrix; the divergence of
every two groups of a language is a sum over all terms.  The work is a cube of
cells (group block, group block, term block).  A slice (group block, term
block) is replicated to the cells along its two group axes; the task of a cell
holds two slices, computes the partial divergences of its pairs of groups, and
the partial sums are reduced along the term axis.  The number of term blocks
grows with the counts, so a cell holds about CELL_ROWS of them whatever the
input; no task sees a whole language or a whole group.

Probabilities are whole numbers (parts of SCALE, from 1), so all sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty
from .tokens import Held, byte_table, runs
from .wordhash import slices, texts_of

# Fixed by the contract.
MIN_DOCS, SCALE, SMOOTHING, TOP_TERMS = 30, 1_000_000_000, 5, 50
_TERM = byte_table(range(0x00, 0x41), range(0x5B, 0x61), range(0x7B, 0x80))

GROUP_BLOCK = 16               # groups on a side of a cell
CELL_ROWS = 1 << 16            # counts in a slice, about
HELD = 2 << 20                 # (group, term) counts a task holds before it sends them on
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _terms(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Slice by slice: (terms, row of the batch of each)."""
    data, off = texts_of(batch.column("text"))
    for i, j in slices(off):
        b, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        starts, ends, text = runs(b, o, _TERM)
        if not len(starts):
            continue
        kept = _LOWER[b[_TERM[b]]]
        at = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=at[1:])
        yield pa.StringArray.from_buffers(len(starts), pa.py_buffer(at.tobytes()),
                                          pa.py_buffer(kept.tobytes())), i + text


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Held(["lang", "source", "term"], HELD, ["n", "docs"])
    for batch in batches:
        lang, source = batch.column("lang"), batch.column("source")
        for terms, row in _terms(batch):
            t = pa.table([pa.array(row.astype(np.int64)), terms], names=["row", "term"])
            t = t.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
            row = t.column("row").combine_chunks()
            yield from held.add(
                [lang.take(row), source.take(row), t.column("term").combine_chunks()],
                [t.column("count_all").combine_chunks().cast(pa.int64()),
                 pa.array(np.ones(len(t), np.int64))])
    yield from held.send()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term."""
    rows = docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * terms)), exactly."""
    wide = "cast({} as decimal(19,0))".format
    return F.expr(f"1 + ({wide(count)} + {SMOOTHING}) * {SCALE} "
                  f"div ({wide(total)} + {SMOOTHING} * {wide(terms)})").cast("long")


def _cell(table: pa.Table) -> pa.Table:
    """Partial divergences of a cell.

    Rows: (gi, gj, lang, source, block, zero, term, p).  ``zero`` is the group's
    share of a term that it lacks; a row with a null term only names a group.
    Terms that neither slice has are not here: the caller adds them, from the
    number of terms that are."""
    gi, gj = table.column("gi")[0].as_py(), table.column("gj")[0].as_py()
    lang = table.column("lang")[0].as_py()
    source = table.column("source").combine_chunks().dictionary_encode()
    names, s = source.dictionary.to_pylist(), source.indices.to_numpy()
    # a pair has the same order in every cell: by block, inside a block by name
    ranks = np.argsort(np.argsort(np.array(names, object)))
    block, zero = np.empty(len(names), np.int64), np.empty(len(names), np.int64)
    block[s], zero[s] = table.column("block").to_numpy(), table.column("zero").to_numpy()
    has = pc.is_valid(table.column("term")).to_numpy()
    term = table.column("term").combine_chunks().dictionary_encode()
    terms = len(term.dictionary)
    p = np.repeat(zero[:, None], terms, axis=1)
    t = term.indices.fill_null(0).to_numpy()
    p[s[has], t[has]] = table.column("p").to_numpy()[has]
    out = []
    for x in np.flatnonzero(block == gi).tolist():
        ys = np.flatnonzero(block == gj)
        ys = ys[ranks[ys] > ranks[x]] if gi == gj else ys
        if len(ys):
            part = np.abs(p[ys] - p[x]).sum(axis=1)
            out += [(lang, names[x], names[y], v, terms) for y, v in zip(ys.tolist(), part.tolist())]
    columns = list(zip(*out)) or [[]] * 5
    return pa.table([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                     pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64()),
                     pa.array(columns[4], pa.int64())], names=["lang", "x", "y", "part", "seen"])


def pair_divergences(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, x, y, value) of every two groups of a language, each pair once.  ``kept``: (lang, source, term, p); ``groups``: (lang,
    source, zero, terms), ``terms`` being the language's number of kept terms."""
    rows = kept.count()
    term_blocks = max(1, -(-rows // CELL_ROWS))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("in_lang"))
    blocks = F.ceil(F.col("in_lang") / GROUP_BLOCK).cast("long")
    g = groups.join(sizes, "lang").withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("source"), F.col("blocks")))
    g = materialize(g.select("lang", "source", "zero", "block", "blocks"), "divergence-groups")
    counted = (kept.join(g, ["lang", "source"])
               .withColumn("tb", F.pmod(F.xxhash64("term", F.lit(1)), F.lit(term_blocks)).cast("int")))
    # every group is named in every term block, so that a cell knows its pairs
    named = g.withColumn("tb", F.explode(F.sequence(F.lit(0), F.lit(term_blocks - 1)))) \
             .withColumns({"term": F.lit(None).cast("string"), "p": F.lit(None).cast("long")})
    columns = ["lang", "source", "block", "blocks", "zero", "term", "p", "tb"]
    slices_ = counted.select(columns).union(named.select(columns))
    cells = slices_.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .select("lang", "tb", F.least("block", "other").alias("gi"), F.greatest("block", "other").alias("gj"),
                "source", "block", "zero", "term", "p")
    parts = cells.groupBy("lang", "gi", "gj", "tb").applyInArrow(
        _cell, "lang string, x string, y string, part long, seen long")
    sums = parts.groupBy("lang", "x", "y").agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"))
    of = groups.select("lang", "source", "zero", "terms")
    both = (sums.join(of.toDF("lang", "x", "zero_x", "terms"), ["lang", "x"])
            .join(of.drop("terms").toDF("lang", "y", "zero_y"), ["lang", "y"]))
    return both.select("lang", "x", "y", (F.col("part") + (F.col("terms") - F.col("seen"))
                                          * F.abs(F.col("zero_x") - F.col("zero_y"))).alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Null text, language and source are read as ''.  Every row of ``docs`` is a
    document, repeated rows too.  A language without kept terms gives pairs of
    value 0; one with a single source gives no pairs.  An empty table gives no
    rows; other columns are ignored.
    """
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                         for c in ("lang", "source")], text_or_empty().alias("text"))
    counts = materialize(term_counts(read), "divergence-counts")
    vocabulary = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs")) \
        .filter(F.col("docs") >= min_docs).select("lang", "term", "in_lang")
    vocabulary = materialize(vocabulary, "divergence-vocabulary")
    kept = materialize(counts.join(vocabulary, ["lang", "term"])
                       .select("lang", "source", "term", "n", "in_lang"), "divergence-kept")
    langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"),
                                           F.sum("in_lang").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zeros = {"terms": 0, "lang_total": 0, "total": 0}
    groups = (read.select("lang", "source").distinct().join(langs, "lang", "left")
              .join(totals, ["lang", "source"], "left").fillna(zeros))
    # without kept terms no share is ever used; 1 keeps the division defined
    groups = groups.withColumn("none", F.lit(0)).withColumn("least", F.greatest("terms", F.lit(1)))
    groups = materialize(groups.select(
        "lang", "source", "terms", "lang_total", "total",
        share("none", "total", "least").alias("zero")), "divergence-totals")
    shares = materialize(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share("n", "total", "terms").alias("p"),
        share("in_lang", "lang_total", "terms").alias("q")), "divergence-shares")

    pairs = materialize(pair_divergences(shares.drop("q"), groups.select("lang", "source", "zero", "terms")),
                        "divergence-pairs")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    both = pairs.select("lang", F.col("x").alias("source"), F.col("y").alias("item"), "value").union(
        pairs.select("lang", "y", "x", "value")).withColumn("rank", F.row_number().over(order))
    terms = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"),
                                          (F.col("p") - F.col("q")).alias("value")) \
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(both, "pair").union(part(terms, "term"))
