"""Secret scan (DataFrame functions only): fixed patterns, and character Markov
models of random strings and of ordinary identifiers.

The base kinds are three patterns.  The method adds spans: every token that
may be a key is scored by the log-likelihood ratio of two first-order Markov
chains over its characters, one trained on the values of the base spans (random
strings), one on the identifiers of all documents outside them (ordinary).  It
is a secret when the whole ratio outweighs the odds against one, so a short
token must look more random, character by character, than a long one.  Tokens
are the parts between separators, so a key inside a path or an address is found
alone; numbers are no keys.  The models are tables of character pairs, so they
fit one constant; they are counted by Spark over every document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doubles_literal, id_and_text, let, text_or_empty

# Fixed by the contract: the kinds, in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"          # [0-9a-f]+ of 32 or more: runs are maximal
MIN_VALUE, MIN_ACCESS = 8, 16

METHOD = "markov"
# What the method judges: runs of letters and digits, of 8 characters if they mix
# letters with digits or small letters with capitals after them, of 16 otherwise.
MIXED = r"(?:[0-9][A-Za-z]|[A-Za-z][0-9]|[a-z][A-Z])"
TOKEN = (r"(?<![A-Za-z0-9])(?![0-9]+(?![A-Za-z0-9]))(?:(?=[A-Za-z0-9]*?" + MIXED + r")"
         r"[A-Za-z0-9]{8,}|[A-Za-z0-9]{16,})")
# Ordinary tokens it learns from: names, mostly shorter than the keys it looks for, so
# that a secret nobody has labelled is not learnt as ordinary, and numbers.  For the
# same reason a name that mixes classes must occur LEARNT times or more.
IDENTIFIER = r"(?<![A-Za-z0-9])(?:[A-Za-z][A-Za-z0-9]{3,14}|[0-9]{4,})(?![A-Za-z0-9])"
LEARNT = 3
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
JUDGED = 62                                  # of these, the letters and digits
ANY = 0.5                                    # share of keys of any alphabet among random strings
ODDS = 9.0                                   # nats by which a token must look random
PLACEHOLDER = "[SECRET]"

PIECE = 256                                  # matches of a text that are placed together

SPANS = "array<struct<start:int,end:int,kind:int,value:string>>"


def _found(text: Column, pattern: str, kind: int, value_group: int = 0) -> Column:
    """All leftmost non-overlapping matches as spans (code points, end
    exclusive); the text between them gives the positions."""
    parts = F.struct(F.split(text, pattern, -1).alias("between"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"))

    none = F.array().cast(SPANS)

    def add(p: Column, acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(p["between"][i])
        end = start + F.length(p["whole"][i])
        one = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"),
                       p["value"][i].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def spans(p: Column) -> Column:
        # in pieces, each counted from 0: lists are grown by copying
        last = F.size(p["whole"]) - 1

        def piece(c: Column) -> Column:
            return F.aggregate(F.sequence(c * PIECE, F.least(c * PIECE + (PIECE - 1), last)),
                               F.struct(F.lit(0).alias("at"), none.alias("out")),
                               lambda acc, i: add(p, acc, i))
        return let(F.transform(F.sequence(F.lit(0), (last / PIECE).cast("int")), piece), joined)

    def joined(pieces: Column) -> Column:
        begins = F.aggregate(
            pieces, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"),
                                    F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]
        return let(begins, lambda at: F.flatten(F.transform(pieces, lambda x, k: F.transform(
            x["out"], lambda s: F.struct((s["start"] + at[k]).alias("start"), (s["end"] + at[k]).alias("end"),
                                         s["kind"].alias("kind"), s["value"].alias("value"))))))

    return F.when(text.rlike(pattern), let(parts, spans)).otherwise(F.array().cast(SPANS))


def _has_base(text: Column) -> Column:
    return text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX)


def base_spans(text: Column) -> Column:
    """The spans of the base kinds, by start, then kind as listed."""
    assign = F.filter(_found(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= MIN_VALUE)
    access = F.filter(_found(text, ACCESS, 1), lambda s: F.length(s["value"]) >= MIN_ACCESS)
    return _ordered(F.concat(assign, access, _found(text, HEX, 2)))


def _ordered(spans: Column) -> Column:
    return F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"),
                                                           s["kind"].alias("kind"), s["end"].alias("end"),
                                                           s["value"].alias("value")))),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                           s["kind"].alias("kind"), s["value"].alias("value")))


def _pair(previous: Column, current: Column) -> Column:
    """Index of a character pair; 0 stands before the first."""
    return previous * 128 + F.ascii(current)


def pair_counts(strings: DataFrame) -> dict[int, tuple[int, int]]:
    """(ordinary, random) counts per character pair of (value, random, n) rows;
    at most the square of the alphabet reaches the driver."""
    v = F.col("value")
    pairs = F.transform(
        F.sequence(F.lit(1), F.length(v)),
        lambda i: _pair(F.when(i == 1, F.lit(0)).otherwise(F.ascii(F.substring(v, i - 1, F.lit(1)))),
                        F.substring(v, i, F.lit(1))))
    def total(kind: Column) -> Column:
        return F.sum(F.when(kind, F.col("n")).otherwise(0))
    rows = (strings.filter(F.length(v) > 0).select("random", "n", F.explode(pairs).alias("pair"))
            .groupBy("pair").agg(total(~F.col("random")).alias("ordinary"),
                                 total(F.col("random")).alias("random")).collect())
    return {r["pair"]: (r["ordinary"], r["random"]) for r in rows}


def training_strings(docs: DataFrame) -> DataFrame:
    """(value, random, n): labelled samples and how often they occur, over all
    documents.  Random: the values of the base spans.  Ordinary: identifier-like
    tokens, none of them inside a base span."""
    d = id_and_text(docs).select("text", _has_base(F.col("text")).alias("hit"))
    text = F.col("text")
    positive = (d.filter("hit").select(F.explode(base_spans(text)).alias("s"))
                .select(F.col("s.value").alias("value"), F.lit(True).alias("random")))
    clean = text
    for pattern in (ASSIGN, ACCESS, HEX):
        clean = F.regexp_replace(clean, pattern, " ")
    clean = F.when(F.col("hit"), clean).otherwise(text)
    negative = d.select(F.explode(F.regexp_extract_all(clean, F.lit(IDENTIFIER), F.lit(0))).alias("value"),
                        F.lit(False).alias("random"))
    return positive.union(negative).groupBy("value", "random").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("random") | ~F.col("value").rlike(MIXED) | (F.col("n") >= LEARNT))


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratio (random over ordinary) per character pair.  One is
    added to every count; random strings are, for a share of ANY, of any
    letters and digits, as the labelled ones may all have one alphabet."""
    counts = pair_counts(training_strings(docs))
    codes = [ord(c) for c in SYMBOLS]
    out = [0.0] * (128 * 128)
    for before in [0, *codes]:
        row = [counts.get(before * 128 + c, (0, 0)) for c in codes]
        ordinary, random_ = (sum(r[k] for r in row) + len(codes) for k in (0, 1))
        for c, (o, r) in zip(codes, row):
            key = ANY / JUDGED + (1 - ANY) * (r + 1) / random_
            out[before * 128 + c] = math.log(key) - math.log((o + 1) / ordinary)
    return out


def whole_ratio(value: Column, ratios: Column) -> Column:
    """Log-likelihood ratio of a token of SYMBOLS."""
    def score(c: Column) -> Column:
        return F.aggregate(
            c, F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum")),
            lambda acc, x: F.struct(F.ascii(x).alias("last"),
                                    (acc["sum"] + ratios[_pair(acc["last"], x)]).alias("sum")))["sum"]

    return let(F.filter(F.split(value, ""), lambda c: F.length(c) > 0), score)


def method_spans(text: Column, base: Column, ratios: Column, odds: float) -> Column:
    """Tokens the models take for random, apart from the base spans."""
    tokens = F.filter(_found(text, TOKEN, len(KINDS)),
                      lambda s: whole_ratio(s["value"], ratios) >= odds)
    return let(base, lambda b: F.filter(tokens, lambda s: ~F.exists(
        b, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, METHOD)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_spans(docs: DataFrame, ratios: list[float], odds: float = ODDS) -> DataFrame:
    """(doc_id, base, method): the spans of every document."""
    d = id_and_text(docs).select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    return d.select("doc_id", "base", method_spans(
        F.col("text"), F.col("base"), doubles_literal(ratios), odds).alias("method"))


def scan_secrets(docs: DataFrame, odds: float = ODDS) -> DataFrame:
    """One row per document: (doc_id, n_assign, n_access, n_hex, n_markov,
    base_sha256, spans).

    A null text is empty and has no spans; repeated rows and rows without
    doc_id are scanned like any other; an empty table gives no rows; other
    columns are ignored.
    """
    s = with_spans(docs, train(docs), odds)
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return s.select(
        "doc_id", *counts, F.size("method").cast("long").alias("n_markov"),
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(_ordered(F.concat("base", "method"))).alias("spans"))


def _blanked(text: Column, spans: Column) -> Column:
    """``text`` with every (ordered) span replaced by the placeholder;
    overlapping spans are replaced as one."""
    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.when(fresh, F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
            F.lit(PLACEHOLDER))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), piece.alias("out"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1,
                                                                    F.length(text))))


def redact_secrets(docs: DataFrame, odds: float = ODDS) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by PLACEHOLDER; all rows
    and columns stay, a null text stays null."""
    ratios = doubles_literal(train(docs))
    text = text_or_empty()

    def spans(base: Column) -> Column:
        return _ordered(F.concat(base, method_spans(text, base, ratios, odds)))

    blanked = let(let(base_spans(text), spans), lambda s: F.when(F.size(s) == 0, text)
                  .otherwise(_blanked(text, s)))
    return docs.withColumn("text", F.when(F.col("text").isNotNull(), blanked))
