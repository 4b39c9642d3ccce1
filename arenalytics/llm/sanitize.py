"""Personal data: fixed patterns, and information-theoretic sanitisation.

The base kinds are four patterns.  Their values are the protected entities.
A term (a run of letters and digits) discloses an entity if seeing it tells
much of what there is to tell: its pointwise mutual information with the
entity, ``log2 p(t, e) / (p(t) p(e))``, reaches ALPHA of the entity's own
information ``-log2 p(e)``.  Probabilities are shares of documents, counted
over the whole corpus; a term and an entity occur together if the term is among
the WINDOW words before or after it.  Evidence must come from SUPPORT different
texts (near copies, seen by their smallest shingle hash, are one), and the
entity must hold MIN_BITS.

A disclosing term is sanitised wherever it occurs.  If the class of the terms
with the same first STEM characters does not itself disclose an entity, the
term is generalised to it (``stem*``), else it is removed.

Three scans: windows around entities; documents with each candidate (a bitmap
of fixed size filters the words, tasks send one row per candidate); places of
disclosing terms.  Only words near entities, counts and places are shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitmaps import MASK, bitmap, has, position_column
from .common import id_and_text, materialize, spare_name, text_or_empty
from .tokens import Held, byte_table, prefix_ends, runs
from .wordhash import shingle_sets, slices, texts_of, word_hashes

# Fixed by the contract: the kinds, in order, and their patterns.  A look-behind
# and possessive runs change no match; they keep long runs of digits linear.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MAX_PART, CARD_DIGITS, PHONE_DIGITS = 255, (16, 19), (8, 15)

METHOD = "term"
ALPHA, SUPPORT, MIN_BITS = 0.8, 3, 1.0
WINDOW, REACH = 8, 400                 # words on each side, within so many characters
STEM = 3
_WORD = byte_table(range(0, 48), range(58, 65), range(91, 97), range(123, 128))
_WORD_RE = re.compile(r"[0-9A-Za-z\u0080-\U0010FFFF]+")
_STEM_SALT = np.uint64(0x5851F42D4C957F2D)
HELD = 1 << 20


def _emails(text: str) -> list[tuple[int, int]]:
    """A match holds exactly one ``@``, so they are found from these: the run
    of local characters before one, the domain after it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        at = text.find("@", at + 1)
    return out


def _luhn(digits: str) -> bool:
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(t - 9 if t > 9 else t for t in twice)) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= MAX_PART


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points."""
    out = [(0, s, e) for s, e in _emails(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in CARD.finditer(text):
        d = _digits(m[0])
        if CARD_DIGITS[0] <= len(d) <= CARD_DIGITS[1] and _luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]:
                out.append((3, m.start(), m.end()))
    return out


def entity(kind: int, value: str) -> str:
    """The name of a protected entity: one for all its spellings."""
    value = value.lower() if kind == 0 else value if kind == 1 else _digits(value)
    return f"{KINDS[kind]}:{value}"


class _Covered:
    """What a text's spans cover, as merged intervals."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts, self.ends = [], []
        for _, s, e in sorted(spans, key=lambda x: x[1]):
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def meets(self, start: int, end: int) -> bool:
        k = bisect_right(self.ends, start)
        return k < len(self.ends) and self.starts[k] < end


def near_words(text: str, covered: _Covered, start: int, end: int) -> list[str]:
    """The WINDOW words on each side of ``start:end``, at most REACH characters
    away, none of them part of a span."""
    low = max(0, start - REACH)
    before = [m for m in _WORD_RE.finditer(text, low, start)
              if m.start() > low or low == 0 or not _WORD_RE.match(text[low - 1])]
    after = [m for m in _WORD_RE.finditer(text, end, min(len(text), end + REACH))
             if m.end() < end + REACH or m.end() == len(text) or not _WORD_RE.match(text[m.end()])]
    return [m[0] for m in before[-WINDOW:] + after[:WINDOW] if not covered.meets(m.start(), m.end())]


def _hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, hash of its class; 0 for words that are no longer)."""
    raw = [w.encode() for w in words]
    off = np.cumsum([0, *map(len, raw)])
    return _word_keys(np.frombuffer(b"".join(raw), np.uint8), off[:-1], off[1:])


def _word_keys(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    stop = prefix_ends(b, starts, ends, STEM)
    stems = word_hashes(b, starts, stop) ^ _STEM_SALT
    return word_hashes(b, starts, ends), np.where(stop < ends, stems, np.uint64(0))


CONTEXT_SCHEMA = "entity string, h long, stem long, name long"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document and entity: the words near it once each, and their classes
    (a row without ``stem``); a row without ``h`` is the entity itself."""
    for batch in batches:
        rows, words, texts = [], [], []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text)
            covered = _Covered(spans)
            near: dict[str, set[str]] = {}
            for kind, s, e in spans:
                near.setdefault(entity(kind, text[s:e]), set()).update(near_words(text, covered, s, e))
            for name, found in near.items():
                found = sorted(found)
                rows.append((name, len(texts), len(found)))
                words += found
            if near:
                texts.append(text)
        if not rows:
            continue
        h, stem = _hashed(words)
        least = np.array([s.min() if len(s) else 0 for _, part in shingle_sets(pa.array(texts, pa.string()))
                          for s in part], np.uint64).view(np.int64)
        out, at = [], 0
        for name, text, n in rows:
            of = least[text]
            own, general = h[at:at + n], stem[at:at + n]
            _, first = np.unique(own, return_index=True)
            out.append((name, None, None, of))
            out += [(name, x, g, of) for x, g in zip(own[first].view(np.int64).tolist(),
                                                     general[first].view(np.int64).tolist())]
            out += [(name, g, None, of) for g in np.unique(general[general != 0]).view(np.int64).tolist()]
            at += n
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
            names=["entity", "h", "stem", "name"])


def _words(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Slice by slice: (bytes, starts, ends, row, start of the row's text, word
    hash, class hash)."""
    data, off = texts_of(batch.column("text"))
    for i, j in slices(off):
        b, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        starts, ends, row = runs(b, o, _WORD)
        if len(starts):
            yield b, starts, ends, i + row, o[row], *_word_keys(b, starts, ends)


def _frequency(candidates) -> Callable:
    """Documents with each word or class that the bitmap lets through."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bits = Held(["h"], HELD), candidates.value
        for batch in batches:
            for _, _, _, row, _, h, stem in _words(batch):
                h, row = np.concatenate([h, stem]), np.concatenate([row, row])
                keep = has(bits, h & MASK) & (h != 0)
                h, row = h[keep], row[keep]
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                yield from held.add([pa.array(h[first].view(np.int64))])
        yield from held.send()
    return count


def disclosing_terms(docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """(h, generalised): the disclosing terms by hash, and whether their class
    is safe to show."""
    d = docs.select(text_or_empty().alias("text"))
    near = materialize(d.mapInArrow(_contexts, CONTEXT_SCHEMA), "pii-contexts")
    total = docs.count()
    own = near.filter("h is null").groupBy("entity").agg(F.count(F.lit(1)).alias("of_entity"))
    # two levels, so that a hot entity and a common word still spread
    joint = (near.filter("h is not null").groupBy("entity", "h", "stem", "name").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("entity", "h", "stem").agg(F.sum("n").alias("both"), F.count(F.lit(1)).alias("texts"))
             .filter(F.col("texts") >= support))
    joint = materialize(joint, "pii-candidates")
    seen = bitmap(joint, position_column("h"))
    of_term = (d.mapInArrow(_frequency(seen), "h long, c long").groupBy("h")
               .agg(F.sum("c").alias("of_term")))
    pair = joint.join(own, "entity").join(of_term, "h")
    n = F.lit(float(total))
    bits = F.log2(n / F.col("of_entity"))
    told = F.log2(F.col("both") * n / (F.col("of_term").cast("double") * F.col("of_entity")))
    found = materialize(pair.filter((bits >= MIN_BITS) & (told >= alpha * bits)).select("h", "stem"),
                        "pii-disclosing")
    classes = found.filter("stem is null").select(F.col("h").alias("stem"), F.lit(False).alias("safe")).distinct()
    terms = found.filter("stem is not null").groupBy("h").agg(F.max("stem").alias("stem"))
    return terms.join(classes, "stem", "left").select(
        "h", (F.coalesce("safe", F.lit(True)) & (F.col("stem") != 0)).alias("generalised"))


def _written(spans: list[tuple[int, int, int]]) -> str:
    names = (*KINDS, METHOD)
    return ",".join(f"{names[k]}:{s}:{e}" for k, s, e in spans)


PLACES = "array<struct<h:bigint,start:int,end:int>>"
_PLACE = pa.list_(pa.struct([("h", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))


def _find(candidates) -> Callable:
    """Base spans of each document, and the places of the words outside them
    that the bitmap lets through."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = candidates.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = [base_spans(t) for t in texts]
            places: list[list] = [[] for _ in texts]
            covered = [_Covered(x) for x in spans]
            for b, starts, ends, row, base, h, _ in _words(batch):
                hit = np.flatnonzero(has(bits, h & MASK))
                if not len(hit):
                    continue
                char = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
                zero, of = char[base[hit]], row[hit].tolist()
                for r, key, s, e in zip(of, h[hit].view(np.int64).tolist(),
                                        (char[starts[hit]] - zero).tolist(),
                                        (char[ends[hit]] - zero).tolist()):
                    if not covered[r].meets(s, e):
                        places[r].append({"h": key, "start": s, "end": e})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("k1"), batch.column("k2"),
                 *[pa.array([sum(x[0] == k for x in s) for s in spans], pa.int64()) for k in range(len(KINDS))],
                 pa.array([_written(s) for s in spans], pa.string()),
                 pa.array(places, _PLACE)],
                names=["doc_id", "k1", "k2", *[f"n_{k}" for k in KINDS], "base", "places"])
    return find


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k1, k2): a 128-bit name of the text beside it; spans
    depend on the text alone, so copies share them."""
    return id_and_text(docs).select("doc_id", "text", F.xxhash64("text").alias("k1"),
                                    F.xxhash64(F.lit(1), "text").alias("k2"))


def _found(docs: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with base spans, (k1, k2, terms) of the texts with any); ``terms``
    lists (start, end, generalised), in order."""
    bits = bitmap(terms, position_column("h"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    rows = materialize(_keyed(docs).mapInArrow(
        _find(bits), f"doc_id long, k1 long, k2 long, {counts}, base string, places {PLACES}"), "pii-rows")
    one = rows.filter(F.size("places") > 0).select("k1", "k2", F.explode("places").alias("p")) \
        .select("k1", "k2", "p.h", "p.start", "p.end").distinct().join(terms, "h")
    return rows, materialize(one.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(
        F.struct("start", "end", "generalised"))).alias("terms")), "pii-terms")


def scan_personal_data(docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """One row per document: (doc_id, n_email, n_ip, n_card, n_phone, n_term,
    base_sha256, spans).

    A null text is empty and has no spans; repeated rows and rows without
    doc_id are scanned like any other; an empty table gives no rows; other
    columns are ignored.
    """
    terms = materialize(disclosing_terms(docs, alpha, support), "pii-terms-found")
    rows, found = _found(docs, terms)
    written = F.transform("terms", lambda t: F.concat_ws(
        ":", F.lit(METHOD), t["start"].cast("string"), t["end"].cast("string")))
    # only the few rows that hold a disclosing term meet the other side
    plain = rows.filter(F.size("places") == 0).withColumn("terms", F.lit(None).cast(
        "array<struct<start:int,end:int,generalised:boolean>>"))
    out = rows.filter(F.size("places") > 0).join(found, ["k1", "k2"], "left").unionByName(plain)
    return out.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.coalesce(F.array_size("terms"), F.lit(0)).cast("long").alias("n_term"),
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(F.col("base"), F.lit("")),
                    F.when(F.array_size("terms") > 0, F.array_join(written, ","))).alias("spans"))


def _cleaned(text: str, terms) -> str:
    """``text`` with base spans named by their kind (overlapping ones by the
    first), and disclosing terms generalised or removed."""
    cuts = [(s, e, f"[{KINDS[k].upper()}]") for k, s, e in base_spans(text)]
    cuts += [(t["start"], t["end"], text[t["start"]:t["start"] + STEM] + "*" if t["generalised"] else "")
             for t in (terms if terms is not None else ())]
    out, at = [], 0
    for s, e, shown in sorted(cuts, key=lambda c: c[:2]):
        if s >= at:
            out += [text[at:s], shown]
        at = max(at, e)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by the name of its kind,
    and disclosing terms generalised (``stem*``) or removed.  All rows and
    columns stay; a null text stays null."""
    terms = materialize(disclosing_terms(docs, alpha, support), "pii-terms-found")
    _, found = _found(docs, terms)
    k1, k2, own = (spare_name(docs, c) for c in ("pii_k1", "pii_k2", "pii_terms"))

    @F.pandas_udf("string")
    def cleaned(text, terms):
        return text.combine(terms, lambda t, x: None if t is None else _cleaned(t, x))

    text = text_or_empty()
    keyed = docs.withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit(1), text)})
    keyed = keyed.join(found.toDF(k1, k2, own), [k1, k2], "left")
    out = keyed.withColumn("text", cleaned(F.col("text").cast("string"), F.col(own)))
    return out.select(*docs.columns)
