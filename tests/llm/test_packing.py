import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from arenalytics.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


LIBRARY = Tokenizer.from_file(PATH)          # as it is, no setting changed
ADDED = [t.content for t in LIBRARY.get_added_tokens_decoder().values()]


def whole_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def test_pieces_are_the_documents(edge_docs):
    docs, rows = edge_docs
    out = packing.pack_documents(docs, PATH, with_ids=True)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    pieces = out.collect()
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    copies = {i: sum(1 for j, _ in rows if j == i) for i, _ in rows}
    for i, t in dict(rows).items():
        ids = whole_ids(t)
        parts = sorted(by_doc[i], key=lambda r: r.start)[::copies[i]]
        assert [x for r in parts for x in r.ids] == ids
        assert all(r.doc_tokens == len(ids) for r in parts)
    for rs in by_seq.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:k]) for k in range(len(rs))]
        assert sum(r.length for r in rs) <= packing.WINDOW
    total = sum(r.length for r in pieces)
    # near-equal windows: at most one more than could hold the tokens, and 3 %
    assert len(by_seq) <= 1 + 1.03 * total / packing.WINDOW


def test_windows_hold_their_pieces(edge_docs):
    docs, _ = edge_docs
    out = packing.pack_documents(docs, PATH, with_ids=True)
    want = defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: r.offset):
        want[r.sequence_id] += r.ids
    got = {r.sequence_id: r.ids for r in packing.sequences(out).collect()}
    assert got == dict(want)


def test_empty(empty_docs):
    assert packing.pack_documents(empty_docs, PATH).count() == 0


ENCODER = packing.Encoder(PATH)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_encoder_equals_the_library(text):
    assert np.frombuffer(next(ENCODER.encode([text])), "<u4").tolist() + [2] == whole_ids(text)


def test_encoder_on_awkward_texts(monkeypatch):
    e = packing.Encoder(PATH)
    assert e.by_word
    texts = ["it's I'LL we've 3rd x2y", "<|endoftext|> a", "a\x1cb\x85c d", "é ́e",
             "ﬁ Å ΣΑΣ", "tab\tnew\nline\x0b\x0c", "…—“q”", "a'sb 's'"]
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)        # the memory is emptied again and again
    for t, b in zip(texts * 2, e.encode(texts * 2)):
        assert np.frombuffer(b, "<u4").tolist() + [2] == whole_ids(t), t


def test_strings_of_added_tokens_are_their_ids():
    e = packing.Encoder(PATH)
    assert ADDED
    texts = [f"see {t} now" for t in ADDED] + [f"a{t}b {t.upper()} x" for t in ADDED] + ["".join(ADDED) * 2]
    for t, b in zip(texts, e.encode(texts)):
        assert np.frombuffer(b, "<u4").tolist() + [2] == whole_ids(t), t
    assert LIBRARY.token_to_id(ADDED[0]) in np.frombuffer(next(e.encode(texts)), "<u4")


def test_cuts_cover_exactly():
    for n in [1, 2, 1023, 1024, 1025, 4095, 4096, 4097, 9000, 12288]:
        c = packing.cuts(n)
        assert [s for s, _ in c] == [sum(k for _, k in c[:i]) for i in range(len(c))]
        assert sum(k for _, k in c) == n
        assert all(k == packing.WINDOW or 0 < k <= packing.WINDOW // packing.PARTS for _, k in c)


def two_way(sizes):
    """Difference that the two-way method leaves, by its plain definition."""
    import heapq
    heap = [-s for s in sizes]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = -heapq.heappop(heap), -heapq.heappop(heap)
        heapq.heappush(heap, -(a - b))
    return -heap[0]


def test_two_bins_equal_the_plain_method():
    rnd = random.Random(0)
    for _ in range(50):
        sizes = sorted((rnd.randrange(1, 1000) for _ in range(rnd.randrange(2, 30))), reverse=True)
        bins, fullest = packing.differencing(np.array(sizes), 2)
        sums = np.bincount(bins, sizes, 2)
        assert fullest == sums.max() and sums.max() - sums.min() == two_way(sizes)


def test_many_bins_are_near_equal_and_never_over():
    rnd = np.random.RandomState(2)
    for n in (1, 5, 40, 600):
        sizes = np.sort(rnd.randint(1, 1025, n))[::-1].copy()
        bins = packing.pack_sizes(sizes, 4096)
        sums = np.bincount(bins, sizes)
        assert sums.max() <= 4096 and len(bins) == n
        if n == 600:
            assert sums.max() - sums.min() < 200
            assert len(sums) <= -(-sizes.sum() // 4096) + 2
