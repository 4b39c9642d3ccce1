import hashlib
import re

from arenalytics.llm import secrets as sc

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
NAMES = ("assign", "access", "hex")


def brute(text):
    t = text or ""
    s = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    s += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    s += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(s)


def joined(spans):
    return ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_match_brute_force(edge_docs):
    docs, rows = edge_docs
    text = dict(rows)
    out = sc.scan_secrets(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        s = brute(text[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in s) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(joined(s).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert len(every) == len(s) + r.n_markov
        assert [x for x in every if not x.startswith("markov")] == joined(s).split(",") * bool(s)
        order = [(int(x.split(":")[1]), [*NAMES, "markov"].index(x.split(":")[0])) for x in every]
        assert order == sorted(order)


def test_models_part_random_from_ordinary(spark):
    import random
    rnd = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def key(n):
        return "".join(rnd.choice(alphabet) for _ in range(n))
    stems = ["parse", "table", "count", "value", "config", "reader", "handle", "index", "buffer", "result"]

    def name(n=2):
        return "_".join(rnd.choice(stems) for _ in range(n))
    rows = [(i, f"{name()} then token={key(24)} and {name()}") for i in range(400)]
    bare, names = [key(30) for _ in range(50)], [name(4) for _ in range(50)]
    rows += [(1000 + i, f"see {b} here") for i, b in enumerate(bare)]
    rows += [(2000 + i, f"call {n} here") for i, n in enumerate(names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in sc.scan_secrets(docs).collect()}
    found = sum(out[1000 + i].n_markov for i in range(50))
    wrong = sum(out[2000 + i].n_markov for i in range(50))
    assert found >= 48 and wrong == 0
    assert out[1000].n_markov == 0 or out[1000].spans == "markov:4:34"


def test_redaction_replaces_spans_and_nothing_else(edge_docs):
    docs, rows = edge_docs
    left = sc.redact_secrets(docs)
    assert left.columns == docs.columns
    got = {r.doc_id: r.text for r in left.collect()}
    spans = {r.doc_id: r.spans for r in sc.scan_secrets(docs).collect()}
    assert left.count() == len(rows)
    for i, t in rows:
        if t is None:
            assert got[i] is None
            continue
        want, at = "", 0
        for s in sorted((int(a), int(b)) for _, a, b in
                        (x.split(":") for x in spans[i].split(",") if x)):
            if s[0] >= at:
                want += t[at:s[0]] + sc.PLACEHOLDER
            at = max(at, s[1])
        assert got[i] == want + t[at:]


def test_empty(empty_docs):
    assert sc.scan_secrets(empty_docs).count() == 0
    assert sc.redact_secrets(empty_docs).count() == 0


def brute_model(rows):
    """The pair table in plain Python."""
    import math
    from collections import Counter
    count, strings_of = [Counter(), Counter()], [Counter(), Counter()]
    for _, t in rows:
        t = t or ""
        values = [m[2] for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
        values += [m[0] for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        values += [m[0] for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        for pattern in (ASSIGN.pattern, "AKIA[A-Z0-9]+", r"(?<![0-9a-f])[0-9a-f]{32,}"):
            t = re.sub(pattern, " ", t, flags=re.I | re.A if pattern == ASSIGN.pattern else 0)
        for k, strings in enumerate((re.findall(sc.IDENTIFIER, t), values)):
            strings_of[k].update(strings)
    for k in (0, 1):
        for v, n in strings_of[k].items():
            if k or n >= sc.LEARNT or not re.search(sc.MIXED, v):
                for pair in zip([None, *v], v):
                    count[k][pair] += n
    n = len(sc.SYMBOLS)

    def ratio(a, b):
        o, r = ((c[a, b] + 1) / (sum(c[a, x] for x in sc.SYMBOLS) + n) for c in count)
        return math.log(sc.ANY / sc.JUDGED + (1 - sc.ANY) * r) - math.log(o)
    return lambda v: sum(ratio(a, b) for a, b in zip([None, *v], v))


def test_method_spans_match_brute_force(edge_docs):
    docs, rows = edge_docs
    score = brute_model(rows)
    seen = {}
    got = {r.doc_id: [x for x in r.spans.split(",") if x.startswith("markov")] for r in sc.scan_secrets(docs).collect()}
    found = 0
    for i, t in rows:
        base, want = brute(t), []
        for m in re.finditer(sc.TOKEN, t or ""):
            v = m[0]
            if v not in seen:
                seen[v] = score(v)
            assert abs(seen[v] - sc.ODDS) > 1e-6
            if seen[v] >= sc.ODDS and all(m.end() <= a or b <= m.start() for a, _, b in base):
                want.append(f"markov:{m.start()}:{m.end()}")
        assert got[i] == want, i
        found += len(want)
    assert len(seen) > 5


def test_precision_and_recall_on_planted_keys(spark):
    """Keys of several alphabets and lengths against numbers, paths and names."""
    import random
    import string
    rnd = random.Random(21)
    text = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}

    def key(n, alphabet):
        while True:
            v = "".join(rnd.choice(alphabet) for _ in range(n))
            if re.search("[0-9][A-Za-z]|[A-Za-z][0-9]|[a-z][A-Z]", v):
                return v
    mixed = string.ascii_letters + string.digits
    keys = [key(n, a) for n in (12, 16, 20, 32) for a in (mixed, string.ascii_lowercase + string.digits) for _ in range(25)]
    keys.append("Zx9Qw3Lk7Pv2")
    rows = [(i, f"{text[d][:300]}\nsee {k} here", True) for i, (k, d) in enumerate(zip(keys, sorted(text) * 9))]
    path = [(1000 + i, f"open /srv/{k}/readable/{'longer' * 3}/part_of_names", True) for i, k in enumerate(keys[:20])]
    clean = ["2026120300000001", "1111111111111111", "5188518586763493 and 4111-1111-1111-1111",
             "/usr/share/verylongfoldername/anotherverylongname/index", "2001-12-31T23:59:59 build20240131", "base64encode",
             "https://example.org/articles/2024/thehandontheother?q=international"]
    rows += path + [(2000 + i, c, False) for i, c in enumerate(clean)] + [
        (3000 + d, t, None) for d, t in text.items()]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r.n_markov for r in sc.scan_secrets(docs).collect()}
    caught = sum(got[i] > 0 for i, _, k in rows if k)
    wrong = [t for i, t, k in rows if k is False and got[i] > 0]
    # what is missed: keys of 12 small letters and digits with few changes between them
    assert caught >= 0.92 * (len(keys) + len(path)) and not wrong and got[len(keys) - 1] == 1, (caught, wrong)
    in_paths = [got[i] for i, _, _ in path]              # the key alone, not the path
    assert max(in_paths) == 1 and sum(in_paths) >= 0.9 * len(path)
