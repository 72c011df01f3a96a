"""Fingerprints, spelling variants, ranked search: against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from conftest import SMALL
from tessera.llm import op11_spotsigs, op12_spelling, op13_ranked_search
from tessera.llm.op11_spotsigs import ANCHORS, classes, fingerprints, near_pairs
from tessera.llm.op12_spelling import bigrams, cheapest_disjoint, near_words, variants
from tessera.llm.op13_ranked_search import Items, Tree, saturation, search
from tessera.session import table

CLASH = "word string, n long, sigs string, bucket long, hash long, terms string, tf long, score double, rank string, item_id string, at long, ghost string"
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def docs(spark, rows):
    """documents plus columns named like the operators' own."""
    extra = [f"cast(null as {c.split()[1]}) {c.split()[0]}" for c in CLASH.split(", ")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return d.selectExpr("*", *extra).repartition(3)


def rows_of(pairs):
    return [(d, t, "en", "a", None if t is None else len(t)) for d, t in pairs]


def small(spark):
    return [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]


# fingerprints -------------------------------------------------------------

def brute_signatures(text):
    words = regex.findall(r"[\p{L}\p{N}\p{M}]+", text.lower())
    common, out, since = set(ANCHORS), set(), 8
    for i, w in enumerate(words):
        since = 0 if w in common else since
        if w in common or since >= 8:
            after = [x for x in words[i + 1:i + 9] if x not in common][:2]
            if len(after) == 2:
                out.add((w, *after))
        since += 1
    return out or {text}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def expect(pairs):
    """Rows in brute force; ids unique."""
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0), reverse=True)
    for k, (d, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        s, e, n = map(brute_signatures, (t, edited, after))
        yield d, (len(t), hashlib.sha256(edited.encode()).hexdigest(), 16 * len(s), 16 * len(e),
                  round(jaccard(s, e), 9), round(jaccard(s, n), 9))


def got_fingerprints(df):
    return [(r.doc_id, (r.n_chars, r.edited_sha256, len(r.fingerprint), len(r.edited_fingerprint),
                        round(r.near_edited, 9), round(r.near_next, 9))) for r in df.collect()]


ODD = [(3, None), (4, ""), (5, " "), (6, "the"), (7, "the cat"), (8, "of cats and dogs and a bird in the tree " * 2000),
       (9, "日本語 テスト 한국어 हिन्दी " * 9), (10, "one two three four five six seven eight nine ten eleven twelve of a"),
       (-5, "the the the the the the the the the the cat sat"), (2**62, "x" * 50_000), (11, "😀 the 😀 é of è à"), (None, "the last one here")]


def test_fingerprints_brute_force(spark):
    pairs = [(d, t) for d, t in small(spark)] + [(10_000 + (d or 0) if d != 2**62 else d, t) for d, t in ODD if d is not None] + [(None, "the last one here")]
    got = fingerprints(docs(spark, rows_of(pairs)))
    assert sorted(got_fingerprints(got), key=str) == sorted(expect(pairs), key=str)
    own = defaultdict(set)
    for r in got.select("doc_id", "fingerprint").collect():
        own[dict(pairs)[r.doc_id] or ""].add(r.fingerprint)
    assert all(len(f) == 1 for f in own.values())


def test_fingerprints_few_rows(spark):
    for pairs in ([(1, "the cat sat here")], [(None, None)], [(2, "a"), (1, "b")]):
        assert got_fingerprints(fingerprints(docs(spark, rows_of(pairs)))) == list(expect(pairs))
    assert fingerprints(docs(spark, [])).count() == 0


def test_fingerprints_repeated_rows(spark):
    text = "the cat sat on the mat with a small dog"
    got = fingerprints(docs(spark, rows_of([(1, text), (2, text), (2, text), (2, "of another kind entirely here"), (None, text)])))
    rows = got_fingerprints(got)
    assert Counter(d for d, _ in rows) == {1: 1, 2: 3, None: 1}
    # of the rows of id 2 one copy is followed by the other, whatever the order of the two texts
    assert sum(r[1][5] == 1.0 for r in rows if r[0] == 2) >= 1


def test_near_pairs_brute_force(spark):
    rng = np.random.default_rng(3)
    sets = {}
    for k in range(240):
        base = sets[k - 1 - int(rng.integers(0, min(k, 6)))] if k % 3 and k else None
        if base is None:
            sets[k] = {int(x) for x in rng.integers(0, 4000, rng.integers(1, 40))} | {5, 6}
        else:
            drop = set(rng.choice(sorted(base), int(rng.integers(0, 1 + len(base) // 5)), replace=False).tolist())
            sets[k] = (base - drop) | {int(x) for x in rng.integers(0, 4000, rng.integers(0, 3))} or {1}
    df = spark.createDataFrame([(k, sorted(s), 1, 2) for k, s in sets.items()], "key long, sigs array<long>, size int, part int")
    for threshold in (0.8, 0.5):
        want = {(a, b): round(jaccard(sets[a], sets[b]), 9) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= threshold}
        got = {(r.a, r.b): round(r.similarity, 9) for r in near_pairs(df, threshold=threshold).collect()}
        assert got == want and len(want) > 20


def test_classes_collapse_copies(spark):
    text = "the cat sat on the mat with a small dog that was in the house"
    pairs = [(k, text) for k in range(50)] + [(100, text + " of them now here"), (101, "un chat est dans la maison grise avec des souris")]
    sets, of = classes(docs(spark, rows_of(pairs)))
    assert sets.count() == 3 and of.count() == 52
    assert near_pairs(sets, "class_id", "sigs", 0.5).count() == 1


def test_anchors_are_parameters(spark):
    d = spark.createDataFrame([(1, "zig one two zag three four")], "doc_id long, text string")
    assert len(fingerprints(d, anchors=("zig", "zag")).first().fingerprint) == 32


# spelling variants ----------------------------------------------------------

def brute_variants(pairs, noise=97, min_length=5, min_count=3):
    n = Counter()
    for d, t in pairs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(UPPER)):
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    v = {w: k for w, k in n.items() if k >= min_count and len(w) >= min_length}
    near = {w: {x for x in v if one_edit(w, x)} for w in v}
    form = {}
    for w in v:
        top = min(near[w], key=lambda x: (-v[x], x), default=None)
        if top and v[top] >= 2 * v[w]:
            form[w] = top

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (form.get(w), root(w), v[w], len(near[w]), v.get(form.get(w))) for w in v}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def got_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_brute_force(spark):
    rng = np.random.default_rng(1)
    words = ["hello", "world", "spelling", "éàèùâ", "aaaaaa", "abababab", "ÀÉÎÕÜß", "Colour", "color", "colour"]
    pairs = [(None, "hello Hello hEllo"), (0, None), (1, ""), (2, "12 -- ??"), (3, "aaaaaa " * 30_000), (3, "aaaaaa " * 30_000), (4, "ŠkodaŠ hello日world")]
    for d in range(5, 60):
        out = []
        for _ in range(60):
            w = words[int(rng.integers(len(words)))]
            for _ in range(int(rng.integers(0, 3))):
                k, c = int(rng.integers(len(w))), "abcolà"[int(rng.integers(6))]
                w = (w[:k] + c + w[k:], w[:k] + w[k + 1:], w[:k] + c + w[k + 1:])[int(rng.integers(3))] or w
            out.append(w)
        pairs.append((d, " ".join(out)))
    want = brute_variants(pairs)
    got = got_variants(variants(docs(spark, rows_of(pairs))))
    assert got == want
    assert len(want) > 100 and any(v[0] for v in want.values()) and any(v[0] and v[1] != v[0] for v in want.values())
    assert variants(docs(spark, [])).count() == 0


def test_variants_small_table(spark):
    pairs = small(spark)
    assert got_variants(variants(docs(spark, rows_of(pairs)))) == brute_variants(pairs)


def test_every_single_edit_is_found(spark):
    rng = np.random.default_rng(7)
    words = {"".join(rng.choice(list("abc"), int(rng.integers(4, 9)))) for _ in range(700)}
    df = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    want = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    assert {(r.a, r.b) for r in near_words(df).collect()} == want and len(want) > 500


def test_pivots():
    assert bigrams("abcd") == ["ab", "bc", "cd"]
    rng = np.random.default_rng(0)
    for _ in range(300):
        places = [(int(p), int(rng.integers(1, 9))) for p in sorted(rng.choice(12, int(rng.integers(3, 7)), replace=False))]
        got = cheapest_disjoint(places, 2)
        cost = dict(places)
        want = min(cost[a] + cost[b] for a in cost for b in cost if b - a >= 2)
        assert got[1] - got[0] >= 2 and cost[got[0]] + cost[got[1]] == want


# ranked search --------------------------------------------------------------

def brute_search(documents, items, top=10):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
    d = [(i, Counter(terms(t))) for i, t in documents]
    n_docs, total = sum(bool(c) for _, c in d), sum(sum(c.values()) for _, c in d)
    df = Counter(t for _, c in d for t in c)
    of = defaultdict(set)
    for i, t in items:
        of[i] |= set(terms(t))
    out = set()
    for item, asked in of.items():
        scored = []
        for i, c in d:
            m = 10 + (90 * sum(c.values()) * n_docs) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in asked if t in c)
            if s > 0:
                scored.append((-s, i is None, i if i is not None else 0))
        out |= {(item, k + 1, None if nil else i, -s) for k, (s, nil, i) in enumerate(sorted(scored)[:top])}
    return out


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1L rank", "'x' term", "2.5 score", "9 doc_id")


def got_search(df):
    return {(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()}


def test_search_brute_force(spark):
    rng = np.random.default_rng(4)
    names = [f"w{k}" for k in range(60)] + ["Éa", "日本", "X-ray", "a_b"]
    odds = 1 / np.arange(1, len(names) + 1)
    def text(n):
        return " ".join(rng.choice(names, n, p=odds / odds.sum()))
    documents = [(k, text(int(rng.integers(0, 40)))) for k in range(300)]
    documents += [(1000 + k, "w1 w2 w3, w7!") for k in range(40)] + [(None, "w1 w2 w3 w50"), (None, None), (7, "w1 w2 w3 w50"), (7, "w1 w2 w3 w50"), (8, ""), (9, "w9 " * 40_000)]
    asked = [(k, text(int(rng.integers(1, 9)))) for k in range(25)] + [(100, "w1 w2 w3 w7"), (101, None), (102, ""), (103, "unknown"), (None, "w50 w3"), (100, "w50"), (5, "w5")]
    want = brute_search(documents, asked)
    d, q = docs(spark, rows_of(documents)), items_of(spark, asked)
    assert got_search(search(d, q)) == want and len(want) > 200
    assert got_search(search(d, q, block=8)) == want
    assert got_search(search(d, q, top=3)) == {r for r in want if r[1] <= 3}
    assert search(d.limit(0), q).count() == 0 and search(d, q.limit(0)).count() == 0
    assert search(docs(spark, rows_of([(1, "..."), (2, None)])), q).count() == 0


def test_search_lots_and_seeds(spark, monkeypatch):
    documents, asked = small(spark), [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    want = brute_search(documents, asked)
    for lot, seeds in ((7, 1), (64, 3), (100_000, 10**9)):
        monkeypatch.setattr(op13_ranked_search, "LOT_DOCS", lot)
        monkeypatch.setattr(op13_ranked_search, "SEEDS", seeds)
        assert got_search(search(docs(spark, rows_of(documents)), items_of(spark, asked))) == want


def test_tree_bounds_hold():
    """Every node's maxima and minimum bound the vectors below it, and equal beginnings share a path."""
    rng = np.random.default_rng(9)
    vectors = []
    for k in range(400):
        t = np.unique(np.minimum(rng.geometric(0.08, int(rng.integers(1, 30))) - 1, 79)).astype(np.int32)
        vectors.append((t, rng.integers(1, 9, len(t)), int(rng.integers(10, 300)), [k]))
    tree, w = Tree(vectors, leaf=4), rng.integers(0, 900, 80)
    assert sum(hi - lo for k, (lo, hi) in enumerate(tree.range) if not tree.children[k]) == 400
    for k, (lo, hi) in enumerate(tree.range):
        most = dict(zip(tree.terms[k].tolist(), tree.tf[k].tolist()))
        for t, f, m, _ in tree.vectors[lo:hi]:
            assert m >= tree.m[k] and all(f[i] <= most[int(x)] for i, x in enumerate(t))
    items = [np.unique(rng.integers(0, 80, 6)) for _ in range(30)]
    found = tree.search(Items(items), w, 5, np.zeros(30, np.int64))
    for asked, got in zip(items, found):
        dense = []
        for t, f, m, ids in vectors:
            s = sum(int(w[x]) * int(saturation(f, m)[i]) for i, x in enumerate(t) if x in asked)
            dense.append((s, -ids[0]))
        assert sorted(got, reverse=True) == [x for x in sorted(dense, reverse=True)[:5] if x[0] > 0]


@pytest.mark.parametrize("module", [op11_spotsigs])
def test_native_module_has_no_python_on_executors(module):
    source = open(module.__file__).read()
    assert not re.search(r"pandas|arrow|udf|rdd|mapIn", source, re.I)
