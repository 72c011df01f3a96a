"""Near-duplicates, line de-duplication, classifiers, pipeline: against brute force."""

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from tessera.llm import op04_quality, op09_toxicity
from tessera.llm.common import connected_components
from tessera.llm.op01_grid_join import near_duplicates
from tessera.llm.op02_simhash import fingerprint, keep_one, links, simhash_components
from tessera.llm.op09_toxicity import Lexicon, Memo, fold, hit_sum
from tessera.llm.op10_lines import dedup_lines
from tessera.session import table

CLASH = "id long, h long, words long, fp long, score double, held_out string, line string, component_id long"


def docs(spark, rows):
    extra = [f"cast(null as {c.split()[1]}) {c.split()[0]}" for c in CLASH.split(", ")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", *extra).repartition(3)


def closure(n, pairs):
    low = list(range(n))
    while True:
        new = list(low)
        for a, b in pairs:
            new[a] = new[b] = min(new[a], new[b])
        if new == low:
            return low
        low = new


def test_connected_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(50)]
    want = closure(400, pairs)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {n: want[n] for n in {x for a, b in pairs if a != b for x in (a, b)}}


def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 16))
    rows = [(i, (base[i % 12] + rng.normal(size=16) * 0.06 * (i % 5)).tolist(), i % 2) for i in range(300)]
    rows += [(400 + i, (base[0] * (i + 1)).tolist(), 0) for i in range(70)]  # one direction, many copies
    rows += [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [None] * 16, 0), (504, [], 0),
             (505, base[0].tolist(), None), (506, base[0].tolist()[:3], 0), (507, [1e300] * 16, 0), (508, [2e300] * 16, 0), (None, base[0].tolist(), 0)]
    return rows


def test_grid_join_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr(
        "*", "1L block", "2L cell", "3L n", "'x' unit").repartition(4)
    ok = [r for r in rows if r[0] is not None and r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    pairs, n = [], dict.fromkeys((r[0] for r in rows), 0)
    unit = {r[0]: np.array(r[1]) / np.abs(r[1]).max() for r in ok}
    for i, a in enumerate(ok):
        for b in ok[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = unit[a[0]], unit[b[0]]
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                    pairs.append((a[0], b[0]))
                    n[a[0]] += 1
                    n[b[0]] += 1
    low = closure(600, pairs)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(df, block=32).collect()}
    assert len(pairs) > 1000
    assert got == {v: (n[v], None if v is None else low[v], v is not None and low[v] == v) for v in n}
    assert near_duplicates(df.limit(0)).count() == 0


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_is_spark_xxhash64_majority(spark):
    for t in ["", None, "One", "Two words", "A b C", "É a b c d É a", "x y z " * 400, " \x0b "]:
        assert fingerprint(t) % (1 << 64) == brute_fingerprint(t)
    h = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_ball_links_brute_force(spark):
    rng = np.random.default_rng(2)
    seeds = [int(x) for x in rng.integers(-2**63, 2**63 - 1, 12)]
    fps = {0}
    for s in seeds:
        x = s
        for _ in range(25):
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= -(1 << 63) if b == 63 else 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    at = {f: i for i, f in enumerate(fps)}
    near = [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (1 << 64) - 1).bit_count() <= 3]
    got = links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    assert all(((r.fp ^ r.center) & (1 << 64) - 1).bit_count() <= 3 for r in got)
    assert closure(len(fps), [(at[r.fp], at[r.center]) for r in got]) == closure(len(fps), near) and near


def test_simhash_documents(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows += [(10_000, None, None, None, None), (10_001, "", "en", "a", 0), (10_001, "", "en", "a", 0), (None, " \n", "en", "a", 2), rows[0], rows[0]]
    d = docs(spark, rows)
    f = [brute_fingerprint(r[1]) for r in rows]
    low = closure(len(rows), [(i, j) for i in range(len(f)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= 3])
    group = pd.DataFrame({"g": low, "id": [r[0] for r in rows]}).groupby("g").id.min()
    want = sorted((-1 if r[0] is None else r[0], x, int(group[g])) for r, x, g in zip(rows, f, low))
    got = [(r.doc_id if r.doc_id is not None else -1, r.fp % (1 << 64), r.component_id) for r in simhash_components(d).collect()]
    assert sorted(got) == want
    kept = keep_one(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == sorted(int(x) for x in group)
    assert simhash_components(d.limit(0)).count() == 0 and keep_one(d.limit(0)).count() == 0


def brute_lines(rows, least):
    """Texts after deletion, for rows of distinct (doc_id, text)."""
    words = lambda s: len(s.encode().split())
    texts = [(d, t.split("\n")) for d, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))]
    real = [[i for i, s in enumerate(lines) if words(s)] for _, lines in texts]
    first, out = {}, {}
    for x, (d, lines) in enumerate(texts):
        own = [lines[i] for i in real[x]]
        gone = set()
        for k in range(len(own)):
            end = next((e for e in range(k, len(own)) if sum(map(words, own[k:e + 1])) >= least), None)
            if end is None:
                break
            y, j = first.setdefault(tuple(own[k:end + 1]), (x, k))
            if (y, j) == (x, k):
                continue
            there = [texts[y][1][i] for i in real[y]]
            t = k
            while t < len(own) and j + t - k < len(there) and own[t] == there[j + t - k] and (
                    t <= end or sum(map(words, own[k + 1:t + 1])) < least):
                gone.add(real[x][t])
                t += 1
        out[d] = "\n".join(s for i, s in enumerate(lines) if i not in gone)
    return out


def test_line_dedup_brute_force(spark):
    rng = np.random.default_rng(4)
    pool = [" ".join(f"w{rng.integers(0, 50)}" for _ in range(rng.integers(1, 9))) for _ in range(14)] + ["", "  "]
    rows = []
    for i in range(60):
        rows.append((i, "\n".join([*rng.choice(pool, rng.integers(0, 9)), f"own {i}", *rng.choice(pool, rng.integers(0, 9))])))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(100, f"a\n{passage}\nb"), (101, f"{passage}\nc"), (102, passage), (None, f"{passage}\nd"), (103, "")]
    rows += [(110 + i, "\n".join([*pool[:9], *pool[:9]][i:i + 9])) for i in range(9)]
    want = brute_lines(rows, 12)
    assert want[101] == "c" and want[102] == "" and passage in want[100] and want[None] == "d"
    d = docs(spark, [(*r, "en", "a", 0) for r in [*rows, rows[3]]] + [(104, None, None, None, None)])
    out = dedup_lines(d, min_words=12)
    assert out.columns == [*d.columns, "n_removed"]
    got = out.collect()
    assert len(got) == len(rows) + 2
    assert all(r.text == want.get(r.doc_id) for r in got)
    assert not any("Python" in x or "Arrow" in x or "Pandas" in x for x in [out._jdf.queryExecution().executedPlan().toString()])
    assert dedup_lines(d.limit(0)).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, e in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != e)))
        row = new
    return row


def test_lexicon_automaton_brute_force():
    entries = [("worthless", False), ("moron", False), ("disgusting", False), ("scum", False), ("lowei", True), ("schlimmer", True)]
    lex = Lexicon(entries)
    rng = np.random.default_rng(8)
    words = [e for e, _ in entries] + ["loweischaft", "schlimerkeit", "oron", "worthles", "wrthles", "", "x"]
    for e, _ in entries:
        for _ in range(60):
            w = list(e)
            for _ in range(rng.integers(0, 4)):
                k, c = int(rng.integers(0, len(w) + 1)), "abcdelmnorst"[rng.integers(0, 12)]
                w[k:k + int(rng.integers(0, 2))] = [c] if rng.random() < 0.7 else []
            words.append("".join(w))
    for w in words:
        best = []
        for e, stem in entries:
            k = op09_toxicity.allowed(e, stem)
            d = min(edits(e, w)) if stem else edits(e, w)[-1]
            if d <= k:
                best.append(d)
        assert lex.distance(w) == (min(best) if best else -1), w


def test_context_of_quotation_and_abuse():
    memo = Memo(Lexicon([("moron", False), ("idiot", False)], frozenset(["oron"])))
    assert fold("1d10t!!") == "idiot" and memo["oron"] == 0 and memo["m0ron"] == 1 and memo["moroon"] == 0.8
    abuse, quoted = hit_sum("you are a moron, you idiot", memo), hit_sum('they wrote "moron" and the word "idiot" here', memo)
    assert abuse > 2 > 1 > quoted > 0 and hit_sum(None, memo) == hit_sum("clean", memo) == 0


def test_misspellings_of_learnt_entries(spark):
    rng = np.random.default_rng(6)
    filler = [a + b + c for a in ("ba", "do", "gi", "lu") for b in ("ner", "mat", "vol") for c in ("ta", "ke", "so")]
    near = "crown flown blown brown clowd".split()  # clean words around "clown"
    bad = ["idiot", "idiots", "idiotic", "grubscher", "grubschig", "grubsch", "clown", "worthless"]

    def text(words):
        return " ".join(x for w in words for x in (*rng.choice(filler, 3), w, *rng.choice(filler, 3)))

    rows = [(i, text(rng.permutation(bad if i % 2 else near * 2)), "en", "a", 0) for i in range(160)]
    lab = spark.createDataFrame([(i, i % 2) for i in range(160)], "doc_id long, toxic int")
    d = docs(spark, rows)
    model = op09_toxicity.train(d, lab)
    assert {(w, False) for w in bad} <= set(model["entries"]) and any(stem for _, stem in model["entries"])
    assert set(near) - {"clowd"} <= set(model["blocked"]) | {w for w in near if min(edits("clown", w)[-1:]) > 1}
    lex = Lexicon(model["entries"], frozenset(model["blocked"]))
    typos = {}
    for e, stem in model["entries"]:
        if len(e) >= 5:
            typos[e, stem] = [w for k in range(1, len(e) - 1) for w in (e[:k] + "x" + e[k + 1:], e[:k] + e[k] + e[k:])]
            assert all(lex.strength(w + "ung" * stem) >= 0.8 for w in typos[e, stem]), (e, stem)
    assert all(lex.strength(w) == 0 for w in near)
    odd = [(1000 + i, text(["you", *rng.choice(w, 4)]), "en", "a", 0) for i, w in enumerate(typos.values())]
    out = {r.doc_id: r.predicted for r in op09_toxicity.classify(docs(spark, rows + odd), lab).collect()}
    assert all(out[r[0]] == (r[0] >= 1000 or r[0] % 2) for r in rows + odd)


def test_letter_runs_inside_tokens():
    memo = Memo(Lexicon([("moron", False), ("idiot", False), ("stupid", False), ("loser", False), ("clown", False), ("大笨蛋", False)],
                        frozenset(["oron"])))
    for token, n in (("you,idiot", 1), ("moron/clown", 2), ("stupid...loser", 2), ("idiot-like", 1), ("stop.Idiot!", 1), ("you,1d10t", 1),
                     ("stupid2you", 1), ("i.d.i.o.t", 1), ("oh,m0ron/cl0wn", 2), ("你是一个大笨蛋。你是大笨蛋", 2), ("you" * 20 + "idiot" + "and" * 9, 1),
                     ("moron", 1), ("calm,words", 0), ("oh,oron", 0), ("x" * 500, 0), ("...", 0), ("12:30", 0)):
        assert memo[token] == n, token
    assert memo["oh,moroon"] == 0.8
    assert hit_sum("well you,idiot", memo) == hit_sum("well you, idiot", memo) == op09_toxicity.ADDRESSED


@pytest.mark.parametrize("op,label,columns", [(op04_quality, "quality", 3), (op09_toxicity, "toxic", 5)])
def test_classifier_edges(spark, op, label, columns):
    good, bad = "calm words of a plain text here", "you moron idiot you stupid moron ### $$$ !!!"
    rows = [(i, f"{bad if i % 2 else good} nr{i}", "en", "a", 0) for i in range(60)]
    rows += [(None, None, None, None, None), (900, "", "en", "a", 0), (900, "", "en", "a", 0), (901, "w " * 40_000, "en", "a", 0)]
    d = docs(spark, rows)
    lab = spark.createDataFrame([(i, int((i % 2) == (label == "toxic"))) for i in range(60)] + [(None, 1), (3, None), (700, 7)],
                                f"doc_id long, {label} int").selectExpr("*", "'x' y", "1 text")
    out = {(-1 if r.doc_id is None else r.doc_id): r for r in op.classify(d, lab).collect()}
    assert len(out) == 63 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    assert all(out[i].predicted == int((i % 2) == (label == "toxic")) for i in range(60))
    import zlib
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % columns == (1 if columns == 3 else 0)) for i, r in out.items() if i >= 0)
    assert op.classify(d, lab.limit(0)).count() == len(rows) and op.classify(d.limit(0), lab).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lab = table(spark, sf, "labels")
    for op, label, least in ((op04_quality, "quality", 0.97), (op09_toxicity, "toxic", 0.93)):
        out = op.classify(table(spark, sf, "documents"), lab).where("held_out").join(lab, "doc_id")
        assert out.select(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least


def test_pipeline_stages(spark, tmp_path):
    d = table(spark, SMALL, "documents")
    schema = d.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d, SMALL).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == schema
            assert out.count() <= d.count() and (name != "repeated_passages" or out.count() == d.count())
            assert out.dropDuplicates(["doc_id"]).count() == out.count()
        else:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in d.collect()}
        d = out
    assert corpus_pipeline.run(spark, SMALL).agg(F.sum("length")).first()[0] == d.agg(F.sum("length")).first()[0]


def test_formulaic_abuse_is_learnt(spark):
    bad, good = "you are a moron and an idiot they said", "some calm words of a plain text here and there"
    rows = [(i, f"{bad if i % 2 else good} number {i}", "en", "a", 0) for i in range(600)]
    # rare words of a near-copied toxic text that an entry explains already are not entries
    rows += [(1000 + i, f"the moron of zanzibar quarrelled with seventeen velvet lampposts part {i}", "en", "a", 0) for i in range(0, 60)]
    lab = spark.createDataFrame([(r[0], int(r[0] % 2 or r[0] >= 1000)) for r in rows], "doc_id long, toxic int")
    d = docs(spark, rows)
    out = {r.doc_id: r.predicted for r in op09_toxicity.classify(d, lab).collect()}
    assert all(out[i] == (i % 2 or i >= 1000) for i in out)
    words = {w for w, _ in op09_toxicity.train(d, lab)["entries"]}
    assert {"moron", "idiot"} <= words and "number" not in words


def test_sample_is_bounded_for_repeated_ids(spark):
    from tessera.llm.labelled import labelled_sample
    d = docs(spark, [(i % 7, f"text {i}", "en", "a", 0) for i in range(500)] + [(1, "text 1", "en", "a", 0)] * 50)
    lab = spark.createDataFrame([(i, int(i % 2)) for i in range(7)], "doc_id long, toxic int")
    got = labelled_sample(d, lab, "toxic", 1, 5, 10).collect()
    assert sorted(r.y for r in got) == [0] * 10 + [1] * 10 and len({(r.doc_id, r.text) for r in got}) == 20


def test_hits_along_runs_and_wide_quotation():
    memo = Memo(Lexicon([("ass", False), ("moron", False), ("笨蛋", False)], frozenset(["moronic"])))
    assert memo["classassessmentpassagemassassignmentgrassembassy"] == 0
    assert memo["x" * 40 + "moron"] == 1 and memo["x" * 40 + "moronic"] == 0
    assert hit_sum("他说「你是笨蛋」。", memo) == hit_sum("他说《你是笨蛋》吧", memo) == op09_toxicity.QUOTED
    assert hit_sum("他是笨蛋。", memo) == 1
    quiet = Memo(memo.lexicon, reporting=frozenset(["quoth"]), address=frozenset())
    assert hit_sum("you moron", quiet) == 1 and hit_sum("quoth he moron", quiet) == op09_toxicity.REPORTED


def brute_hits(text, entries, blocked):
    """Summed weights of plain words by edit distances to every entry, one by one."""
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    total, words = 0.0, text.split()
    for i, w in enumerate(words):
        found = []
        for e, stem in entries:
            ends = range(len(w) + 1) if stem else [len(w)]
            k = min(distance(w[:j], e) for j in ends)
            if k <= op09_toxicity.allowed(e, stem):
                found.append(k)
        d = min(found, default=-1)
        if len(w) >= 3 and d >= 0 and not (d and w in blocked):
            near = words[max(0, i - 6):i + 7]
            factor = op09_toxicity.REPORTED if any(x in op09_toxicity.REPORTING for x in words[max(0, i - 6):i]) else \
                op09_toxicity.ADDRESSED if any(x in op09_toxicity.ADDRESS for x in near) else 1.0
            total += (1.0, 0.8, 0.6)[d] * factor
    return total


def test_toxicity_score_brute_force():
    rng = np.random.default_rng(11)
    entries = [("moron", False), ("idiot", False), ("scum", False), ("worthless", True), ("nincompoopery", False), ("trash", True)]
    blocked = frozenset(["idiom", "crash"])
    memo = Memo(Lexicon(entries, blocked))
    plain = ["you", "said", "idiom", "crash", "the", "trashes", "wordless", "of", "calm", "worthlessness", "scam"]
    for _ in range(150):
        words = []
        for _ in range(25):
            w = [*plain, *(e for e, _ in entries)][int(rng.integers(len(plain) + len(entries)))]
            for _ in range(int(rng.integers(0, 3))):
                k, c = int(rng.integers(len(w))), "abeorst"[int(rng.integers(7))]
                w = (w[:k] + c + w[k:], w[:k] + w[k + 1:], w[:k] + c + w[k + 1:])[int(rng.integers(3))] or w
            words.append(w)
        assert hit_sum(" ".join(words), memo) == pytest.approx(brute_hits(" ".join(words), entries, blocked))


def test_lines_that_stood_apart_stay(spark):
    """Only lines that stood together earlier are a passage."""
    ten = [" ".join(f"a{i}b{k}" for k in range(10)) for i in range(6)]
    rows = [(i, f"{s}\nown line {i}") for i, s in enumerate(ten)] + [(9, "\n".join(ten)), (10, "x\n" + "\n\n".join(ten) + "\ny"), (11, "\n".join(ten[:4]))]
    got = {r.doc_id: r.text for r in dedup_lines(docs(spark, [(*r, "en", "a", 0) for r in rows])).collect()}
    assert got[9] == "\n".join(ten) and got[10] == "x\n\n\n\n\n\ny" and got[11] == "\n".join(ten[:4])
    # the short line after the last whole window of a run goes with it
    long = " ".join(f"l{k}" for k in range(60))
    two = {r.doc_id: r.text for r in dedup_lines(docs(spark, [(1, f"{long}\nshort end\nz", "", "", 0), (2, f"q\n{long}\nshort end\nk", "", "", 0)])).collect()}
    assert two == {1: f"{long}\nshort end\nz", 2: "q\nk"}
