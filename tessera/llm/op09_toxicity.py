"""Toxicity: Levenshtein automata intersected with a lexicon trie.

The lexicon is learnt from a bounded labelled sample: words, and stems of
inflected families, far commoner in toxic documents than chance allows.  Its
trie and the Levenshtein automaton of the text word are run together; their
product is determinised lazily, so each word costs a table look-up a letter and
misspellings are found without trying each entry.  A misspelling does not count if
it is itself a word of the sample's clean documents.

A token is scored as one word (what stands between its letters left out) and by its
runs of letters, as the lexicon is learnt; the greater counts.  Runs of over
LONGEST letters, and those in scripts without blanks, are searched for entries
as they are spelt at every place, since nothing shows where their words begin;
there short entries don't count, nor those inside a longer clean word.

A hit's weight depends on its context: inside quotation marks or shortly after
a reporting word it counts less, next to a form of address more.
The score is a logistic function of the summed weights, fitted on the sample
with a pull towards a fixed prior (about two plain hits: 0.5).
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns, id_bucket
from tessera.llm.labelled import labelled_sample

PER_CLASS = 6000
STEM_MIN, STEM_MAX = 4, 8
PRIOR = (-3.67, 4.0)  # intercept and weight of log(1 + summed hits)
WINDOW = 6
LONGEST, LEAST_ALONG = 40, 5
QUOTED, REPORTED, ADDRESSED = 0.35, 0.5, 1.25

# Characters that commonly stand for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
LETTERS = re.compile(r"[^\W\d_]+")
# Thai, Lao, Myanmar, Khmer, kana, Han
NO_BLANKS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff]")
EDGES = "!?.,;:#$%&*()[]{}<>|'\"“”„«»‘’‹›「」『』《》。，！？；：、-_+=~^`/\\"
OPENING = ('"', "“", "„", "«", "‘", "‹", "「", "『", "《")
CLOSING = ('"', "”", "“", "»", "’", "›", "」", "』", "》")
WIDE_OPENING, WIDE_CLOSING = re.compile("[「『《]"), re.compile("[」』》]")
# Defaults of parameters: words that report speech and forms of address in four languages.
REPORTING = frozenset("said says wrote called quote quoted term word dit écrit sagte schrieb wort dijo escribió palabra".split())
ADDRESS = frozenset("you your youre u tu toi vous du dich dir ihr usted vosotros".split())


def fold(token: str) -> str:
    """Lower-case letters of a token, look-alikes between letters replaced."""
    t = token.lower()
    if not t.isalpha():
        core = t.strip(EDGES)
        if not core.isalpha():
            core = "".join(c for c in core.translate(LOOKALIKES) if c.isalpha()) if any(map(str.isalpha, core)) else ""
        t = core
    return t


def runs(token: str) -> list[list[str]]:
    """Runs of letters of a token: as they stand, and with look-alikes replaced."""
    core = token.lower().strip(EDGES)
    plain, replaced = LETTERS.findall(core), LETTERS.findall(core.translate(LOOKALIKES))
    return [plain] if plain == replaced else [plain, replaced]


def among(token: str, words: frozenset[str]) -> bool:
    """Whether a token, or a run of two letters or more in it, is one of the words."""
    return fold(token) in words or any(len(r) > 1 and r in words for x in runs(token) for r in x)


def allowed(entry: str, stem: bool) -> int:
    """Edits allowed for an entry: none under five letters, one in stems."""
    n = len(entry)
    return 0 if n < 5 else 1 if stem or n < 10 else 2


class Lexicon:
    """Lexicon trie x Levenshtein automaton, determinised as words need it."""

    def __init__(self, entries: list[tuple[str, bool]], blocked: frozenset[str] = frozenset()):
        self.blocked = blocked
        # trie nodes: children, and (edits allowed) of an entry or stem ending there
        self.children: list[dict[str, int]] = [{}]
        self.word_end: dict[int, int] = {}
        self.stem_end: dict[int, int] = {}
        self.most: list[int] = [0]  # edits allowed to any entry below
        for entry, stem in entries:
            k, node = allowed(entry, stem), 0
            self.most[0] = max(self.most[0], k)
            for c in entry:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], k)
            (self.stem_end if stem else self.word_end)[node] = k
        self.states: list[tuple] = []
        self.number: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _close(self, items) -> frozenset:
        """Add letters of the lexicon that the word leaves out."""
        best: dict[int, int] = {}
        stack = list(items)
        while stack:
            node, e = stack.pop()
            if e > self.most[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            stack.extend((child, e + 1) for child in self.children[node].values())
        return frozenset(best.items())

    def _state(self, items) -> int:
        closed = self._close(items)
        if closed not in self.number:
            self.number[closed] = len(self.states)
            words = [e for node, e in closed if node in self.word_end and e <= self.word_end[node]]
            stems = [e for node, e in closed if node in self.stem_end and e <= self.stem_end[node]]
            self.states.append((closed, min(words, default=-1), min(stems, default=-1)))
            self.moves.append({})
        return self.number[closed]

    def _step(self, state: int, c: str) -> int:
        out = []
        for node, e in self.states[state][0]:
            out.append((node, e + 1))  # an extra letter
            for d, child in self.children[node].items():
                out.append((child, e if c == d else e + 1))
        to = self.moves[state][c] = self._state(out)
        return to

    def distance(self, word: str) -> int:
        """Fewest edits to an entry within its bound, or of a beginning of
        the word to a stem; -1 if none."""
        state, best = self.start, -1
        for c in word:
            to = self.moves[state].get(c)
            state = self._step(state, c) if to is None else to
            items, _, stem = self.states[state]
            if stem == 0:
                return 0
            if stem > 0 and (best < 0 or stem < best):
                best = stem
            if not items:
                return best
        end = self.states[state][1]
        return end if end >= 0 and (best < 0 or end < best) else best

    def along(self, run: str) -> float:
        """Entries spelt out in a run, the longest at each place, none
        overlapping: two letters or more in scripts without blanks, LEAST_ALONG in
        others, and not within a longer clean word that begins there."""
        total, at = 0.0, 0
        while at < len(run):
            node, end = 0, 0
            for i in range(at, len(run)):
                if (node := self.children[node].get(run[i])) is None:
                    break
                if node in self.word_end or node in self.stem_end:
                    end = i + 1
            if end and end - at < (2 if NO_BLANKS.match(run[at]) else LEAST_ALONG):
                end = 0
            clean = next((k for k in range(min(len(run), at + LONGEST), end, -1) if run[at:k] in self.blocked), 0) if end else 0
            total += end > 0 and not clean
            at = max(end, clean) or at + 1
        return total

    def word_strength(self, word: str) -> float:
        if len(word) < 3 or len(word) > LONGEST:
            return 0.0
        d = self.distance(word)
        return 0.0 if d < 0 or d and word in self.blocked else (1.0, 0.8, 0.6)[min(d, 2)]

    def run_strength(self, run: str) -> float:
        if len(run) > LONGEST or not run.isascii() and NO_BLANKS.search(run):
            return max(self.along(run), self.word_strength(run))
        return self.word_strength(run)

    def strength(self, token: str) -> float:
        word = fold(token)
        best = self.run_strength(word) if word.isalpha() and token.lower().strip(EDGES) == word else self.word_strength(word)
        if word and token.lower().strip(EDGES) != word:
            best = max(best, *(sum(map(self.run_strength, x)) for x in runs(token)))
        return best


class Memo(dict):
    """Strength of tokens met; emptied when large."""

    def __init__(self, lexicon: Lexicon, reporting: frozenset[str] = REPORTING, address: frozenset[str] = ADDRESS):
        super().__init__()
        self.lexicon, self.reporting, self.address = lexicon, reporting, address

    def __missing__(self, token: str) -> float:
        if len(self) > 400_000:
            self.clear()
        out = self[token] = self.lexicon.strength(token)
        return out


def context(tokens: list[str], i: int, reporting: frozenset[str] = REPORTING, address: frozenset[str] = ADDRESS) -> float:
    """Factor of a hit at token i."""
    near = tokens[max(0, i - WINDOW):i + WINDOW + 1]
    before = tokens[max(0, i - WINDOW):i]
    opened = tokens[i].startswith(OPENING)
    for t in before:
        opened = True if t.startswith(OPENING) and not t[1:].endswith(CLOSING) else False if t.endswith(CLOSING) else opened
    opened = opened or tokens[i].startswith(OPENING)
    factor = 1.0
    if opened and any(t.rstrip(".,;:!?").endswith(CLOSING) for t in tokens[i:i + WINDOW + 1]):
        factor = QUOTED
    elif any(among(t, reporting) for t in before):
        factor = REPORTED
    if factor == 1.0 and any(among(t, address) for t in near):
        factor = ADDRESSED
    return factor


def hit_sum(text: str | None, memo: Memo) -> float:
    tokens = WIDE_CLOSING.sub(r"\g<0> ", WIDE_OPENING.sub(r" \g<0>", text or "")).split()
    strength = list(map(memo.__getitem__, tokens))
    if not any(strength):
        return 0.0
    return sum(s * context(tokens, i, memo.reporting, memo.address) for i, s in enumerate(strength) if s)


def _words(sample: DataFrame) -> DataFrame:
    """(y, doc, word, around) of the sample's words of 3 to 40 letters; equal texts are one document."""
    words = sample.select("y", F.xxhash64("text").alias("doc"), F.regexp_extract_all(
        F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}+"), F.lit(0)).alias("t")).where("size(t) > 0")
    words = words.select("y", "doc", F.explode(F.transform(F.sequence(F.lit(0), F.size("t") - 1), lambda i: F.struct(
        F.get("t", i).alias("word"), F.xxhash64(F.get("t", i - 1), F.get("t", i + 1)).alias("around")))).alias("w"))
    return words.where("length(w.word) between 3 and 40").select("y", "doc", "w.*")


def _by_class(found: DataFrame) -> DataFrame:
    return found.groupBy("word").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))


def _least(counts: DataFrame, share: float) -> int:
    """Toxic occurrences that chance does not give any of the words tried."""
    total = counts.where("pos > 0").count()
    return max(3, math.ceil(math.log(20.0 * max(total, 1)) / -math.log(share)))


def learn_lexicon(sample: DataFrame) -> tuple[list[tuple[str, bool]], list[str]]:
    """Entries (text, is a stem) and clean words near them, from (text, y) rows.

    Words are counted by distinct contexts (the words before and after), so that
    copies of one document count once.  An entry's contexts must lie in toxic
    documents more than chance allows over all words tried: p ** toxic <
    1 / (20 * candidates), clean ones a twentieth at most.  A stem is a word
    beginning shared by three or more words, none with over half of its
    contexts, lengthened while it keeps 95 of 100 of them.  Words of a family are entries
    beside their stem: their misspellings are found by the whole word too.

    Formulaic abuse has few contexts.  Toxic documents that hold no entry so far
    are counted again by distinct texts, under the same two rules against all clean ones.
    """
    n = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1):
        return [], []
    share = n[1] / (n[1] + n.get(0, 0) + 1)
    counts = _by_class(_words(sample).select("y", "word", "around").distinct())
    least = _least(counts, share)
    strong = F.col("neg") * 20 <= F.col("pos")
    single = counts.where(strong & (F.col("pos") >= least)).select("word", "pos").collect()
    stems = (counts.select("pos", "neg", "word", F.explode(F.expr(
                f"transform(sequence({STEM_MIN}, least({STEM_MAX}, length(word) - 1)), k -> substring(word, 1, k))"
             )).alias("stem")).where(f"length(word) > {STEM_MIN}")
             .groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                                  F.sum((F.col("pos") > 0).cast("int")).alias("forms"), F.max("pos").alias("top"))
             .where(strong & (F.col("pos") >= least) & (F.col("forms") >= 3) & (F.col("top") * 2 <= F.col("pos"))).collect())
    weight = {r.stem: r.pos for r in stems}
    chosen: list[str] = []
    for s in sorted(weight, key=lambda x: (len(x), x)):
        if any(s.startswith(c[:STEM_MIN]) and weight.get(c, 0) and s.startswith(c) for c in chosen):
            continue
        while True:
            longer = [t for t in weight if len(t) == len(s) + 1 and t.startswith(s) and weight[t] >= 0.95 * weight[s]]
            if not longer:
                break
            s = longer[0]
        if s not in chosen:
            chosen.append(s)
    entries = [(s, True) for s in chosen]
    entries += [(r.word, False) for r in single]
    clean = near_clean(counts, entries)

    unexplained = sample.where("y = 1")
    if entries:
        unexplained = unexplained.where(hits_column({"entries": sorted(entries), "blocked": clean})("text") == 0)
    rest = _by_class(_words(unexplained.select("y", "text").unionByName(sample.where("y = 0").select("y", "text")))
                     .select("y", "word", "doc").distinct())
    formulaic = rest.where(strong & (F.col("pos") >= _least(rest, share))).select("word").collect()
    if formulaic:
        entries = sorted({*entries, *((r.word, False) for r in formulaic)})
        clean = near_clean(counts, entries)
    return sorted(entries), clean


def near_clean(counts: DataFrame, entries: list[tuple[str, bool]]) -> list[str]:
    """Words of clean documents that would count as misspellings of an entry."""
    lexicon = Lexicon(sorted(entries))

    @F.pandas_udf("boolean")
    def near(word: pd.Series) -> pd.Series:
        return pd.Series([lexicon.distance(w) > 0 for w in word], dtype="bool")

    return sorted(r.word for r in counts.where("neg > 0").where(near("word")).select("word").collect())


def fit_logistic(x: np.ndarray, y: np.ndarray, prior=PRIOR, pull: float = 5.0) -> tuple[float, float]:
    """Intercept and weight of a logistic model, pulled towards the prior."""
    p = np.array(prior, np.float64)
    beta, a = p.copy(), np.column_stack((np.ones(len(x)), x))
    for _ in range(50):
        mu = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (mu - y) + pull * (beta - p)
        step = np.linalg.solve((a * (mu * (1 - mu))[:, None]).T @ a + pull * np.eye(2), grad)
        beta = beta - step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
          mod: int = 5, held_out: int = 0, per_class: int = PER_CLASS, reporting: frozenset[str] = REPORTING,
          address: frozenset[str] = ADDRESS) -> dict:
    """Model (entries, blocked, intercept, weight) from a bounded sample.
    ``reporting`` and ``address`` are lower-case words that lessen or raise a hit near them."""
    sample = labelled_sample(docs, labels, label, mod, held_out, per_class, doc_id, text)
    entries, blocked = learn_lexicon(sample)
    model = {"entries": entries, "blocked": blocked, "beta": PRIOR, "reporting": reporting, "address": address}
    if entries:
        got = sample.select(hits_column(model)("text").alias("x"), "y").collect()  # at most 2 * per_class numbers
        x, y = np.log1p([r.x for r in got]), np.array([r.y for r in got], np.float64)
        model["beta"] = fit_logistic(x, y)
    return model


_LOADED: dict = {}


def hits_column(model: dict):
    """Summed hit weights as a function of a text column; the lexicon (bounded
    by the sample it is learnt from) travels with the function."""
    entries, blocked = model["entries"], frozenset(model["blocked"])
    reporting, address = model.get("reporting", REPORTING), model.get("address", ADDRESS)

    @F.pandas_udf("double")
    def hits(texts: pd.Series) -> pd.Series:
        key = hash((tuple(entries), blocked, reporting, address))
        if key not in _LOADED:
            _LOADED.clear()
            _LOADED[key] = Memo(Lexicon(entries, blocked), reporting, address)
        memo = _LOADED[key]
        return pd.Series([hit_sum(t, memo) for t in texts], dtype="float64")

    return hits


def score_column(model: dict, text: str):
    a, b = model["beta"]
    return 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.log1p(hits_column(model)(F.col(text))))))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
             mod: int = 5, held_out: int = 0, per_class: int = PER_CLASS) -> DataFrame:
    """One row per input row: doc_id, held_out (its id's CRC-32 bucket, never
    trained on), score (0 to 1), predicted (score >= 0.5).

    A null text scores as the empty one; a null id belongs to the bucket of ''.
    Repeated rows score alike.  Without toxic labels the lexicon is empty and
    every score is the prior's for no hit; an empty table gives no rows.
    """
    model = train(docs, labels, label, doc_id, text, mod, held_out, per_class)
    return (columns(docs, doc_id=doc_id, text=text)
            .select("doc_id", (id_bucket("doc_id", mod) == held_out).alias("held_out"),
                    score_column(model, "text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
