"""BPE encoding and decoding with a pair occurrence index.

A worker encodes the distinct words of a stretch of documents together.  Their
symbols lie in one array with links to the next symbol of the word, and an index
maps each pair's rank to all positions where that pair stands.  Ranks are taken
in ascending order; a rank's positions merge at once, and the pairs left and
right of each merge move to the lists of their new ranks.  A word's merges thus
happen in the order of its own lowest ranks, as word-by-word encoding does.

Works for ``tokenizers`` BPE files with a word-end suffix that drop white space:
normalisation and pre-tokenizing then act on each white-space-separated stretch
alone, so its encoding can be remembered.  Memory is bounded: documents are taken
in lots of about HELD_CHARS characters, and what is remembered is dropped when it
would pass CACHE_WORDS stretches.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from tessera.llm.bytebpe import byte_alphabet
from tessera.llm.common import columns

HELD_CHARS = 8_000_000
CACHE_WORDS = 300_000
NONE = np.iinfo(np.int32).max

# str.split() also splits at these, which the tokenizer's \s does not hold
_CONTROL = re.compile("[\x1c-\x1f]")


class WordBpe:
    """Vocabulary, merges and word patterns of one ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        split = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.words = regex.compile(split[0]["pattern"]["Regex"] + "| ")
        self.spaces = regex.compile(r"\s+")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        end = model["end_of_word_suffix"]
        chars = {b: c for c, b in byte_alphabet().items()}
        self.inside = np.array([vocab[chars[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[chars[b] + end] for b in range(256)], np.int64)
        self.size = max([*vocab.values(), *self.added.values()]) + 1
        self.token = [""] * self.size
        for t, i in [*vocab.items(), *self.added.items()]:
            self.token[i] = t
        self.number = list(map(str, range(self.size)))
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.twin = left == right
        code = left * self.size + right
        order = np.argsort(code, kind="stable")
        self.codes, self.code_rank = code[order], order.astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left * self.size + right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.code_rank[at], NONE)

    def encode_stretches(self, stretches: list[str]) -> list[list[int]]:
        """Ids of stretches without white space: NFC, lower case character by
        character, the file's split pattern, merges."""
        s = " ".join(stretches)
        if not s.isascii():
            s = unicodedata.normalize("NFC", s).replace("Σ", "σ")  # str.lower() has its own rule for a final one
        # a word a line, a space between stretches: neither stands in a word
        data = np.frombuffer(("\n".join(self.words.findall(s.lower())) + "\n").encode(), np.uint8)
        line, mark = data == 10, data == 32
        own = ~(line | mark)
        before = np.cumsum(own)
        ends = before[line]
        ends = ends[np.diff(ends, prepend=0) > 0]
        ids, offset = self.encode_words(data[own], ends)
        until = [*offset[before[mark] - 1].tolist(), len(ids)]
        return list(map(ids.tolist().__getitem__, map(slice, [0, *until], until)))

    def encode_words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as bytes and their ends; and for every byte the
        number of ids up to it."""
        n = len(data)
        size = np.diff(ends, prepend=0)
        sym = self.inside[data]
        sym[ends - 1] = self.last[data[ends - 1]]
        nxt = np.arange(1, n + 1, dtype=np.int32)
        nxt[ends - 1] = -1
        prv = np.arange(-1, n - 1, dtype=np.int32)
        prv[ends - size] = -1
        rank = np.full(n, NONE, np.int32)  # of the pair that starts here
        inner = np.flatnonzero(nxt >= 0).astype(np.int32)
        rank[inner] = self.ranks(sym[inner], sym[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def file(at: np.ndarray, ranks: np.ndarray) -> None:
            """Add positions to the lists of their ranks."""
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            first = [0, *cut.tolist()]
            for r, a, b in zip(ranks[first].tolist(), first, [*first[1:], len(at)]):
                if r in index:
                    index[r].append(at[a:b])
                else:
                    index[r] = [at[a:b]]
                    heapq.heappush(active, r)

        some = inner[rank[inner] != NONE]
        if len(some):
            file(some, rank[some])
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[rank[at] == r]  # others have merged with a neighbour meanwhile
            if not len(at):
                continue
            if self.twin[r] and len(at) > 1:  # x x x: every other pair, from the left
                at = np.sort(at)
                chained = np.concatenate(([False], nxt[at[:-1]] == at[1:]))
                run = np.arange(len(at)) - np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                at = at[run % 2 == 0]
            gone = nxt[at]
            after, before = nxt[gone], prv[at]
            sym[at] = self.product[r]
            rank[gone] = NONE
            sym[gone] = -1
            nxt[at] = after
            has = after >= 0
            prv[after[has]] = at[has]
            rank[at] = NONE
            touched = np.concatenate((before[before >= 0], at[has]))
            if len(touched):
                now = self.ranks(sym[touched], sym[nxt[touched]])
                rank[touched] = now
                live = now != NONE
                if live.any():
                    file(touched[live], now[live])
        kept = sym >= 0
        return sym[kept], np.cumsum(kept)


class Memory:
    """Ids of white-space-free stretches met before."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.ids: dict[str, list[int]] = {}

    def learn(self, texts: list[str]) -> None:
        new: set[str] = set()
        for t in texts:
            new.update(stretches(self.bpe, t))
        unseen = new.difference(self.ids, self.bpe.added)
        if len(self.ids) + len(unseen) > CACHE_WORDS:
            self.ids.clear()
            unseen = new.difference(self.bpe.added)
        unseen = list(unseen)
        if unseen:
            self.ids.update(zip(unseen, self.bpe.encode_stretches(unseen)))
        self.ids.update((a, [i]) for a, i in self.bpe.added.items())


@functools.lru_cache(maxsize=2)
def load(path: str) -> Memory:
    return Memory(WordBpe(path))


def stretches(bpe: WordBpe, text: str) -> list[str]:
    """The text at its white space; a special token's string stands alone."""
    if any(a in text for a in bpe.added):
        return [s for i, part in enumerate(bpe.at_added.split(text))
                for s in ([part] if i % 2 else stretches_plain(bpe, part))]
    return stretches_plain(bpe, text)


def stretches_plain(bpe: WordBpe, text: str) -> list[str]:
    return [s for s in bpe.spaces.split(text) if s] if _CONTROL.search(text) else text.split()


def encode_texts(memory: Memory, texts: list[str]) -> list[list[int]]:
    memory.learn(texts)
    of = memory.ids.__getitem__
    return [list(chain.from_iterable(map(of, stretches(memory.bpe, t)))) for t in texts]


def encode_decode(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                  ids_as_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids (array of int, or their
    decimals with one space between), decoded (the text that the ids decode to, special tokens included).

    A null or empty text has no ids and decodes to ''; repeated rows give
    repeated results; an empty table gives no rows.  ``tokenizer`` is a path
    every worker can read.
    """
    kind = "string" if ids_as_text else "array<int>"
    schema = f"doc_id long, n_tokens long, ids {kind}, decoded string"

    def run(batches):
        import pyarrow as pa
        memory = load(tokenizer)

        number, token = memory.bpe.number.__getitem__, memory.bpe.token.__getitem__

        def result(keys, texts):
            ids = encode_texts(memory, texts)
            shown = (pa.array([" ".join(map(number, x)) for x in ids], pa.string()) if ids_as_text
                     else pa.array(ids, pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(list(map(len, ids)), pa.int64()), shown,
                 pa.array([" ".join(map(token, x)) for x in ids], pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

        keys, texts, chars = [], [], 0
        for b in batches:
            for key, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py() or ""
                keys.append(key)
                texts.append(t)
                chars += len(t)
                if chars >= HELD_CHARS:
                    yield result(keys, texts)
                    keys, texts, chars = [], [], 0
        if keys:
            yield result(keys, texts)

    fields = columns(docs, doc_id=doc_id, text=text).selectExpr("cast(doc_id as long) doc_id", "text")
    return fields.mapInArrow(run, schema)
