"""Byte-level BPE ids of whole texts.

``tiktoken`` encodes with the ranks of the ``tokenizers`` file.  Texts without
two white-space characters in a row take a pattern without look-ahead, which
splits them alike and far faster; texts that hold a special token's string
are encoded by ``tokenizers`` itself.
"""

from __future__ import annotations

import functools
import json
import re
from array import array

# The pre-tokenizing pattern of byte-level BPE files, in two parts.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
SPACES = r"|\s+(?!\S)|\s+"

_TWO = re.compile(r"\s\s")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Ids of a byte-level BPE vocabulary file (``tokenizers`` JSON)."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        self.special = [t["content"] for t in spec["added_tokens"]]
        alphabet, known = byte_alphabet(), set(self.special)
        ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in known}
        self.general, self.simple = (
            tiktoken.Encoding("byte-bpe", pat_str=p, mergeable_ranks=ranks, special_tokens={})
            for p in (WORDS + SPACES, WORDS + r"|\s+"))

    @functools.cached_property
    def whole(self):
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(self.path)
        t.no_truncation()
        t.no_padding()
        return t

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if any(s in text for s in self.special):
            return self.whole.encode(text, add_special_tokens=False).ids
        return (self.general if _TWO.search(text) else self.simple).encode_ordinary(text)

    def packed(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return little_endian(self.ids(text))


def little_endian(ids: list[int]) -> bytes:
    import sys
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def end_id_for(path: str, wanted: int) -> int:
    """``wanted`` if no text can be encoded to it, else the greatest 16-bit id that
    the vocabulary file leaves free."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    used = {*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])}
    free = wanted if wanted not in used else next((i for i in range((1 << 16) - 1, -1, -1) if i not in used), None)
    if free is None:
        raise ValueError(f"{path} leaves no 16-bit id for the end of a document")
    return free


@functools.lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """One encoder per worker process and file."""
    return ByteBpe(path)
