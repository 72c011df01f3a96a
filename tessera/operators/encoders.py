"""Text encoders as plug-ins (C08): texts to vectors in iterators of Arrow batches.

An encoder is a factory registered under a name: ``factory() -> (list of
texts -> rows of a matrix)``.  A worker calls the factory once, however many batches
and tasks it runs, and a batch's equal texts are encoded once; texts met lately are remembered.
"""

from __future__ import annotations

import hashlib
import re
from collections import OrderedDict
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

__all__ = ["ENCODERS", "register_encoder", "encode", "hashed_words"]

ENCODERS: dict[str, Callable[[], Callable[[list[str]], np.ndarray]]] = {}
REMEMBERED = 10_000  # texts a worker remembers

_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_LOADED: dict[str, tuple] = {}


def register_encoder(name: str, factory: Callable[[], Callable[[list[str]], np.ndarray]]) -> None:
    """Add or replace an encoder; the factory travels to the workers with the job."""
    ENCODERS[name] = factory


def hashed_words(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """Bag of words without a vocabulary: a word [a-z0-9]+ (A-Z lower-cased) counts at
    the first 32 bits of its MD5 modulo ``dim``; vectors have length 1, or 0 without words."""
    place: dict[str, int] = {}

    def of(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for i, t in enumerate(texts):
            for w in re.findall("[a-z0-9]+", t.translate(_UPPER)):
                k = place.get(w)
                if k is None:
                    if len(place) >= 200_000:
                        place.clear()
                    k = place[w] = int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim
                out[i, k] += 1
        n = np.sqrt((out * out).sum(1, keepdims=True))
        return np.divide(out, n, out=out, where=n > 0)
    return of


register_encoder("hashed_words", hashed_words)


def _loaded(key: str, factory: Callable) -> tuple[Callable, OrderedDict]:
    """The worker's encoder and the texts it remembers (a function of the module, so
    that the module's table is meant and not a copy that travels with each task)."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = factory(), OrderedDict()
    return _LOADED[key]


def encode(df: DataFrame, text: str, encoder: str = "hashed_words", out: str = "vector") -> DataFrame:
    """``df`` with the vector of a text column as array<double>; a null text has a null vector."""
    factory, name = ENCODERS[encoder], encoder
    keep = [c for c in df.columns if c != out]
    schema = df.select(*keep).schema.add(out, T.ArrayType(T.DoubleType()))
    at = keep.index(text)
    run_id = hashlib.md5(f"{name}-{id(factory)}".encode()).hexdigest()

    def run(batches):
        import pyarrow as pa
        model, lately = _loaded(run_id, factory)
        for b in batches:
            texts = b.column(at).to_pylist()
            fresh = list(dict.fromkeys(t for t in texts if t is not None and t not in lately))
            found = dict(zip(fresh, np.asarray(model(fresh), np.float64).tolist())) if fresh else {}
            vectors = [None if t is None else found[t] if t in found else lately[t] for t in texts]
            for t, v in found.items():
                lately[t] = v
                if len(lately) > REMEMBERED:
                    lately.popitem(last=False)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors, pa.list_(pa.float64()))], names=[*b.schema.names, out])

    return df.select(*keep).mapInArrow(run, schema)
