"""Cost-balanced packing of token streams into fixed-length sequences.

Each document is its ids followed by one end id.  Whole blocks of
``seq_len`` ids become sequences of their own; the tails are packed.  A
sequence costs ``linear * tokens + quadratic * sum(piece ** 2)``: the second
term is the attention inside its pieces.  Tails go in descending length to the
cheapest sequence with room for all of it; when none has, the tail is cut to
fill the cheapest one with any room.  The sequences opened hold exactly the
tails' ids: as many of ``seq_len`` as fit, then one per power of two in the
remainder, which needs no padding either.

Packing runs inside the map tasks over windows of ``window`` tokens, so nothing
is shuffled, a task holds one window, and a recomputed task (same input split)
numbers its sequences alike.  Neither a source nor a long document is a group.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
from pyspark.sql import DataFrame

from tessera.llm.common import columns

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")


def room(total: int, seq_len: int) -> list[int]:
    """Capacities that hold exactly ``total`` ids without padding."""
    full, rest = divmod(total, seq_len)
    return [seq_len] * full + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def assign(tails: list[tuple[int, int]], seq_len: int, linear: float, quadratic: float):
    """Pieces ``(item, start, length, sequence, offset)`` of ``(item, length)``
    tails; sequences count from 0."""
    caps = room(sum(n for _, n in tails), seq_len)
    left = list(caps)
    # open sequences by room left, each a heap of (cost, sequence); best: its cheapest cost
    heaps: list[list] = [[] for _ in range(seq_len + 1)]
    best = np.full(seq_len + 1, np.inf)
    for s, c in enumerate(caps):
        heapq.heappush(heaps[c], (0.0, s))
        best[c] = 0.0
    out = []
    for item, n in sorted(tails, key=lambda t: (-t[1], t[0])):
        start = 0
        while n:
            r = n + int(best[n:].argmin())
            if best[r] == np.inf:
                r = 1 + int(best[1:].argmin())
            cost, s = heapq.heappop(heaps[r])
            best[r] = heaps[r][0][0] if heaps[r] else np.inf
            take = min(n, r)
            out.append((item, start, take, s, caps[s] - left[s]))
            left[s] -= take
            if left[s]:
                cost += linear * take + quadratic * take * take
                heapq.heappush(heaps[left[s]], (cost, s))
                best[left[s]] = heaps[left[s]][0][0]
            start, n = start + take, n - take
    return out, len(caps)


def pack_window(docs: list[tuple[int | None, bytes]], seq_len: int, linear: float, quadratic: float, first: int):
    """Rows of SCHEMA's fields for documents given as (id, ids); sequences are
    numbered from ``first``; also the next free number."""
    rows, tails, seq = [], [], first
    for i, (_, ids) in enumerate(docs):
        n = len(ids) // 4
        whole = n // seq_len * seq_len
        for at in range(0, whole, seq_len):
            rows.append((i, at, seq_len, seq, 0))
            seq += 1
        if n > whole:
            tails.append((i, n - whole))
    pieces, used = assign(tails, seq_len, linear, quadratic)
    for i, start, n, s, offset in pieces:
        rows.append((i, len(docs[i][1]) // 4 // seq_len * seq_len + start, n, seq + s, offset))
    out = []
    for i, start, n, s, offset in rows:
        doc, ids = docs[i]
        cut = ids[4 * start:4 * (start + n)]
        out.append((doc, start, n, zlib.crc32(cut), len(ids) // 4, s, offset, cut))
    return out, seq + used


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", seq_len: int = 1024,
         end_id: int = 0, window: int = 1 << 20, linear: float = 1.0, quadratic: float = 1 / 1024,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and the piece's ids (little-endian 32-bit).

    ``tokenizer`` is the path of a byte-level BPE JSON file that every worker
    can read.  A null or empty text is the end id alone; a null doc_id stays
    null; repeated rows are separate documents, each packed; an empty table gives no rows.
    """
    fields = columns(docs, doc_id=doc_id, text=text).selectExpr("cast(doc_id as long) doc_id", "text")
    schema = SCHEMA if with_ids else SCHEMA.rpartition(",")[0]

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from tessera.llm import bytebpe
        bpe = bytebpe.load(tokenizer)
        seq = TaskContext.get().partitionId() << 40
        end = bytebpe.little_endian([end_id])
        types = {"long": pa.int64(), "binary": pa.binary()}
        names = [f.split() for f in schema.split(", ")]

        def flush(held, seq):
            rows, seq = pack_window(held, seq_len, linear, quadratic, seq)
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(cols, names)],
                                              names=[n for n, _ in names]), seq

        held, size = [], 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = bpe.packed(text.as_py()) + end
                held.append((doc, ids))
                size += len(ids) // 4
                if size >= window:
                    batch, seq = flush(held, seq)
                    held, size = [], 0
                    yield batch
        if held:
            yield flush(held, seq)[0]

    return fields.mapInArrow(run, schema)
