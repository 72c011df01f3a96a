"""Order-insensitive comparison of a Spark result with an SQL oracle result
(used by the test suite and ``tools/oracle_check.py``)."""

from __future__ import annotations

import datetime as dt
import decimal
import math


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{round(float(v), 6):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    return str(v)


def family(t: str) -> str:
    t = t.lower()
    if any(x in t for x in ("int", "long", "short", "byte")):
        return "int"
    if any(x in t for x in ("double", "float", "decimal", "real")):
        return "float"
    if "timestamp" in t:
        return "ts"
    if "date" in t:
        return "date"
    if "bool" in t:
        return "bool"
    if any(x in t for x in ("string", "varchar", "char")):
        return "str"
    if "array" in t or "[]" in t or "list" in t:
        return "list"
    return t



def compare(scols, stypes, srows, dcols, dtypes, drows) -> list[str]:
    """Problems found (empty when equal): names, type families, row count,
    values (sorted rows of canonical text, columns in name order)."""
    msgs = []
    if sorted(scols) != sorted(dcols):
        return [f"cols spark={sorted(scols)} duck={sorted(dcols)}"]
    tm = [c for c in scols if stypes[c] != dtypes[c]]
    if tm:
        msgs.append("types " + ", ".join(f"{c}:{stypes[c]}/{dtypes[c]}" for c in tm))
    if len(srows) != len(drows):
        msgs.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not msgs:
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        a = sorted(tuple(canon(r[i]) for i in si) for r in srows)
        b = sorted(tuple(canon(r[i]) for i in di) for r in drows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            msgs.append(f"values differ e.g. {diff}")
    return msgs
