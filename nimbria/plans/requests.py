"""Request algebra: requests are dictionaries of keys to a value or a list; lists stand for their cross product."""

from __future__ import annotations

import datetime as dt
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expand(request: dict, dims: list[str] | None = None) -> list[dict]:
    """One request per combination of the list values of ``dims`` (default all); the last key varies fastest."""
    dims = [d for d in (dims if dims is not None else request) if d in request]
    values = [request[d] if isinstance(request[d], list | tuple | range) else [request[d]] for d in dims]
    return [{**request, **dict(zip(dims, combo, strict=True))} for combo in product(*values)]


def squeeze(requests: list[dict], dims: list[str]) -> list[dict]:
    """Requests equal but for ``dims`` merged: each dim becomes the sorted list of its values, or the only one."""
    groups: dict[tuple, dict[str, set]] = {}
    for r in requests:
        key = tuple(sorted((k, repr(v)) for k, v in r.items() if k not in dims))
        group = groups.setdefault(key, {"__rest": {k: v for k, v in r.items() if k not in dims}})
        for d in dims:
            if d in r:
                group.setdefault(d, set()).update(r[d] if isinstance(r[d], list | tuple | range) else [r[d]])
    out = []
    for group in groups.values():
        rest = dict(group.pop("__rest"))
        out.append(rest | {d: next(iter(v)) if len(v) == 1 else sorted(v) for d, v in group.items()})
    return out


def deep_update(base: dict, changes: dict) -> dict:
    """``base`` with nested dictionaries merged and other values replaced."""
    out = dict(base)
    for k, v in changes.items():
        out[k] = deep_update(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def update_request(requests: dict | list[dict], changes: dict | list[dict]) -> dict | list[dict]:
    """Merge changes; one of the two sides may be a list, or both of one length."""
    one_r, one_c = isinstance(requests, dict), isinstance(changes, dict)
    if one_r and one_c:
        return deep_update(requests, changes)
    rs = [requests] * len(changes) if one_r else requests
    cs = [changes] * len(rs) if one_c else changes
    if len(rs) != len(cs):
        raise ValueError("requests and changes differ in number")
    return [deep_update(r, c) for r, c in zip(rs, cs, strict=True)]


def dict_product(dims: dict[str, list]) -> list[dict]:
    return [dict(zip(dims, combo, strict=True)) for combo in product(*dims.values())]


def unique_requests(requests: list[dict]) -> list[dict]:
    seen, out = set(), []
    for r in requests:
        key = repr(sorted(r.items(), key=lambda kv: kv[0]))
        if key not in seen:
            seen.add(key)
            out.append(r)
    return out


def common_requests(required: list[dict], available: list[dict]) -> list[dict]:
    """The available requests that match a required one on all of its keys but the member's number; none at all if one of the
    required ones is missed."""
    wanted = unique_requests([{k: v for k, v in r.items() if k != "number"} for r in required])
    found = [[a for a in available if all(k in a and a[k] == v for k, v in r.items())] for r in wanted]
    return [a for own in found for a in own] if all(found) else []


def intersect(required: DataFrame, available: DataFrame) -> DataFrame:
    """The same for tables of requests: the rows of ``available`` that match a row of ``required`` on its columns (number
    apart), or none if a row of ``required`` has no match."""
    on = [c for c in required.columns if c != "number"]
    wanted = required.select(on).distinct()
    missed = wanted.join(available, on, "left_anti").limit(1).select(F.lit(1).alias("__missed"))
    return available.join(wanted, on, "left_semi").where(F.lit(missed.isEmpty()))


def _text(value) -> str:
    if isinstance(value, range):
        step = f"/by/{value.step}" if value.step != 1 else ""
        return f"{value.start}/to/{value[-1]}{step}"
    if isinstance(value, list | tuple):
        return "/".join(_text(v) for v in value)
    if isinstance(value, dt.date):
        return value.strftime("%Y%m%d")
    return str(value)


def serialise(verb: str, request: dict) -> str:
    """``verb, key=value, ...`` with lists as a/b/c, ranges as a/to/b/by/c and dates as YYYYMMDD."""
    return ",\n".join([verb, *[f"  {k}={_text(v)}" for k, v in request.items()]])


def parse_values(text: str) -> list:
    """``a/b``, ``a/to/b/by/c``, ``a-b`` and ``a,b`` of integers, or plain words."""
    parts = [p.strip() for p in text.replace(",", "/").split("/")]
    number = lambda x: int(x) if x.lstrip("-").isdigit() else x
    if "to" in parts:
        at = parts.index("to")
        by = int(parts[parts.index("by") + 1]) if "by" in parts else 1
        return [*map(number, parts[: at - 1]), *range(int(parts[at - 1]), int(parts[at + 1]) + 1, by)]
    out = []
    for p in parts:
        first, dash, last = p.partition("-")
        out += range(int(first), int(last) + 1) if dash and first.isdigit() and last.isdigit() else [number(p)]
    return out
