"""Exact quantiles that stay exact and bounded at any scale.

Spark's exact ``percentile`` keeps a map of every distinct value of a group
and merges it in one task; on a 100 TB column that map is unbounded.  This
module finds the exact order statistics with a bounded amount of work per
task and a bounded amount of data on the driver:

1. one pass computes ``count``, ``min``, ``max`` and an ``approx_percentile``
   bracket around every wanted rank (mergeable sketch, bounded memory);
2. one pass counts the rows below each bracket and, per bracket, either
   builds an equi-width histogram (count/min/max per bin) or, when the
   bracket is small, the distinct values with their counts;
3. histogram rounds narrow the bracket until its distinct values fit in
   ``fetch_limit``; ties collapse into one (value, count) row, so a hot value
   never makes the fetched set large.

Interpolation matches pandas / DuckDB ``quantile_cont``: the value at
position ``p * (n - 1)`` between the two neighbouring order statistics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SEP = "\u001f"


def _long_form(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(key, x) rows; key = feature name, or group values + feature name."""
    pairs = [F.struct(F.lit(c).alias("f"), F.col(c).cast("double").alias("x")) for c in cols]
    out = df.select(*[F.col(b) for b in by], F.explode(F.array(*pairs)).alias("_p"))
    if by:
        gk = F.concat_ws(_SEP, *[F.coalesce(F.col(b).cast("string"), F.lit("\u0000")) for b in by])
        key = F.concat_ws(_SEP, gk, F.col("_p.f"))
    else:
        key = F.col("_p.f")
    x = F.col("_p.x")
    return out.select(key.alias("_k"), x.alias("_x")).where(x.isNotNull() & ~F.isnan(x))


def _map_lit(d: dict) -> F.Column:
    if not d:
        return F.create_map().cast("map<string,double>")
    parts = []
    for k, v in d.items():
        parts += [F.lit(k), F.lit(float(v))]
    return F.create_map(*parts)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), accuracy: int = 10000, bins: int = 2048,
                    fetch_limit: int = 100_000) -> dict:
    """Return ``{(group_tuple, col, p): value}`` (group_tuple is ``()`` without ``by``).

    Nulls and NaN are ignored (pandas semantics); an all-null column gives None.
    """
    cols = list(cols)
    probs = [float(p) for p in probs]
    by = list(by)
    long = _long_form(df, cols, by)

    delta = 3.0 / accuracy
    edges = sorted({min(1.0, max(0.0, p + s * delta)) for p in probs for s in (-1, 1)})
    stats = (long.groupBy("_k")
             .agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("mn"), F.max("_x").alias("mx"),
                  F.percentile_approx("_x", edges, accuracy).alias("q"))
             .collect())

    # target: (key, rank) -> state {lo, hi, below, value}
    targets: dict[tuple[str, int], dict] = {}
    plan: dict[tuple[str, float], tuple[int, int, float]] = {}
    for row in stats:
        n, qv = row["n"], list(row["q"])
        qmap = dict(zip(edges, qv))
        for p in probs:
            pos = p * (n - 1)
            k = int(math.floor(pos))
            frac = pos - k
            k2 = min(k + 1, n - 1)
            plan[(row["_k"], p)] = (k, k2, frac)
            lo = qmap[min(1.0, max(0.0, p - delta))]
            hi = qmap[min(1.0, max(0.0, p + delta))]
            for rank in {k, k2}:
                targets.setdefault((row["_k"], rank), {
                    "lo": min(lo, hi), "hi": max(lo, hi), "below": None,
                    "mn": row["mn"], "mx": row["mx"], "value": None})

    # first attempt: one pass counts the rows below every bracket and fetches the
    # bracket's distinct values together, when every bracket spans few ranks
    n_max = max((r["n"] for r in stats), default=0)
    if targets and 4 * delta * n_max + 2 <= fetch_limit:
        _fetch_with_below(long, targets)

    for _round in range(64):
        pending = {t: s for t, s in targets.items() if s["value"] is None}
        if not pending:
            break
        # brackets shared by several ranks are processed once
        brackets: dict[tuple[str, float, float], list] = {}
        for (key, rank), s in pending.items():
            brackets.setdefault((key, s["lo"], s["hi"]), []).append(rank)
        blist = list(brackets)
        need_below = [b for b in blist if any(targets[(b[0], r)]["below"] is None for r in brackets[b])]

        if need_below:
            aggs = [F.sum(F.when((F.col("_k") == k) & (F.col("_x") < lo), 1).otherwise(0)).alias(f"b{i}")
                    for i, (k, lo, hi) in enumerate(need_below)]
            aggs += [F.sum(F.when((F.col("_k") == k) & (F.col("_x") >= lo) & (F.col("_x") <= hi), 1)
                           .otherwise(0)).alias(f"c{i}") for i, (k, lo, hi) in enumerate(need_below)]
            res = long.agg(*aggs).collect()[0]
            for i, b in enumerate(need_below):
                for r in brackets[b]:
                    targets[(b[0], r)]["below"] = int(res[f"b{i}"] or 0)
                    targets[(b[0], r)]["inside"] = int(res[f"c{i}"] or 0)

        # a bracket that missed its rank (sketch error) is widened to the column range
        retry = False
        for b in blist:
            for r in brackets[b]:
                s = targets[(b[0], r)]
                if r < s["below"]:
                    s.update(lo=s["mn"], below=None)
                    retry = True
                elif r >= s["below"] + s["inside"]:
                    s.update(hi=s["mx"], below=None)
                    retry = True
        if retry:
            continue

        small = [b for b in blist if targets[(b[0], brackets[b][0])]["inside"] <= fetch_limit]
        large = [b for b in blist if b not in small]
        if small:
            # brackets of one column may overlap: a value is counted once per bracket holding it
            conds = [(F.col("_k") == k) & (F.col("_x") >= lo) & (F.col("_x") <= hi) for k, lo, hi in small]
            ids = F.filter(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conds)]), lambda x: x.isNotNull())
            rows = (long.select(F.explode(ids).alias("t"), "_x").groupBy("t", "_x").count()
                    .collect())
            per: dict[int, list] = {}
            for row in rows:
                per.setdefault(row["t"], []).append((row["_x"], row["count"]))
            for i, b in enumerate(small):
                vals = sorted(per.get(i, []))
                for r in brackets[b]:
                    s = targets[(b[0], r)]
                    cum = s["below"]
                    for v, c in vals:
                        if r < cum + c:
                            s["value"] = v
                            break
                        cum += c
        if large:
            items = []
            for i, (k, lo, hi) in enumerate(large):
                width = (hi - lo) / bins if hi > lo else 1.0
                c = (F.col("_k") == k) & (F.col("_x") >= lo) & (F.col("_x") <= hi)
                b_expr = F.least(F.floor((F.col("_x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
                items.append(F.when(c, F.struct(F.lit(i).alias("t"), b_expr.alias("bin"))))
            hits = F.filter(F.array(*items), lambda x: x.isNotNull())
            rows = (long.select(F.explode(hits).alias("h"), "_x").groupBy("h.t", "h.bin")
                    .agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("mn"), F.max("_x").alias("mx"))
                    .collect())
            per = {}
            for row in rows:
                per.setdefault(row["t"], []).append((row["bin"], row["n"], row["mn"], row["mx"]))
            for i, b in enumerate(large):
                hist = sorted(per.get(i, []))
                for r in brackets[b]:
                    s = targets[(b[0], r)]
                    cum = s["below"]
                    for _bin, n, mn, mx in hist:
                        if r < cum + n:
                            if mn == mx:
                                s["value"] = mn
                            else:
                                s.update(lo=mn, hi=mx, below=cum, inside=n)
                            break
                        cum += n

    open_ranks = [t for t, s in targets.items() if s["value"] is None]
    if open_ranks:
        raise RuntimeError(f"quantile ranks not resolved after 64 rounds: {open_ranks[:5]}")
    out = {}
    group_values = {}
    for (key, p), (k, k2, frac) in plan.items():
        lo = targets[(key, k)]["value"]
        hi = targets[(key, k2)]["value"]
        val = lo if frac == 0 or lo == hi else lo + (hi - lo) * frac
        if by:
            parts = key.split(_SEP)
            g, f = tuple(parts[:-1]), parts[-1]
            group_values[g] = None
        else:
            g, f = (), key
        out[(g, f, p)] = val
    for c in cols:
        for p in probs:
            if not by:
                out.setdefault(((), c, p), None)
    return out


def _fetch_with_below(long: DataFrame, targets: dict) -> None:
    """One pass: per column, merged brackets cut the value line into gap and
    bracket segments (a codegen'd CASE); gaps are only counted, bracket values
    are kept as distinct (value, count) rows.  Ranks are then exact on the driver."""
    per_key: dict[str, list] = {}
    for (key, _rank), st in targets.items():
        per_key.setdefault(key, []).append((st["lo"], st["hi"]))
    merged: dict[str, list] = {}
    for key, ivs in per_key.items():
        out = []
        for lo, hi in sorted(ivs):
            if out and lo <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], hi))
            else:
                out.append((lo, hi))
        merged[key] = out
    seg = None
    for key, ivs in merged.items():
        inner = None
        for j, (lo, hi) in enumerate(ivs):
            inner = (F.when(F.col("_x") < lo, F.lit(2 * j)) if inner is None
                     else inner.when(F.col("_x") < lo, F.lit(2 * j)))
            inner = inner.when(F.col("_x") <= hi, F.lit(2 * j + 1))
        inner = inner.otherwise(F.lit(2 * len(ivs)))
        seg = F.when(F.col("_k") == key, inner) if seg is None else seg.when(F.col("_k") == key, inner)
    staged = long.where(F.col("_k").isin(list(merged))).select("_k", seg.alias("seg"), "_x")
    value = F.when(F.col("seg") % 2 == 1, F.col("_x"))
    rows = staged.groupBy("_k", "seg", value.alias("v")).count().collect()
    walk: dict[str, list] = {}
    for row in rows:
        walk.setdefault(row["_k"], []).append((row["seg"], row["v"], row["count"]))
    for key in merged:
        cum = 0
        ranked = []  # (first rank, last rank, segment, value)
        for sg, v, c in sorted(walk.get(key, []), key=lambda t: (t[0], t[1] if t[1] is not None else 0.0)):
            ranked.append((cum, cum + c - 1, sg, v))
            cum += c
        for (k2, rank), st in targets.items():
            if k2 != key:
                continue
            for first, last, sg, v in ranked:
                if first <= rank <= last:
                    if sg % 2 == 1:
                        st["value"] = v
                    break


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    q = exact_quantiles(df, cols, [0.5])
    return {c: q[((), c, 0.5)] for c in cols}
