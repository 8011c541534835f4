"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are put into a few partitions, correlated bits together, and each
partition i gets a threshold t_i with sum(t_i + 1) = distance + 1.  Two
fingerprints within the distance then agree in at least one partition up to
that partition's threshold.  The thresholds are the cheapest found by dynamic
programming on candidate counts estimated from a bounded sample, for each number of
partitions in PARTS: the more fingerprints, the wider the partitions that pay.  The
sample steers the cost only, every fingerprint is indexed and probed.  Probes meet
in buckets (partition, value) and are verified on all 64 bits.

Exact copies are one fingerprint from the start.  A bucket is compared in
blocks of at most BLOCK rows a side, spread over tasks, and a block returns no
more links than it has members (a spanning forest), so a large group neither
lands in one task nor turns into all its pairs.

Defined results: null, empty and blank texts have fingerprint 0 and link like
any other; a text of fewer words than a shingle is one shingle.  Repeated rows
and ids are copies of each other.  Rows with a null id get a component like the
others, named by the smallest id that is not null.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import fits_broadcast
from . import grid
from .common import stored
from .components import components

SHINGLE, DISTANCE, SEED, BITS = 4, 4, 42, 64
PARTS = (2, 3, 4)  # partitions to choose from: 32, 21 or 16 bits each
PROBE = 32      # comparisons that cost as much as a probe, which is shuffled and sorted
SAMPLE = 2048   # fingerprints, at most, that the thresholds are planned on
BLOCK = 2048    # rows of a bucket compared with as many others at once
SMALL = 16      # buckets up to this size are compared many at a time
CHUNK = 65_536  # shingles counted at once


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word k-shingles of a text."""
    # bytes.lower() changes A-Z only, bytes.split() splits at U+0009..U+000D and space.
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    line = b" ".join(ws)
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(k, len(ws))
    starts, ends = starts[:len(ws) - k + 1].tolist(), ends[k - 1:].tolist()
    total, counts = len(starts), np.zeros(BITS, np.int64)
    for i in range(0, total, CHUNK):
        h = np.array([xxhash.xxh64_intdigest(line[s:e], SEED)
                      for s, e in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(text: Column | str, k: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, k) for t in texts], dtype="int64")
    return each(F.col(text) if isinstance(text, str) else text)


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")


def partition_bits(values: np.ndarray, parts: int = 3) -> list[list[int]]:
    """Bits into parts of nearly equal size, correlated bits together: each
    part starts with a free bit and takes in the one most correlated with it."""
    x = _bits(values).astype(float) if len(values) > 1 else np.zeros((2, BITS))
    x -= x.mean(axis=0)
    size = np.sqrt((x * x).sum(axis=0))
    corr = np.abs(x.T @ x) / np.outer(np.where(size == 0, 1, size), np.where(size == 0, 1, size))
    free, out = list(range(BITS)), []
    for i in range(parts):
        width = BITS // parts + (i < BITS % parts)
        part = [free.pop(0)]
        while len(part) < width:
            best = max(free, key=lambda b: (corr[b, part].mean(), -b))
            free.remove(best)
            part.append(best)
        out.append(sorted(part))
    return out


def thresholds(values: np.ndarray, rows: int, parts: list[list[int]],
               distance: int = DISTANCE) -> list[int]:
    """Per-part thresholds t (-1: part unused) with sum(t + 1) = distance + 1 and
    the least cost."""
    return _cheapest(values, rows, parts, distance)[1]


def plan(values: np.ndarray, rows: int, distance: int = DISTANCE,
         choice: tuple[int, ...] = PARTS) -> tuple[list[list[int]], list[int]]:
    """Parts and their thresholds: the cheapest of ``choice`` numbers of parts."""
    tried = []
    for n in choice:
        parts = partition_bits(values, n)
        cost, limits = _cheapest(values, rows, parts, distance)
        tried.append((cost, parts, limits))
    return min(tried)[1:]


def _cheapest(values: np.ndarray, rows: int, parts: list[list[int]],
              distance: int) -> tuple[float, list[int]]:
    """Least cost and its thresholds, among ``rows`` fingerprints: values probed, and
    candidates expected from the sample's pairs."""
    bits = _bits(values).astype(np.int16)
    pairs = max(1, len(values) * (len(values) - 1) // 2)
    scale = rows * (rows - 1) / 2 / pairs
    cost = []
    for part in parts:
        x = bits[:, part]
        apart = x.sum(axis=1)[:, None] + x.sum(axis=1)[None, :] - 2 * (x @ x.T)
        near = np.bincount(apart[np.triu_indices(len(x), 1)], minlength=distance + 1) \
            if len(x) > 1 else np.zeros(distance + 1)
        balls = [1] + [0] * distance
        row = [0.0]
        for t in range(distance + 1):
            if t:
                balls[t] = balls[t - 1] * (len(part) - t + 1) // t
            # + 1: a part no sampled pair shares is rare, not free.
            row.append(PROBE * rows * sum(balls[:t + 1]) + scale * (near[:t + 1].sum() + 1))
        cost.append(row)
    best = {0: (0.0, [])}  # budget used -> cheapest choice so far
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, chosen) in best.items():
            for units, more in enumerate(row):
                if used + units <= distance + 1:
                    new = (c + more, [*chosen, units - 1])
                    if used + units not in step or new < step[used + units]:
                        step[used + units] = new
        best = step
    return best[distance + 1]


def _balls(part: list[int], t: int) -> list[int]:
    """Bit masks of up to t bits of a part, without the empty one."""
    out, last = [], [(0, -1)]
    for _ in range(t):
        last = [(m | 1 << part[j], j) for m, i in last for j in range(i + 1, len(part))]
        out += [m for m, _ in last]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


def _probes(fps: DataFrame, parts: list[list[int]], limits: list[int]) -> DataFrame:
    """(part, value, fp, home): each fingerprint under its own value of each part
    and, as a probe, under the values up to the part's threshold away."""
    out = []
    for i, (part, t) in enumerate(zip(parts, limits)):
        if t < 0:
            continue
        mask = sum(1 << b for b in part)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        own = F.col("fp").bitwiseAND(F.lit(mask).cast("long"))
        balls = F.lit(_balls(part, t)).cast("array<long>")
        if t == 1:  # of two values one bit apart, one has that bit 0: that one probes
            balls = F.filter(balls, lambda m: F.col("fp").bitwiseAND(m) == 0)
        away = F.transform(balls, lambda m: F.struct(
            own.bitwiseXOR(m).alias("value"), F.lit(False).alias("home")))
        out.append(F.transform(
            F.concat(F.array(F.struct(own.alias("value"), F.lit(True).alias("home"))), away),
            lambda e: F.struct(F.lit(i).alias("part"), e["value"].alias("value"),
                               e["home"].alias("home"))))
    return fps.select("fp", F.explode(F.concat(*out)).alias("p")).select("p.*", "fp")


def _compare(distance: int):
    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.bitwise_count((x ^ y).view(np.uint64)) <= distance

    def links(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        fp, role = pdf["fp"].to_numpy(), pdf["role"].to_numpy()
        keys = pdf[["part", "value", "rb", "cb"]].to_numpy()
        first = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
        group = np.cumsum(first) - 1
        size = np.bincount(group)[group]
        i = np.flatnonzero((size > 1) & (size <= SMALL) & (role != grid.ROW))
        a, b = [], []
        for k in range(1, SMALL):  # pairs k rows apart in the same bucket
            x, y = i[:-k], i[k:]
            x, y = (z[(group[x] == group[y]) & ((role[x] == grid.HOME) | (role[y] == grid.HOME))] for z in (x, y))
            ok = near(fp[x], fp[y])
            a.append(fp[x[ok]])
            b.append(fp[y[ok]])
        for g in np.unique(group[(size > SMALL) | (role == grid.ROW)]):
            lo, hi = np.searchsorted(group, [g, g + 1])
            f, r = fp[lo:hi], role[lo:hi]
            rows, cols = f[r != grid.COLUMN], f[r != grid.ROW]
            if len(rows) and len(cols):
                x, y = grid.forest(near(rows[:, None], cols[None, :]), rows, cols)
                a.append(x[x != y])
                b.append(y[x != y])
        if a and (n := sum(map(len, a))):
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bucket; the last bucket of a batch waits for the next."""
        wait: list[pd.DataFrame] = []
        for pdf in batches:
            if not len(pdf):
                continue
            k = pdf[["part", "value", "rb", "cb"]].to_numpy()
            cut = np.flatnonzero((k != k[-1]).any(axis=1))
            if len(cut):
                at = cut[-1] + 1
                yield from links(pd.concat([*wait, pdf.iloc[:at]]))
                wait = [pdf.iloc[at:]]
            else:
                wait.append(pdf)
        if wait:
            yield from links(pd.concat(wait))

    return stream


def links(fps: DataFrame, distance: int = DISTANCE, block: int = BLOCK,
          choice: tuple[int, ...] = PARTS) -> DataFrame:
    """(a, b) links between the distinct fingerprints of ``fps`` (one column, fp)
    with the same components as all pairs at most ``distance`` bits apart."""
    n = fps.count()
    sample = np.array([r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()],
                      dtype=np.int64)
    probes = _probes(fps, *plan(sample, n, distance, choice))
    keys = ["part", "value", "rb", "cb"]
    rows = (grid.in_blocks(probes, ["part", "value"], "fp", "home", block)
            .repartition(*keys).sortWithinPartitions(*keys))
    found = rows.mapInPandas(_compare(distance), "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", *,
                    k: int = SHINGLE, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """(key, text_hash, fp, group, component): one row per row of ``df``.

    group: a fingerprint that stands for the component; component: the smallest
    key in it; text_hash tells rows of the same key apart.
    """
    rows = stored(df.select(F.col(f"`{key}`").alias(key),
                            F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
                            fingerprints(F.col(f"`{text}`"), k).alias("fp")), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min(key).alias("low")), "distinct_fingerprints")
    found = components(links(fps.select("fp"), distance, block))
    # Joins are between written tables: Spark splits a group that is very large.
    named = stored(fps.join(found.withColumnRenamed("node", "fp"), "fp", "left")
                   .select("fp", "low", F.coalesce("label", "fp").alias("group")), "groups")
    lows = stored(named.groupBy("group").agg(F.min("low").alias("component")), "lows")
    names = stored(named.join(lows, "group").select("fp", "group", "component"), "named")
    return rows.join(names, "fp").select(key, "text_hash", "fp", "group", "component")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with one row of each near-duplicate component: that of the smallest
    key, of those the smallest text hash; equal rows count once."""
    rows = stored(near_duplicates(df, key, text, **options), "members")
    order = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col("text_hash"))
    best = stored(rows.groupBy("group").agg(F.min(order).alias("best")), "best")
    ranked = rows.join(best, "group")
    wins = order == F.col("best")
    lost = stored(ranked.filter(~wins).select(key, "text_hash").distinct(), "lost")
    again = stored(ranked.filter(wins).groupBy(key, "text_hash")
                   .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated")
    cols = df.columns
    marked = df.withColumn("__hash", F.xxhash64(F.col(f"`{text}`")))

    def match(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(F.col(key).alias("__k"), F.col("text_hash").alias("__h"))
        right = F.broadcast(right) if fits_broadcast(right) else right
        return left.join(right, left[f"`{key}`"].eqNullSafe(right["__k"])
                         & (left["__hash"] == right["__h"]), how)

    kept = match(marked, lost, "left_anti")
    if again.isEmpty():
        return kept.select(*[f"`{c}`" for c in cols])
    twice = match(kept, again, "left_semi").dropDuplicates([key, "__hash"])
    return match(kept, again, "left_anti").union(twice).select(*[f"`{c}`" for c in cols])
