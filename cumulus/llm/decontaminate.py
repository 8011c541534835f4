"""Benchmark decontamination by suffix arrays.

The documents are the shards: each batch of them that a task reads gets a suffix
array of its words, sorted by prefix doubling as deep as the longest test item.
Every test suffix is looked up in it by binary search; those whose first ``window``
words are found (or the whole of an item with fewer) give the places of all verbatim
copies.  Each place is then extended to its longest verbatim match, by a binary
search of the other kind: in the suffix array of the test items.  Documents with a
place are contaminated, and ``clean`` removes them.

Words that no test item has are one number that nothing matches, so a shard's
suffixes are compared up to their first such word only.  The benchmark goes to the
tasks in chunks of at most ``CHUNK`` bytes, measured as it is read (a single longer
item is a chunk of its own), and each chunk has its own pass over the documents; the
driver holds one chunk at a time.  Most benchmarks are one chunk.

Defined results: a null or blank text has no words and is clean; such an item has no
window.  Item ids are compared as text, rows with one id are one item, a null id is
the empty text.  Equal windows of several items count for each of them.  Repeated
documents are rows of their own.  Without items every document is clean; an empty
table gives an empty result.  Texts are read whole: one longer than a shard is cut
into shards that overlap by the longest item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import stored

# Words of lower-cased UTF-8: digits, a-z and every byte of a non-ASCII character.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 10
SHARD = 500_000     # words whose suffixes are sorted together
CHUNK = 8 << 20     # bytes of test items looked up in one pass
BLOCK = 16          # words compared at once while a match is extended

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("longest", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType()))])


def words(text: bytes | None) -> list[bytes]:
    return WORD.findall((text or b"").lower())


def suffix_array(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in suffix order, rank of each place) of the suffixes that begin with a
    number over 0, sorted by their first ``depth`` numbers up to the first 0.

    Prefix doubling: ranks by 2k numbers from those by k, until no two are equal or
    another round would part none."""
    at = np.flatnonzero(ids)
    rank = np.append(ids.astype(np.int64), 0)
    k, classes = 0, 0
    while len(at):
        pair = rank[at] * (rank.max() + 1)
        if k:
            pair += rank[np.minimum(at + k, len(ids))]
        found, order = np.unique(pair, return_inverse=True)
        rank[at] = order + 1
        k = 2 * k or 1
        if k >= depth or len(found) in (classes, len(at)):
            break
        classes = len(found)
    return at[np.argsort(rank[at], kind="stable")], rank[:-1]


def _search(ids: np.ndarray, order: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end place in ``order`` of the suffixes that begin with each row of
    ``wanted``.  ``ids`` ends in as many zeros as a row is long."""
    w = np.arange(wanted.shape[1])

    def border(after: bool) -> np.ndarray:
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(order))
        while (todo := np.flatnonzero(low < high)).size:
            mid = (low[todo] + high[todo]) // 2
            here, there = ids[order[mid][:, None] + w], wanted[todo]
            differ = here != there
            first = differ.argmax(axis=1)[:, None]
            less = (np.take_along_axis(here, first, 1) < np.take_along_axis(there, first, 1))[:, 0]
            less |= after & ~differ.any(axis=1)
            low[todo] = np.where(less, mid + 1, low[todo])
            high[todo] = np.where(less, high[todo], mid)
        return low
    return border(False), border(True)


def _common(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words the suffixes a[i:] and b[j:] share before a 0.  Both arrays end
    in ``BLOCK`` zeros."""
    n, todo, w = np.zeros(len(i), np.int64), np.arange(len(i)), np.arange(BLOCK)
    while todo.size:
        x = a[np.minimum(i[todo] + n[todo], len(a) - BLOCK)[:, None] + w]
        y = b[np.minimum(j[todo] + n[todo], len(b) - BLOCK)[:, None] + w]
        differ = (x != y) | (x == 0)
        more = np.where(differ.any(axis=1), differ.argmax(axis=1), BLOCK)
        n[todo] += more
        todo = todo[more == BLOCK]
    return n


@dataclass
class Chunk:
    """Test items ready for the tasks: word numbers, their suffix array, and for each
    window length the different windows with the items that have them."""
    vocabulary: dict
    ids: np.ndarray
    order: np.ndarray
    depth: int
    windows: list     # (windows as rows, place of each one's first owner, owners)
    names: list

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int) -> "Chunk":
        vocabulary, names, by_name = {}, [], {}
        seqs, owners = [], []
        for name, text in items:
            found = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]
            if found:
                if name not in by_name:
                    by_name[name] = len(names)
                    names.append(name)
                seqs.append(np.asarray(found, np.int32))
                owners.append(by_name[name])
        ids = np.concatenate([x for s in seqs for x in (s, np.zeros(1, np.int32))]
                             + [np.zeros(max(window, BLOCK), np.int32)])
        depth = max(map(len, seqs), default=1)
        begins = np.cumsum([0] + [len(s) + 1 for s in seqs[:-1]])
        windows = []
        for w in sorted({min(window, len(s)) for s in seqs}):
            having = [(b, len(s), o) for b, s, o in zip(begins, seqs, owners)
                      if min(window, len(s)) == w]
            at = np.concatenate([b + np.arange(n - w + 1) for b, n, _ in having])
            own = np.concatenate([np.full(n - w + 1, o) for _, n, o in having])
            rows, which = np.unique(ids[at[:, None] + np.arange(w)], axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.reshape(-1), own]), axis=1)
            windows.append((rows, np.searchsorted(pairs[0], np.arange(len(rows) + 1)), pairs[1]))
        return cls(vocabulary, ids, suffix_array(ids, depth)[0], depth, windows, names)

    def places(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(window length, number of the window, place, longest match there) of every
        verbatim copy of a window in a shard."""
        order, rank = suffix_array(ids, self.depth)
        ids = np.append(ids, np.zeros(max([BLOCK] + [r.shape[1] for r, _, _ in self.windows]),
                                      np.int32))
        for rows, _, _ in self.windows:
            first, end = _search(ids, order, rows)
            n = end - first
            which = np.repeat(np.arange(len(rows)), n)
            at = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
            # Places of one rank go on alike: they are extended once.
            _, some, same = np.unique(rank[at], return_index=True, return_inverse=True)
            yield rows.shape[1], which, at, self._longest(ids, at[some])[same]

    def _longest(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Longest verbatim match of each place with any test suffix: with one of its
        two neighbours in the order of the test suffixes."""
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.order))
        while (todo := np.flatnonzero(low < high)).size:
            mid = (low[todo] + high[todo]) // 2
            i, j = at[todo], self.order[mid]
            n = _common(ids, i, self.ids, j)
            less = self.ids[j + n] < ids[i + n]
            low[todo] = np.where(less, mid + 1, low[todo])
            high[todo] = np.where(less, high[todo], mid)
        best = np.zeros(len(at), np.int64)
        for j in (low - 1, low):
            ok = (j >= 0) & (j < len(self.order))
            best[ok] = np.maximum(best[ok], _common(ids, at[ok], self.ids, self.order[j[ok]]))
        return best


def _shards(texts: list, chunk: Chunk, size: int) -> Iterator[tuple]:
    """(word numbers, and of each text's part in it: row, place in the shard, place in
    the text, words of its own): texts until ``size`` words, a 0 after each."""
    ids, parts, at = [], [], 0
    get = chunk.vocabulary.get
    for row, text in enumerate(texts):
        found = np.asarray([get(w, 0) for w in words(text)], np.int32)
        for begin in range(0, len(found), size):
            part = found[begin: begin + size + chunk.depth]
            ids += [part, np.zeros(1, np.int32)]
            parts.append((row, at, begin, min(size, len(found) - begin)))
            at += len(part) + 1
            if at >= size:
                yield np.concatenate(ids), np.asarray(parts)
                ids, parts, at = [], [], 0
    if ids:
        yield np.concatenate(ids), np.asarray(parts)


def _scan(texts: list, chunk: Chunk, size: int) -> list[dict]:
    """RESULT of each text."""
    n = len(texts)
    length, longest = np.zeros(n, np.int64), np.zeros(n, np.int64)
    rows, begins, ends, held = [], [], [], set()
    for ids, parts in _shards(texts, chunk, size):
        row, in_shard, in_text, own = parts.T
        np.add.at(length, row, own)
        for (w, which, at, match), (_, first_owner, owners) in zip(chunk.places(ids), chunk.windows):
            part = np.searchsorted(in_shard, at, side="right") - 1
            mine = at - in_shard[part] < own[part]   # the overlap belongs to the next part
            which, at, match, part = which[mine], at[mine], match[mine], part[mine]
            np.maximum.at(longest, row[part], match)
            rows.append(row[part])
            begins.append(at - in_shard[part] + in_text[part])
            ends.append(begins[-1] + w)
            for r, x in np.unique(np.stack([row[part], which]), axis=1).T.tolist():
                held.update((r, o) for o in owners[first_owner[x]: first_owner[x + 1]].tolist())
    out = [{"n_words": k, "n_hit": 0, "longest": m, "spans": [], "items": []}
           for k, m in zip(length.tolist(), longest.tolist())]
    if rows:
        row, begin, end = map(np.concatenate, (rows, begins, ends))
        for i in np.lexsort((begin, row)).tolist():
            one, b, e = out[row[i]], int(begin[i]), int(end[i])
            spans = one["spans"]
            if spans and b <= spans[-1]["end"]:
                one["n_hit"] += max(0, e - spans[-1]["end"])
                spans[-1]["end"] = max(e, spans[-1]["end"])
            else:
                one["n_hit"] += e - b
                spans.append({"start": b, "end": e})
    for r, o in held:
        out[r]["items"].append(chunk.names[o])
    for one in out:
        one["items"].sort()
    return out


def _annotate(df: DataFrame, chunk: Chunk, text: str, into: str, size: int) -> DataFrame:
    """``df`` with one struct column more."""
    place, kind = df.columns.index(text), pa.struct([
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _scan(batch.column(place).cast(pa.binary()).to_pylist(), chunk, size)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)],
                                             [*batch.schema.names, into])
    return df.mapInArrow(scan, T.StructType(df.schema.fields + [T.StructField(into, RESULT)]))


def _chunks(items: DataFrame, item_key: str, item_text: str, window: int, limit: int,
            ) -> Iterator[Chunk]:
    """The test items in chunks of at most ``limit`` bytes; one empty chunk if there are none."""
    rows, size, n = [], 0, 0
    for name, text in items.select(
            F.coalesce(F.col(f"`{item_key}`").cast("string"), F.lit("")),
            F.encode(F.col(f"`{item_text}`"), "UTF-8")).toLocalIterator():
        text = bytes(text or b"")
        if rows and size + len(text) > limit:
            yield Chunk.of(rows, window)
            rows, size, n = [], 0, n + 1
        rows.append((name, text))
        size += len(text)
    if rows or not n:
        yield Chunk.of(rows, window)


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  shard: int = SHARD, chunk: int = CHUNK) -> DataFrame:
    """(key, n_words, n_hit, longest, spans, items) of every document: words, words in
    copied windows, words of the longest verbatim match, the copied places as word
    intervals that do not touch, and the sorted ids of the items copied from."""
    src = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("__t"))
    chunks = _chunks(items, item_key, item_text, window, chunk)
    first, second = next(chunks), next(chunks, None)
    if second is None:
        return _annotate(src, first, "__t", "__c", shard).select(key, "__c.*")
    hashed = F.sha2(F.coalesce("__t", F.lit("")), 256).alias("__h")
    return _merged([stored(_annotate(src, one, "__t", "__c", shard).select(key, hashed, "__c"),
                           "contamination") for one in chain([first, second], chunks)], key)


def _merged(passes: list[DataFrame], key: str) -> DataFrame:
    """One row per document from a pass per chunk.  Rows of equal key and text have equal
    results, so a group's sets hold as many values as there are chunks at most."""
    every = reduce(DataFrame.unionByName, passes)
    each = every.groupBy(key, "__h").agg(
        F.count(F.lit(1)).alias("n"), F.max("__c.n_words").alias("n_words"),
        F.max("__c.longest").alias("longest"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("__c.spans")))).alias("s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("__c.items")))).alias("items"))

    def add(done, x):
        end = F.try_element_at(done, F.lit(-1))
        longer = F.struct(end["start"].alias("start"), F.greatest(end["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (x["start"] <= end["end"]), F.concat(
            F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        ).otherwise(F.concat(done, F.array(x)))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    copies = F.sequence(F.lit(1), F.expr(f"cast(n div {len(passes)} as int)"))
    return (each.withColumn("spans", F.aggregate("s", F.slice("s", 1, 0), add))
            .withColumn("n_hit", hit).withColumn("__i", F.explode(copies))
            .select(key, "n_words", "n_hit", "longest", "spans", "items"))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
          item_text: str = "text", window: int = WINDOW, shard: int = SHARD,
          chunk: int = CHUNK) -> DataFrame:
    """The documents, all their columns, that hold no window of any item."""
    chunks = _chunks(items, item_key, item_text, window, chunk)
    first, second = next(chunks), next(chunks, None)
    if second is None:
        return (_annotate(docs, first, text, "__contamination", shard)
                .filter("size(__contamination.items) = 0").drop("__contamination"))
    # Texts are judged by their content alone, so the bad ones go by their digest.
    digest = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)
    src = docs.select(digest.alias("__h"), F.col(f"`{text}`").alias("__t"))
    bad = reduce(DataFrame.unionByName, [
        stored(_annotate(src, one, "__t", "__c", shard).filter("size(__c.items) > 0")
               .select("__h").distinct(), "contaminated") for one in chain([first, second], chunks)])
    return docs.join(bad.distinct(), digest == bad["__h"], "left_anti")
