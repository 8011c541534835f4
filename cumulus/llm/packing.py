"""Packing documents into training sequences by best-fit decreasing.

A document's token ids, with an end id, are cut into full windows and one rest;
the pieces then go, longest first, into the open window with the least room
that still fits.  That window is found in a segment tree over remaining room.

Pieces are dealt by a stored row number into bins of about BIN pieces, each
packed by one task on its own, so no task grows with the corpus.  Only
lengths and checksums are shuffled, never texts or ids.

Defined results: a null or empty text is one piece, the end id alone.  Repeated
rows and ids are documents of their own.  A text of any length is tokenized
whole.  An empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import stored

WINDOW = 2048
END = 1
BIN = 8192
LONG_RUN = 2000  # longer runs without white space go to the slower, steadier engine


@lru_cache(maxsize=4)
def encoder(path: str):
    """text -> ids as unsigned 32-bit numbers, as `tokenizers` gives them for the
    file with add_special_tokens=False.

    For the byte-level vocabulary the same merges run through tiktoken, three
    times as fast; texts with a special token's string, or with a very long run
    without white space, and all other kinds of file go through `tokenizers`.
    """
    import re

    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    whole = []  # loaded when a text needs it: it holds tens of megabytes

    def plain(text: str) -> np.ndarray:
        if not whole:
            whole.append(Tokenizer.from_file(path))
        return np.array(whole[0].encode(text, add_special_tokens=False).ids, dtype="<u4")

    kind = (spec.get("pre_tokenizer") or {}).get("type"), spec["model"]["type"]
    if kind != ("ByteLevel", "BPE") or spec["pre_tokenizer"].get("add_prefix_space") \
            or spec.get("normalizer"):
        return plain
    import public_tokenizers
    import tiktoken
    special = [t["content"] for t in spec["added_tokens"]]
    # Byte-level files write bytes that do not print as the code points from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
             if token not in special}
    fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})
    run = re.compile(rf"(?<!\S)\S{{{LONG_RUN}}}")

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special) or run.search(text):
            return plain(text)
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    return encode


def cuts(n: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full windows, then the rest."""
    return [(s, min(window, n - s)) for s in range(0, n, window)]


class Rooms:
    """Open windows by remaining room; a segment tree finds the tightest fit."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) with the least room of at least ``need``."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(sequence, offset) for each length; they come longest first."""
    rooms, out, made = Rooms(window), [], 0
    for n in lengths:
        at = rooms.take(n)
        if at is None:
            at, made = (window, made), made + 1
        room, seq = at
        out.append((seq, window - room))
        if room > n:
            rooms.put(room - n, seq)
    return out


def pieces(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", *,
           window: int = WINDOW, end: int = END, with_ids: bool = False) -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens (and ids): a row for each piece."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["key"], pdf["text"]):
                ids = np.append(encode(t), np.uint32(end)) if t else np.array([end])
                ids = ids.astype("<u4")
                for s, n in cuts(len(ids), window):
                    data = ids[s:s + n].tobytes()
                    rows.append((k, s, n, zlib.crc32(data), len(ids),
                                 *([data] if with_ids else [])))
            yield pd.DataFrame(rows, columns=names)

    # The key travels as text: pandas would make numbers with nulls inexact.
    kind = df.schema[key].dataType
    names = ["key", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = "key string, start long, length long, ids_crc32 long, doc_tokens long" \
        + ", ids binary" * with_ids
    rows = df.select(F.col(f"`{key}`").cast("string").alias("key"),
                     F.col(f"`{text}`").alias("text"))
    return rows.mapInPandas(cut, schema).select(F.col("key").cast(kind).alias(key), *names[1:])


def pack(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", *,
         window: int = WINDOW, end: int = END, with_ids: bool = False,
         bin_pieces: int = BIN) -> DataFrame:
    """The pieces with sequence_id and offset: where each one lies."""
    cut = stored(pieces(df, tokenizer, key, text, window=window, end=end, with_ids=with_ids)
                 .withColumn("row", F.monotonically_increasing_id()), "pieces")
    bins = max(1, -(-cut.count() // bin_pieces))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bin; the last bin of a batch waits for the next."""
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            at = best_fit(pdf["length"].tolist(), window)
            first = int(pdf["bin"].iloc[0]) << 32
            return pd.DataFrame({"row": pdf["row"].to_numpy(),
                                 "sequence_id": [first + s for s, _ in at],
                                 "offset": [o for _, o in at]})
        wait: list[pd.DataFrame] = []
        for pdf in batches:
            for name, part in pdf.groupby("bin", sort=True):
                if wait and wait[0]["bin"].iloc[0] != name:
                    yield one(pd.concat(wait))
                    wait = []
                wait.append(part)
        if wait:
            yield one(pd.concat(wait))

    dealt = cut.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(bins)).alias("bin"))
    placed = (dealt.repartition("bin").sortWithinPartitions("bin", F.desc("length"), "row")
              .mapInPandas(place, "row long, sequence_id long, offset long"))
    return cut.join(placed, "row").drop("row")
