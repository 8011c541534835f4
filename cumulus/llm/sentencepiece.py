"""SentencePiece encoding by streaming Viterbi, and decoding.

A text is cut into the pieces of the given model whose scores have the largest
sum.  Viterbi runs left to right: scores are held only for the next places a
piece can end, as many as the longest piece has characters, and ids are given
out as soon as all surviving paths go through one boundary.  Characters
without a piece become their UTF-8 bytes' pieces.

Between two characters that stand side by side in no piece, as between a
letter and a following space, every path goes through one boundary, so words
and their parts can be cut one by one and remembered.

Defined results: a null or empty text has no ids.  Equal sums: the longer last
piece wins.  U+2581, the model's sign for a space, is read as a space.
Decoding gives back the text, but for that sign.  Texts of any length are read
whole.  Rows are independent: repeated rows and ids repeat their results.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
REMEMBERED = 500_000  # words whose ids a task remembers at once
SHORT = 64            # characters of what is remembered
EVERY = 64            # characters between two searches for a common boundary
UNKNOWN = 10.0        # how far an unknown character scores below the worst piece


class Model:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(self.size)]
        self.bytes = {int(self.names[i][1:-1], 16): i for i in range(self.size) if sp.is_byte(i)}
        special = {i for i in range(self.size) if sp.is_control(i) or sp.is_unknown(i)
                   or sp.is_unused(i) or sp.is_byte(i)}
        self.set({self.names[i]: (i, sp.get_score(i)) for i in range(self.size)
                  if i not in special})
        raw = [b"" if i in special else n.replace(SPACE, " ").encode()
               for i, n in enumerate(self.names)]
        for value, i in self.bytes.items():
            raw[i] = bytes([value])
        self.raw = raw

    def set(self, pieces: dict[str, tuple[int, float]]) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN
        # Can words be cut apart?  Only if spaces stand at the front of pieces.
        self.by_word = all(SPACE not in p.lstrip(SPACE) for p in pieces)
        self.trie: dict = {}  # character -> (children, id or -1, score)
        for piece, (i, score) in pieces.items():
            at = self.trie
            for c in piece[:-1]:
                at = at.setdefault(c, ({}, -1, 0.0))[0]
            kids = at[piece[-1]][0] if piece[-1] in at else {}
            at[piece[-1]] = kids, i, score
        # Between two characters that stand side by side in no piece, all paths
        # go through one boundary too.
        self.joined = {p[n:n + 2] for p in pieces for n in range(len(p) - 1)}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def unknown_ids(self, char: str) -> tuple[int, ...]:
        return tuple(self.bytes.get(b, 0) for b in char.encode("utf-8", "surrogatepass"))

    def stream(self, chars: Iterable[str]) -> Iterator[list[int]]:
        """Lists of ids of the characters, as soon as they are certain.

        Held are the characters and scores of as many places as the longest piece has
        characters, and the best last piece of each place since the last boundary that
        was given out."""
        longest, unknown, pieces, trie = self.longest, self.unknown, self.pieces, self.trie
        none = -math.inf
        source, ahead, i, done = iter(chars), "", 0, False
        size = longest + 1
        best = [none] * size                 # ring: score of the best path to each place
        best[0] = 0.0
        at = start = reach = 0               # ahead[i]'s place; given out up to; last place reached
        begins: list[int] = []               # of the best last piece to each place after start
        ids: list = []                       # its id, or the character it has no piece for
        while True:
            while not done and len(ahead) - i < longest:
                more = next(source, None)
                if more is None:
                    done = True
                else:
                    ahead, i = ahead[i:] + more, 0
            if i == len(ahead):
                break
            slot = at % size
            here, best[slot] = best[slot], none
            kids, end, char = trie, at, ahead[i]
            for c in ahead[i:i + longest]:
                got = kids.get(c)
                if got is None:
                    break
                kids, piece, score = got
                end += 1
                if piece >= 0:
                    score += here
                    slot = end % size
                    if score > best[slot]:
                        best[slot] = score
                        if end > reach:
                            begins += [0] * (end - reach)
                            ids += [0] * (end - reach)
                            reach = end
                        slot = end - start - 1
                        begins[slot], ids[slot] = at, piece
            i, at = i + 1, at + 1
            if char not in pieces and here + unknown > best[at % size]:
                best[at % size] = here + unknown
                if at > reach:
                    begins.append(0)
                    ids.append(0)
                    reach = at
                begins[at - start - 1], ids[at - start - 1] = at - 1, char
            if reach == at:                  # one path survives
                common = at
            elif at % EVERY:
                continue
            else:                            # do all surviving paths go through one place?
                ends = {e for e in range(at, reach + 1) if best[e % size] > none}
                while len(ends) > 1 and (last := max(ends)) > start:
                    ends.remove(last)
                    ends.add(begins[last - start - 1])
                common = min(ends)
            if common > start:
                out, end = [], common
                while end > start:
                    got = ids[end - start - 1]
                    out += self.unknown_ids(got)[::-1] if isinstance(got, str) else (got,)
                    end = begins[end - start - 1]
                out.reverse()
                yield out
                del begins[:common - start], ids[:common - start]
                start = common

    def _part(self, part: str) -> bytes:
        """Ids of a stretch between forced boundaries."""
        return array("i", chain.from_iterable(self.stream((part,)))).tobytes()

    def _remembered(self, part: str, make) -> bytes:
        """Ids of a part, from memory if it came up lately."""
        ids = self.known.get(part)
        if ids is None:
            ids = self.older.get(part)
            if ids is None:
                ids = make(part)
            if len(part) <= SHORT:
                if len(self.known) >= REMEMBERED:  # keep what is in use, forget the rest
                    self.older, self.known = self.known, {}
                self.known[part] = ids
        return ids

    def _word(self, word: str) -> bytes:
        joined, cuts = self.joined, [0]
        cuts += [j for j in range(1, len(word)) if word[j - 1:j + 1] not in joined]
        if len(cuts) == 1:
            return self._part(word)
        cuts.append(len(word))
        return b"".join([self._remembered(word[i:j], self._part) for i, j in zip(cuts, cuts[1:])])

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        text = SPACE + text.replace(" ", SPACE)
        if not self.by_word:
            return np.array([i for part in self.stream((text,)) for i in part], dtype="<i4")
        known, out = self.known.get, []
        for word in _WORDS.findall(text):
            ids = known(word)
            if ids is None:
                ids = self._remembered(word, self._word)
                known = self.known.get
            out.append(ids)
        return np.frombuffer(b"".join(out), dtype="<i4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
        raw = self.raw
        data = b"".join([raw[i] for i in ids.tolist()])
        return data.removeprefix(b" ").decode("utf-8", "replace")


_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def encode(df: DataFrame, model: str, key: str = "doc_id", text: str = "text", *,
           check: bool = False) -> DataFrame:
    """key, ids, n_ids (and round_trip: decoding gives back the text)."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = load(model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = [sp.encode(t) for t in texts]
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                       pa.array(sizes)]
            if check:
                columns.append(pa.array([sp.decode(x) == (t or "").replace(SPACE, " ")
                                         for x, t in zip(ids, texts)]))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = df.schema[key].dataType.simpleString()
    names = ["key", "ids", "n_ids"] + ["round_trip"] * check
    schema = f"key {kind}, ids array<int>, n_ids long" + ", round_trip boolean" * check
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(each, schema).withColumnRenamed("key", key)


def decode(df: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, text of the ids; null ids are no ids."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = load(model)
        for batch in batches:
            texts = [sp.decode(np.array(x or [], dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["key", "text"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").alias("ids"))
    return rows.mapInArrow(each, f"key {kind}, text string").withColumnRenamed("key", key)
