"""Byte-level BPE: exact encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stratum.llm.common import arrow_batches

#: How the byte-level pre-tokenizer splits text; its white space is the Unicode property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

#: Pieces whose ids a worker remembers, and pairs of tokens whose compatibility it does.
REMEMBERED, REMEMBERED_PAIRS = 300_000, 2_000_000

_NEVER = 1 << 60


def _printable_bytes() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec(dict):
    """Ids of one piece of text (as packed 32-bit integers) by its characters; works out and keeps what is missing.

    Every prefix of a piece has one valid encoding, and so one last token.  A token that ends at a place is
    the last one there if the last token of what precedes it may stand before it: two tokens may stand side by
    side if merging their bytes yields just the two.  Following the last tokens backwards gives the ids.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _printable_bytes()
        vocabulary = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocabulary.values(), *self.added.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, i in vocabulary.items():
            self.tokens[i] = bytes(byte_of[c] for c in token)
        for token, i in self.added.items():
            self.tokens[i] = token.encode()
        self.lengths = [len(t) for t in self.tokens]
        self.bytes = pa.array(self.tokens, pa.large_binary())
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.ranks: dict[int, dict[int, int]] = defaultdict(dict)  # by the left and then the right token
        for r, (a, b) in enumerate(pairs):
            self.ranks[vocabulary[a]][vocabulary[b]] = r
        self.parts = {vocabulary[a + b]: (vocabulary[a], vocabulary[b]) for a, b in reversed(pairs)}
        self.matches = ahocorasick.Automaton()
        for i in vocabulary.values():
            self.matches.add_word(self.tokens[i].decode("latin-1"), i)
        self.matches.make_automaton()
        self.split = regex.compile(PATTERN).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self._older: dict[str, bytes] = {}
        self._pairs: dict[int, dict[int, bool]] = defaultdict(dict)
        self._known_pairs = 0
        self._whole: dict[int, bool] = {}
        self._edges: tuple[dict[int, list], dict[int, list]] = {}, {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one edge while ``token`` is put together, each with the rank of the merge that ends it."""
        edge = self._edges[side].get(token)
        if edge is None:
            edge, end, at = [], _NEVER, token
            while True:
                edge.append((at, end))
                if at not in self.parts:
                    break
                left, right = self.parts[at]
                end, at = self.ranks[left][right], (left, right)[side]
            self._edges[side][token] = edge
        return edge

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens are what their joined bytes are merged to.

        Merges go by rank, and a token's rank is above those of its parts, so the tokens at both edges of the
        boundary live for ranges of ranks.  A merge across it happens if its rank comes before the merges that
        end its two sides; of equal merges the one further left is first.
        """
        known = self._pairs[left].get(right)
        if known is None:
            known = not self._crossed(left, right, _NEVER)
            self._known_pairs += 1
            if self._known_pairs >= REMEMBERED_PAIRS:
                self._pairs.clear()
                self._known_pairs = 0
            self._pairs[left][right] = known
        return known

    def _crossed(self, left: int, right: int, limit: int) -> bool:
        """Whether a merge of rank below ``limit`` goes across the boundary of the two tokens."""
        starts = self._edge(right, 0)
        for a, a_end in self._edge(left, 1):
            ranks = self.ranks.get(a)
            if ranks:
                end = min(a_end, limit)
                for b, b_end in starts:
                    rank = ranks.get(b, _NEVER)
                    if rank < end and rank <= b_end:
                        return True
        return False

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes are merged to it."""
        if token not in self._whole:
            parts = self.parts.get(token)
            self._whole[token] = self.lengths[token] == 1 or parts is not None and (
                self.whole(parts[0]) and self.whole(parts[1]) and not self._crossed(*parts, self.ranks[parts[0]][parts[1]])
            )
        return self._whole[token]

    def piece(self, data: bytes) -> list[int]:
        last = [-1] * (len(data) + 1)
        lengths, pairs, whole = self.lengths, self._pairs, self._whole
        for end, token in self.matches.iter(data.decode("latin-1")):
            end += 1
            if last[end] >= 0:  # the longest match comes first and mostly is the one
                continue
            start = end - lengths[token]
            if start == 0:
                if whole.get(token) or self.whole(token):
                    last[end] = token
            else:
                before = last[start]
                known = pairs[before].get(token)
                if known or known is None and self.compatible(before, token):
                    last[end] = token
        ids, at = [], len(data)
        while at:
            ids.append(last[at])
            at -= lengths[last[at]]
        return ids[::-1]

    def __missing__(self, text: str) -> bytes:
        ids = self._older.get(text)
        if ids is None:
            found = self.piece(text.encode())
            ids = pack(f"{len(found)}i", *found)
        if len(text) <= 64:
            if len(self) >= REMEMBERED:  # what is still in use comes back from the older ones
                self._older = dict(self)
                self.clear()
            self[text] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; the strings of added tokens are those tokens."""
        get, packed = self.__getitem__, []
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            packed.append(np.int32(self.added[part]).tobytes() if i % 2 else b"".join(map(get, self.split(part))))
        return np.frombuffer(b"".join(packed), np.int32)

    def decode(self, ids: list[int]) -> str:
        return self.texts(pa.array(ids, pa.int32()), np.array([0, len(ids)]))[0]

    def texts(self, ids: pa.Array, edges: np.ndarray) -> list[str]:
        """The texts of consecutive runs of ``ids``, from one of the ``edges`` to the next."""
        found = self.bytes.take(ids)
        starts, data = (np.frombuffer(found.buffers()[1], np.int64), found.buffers()[2]) if len(ids) else (np.zeros(1, np.int64), None)
        held = memoryview(data if data is not None else b"")
        return [str(held[a:b], "utf-8", "replace") for a, b in pairwise(starts[edges].tolist())]


@lru_cache(2)
def codec(path: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path)


def _encoded(own: Codec, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Ids of all texts of a batch one after the other, and where each text begins and ends."""
    found = [own.encode(t or "") for t in texts.to_pylist()]
    edges = np.cumsum([0, *map(len, found)], dtype=np.int32)
    return pa.array(np.concatenate([np.empty(0, np.int32), *found])), edges


def encode(rows: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Replace ``text`` by ``ids``, the token ids of the whole text; null is encoded as the empty text.

    With ``decoded`` the ids are decoded in the same pass into a column of that name, as ``decode`` does.
    ``path`` is a tokenizer file that every executor can open (it is part of an installed package or sent along
    with the job).  Other columns, repeated rows and empty tables pass through.
    """
    others = [c for c in rows.columns if c != text]
    more = [T.StructField(decoded, T.StringType())] if decoded else []
    schema = T.StructType([*[rows.schema[c] for c in others], T.StructField(ids, T.ArrayType(T.IntegerType())), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            flat, edges = _encoded(own, batch.column(text))
            columns = [*[batch.column(c) for c in others], pa.ListArray.from_arrays(pa.array(edges), flat)]
            if decoded:
                columns.append(pa.array(own.texts(flat, edges), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return arrow_batches(rows).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``, decoded from ``ids``; bytes that are no UTF-8 become replacement characters, null ids null."""
    schema = T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            lists = batch.column(ids)
            edges = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            found = own.texts(lists.flatten(), edges)
            missing = lists.is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(found, object), pa.string(), mask=missing)], [*batch.schema.names, text]
            )

    return arrow_batches(rows).mapInArrow(run, schema)
