"""Masked pseudo-likelihood of documents: a network predicts every word from the words on both sides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import arrow_batches
from stratum.llm.text_arrays import chunks, column_bytes, mixed, word_hashes

#: Words on each side, and sizes of embeddings and hidden layer.
SIDE, EMBEDDING, HIDDEN = 2, 8, 16

#: Tokens are CLASSES x MEMBERS: the most frequent words, and BUCKETS for the hashes of all others.
CLASSES, MEMBERS, BUCKETS = 64, 64, 512
TOKENS = CLASSES * MEMBERS

#: Rounds of training; every word of every document is predicted in one of them.
ROUNDS = 2

_BATCH, _RATE, _AT_ONCE = 4096, 0.1, 1 << 15


def vocabulary(documents: DataFrame) -> np.ndarray:
    """Hashes of the most frequent words of all rows, most frequent first; the list has a fixed length at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            own, times = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(times)], ["word", "times"])

        for batch in batches:
            for _, part in chunks(column_bytes(batch, "text")):
                held.append(word_hashes(part)[0])
                size += len(held[-1])
            if size > 4_000_000:
                yield flush()
                held, size = [], 0
        yield flush()

    counted = arrow_batches(documents.select("text")).mapInArrow(count, "word long, times long")
    top = counted.groupBy("word").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "word").limit(TOKENS - BUCKETS)
    return np.array([r[0] for r in top.collect()], np.int64).view(np.uint64)


class Network:
    """Embeddings of the words around a gap, a hidden layer, and a softmax over classes and over a class's members."""

    SHAPES = {
        "embed": (TOKENS + 1, EMBEDDING), "mix": (2 * SIDE * EMBEDDING, HIDDEN), "bias": (HIDDEN,),
        "classes": (HIDDEN, CLASSES), "class_bias": (CLASSES,), "members": (CLASSES, HIDDEN, MEMBERS), "member_bias": (CLASSES, MEMBERS),
    }

    def __init__(self, known: np.ndarray, flat: np.ndarray | None = None) -> None:
        self.order = np.argsort(known).astype(np.int64)
        self.known = known[self.order]
        if flat is None:
            rnd, flat = np.random.default_rng(3), []
            for name, shape in self.SHAPES.items():
                flat.append((np.zeros(shape) if "bias" in name else rnd.normal(0, 0.1, shape)).ravel())
            flat = np.concatenate(flat)
        self.flat, at = flat.astype(np.float32), 0
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token of each word of the texts, and where each text starts."""
        h, bounds = word_hashes(texts)
        out = TOKENS - BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            hit = self.known[at] == h
            out[hit] = self.order[at[hit]]
        return out, bounds

    @staticmethod
    def contexts(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The words on both sides of each word, within its text."""
        n = len(tokens)
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        out = np.full((n, 2 * SIDE), TOKENS, np.int64)
        place = np.arange(n)
        for i, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
            at = np.clip(place + step, 0, max(n - 1, 0))
            inside = (place + step >= 0) & (place + step < n) & (owner[at] == owner)
            out[inside, i] = tokens[at[inside]]
        return out

    def _hidden(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seen = self.embed[contexts].reshape(len(contexts), -1)
        return seen, np.tanh(seen @ self.mix + self.bias)

    @staticmethod
    def _softmax(x: np.ndarray) -> np.ndarray:
        if not _small(x):
            x -= x.max(1, keepdims=True)
        np.exp(x, out=x)
        x /= _row_sums(x)[:, None]
        return x

    def log_probabilities(self, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """ln P(word | words around it) for each gap."""
        out = np.empty(len(targets))
        for at in range(0, len(targets), _AT_ONCE):
            part = slice(at, at + _AT_ONCE)
            hidden, (kind, member) = self._hidden(contexts[part])[1], np.divmod(targets[part], MEMBERS)
            logits = hidden @ self.classes + self.class_bias
            own = logits[np.arange(len(kind)), kind] - _log_sum(logits)
            order = np.argsort(kind, kind="stable")
            edges = np.searchsorted(kind[order], np.arange(CLASSES + 1))
            for c in np.flatnonzero(np.diff(edges)):
                rows = order[edges[c] : edges[c + 1]]
                inner = hidden[rows] @ self.members[c] + self.member_bias[c]
                own[rows] += inner[np.arange(len(rows)), member[rows]] - _log_sum(inner)
            out[part] = own
        return out

    def train(self, contexts: np.ndarray, targets: np.ndarray, squares: np.ndarray) -> None:
        """Adagrad on the cross entropy; ``squares`` carries the summed squared gradients on."""
        views, at = {}, 0
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            views[name] = squares[at : at + n].reshape(shape)
            at += n
        for at in range(0, len(targets), _BATCH):
            x, (kind, member) = contexts[at : at + _BATCH], np.divmod(targets[at : at + _BATCH], MEMBERS)
            n = len(x)
            seen, hidden = self._hidden(x)
            p = self._softmax(hidden @ self.classes + self.class_bias)
            p[np.arange(n), kind] -= 1
            back = p @ self.classes.T
            order = np.argsort(kind, kind="stable")
            edges = np.searchsorted(kind[order], np.arange(CLASSES + 1))
            hidden_of, member_of, back_of = hidden[order], member[order], np.empty_like(hidden)
            members, member_bias = np.zeros_like(self.members), np.zeros_like(self.member_bias)
            for c in np.flatnonzero(np.diff(edges)):
                rows = slice(edges[c], edges[c + 1])
                q = self._softmax(hidden_of[rows] @ self.members[c] + self.member_bias[c])
                q[np.arange(len(q)), member_of[rows]] -= 1
                np.matmul(q, self.members[c].T, out=back_of[rows])
                np.matmul(hidden_of[rows].T, q, out=members[c])
                member_bias[c] = q.sum(0)
            back[order] += back_of
            changes = {"classes": hidden.T @ p, "class_bias": p.sum(0), "members": members, "member_bias": member_bias}
            back *= 1 - hidden * hidden
            inner = (back @ self.mix.T).reshape(-1, EMBEDDING)
            ids = x.ravel()
            by_id = np.stack([np.bincount(ids, w, TOKENS + 1) for w in inner.T], 1).astype(np.float32)
            changes |= {"mix": seen.T @ back, "bias": back.sum(0), "embed": by_id}
            for name, grad in changes.items():
                grad = grad / 32
                views[name][...] += grad * grad
                getattr(self, name)[...] -= _RATE * grad / np.sqrt(views[name] + 1e-6)


def _small(x: np.ndarray) -> bool:
    """Whether sums of exp(x) stay within the range of a float without a shift."""
    return -60 < x.min() and x.max() < 60


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def _log_sum(x: np.ndarray) -> np.ndarray:
    if _small(x):
        return np.log(_row_sums(np.exp(x)))
    top = x.max(1)
    return np.log(np.exp(x - top[:, None]).sum(1)) + top


def rounds(texts: list[bytes], bounds: np.ndarray) -> np.ndarray:
    """The round in which each word of the texts is predicted, by its place and the length of its text."""
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], np.diff(bounds))
    salt = np.repeat(mixed(np.array([len(t) for t in texts], np.uint64)), np.diff(bounds))
    return mixed(place.astype(np.uint64) ^ salt) % np.uint64(ROUNDS)


def fit(documents: DataFrame) -> Network:
    """The network, trained on every word of every document of the table.

    A round predicts one word in ROUNDS, so all of them together predict each once.  In a round every task trains its own copy on its part of the table, starting from the common parameters, and
    the copies are averaged, weighted by their words, parameter by parameter.  What reaches the driver is one network.
    """
    known = vocabulary(documents)
    network = Network(known)
    for turn in range(ROUNDS):
        start = network.flat

        def learn(batches: Iterator[pa.RecordBatch], start: np.ndarray = start, turn: int = turn) -> Iterator[pa.RecordBatch]:
            own, squares, n = Network(known, start), np.zeros(len(start), np.float32), 0
            for batch in batches:
                for _, part in chunks(column_bytes(batch, "text")):
                    tokens, bounds = own.tokens(part)
                    chosen = rounds(part, bounds) == turn
                    own.train(own.contexts(tokens, bounds)[chosen], tokens[chosen], squares)
                    n += int(chosen.sum())
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(start))), pa.array(own.flat.astype(float) * n), pa.array(np.full(len(start), n, float))],
                    ["place", "value", "weight"],
                )

        copies = arrow_batches(documents.select("text")).mapInArrow(learn, "place long, value double, weight double")
        mean = copies.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("value"))
        flat = start.copy()
        for place, value in mean.collect():  # one network
            flat[place] = value
        network = Network(known, flat)
    return network


def score(documents: DataFrame, network: Network) -> DataFrame:
    """``doc_id, n_tokens, pseudo_log_likelihood, score`` of every row.

    The sum of ln P(word | words around it) over all words of the text, and its mean.  Null text and text without words
    have sum 0 and a null mean.  Sums are rounded to six places.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for at, part in chunks(column_bytes(batch, "text")):
                tokens, bounds = network.tokens(part)
                n[at : at + len(part)] = np.diff(bounds)
                owner = np.repeat(np.arange(len(part)), np.diff(bounds))
                logs = network.log_probabilities(network.contexts(tokens, bounds), tokens)
                total[at : at + len(part)] = np.round(np.bincount(owner, logs, len(part)), 6)
            mean = pa.array(np.divide(total, n, out=np.zeros(len(n)), where=n > 0), mask=n == 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(total), mean], ["doc_id", "n_tokens", "pseudo_log_likelihood", "score"]
            )

    schema = f"doc_id {kind}, n_tokens long, pseudo_log_likelihood double, score double"
    return arrow_batches(documents.select("doc_id", "text")).mapInArrow(run, schema)
