"""Language identification by a convolutional network over bytes, trained in numpy on labelled text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import arrow_batches

#: Bytes per window, widths of the filters and filters per width.
WINDOW, WIDTHS, FILTERS = 192, (2, 3, 4), 8

#: The network is fitted on about so many documents a language, on so many windows of each, and on fewer a
#: language beyond so many documents in all.
SAMPLE_PER_LANGUAGE, WINDOWS_PER_DOCUMENT, SAMPLE = 1500, 4, 24_000

UNDETERMINED = "und"

_WINDOWS_AT_ONCE = 256


class ByteConv:
    """Filters of several widths over a window's bytes, the maximum of each over all places, then a softmax."""

    def __init__(self, languages: list[str], seed: int = 1) -> None:
        rnd = np.random.default_rng(seed)
        self.languages = languages
        self.filters = [rnd.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = rnd.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.offset = np.zeros(len(languages), np.float32)

    def _responses(self, windows: np.ndarray) -> list[np.ndarray]:
        out = []
        for w, table in zip(WIDTHS, self.filters, strict=True):
            n = windows.shape[1] - w + 1
            out.append(sum(table[i][windows[:, i : i + n]] for i in range(w)))
        return out

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 0.01) -> None:
        """Adam on the cross entropy."""
        rnd = np.random.default_rng(2)
        params = [*self.filters, self.bias, self.dense, self.offset]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        step = 0
        for _ in range(epochs):
            order = rnd.permutation(len(windows))
            for at in range(0, len(order), batch):
                x, y = windows[order[at : at + batch]], labels[order[at : at + batch]]
                rows, responses = np.arange(len(x)), self._responses(x)
                places = [r.argmax(1) for r in responses]
                pooled = np.concatenate([np.take_along_axis(r, p[:, None], 1)[:, 0] for r, p in zip(responses, places, strict=True)], 1)
                hidden = np.maximum(pooled + self.bias, 0)
                logits = hidden @ self.dense + self.offset
                p = np.exp(logits - logits.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[rows, y] -= 1
                p /= len(x)
                back = (p @ self.dense.T) * (hidden > 0)
                grads = []
                for k, (w, place) in enumerate(zip(WIDTHS, places, strict=True)):
                    g = np.zeros_like(self.filters[k])
                    part = back[:, k * FILTERS : (k + 1) * FILTERS]
                    for i in range(w):
                        seen = x[rows[:, None], place + i]
                        np.add.at(g[i], (seen, np.arange(FILTERS)[None]), part)
                    grads.append(g)
                grads += [back.sum(0), hidden.T @ p, p.sum(0)]
                step += 1
                for value, grad, (m, v) in zip(params, grads, moments, strict=True):
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What each pair of bytes adds to the filters, so that a place needs two look-ups."""
        two, three, four = self.filters
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
        return np.concatenate([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1]), pair(four[2], four[3])], 1), three[2]

    def logits(self, windows: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        pairs, third = tables
        codes = windows[:, :-1].astype(np.int32) << 8 | windows[:, 1:]
        found = pairs[codes]
        n = FILTERS
        pooled = np.concatenate([
            found[..., :n].max(1),
            (found[:, :-1, n : 2 * n] + third[windows[:, 2:]]).max(1),
            (found[:, :-2, 2 * n : 3 * n] + found[:, 2:, 3 * n :]).max(1),
        ], 1)
        return np.maximum(pooled + self.bias, 0) @ self.dense + self.offset


def cut(texts: list[bytes], most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, the last of each padded with zeros, and the text each one is from.

    With ``most``, only so many of a text, at even distances.
    """
    counts = np.array([max(1, -(-len(t) // WINDOW)) for t in texts], np.int64)
    data = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    firsts = np.cumsum(counts) - counts
    for first, t in zip(firsts, texts, strict=True):
        data[first * WINDOW : first * WINDOW + len(t)] = np.frombuffer(t, np.uint8)
    windows, owner = data.reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), counts)
    if most:
        place = np.arange(len(owner)) - firsts[owner]
        picked = place * most // counts[owner] != (place - 1) * most // counts[owner]
        return windows[picked], owner[picked]
    return windows, owner


def _has_letter() -> Column:
    return F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(labelled: DataFrame) -> ByteConv | None:
    """The network, from ``doc_id, text, lang``; None if there is nothing to learn from.

    It is fitted on a sample whose size does not grow with the table (``SAMPLE_PER_LANGUAGE`` and ``SAMPLE``):
    of each language, the documents whose hashed id is below the share it needs.
    """
    usable = labelled.where(F.col("lang").isNotNull() & _has_letter()).select("doc_id", "text", "lang")
    counts = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return None
    each = min(SAMPLE_PER_LANGUAGE, -(-SAMPLE // len(counts)))
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000))
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, each / n))]), F.col("lang"))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("window", T.BinaryType())])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = cut([t.encode() for t in batch.column("text").to_pylist()], WINDOWS_PER_DOCUMENT)
            langs = batch.column("lang").take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([langs, pa.array([w.tobytes() for w in found], pa.binary())], ["lang", "window"])

    sample = arrow_batches(usable.where(place < share * 1_000_000)).mapInArrow(windows, schema).orderBy("lang", "window").collect()
    languages = sorted(counts)
    number = {k: i for i, k in enumerate(languages)}
    model = ByteConv(languages)
    if sample:
        model.train(
            np.stack([np.frombuffer(bytes(r[1]), np.uint8) for r in sample]), np.array([number[r[0]] for r in sample])
        )
    return model


def predict(documents: DataFrame, model: ByteConv | None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to rows with ``text``: the mean of the windows' outputs decides.

    Every window of the whole text counts, by its bytes.  Null text, and text without a letter, is ``und`` with
    score 0, as is everything if there is no model.
    """
    own = documents.columns
    schema = T.StructType([*documents.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables() if model else None
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            known = np.array(batch.column("_letter").to_pylist(), bool)
            best, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if model and len(texts):
                total, windows, owner = np.zeros((len(texts), len(model.languages))), *cut(texts)
                sizes = np.array([len(t) for t in texts], float)
                place = np.arange(len(owner)) - np.searchsorted(owner, owner)
                weight = np.minimum(WINDOW, np.maximum(1, sizes[owner] - place * WINDOW))
                for at in range(0, len(windows), _WINDOWS_AT_ONCE):
                    part = slice(at, at + _WINDOWS_AT_ONCE)
                    np.add.at(total, owner[part], model.logits(windows[part], tables) * weight[part, None])
                total /= np.maximum(sizes, 1)[:, None]
                p = np.exp(total - total.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                top = p.argmax(1)
                best = [model.languages[i] if k else UNDETERMINED for i, k in zip(top, known, strict=True)]
                score = np.where(known, p.max(1), 0.0)
            columns = [batch.column(c) for c in own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(best, pa.string()), pa.array(score)], [*own, "lang_pred", "score"])

    return arrow_batches(documents.withColumn("_letter", _has_letter())).mapInArrow(run, schema)


def identified(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; what is held out is not learnt from.

    Null ids are held out.  Repeated rows get equal predictions; an empty table gives an empty result.
    """
    rows = documents.select("doc_id", "text", "lang")
    model = fit(rows.where(~held_out()))
    return predict(rows.select("doc_id", "text", held_out().alias("held_out")), model).drop("text")
