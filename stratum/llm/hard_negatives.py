"""Hard negatives by threshold joins over inverted lists, with thresholds lowered until each window is full.

Anchors come in blocks of bounded size, and every block meets all rows.  A task cuts its rows into pieces and indexes
each by dimension.  A row's leading dimensions are left out of the lists as long as their norm alone cannot bring
any score to the lowest threshold in force.  Scores are accumulated from the last dimension to the first; after each
group of dimensions, rows go whose score so far plus the product of the norms not yet seen stays below the
threshold of every anchor.  What is left is completed exactly with the dimensions left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import arrow_batches, shared_folder, stored

#: Positives per anchor, negatives per positive, and the least score of a negative in percent of the positive's.
POSITIVES, NEGATIVES, LEAST_PERCENT = 5, 5, 80

#: Components are multiplied by this and floored, and then lie within plus and minus LARGEST.
SCALE, LARGEST = 256, 1 << 24

#: Thresholds tried for positives, as parts of the anchor's score with itself, and for negatives, as parts of the
#: positive's score.  Whoever has a window open after the last one is searched down to the window's end.
POSITIVE_STEPS, NEGATIVE_STEPS = (0.8, 0.4, 0.2, 0.1), (0.96, 0.9)

#: Anchors per block (about), which are sent to every task, and cells per piece of rows and per table of scores.
BLOCK, PIECE_CELLS, SCORE_CELLS = 4096, 1 << 20, 1 << 21

_GROUP = 16  # dimensions between two prunings
_EXACT = float(1 << 52)  # integers up to here are exact in double
_NO_END = np.iinfo(np.int64).min


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, parts`` of the rows that take part: with id, label, and finite components throughout."""
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = lambda x: F.floor(x.cast("double") * SCALE)
    parts = F.transform(
        vector, lambda x: F.greatest(F.least(whole(x), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")
    )
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), parts.alias("parts")
    )


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Lists of numbers as rows of ``width`` columns: what is missing is 0, what is beyond is left out."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(offsets)
    values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    if (sizes == width).all():
        return values.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    owner, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    fits = place < width
    out[owner[fits], place[fits]] = values[fits]
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    """Norms of the first 0, 1, ... dimensions of each row."""
    out = np.zeros((len(x), x.shape[1] + 1))
    np.sqrt(np.cumsum(np.square(x, dtype=np.float64), axis=1), out=out[:, 1:])
    return out


@dataclass
class Block:
    """Anchors and the windows to fill: ``owner`` is the anchor of a window, ``low`` and ``high`` its score limits."""

    vectors: np.ndarray
    label: np.ndarray
    row: np.ndarray
    owner: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same_label: bool
    wanted: int

    def prepared(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of dimensions (those that weigh least first), norms of leading dimensions, threshold per anchor."""
        order = np.argsort(np.square(self.vectors, dtype=np.float64).sum(0), kind="stable")
        least = np.full(len(self.vectors), np.iinfo(np.int64).max)
        np.minimum.at(least, self.owner, self.low)
        return order, _norms(self.vectors[:, order]), least


class Index:
    """Inverted lists of one piece of rows: dimension k is listed for the first ``ends(k)`` rows."""

    def __init__(self, rows: np.ndarray, least: float):
        norms = _norms(rows)
        left_out = (norms[:, 1:] < least).sum(1)
        self.order = np.argsort(left_out, kind="stable")
        self.left_out, self.norms = left_out[self.order], norms[self.order]
        self.rows = rows[self.order].astype(np.float64)
        self.listed = self.rows * (np.arange(rows.shape[1]) >= self.left_out[:, None])

    def matches(self, q: np.ndarray, q_norms: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (anchor, row of the piece) whose score reaches the anchor's threshold, and the scores."""
        live = np.arange(len(self.rows))
        listed, left_out = self.listed, self.left_out
        score = np.zeros((len(q), len(live)))
        reached = np.ones(score.shape, bool)
        slack = 1e-9 * (q_norms[:, -1:] * self.norms[:, -1].max(initial=0) + 1)
        starts = list(range(0, q.shape[1], _GROUP))[::-1]
        for start in starts:
            stop = min(start + _GROUP, q.shape[1])
            n = np.searchsorted(left_out, stop)  # rows with a listed dimension before stop
            score[:, :n] += q[:, start:stop] @ listed[:n, start:stop].T
            unseen = np.maximum(start, left_out)
            bound = q_norms[:, unseen] * self.norms[live, unseen] + score
            reached = bound >= least[:, None] - slack
            if start:
                some = reached.any(0)
                if some.mean() < 0.75:
                    live, listed, left_out, score = live[some], listed[some], left_out[some], score[:, some]
                    reached = reached[:, some]
        anchor, at = np.nonzero(reached)
        row = live[at]
        if q_norms[:, -1].max(initial=0) * self.norms[:, -1].max(initial=0) < _EXACT:
            total = score[anchor, at]
            short = np.flatnonzero(self.left_out[row] > 0)
            for part in np.array_split(short, len(short) // 65536 + 1):
                rest = self.rows[row[part]] * (np.arange(q.shape[1]) < self.left_out[row[part], None])
                total[part] += np.einsum("ij,ij->i", q[anchor[part]], rest)
            exact = total.astype(np.int64)
        else:
            exact = np.zeros(len(row), np.int64)
            for part in np.array_split(np.arange(len(row)), len(row) // 65536 + 1):
                exact[part] = np.einsum("ij,ij->i", q[anchor[part]].astype(np.int64), self.rows[row[part]].astype(np.int64))
        good = exact >= least[anchor]
        return anchor[good], self.order[row[good]], exact[good]


def _first(window: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``most`` of each window by score, high ones first, then by id."""
    order = np.lexsort((ids, -score, window))
    window, score, ids = window[order], score[order], ids[order]
    kept = np.arange(len(window)) - np.searchsorted(window, window) < most
    return window[kept], score[kept], ids[kept]


def search_piece(block: Block, prepared: tuple, x: np.ndarray, ids: np.ndarray, label: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """Window, score and id of what one piece of rows has to offer: no more per window than it wants."""
    order, q_norms, least = prepared
    top = q_norms[:, -1]
    relative = np.min(np.where(top > 0, least / np.maximum(top, 1e-300), np.where(least > 0, np.inf, -1.0)))
    index = Index(x[:, order], float(relative) * (1 - 1e-9))
    q = block.vectors[:, order].astype(np.float64)
    step = max(1, SCORE_CELLS // max(len(x), 1))
    by_owner = np.argsort(block.owner, kind="stable")
    out = []
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        anchor, found, score = index.matches(q[part], q_norms[part], least[part])
        anchor = anchor + at
        fits = label[found] == block.label[anchor] if block.same_label else label[found] != block.label[anchor]
        fits &= row[found] != block.row[anchor]
        anchor, found, score = anchor[fits], found[fits], score[fits]
        order_ = np.lexsort((ids[found], -score, anchor))
        anchor, found, score = anchor[order_], found[order_], score[order_]
        windows = by_owner[np.searchsorted(block.owner[by_owner], at) : np.searchsorted(block.owner[by_owner], at + step)]
        begin, end = np.searchsorted(anchor, block.owner[windows]), np.searchsorted(anchor, block.owner[windows], "right")
        # Scores fall within an anchor: skip those above the window, then take what it wants.
        first = np.array([b + np.searchsorted(-score[b:e], -h) for b, e, h in zip(begin, end, block.high[windows], strict=True)], np.int64)
        for i in range(block.wanted):
            place = first + i
            inside = place < end
            w, p = windows[inside], place[inside]
            good = score[p] >= block.low[w]
            out.append((w[good], score[p[good]], ids[found[p[good]]]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def searched(rows: DataFrame, block: Block) -> DataFrame:
    """``window, score, id``: the best rows of each window of a block, from all ``rows``, ranked from 1."""
    width = block.vectors.shape[1]
    most = max(1, PIECE_CELLS // max(width, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepared, best = block.prepared(), (np.zeros(0, np.int64),) * 3
        pending: list[pa.RecordBatch] = []

        def done() -> None:
            nonlocal best, pending
            table = pa.Table.from_batches(pending).combine_chunks()
            pending = []
            x = _matrix(table.column("parts").chunk(0), width)
            found = search_piece(block, prepared, x, *[table.column(c).to_numpy() for c in ("vec_id", "label", "_row")])
            window, score, ids = (np.concatenate(pair) for pair in zip(best, found, strict=True))
            best = _first(window, score, ids, block.wanted)

        for batch in batches:
            for at in range(0, batch.num_rows, most):  # none of an empty batch
                pending.append(batch.slice(at, most))
                if sum(b.num_rows for b in pending) >= most:
                    done()
        if pending:
            done()
        window, score, ids = best
        yield pa.RecordBatch.from_arrays([pa.array(window, pa.int64()), pa.array(score, pa.int64()), pa.array(ids, pa.int64())], ["window", "score", "id"])

    found = rows.select("vec_id", "label", "_row", "parts").mapInArrow(run, "window long, score long, id long")
    rank = F.expr("row_number() OVER (PARTITION BY window ORDER BY score DESC, id)")
    return found.withColumn("rank", rank).where(F.col("rank") <= block.wanted)


def _positives(rows: DataFrame, vectors: np.ndarray, label: np.ndarray, row: np.ndarray, wanted: int) -> list[tuple[int, int, int]]:
    """(anchor, score, id) of the first rows with each anchor's label; no more than ``wanted`` of one block's anchor."""
    own = np.square(vectors, dtype=np.float64).sum(1)
    open_, found = np.arange(len(vectors)), {}
    for step in (*POSITIVE_STEPS, None):
        low = np.full(len(open_), _NO_END) if step is None else np.ceil(own[open_] * step).astype(np.int64)
        high = np.full(len(open_), np.iinfo(np.int64).max)
        block = Block(vectors[open_], label[open_], row[open_], np.arange(len(open_)), low, high, True, wanted)
        got: dict[int, list] = {}
        for r in searched(rows, block).collect():  # no more than wanted of each anchor of the block
            got.setdefault(int(open_[r.window]), []).append((r.score, r.id))
        found |= {a: f for a, f in got.items() if len(f) == wanted or step is None}
        open_ = np.array([a for a in open_ if a not in found], np.int64)
        if not len(open_):
            break
    return [(a, s, i) for a, f in sorted(found.items()) for s, i in sorted(f, key=lambda x: (-x[0], x[1]))]


def mined(
    embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT, every: int = 100, block: int = BLOCK
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``embeddings`` has ``vec_id, label, embedding``; anchors are the rows whose id ``every`` divides.  A score is
    the inner product of the floored components; high scores come first, ties by the smaller id.  An anchor's positives
    are its first other rows of its label; a positive's negatives are the first rows of other labels
    whose score is at least ``least_percent`` of the positive's and not above it, none for a negative positive score.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part.  Components
    beyond 2**24 after scaling count as that.  Vectors may differ in length: missing components are 0.  Rows that
    repeat an id are rows of their own, as anchor, positive and negative.  Empty tables give an empty result, and
    further columns are not read.
    """
    spark = embeddings.sparkSession
    rows = stored(usable(embeddings).withColumn("_row", F.monotonically_increasing_id()), "vectors")
    anchors = rows.where(F.col("vec_id") % every == 0)
    blocks = math.ceil(anchors.count() / block)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    path = shared_folder(spark, "negatives")
    spark.createDataFrame([], schema).write.parquet(f"{path}/part=none")
    arrow_batches(rows, 4096)
    for b in range(blocks):
        mine = anchors.where(F.pmod(F.xxhash64("vec_id", "_row"), F.lit(blocks)) == b).orderBy("vec_id", "_row").collect()
        if not mine:
            continue
        width = max(1, *[len(r.parts) for r in mine])
        vectors = np.array([r.parts + [0] * (width - len(r.parts)) for r in mine], np.int64).reshape(len(mine), width)
        label, row = (np.array([r[c] for r in mine], np.int64) for c in ("label", "_row"))
        found = [(a, s, i) for a, s, i in _positives(rows, vectors, label, row, positives) if s >= 0]
        if not found:
            continue
        owner, high, ids = (np.array(c, np.int64) for c in zip(*found, strict=True))
        end = -((-least_percent * high) // 100)
        open_ = np.arange(len(owner))
        for k, step in enumerate((*NEGATIVE_STEPS, None)):
            low = end[open_] if step is None else np.maximum(end[open_], np.ceil(high[open_] * step).astype(np.int64))
            used, own = np.unique(owner[open_], return_inverse=True)
            part = Block(vectors[used], label[used], row[used], own, low, high[open_], False, negatives)
            names = spark.createDataFrame(  # no more than ``positives`` for each anchor of the block
                [(i, int(mine[owner[w]].vec_id), int(ids[w]), int(high[w]), bool(low[i] == end[w]), int(w)) for i, w in enumerate(open_)],
                "window long, anchor_id long, positive_id long, positive_score long, _last boolean, _open long",
            )
            full = F.count("*").over(Window.partitionBy("window")) == negatives
            kept = searched(rows, part).withColumn("_full", full).join(F.broadcast(names), "window").where(F.col("_full") | F.col("_last"))
            here = f"{path}/part={b}-{k}"
            kept.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).write.parquet(here)
            filled = spark.read.parquet(here).where(F.col("rank") == negatives).select("_open").collect()
            closed = {r[0] for r in filled} | set(open_[low == end[open_]].tolist())
            open_ = np.array([w for w in open_.tolist() if w not in closed], np.int64)
            if not len(open_):
                break
    return spark.read.schema(schema).parquet(path).select(*[c.split()[0] for c in schema.split(", ")])
