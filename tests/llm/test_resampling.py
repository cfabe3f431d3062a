"""Importance resampling against a direct computation, and its selection against sorting."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.llm import resampling
from tests.llm.cases import edge_documents, edge_rows, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    return [zlib.crc32(w.encode()) % 10000 for w in WORD.findall((text or "").translate(LOWER))]


def brute(rows, target, percent=10, least=20):
    source, wanted = Counter(), Counter()
    for _, t in rows:
        source.update(features(t))
    for t in target:
        wanted.update(features(t))
    s_all, t_all = source.total(), wanted.total()
    scored = []
    for i, t in rows:
        found = features(t)
        gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000)))) for b in found]
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(gain) if gain else 0
        scored.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    ranks = {id(r): n for n, r in enumerate(able[: len(able) * percent // 100], 1)}
    return Counter((*r, ranks.get(id(r))) for r in scored)


def test_edge_cases_equal_a_direct_computation(spark):
    target = spark.createDataFrame([(1, "abc  DÉ é one two"), (2, None), (3, "")], "item_id long, text string")
    out = resampling.resampled(edge_documents(spark), target, percent=50)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in out.dtypes} == {"bigint"}
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert Counter(tuple(r) for r in out.collect()) == brute(rows, ["abc  DÉ é one two", None, ""], 50)


def test_large_text_and_hot_repeats(spark):
    rnd = random.Random(3)
    rows = [(i, words(rnd, rnd.randint(1, 60))) for i in range(300)] + [(7, words(rnd, 25))] * 150 + [(400, words(rnd, 30_000))]
    target = [words(rnd, 40) for _ in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    out = resampling.resampled(docs.repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), percent=30)
    got = Counter(tuple(r) for r in out.collect())
    assert got == brute(rows, target, 30)
    assert got == Counter(tuple(r) for r in resampling.resampled(docs.repartition(2), spark.createDataFrame([(t,) for t in target], "text string"), percent=30).collect())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resampled(none, none).count() == 0
    one = spark.createDataFrame([(1, "a b c " * 20)], "doc_id long, text string")
    assert [r.rank for r in resampling.resampled(one, none).collect()] == [None]
    assert [r.rank for r in resampling.resampled(one, none, percent=100).collect()] == [1]


@pytest.mark.parametrize("k", [0, 1, 57, 498, 499])
def test_selection_with_ties_and_nulls(spark, k):
    rnd = random.Random(k)
    rows = [(rnd.randint(0, 5), rnd.choice([None, 1, 2]), i) for i in range(500)]
    table = spark.createDataFrame(rows, "a long, b long, c long").repartition(4)
    order = resampling.Order(("a", "b", "c"))
    want = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))[k]
    assert resampling.kth(table, order, k, pivots=3) == want
