"""Base spans against the plain patterns; further spans on planted data."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from stratum.llm import personal_data as pd
from stratum.llm import queries
from tests.llm.cases import edge_documents, words

PLAIN = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    good = (
        lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")),
        lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)), lambda s: 9 <= len(digits(s)) <= 15,
    )
    return [(k, *m.span()) for k, p in enumerate(PLAIN) for m in p.finditer(text) if good[k](m.group())]


def test_base_spans_equal_the_plain_patterns():
    rnd = random.Random(1)
    alphabet = ["1", "2", "55", "255", "256", "4111111111111111", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "é", "_", "\n", "000", "x@y.z"]
    for _ in range(30_000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30)))
        assert pd.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + " " * 200_000, "@a.b" * 50_000, "1 " * 100_000, "(at)" * 50_000):
        base = pd.base_spans(text)
        pd.further_spans(text, base)


def card(rnd):
    d = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
    return next(d + c for c in "0123456789" if pd.luhn(d + c))


def planted(rnd, n=300):
    rows, extra = [], {}
    for i in range(n):
        a, b = card(rnd), card(rnd)
        bad = a[:-1] + str((int(a[-1]) + 5) % 10)
        text = words(rnd, 30) + " " + [
            f"{a} rest", f"{a} {b} rest", f"{bad} rest", f"write to jo.{i}@mail.example.com now", "call +1 (212) 555-0199 10.20.30.44 ok",
            f"mail mo{i} [at] mail [dot] org now", "host 10.0.0.1 up", "version 3.0 of 2020", "call 212-555-0123 now",
        ][i % 9] + " " + words(rnd, 30)
        rows.append((i, text))
        if i % 9 in (1, 4, 5):
            extra[i] = {a, b} if i % 9 == 1 else {"+1 (212) 555-0199"} if i % 9 == 4 else {f"mo{i} [at] mail [dot] org"}
    return rows, extra


def test_further_spans_of_planted_data(spark):
    rows, extra = planted(random.Random(2))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = pd.fit(docs)
    text = dict(rows)
    for r in pd.find(docs, model).collect():
        own = [(pd.KINDS.index(s.kind), s.start, s.end) for s in r.spans]
        assert own == sorted(own) and [o for o, s in zip(own, r.spans, strict=True) if s.base] == plain(text[r.doc_id])
        added = {text[r.doc_id][s.start : s.end] for s in r.spans if not s.base}
        if r.doc_id % 9 in (1, 4, 5):
            assert added >= extra[r.doc_id]
        elif r.doc_id % 9 != 8:
            assert not added, (text[r.doc_id], added)
    again = pd.fit(docs.repartition(7))
    assert all(np.allclose(model.weights[k], again.weights[k]) for k in model.weights)
    redacted = {r.doc_id: r.text for r in pd.redact(docs, model).collect()}
    assert "[card] [card] rest" in redacted[1] and "+1 (212)" not in redacted[4] and "[phone] [ip] ok" in redacted[4]
    assert redacted[7] == text[7]


def test_a_checksum_is_not_overruled():
    votes = np.array([(1, 1, 1, 0, 0, 1), (1, -1, 1, 0, 0, 1), (1, -1, 0, 0, 0, 1), (1, 1, 0, 0, 0, 1)])
    likely, trust = pd.aggregated(votes, np.array([900.0, 300.0, 700.0, 100.0]))
    assert likely[0] > 0.9 and likely[3] > 0.5 > likely[1] > likely[2] and trust.shape == (6, 2, 3)
    assert np.allclose(trust.sum(2), 1)


def test_edge_cases(spark):
    docs = edge_documents(spark).withColumn("spans", F.lit("clash")).withColumn("start", F.lit(1))
    model = pd.fit(docs)
    out = pd.find(docs, model)
    assert out.columns == [c for c in docs.columns if c not in ("text", "spans")] + ["spans"]
    assert out.count() == docs.count() and out.where("size(spans) > 0").count() == 0
    assert {(r.doc_id, r.text) for r in pd.redact(docs, model).collect()} == {(r.doc_id, r.text) for r in docs.collect()}
    none = spark.createDataFrame([], "doc_id long, text string")
    empty = pd.fit(none)
    assert not empty.weights and pd.find(none, empty).count() == 0
    assert pd.spans_of("1234567812345678 a@b.c", empty) == [(0, 17, 22, True, 1.0)]


def test_query_columns(spark, tmp_path):
    text = "é a@b.co, 10.0.0.1 +49 30 1234567"
    docs = spark.createDataFrame([(1, text), (2, None), (None, "")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op12_personal_data(spark, str(tmp_path))
    assert out.dtypes == [
        ("doc_id", "bigint"), ("n_email", "bigint"), ("n_ip", "bigint"), ("n_card", "bigint"), ("n_phone", "bigint"),
        ("base_sha256", "string"), ("spans", "string"),
    ]
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].spans == "email:2:8,ip:10:18,phone:19:33" and rows[1][1:5] == (1, 1, 0, 1)
    assert rows[2].spans == rows[None].spans == "" and rows[2].base_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
