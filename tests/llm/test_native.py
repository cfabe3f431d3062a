"""Fingerprints, shards, quality rules and mixing against plain Python."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
import xxhash

from stratum.llm import common, fingerprints, mixture, quality_rules, shards
from tests.llm.cases import SCHEMA, edge_documents, edge_rows, labels, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_running_totals(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), i, rnd.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, at long, v long").repartition(7)
    got = {(r.g, r.at): r.before for r in common.running_totals(df, ["at"], {"before": "v"}, "g").collect()}
    sums = collections.Counter()
    for g, at, v in rows:
        assert got[g, at] == sums[g]
        sums[g] += v


def test_salted_join_keeps_rows(spark):
    left = spark.createDataFrame([(i % 3 or None, i) for i in range(50)], "k long, v long")
    right = spark.createDataFrame([(1, "one")], "k long, name string")
    assert common.salted_join(left, right, ["k"], "left").count() == 50
    assert common.salted_join(left, right, ["k"], "inner").count() == sum(i % 3 == 1 for i in range(50))


def test_fingerprints(spark):
    out = fingerprints.fingerprinted(edge_documents(spark)).collect()
    rows = edge_rows()
    assert len(out) == len(rows)
    ids = sorted({r[0] for r in rows}, key=lambda x: -1 if x is None else x)
    texts = collections.defaultdict(list)
    for r in rows:
        texts[r[0]].append(r[1] or "")
    following = {a: min(texts[b], key=lambda t: hashlib.sha256(t.encode()).hexdigest()) for a, b in zip(ids, [*ids[1:], ids[0]], strict=True)}
    want = collections.Counter()
    for r in rows:
        t, n = r[1] or "", following[r[0]]
        k = len(t) // 4
        want[r[0], len(t), hashlib.sha256((t[: len(t) - k] + n[:k]).encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == want
    by_text = collections.defaultdict(set)
    for r in out:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.n_chars:
            by_text[r.doc_id, r.n_chars].add(r.fingerprint)
    assert by_text[0, len(rows[0][1])] == by_text[3, len(rows[3][1])]  # equal texts
    assert fingerprints.fingerprinted(edge_documents(spark).limit(0)).count() == 0


def _sketch(text):
    """Spark's xxhash64 of each five words, one word's hash the seed of the next; those below the common limit."""
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = set()
    for i in range(max(len(tokens) - 4, 1 if tokens else 0)):
        h = 42
        for w in tokens[i : i + 5]:
            h = xxhash.xxh64(w.encode(), seed=h).intdigest()
        hashes.add(h - 2**64 if h >= 2**63 else h)
    below = {h for h in hashes if h < -(2**63) + 2**64 // fingerprints.SCALE}
    return below or ({min(hashes)} if hashes else set())


def _alike(a, b):
    return 1.0 if a == b else len(a & b) / max(min(len(a), len(b)), 1)


def test_fingerprints_equal_brute_force(spark):
    rows = {r[0]: r[1] or "" for r in edge_rows()}
    rows |= {100 + i: words(random.Random(i), 3 * i) for i in range(40)}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(5)
    ids = sorted(rows, key=lambda x: -1 if x is None else x)
    got = {r.doc_id: r for r in fingerprints.fingerprinted(df).collect()}
    assert got.keys() == rows.keys()
    for own, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, following = rows[own], rows[after]
        k = len(text) // 4
        edited = text[: len(text) - k] + following[:k]
        x, y, z = _sketch(text), _sketch(edited), _sketch(following)
        r = got[own]
        assert r.fingerprint == "".join(f"{h % 2**64:016x}" for h in sorted(x))
        assert r.edited_fingerprint == "".join(f"{h % 2**64:016x}" for h in sorted(y))
        assert math.isclose(r.near_edited, _alike(x, y)) and math.isclose(r.near_next, _alike(x, z))


def test_short_passages_are_contained_in_long_texts(spark):
    rnd = random.Random(5)
    long = words(rnd, 1000)
    parts = [" ".join(long.split(" ")[at : at + 30]) for at in range(0, 970, 2)]
    df = spark.createDataFrame([(long, p) for p in parts], "a string, b string")
    both = fingerprints.with_sketch(fingerprints.with_sketch(df, "a", "x"), "b", "y")
    found = [r[0] for r in both.select(fingerprints.containment(both.y, both.x)).collect()]
    assert sum(v == 1 for v in found) >= 0.99 * len(found)


def test_sketch_estimates_containment(spark):
    rnd = random.Random(2)
    long, short = words(rnd, 20000), ""
    short = " ".join(long.split(" ")[5000:8000]) + " " + words(rnd, 3000)
    df = spark.createDataFrame([(long, short)], "a string, b string")
    both = fingerprints.with_sketch(fingerprints.with_sketch(df, "a", "x"), "b", "y")
    row = both.select(
        fingerprints.containment(both.y, both.x).alias("part"), fingerprints.merge(both.x, both.y).alias("both"), "x", "y"
    ).first()
    assert abs(row.part - 0.5) < 0.1
    assert row.both == sorted({*row.x, *row.y})
    assert all(h < -(2**63) + 2**64 // fingerprints.SCALE for h in row.x)


def test_shards(spark):
    rows = edge_rows()
    out = shards.sharded(edge_documents(spark), 3).collect()
    sizes = collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in out) == sizes
    for s in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert shards.sharded(edge_documents(spark).limit(0)).count() == 0


def test_shards_are_balanced_and_keep_groups(spark):
    rnd = random.Random(3)
    texts = [words(rnd, rnd.randint(5, 60)) for _ in range(3000)]
    rows = [(i, rnd.choice(texts)) for i in range(9000)] + [(10_000 + i, "copy " * 40) for i in range(4500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = shards.sharded(df).collect()
    size = collections.Counter()
    where = collections.defaultdict(set)
    for r in out:
        size[r.shard] += r.size
        where[r.text_crc32].add(r.shard)
    mean = sum(size.values()) / 8
    assert len(size) == 8 and max(abs(s - mean) for s in size.values()) < mean / 50
    assert [len(w) > 1 for w in where.values()].count(True) == 1  # only the group larger than a shard


def _measures(t: str) -> tuple:
    w, seen, repeated = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    runs = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), repeated, len(covered)


def test_quality_measures(spark):
    rows = edge_rows()
    out = quality_rules.rated(edge_documents(spark), labels(spark)).collect()
    want = collections.Counter((r[0], *_measures(r[1] or "")) for r in rows)
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == want
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in out)
    assert all(r.kept != r.base_failed for r in out)  # too few labels for any further rule
    kept = quality_rules.keep_good(edge_documents(spark), labels(spark))
    assert kept.columns == edge_documents(spark).columns
    assert kept.count() == sum(r.kept for r in out)
    assert quality_rules.rated(edge_documents(spark).limit(0), labels(spark)).count() == 0
    assert quality_rules.rated(edge_documents(spark), labels(spark).limit(0)).count() == len(rows)


@pytest.mark.parametrize(("n", "k"), [(10, 0), (500, 2), (2000, 3), (20000, 80), (100, 7)])
def test_binomial_tail(spark, n, k):
    from pyspark.sql import functions as F

    got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), 0.005)).first()[0]
    exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(0.005) + (n - j) * math.log(0.995)) for j in range(k + 1))
    assert got == pytest.approx(1.0 if k > n * 0.005 else exact, rel=1e-6)


def test_cutoffs_are_safe_and_useful(spark):
    """With enough good documents rules reject junk; where good documents have symbols too, that rule stays off."""
    rnd = random.Random(5)
    rows, marks = [], []
    for i in range(6000):
        lang, good = ("en", "de")[i % 2], i % 10 != 0
        w = words(rnd, 15).split(" ")
        if not good or lang == "de" and i % 7 == 0:
            w = [x + "#" for x in w]
        rows.append((i, " ".join(w), lang))
        marks.append((i, int(good), 0, 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    out = {r.doc_id: r.kept for r in quality_rules.rated(df, labels(spark, marks)).collect()}
    assert all(out[i] == (i % 10 != 0) for i in range(0, 6000, 2))
    assert all(out[i] for i in range(1, 6000, 2))


def test_cutoffs_hold_for_their_own_stratum_only(spark):
    """400 good documents of a language are enough for cutoffs; 5 good ones with symbols of another, and 20 of a third
    without any label, lose nothing by them."""
    rnd = random.Random(6)
    rows, marks = [], []
    for i in range(470):
        lang = "de" if i < 445 else "eu" if i < 450 else "la"
        symbols = i % 10 == 0 if lang == "de" else True
        w = [x + "##" if symbols else x for x in words(rnd, 15).split(" ")]
        rows.append((i, " ".join(w), lang))
        if lang != "la":
            marks.append((i, int(lang == "eu" or not symbols), 0, 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    out = {r.doc_id: r.kept for r in quality_rules.rated(df, labels(spark, marks)).collect()}
    assert out == {i: i >= 445 or i % 10 != 0 for i in range(470)}


def test_rejections_by_the_base_do_not_count_against_rules(spark):
    """Good documents that the base rejects have symbols too; the rule is calibrated on the others."""
    rnd = random.Random(7)
    rows, marks = [], []
    for i in range(500):
        lost, junk = i % 20 == 1, i % 10 == 0
        w = [x + "##" if lost or junk else x for x in words(rnd, 5 if lost else 15).split(" ")]
        rows.append((i, " ".join(w), "de"))
        marks.append((i, int(not junk), 0, 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    out = {r.doc_id: r.kept for r in quality_rules.rated(df, labels(spark, marks)).collect()}
    assert out == {i: i % 20 != 1 and i % 10 != 0 for i in range(500)}


@pytest.mark.parametrize(("n", "k"), [(150, 0), (400, 1), (400, 9), (2000, 8), (2000, 25)])
def test_cutoffs_equal_brute_force(spark, n, k):
    """The cutoffs of one stratum from plain binomial sums over both families of settings."""
    from pyspark.sql import functions as F

    rnd = random.Random(n + k)
    texts = [" ".join(x + "#" * (i < k) for x in words(rnd, 20).split(" ")) for i in range(n)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    good = quality_rules.measured(df).withColumn("stratum", F.lit("s"))
    got = quality_rules.calibrate(good).collect()

    def tail(hits: int, p: float) -> float:
        return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(hits + 1))

    rules = quality_rules.RULES
    over = {r: [sum(x > c for x in ([1.0] * k if r == "symbols_per_word" else [])) for c in ladder] for r, ladder in rules.items()}

    def climb(hits: list[int], p: float, most: float) -> int:
        passed = [tail(h, p) <= most for h in hits]
        return passed.index(False) if False in passed else len(passed)

    most = quality_rules.RISK / 2
    if tail(0, quality_rules.MAX_FALSE_REJECTION) > most:
        assert got == []
        return
    alone = {r: climb(h, quality_rules.MAX_FALSE_REJECTION / len(rules), most / len(rules)) for r, h in over.items()}
    steps = max(map(len, rules.values()))
    joint = climb([max(h[min(i, len(h) - 1)] for h in over.values()) for i in range(steps)], quality_rules.MAX_FALSE_REJECTION, most)
    reached = alone if any(alone.values()) else {r: min(joint, len(x)) for r, x in rules.items()}
    want = {r: float("inf") if reached[r] == 0 else x[reached[r] - 1] for r, x in rules.items()}
    assert got[0].cutoffs.asDict() == want


def _mix(rows: list[tuple], weights=(1, 2, 3), most=3) -> dict:
    sized = [(r[0], r[3], len(WORD.findall(r[1] or ""))) for r in rows]
    total = collections.Counter()
    for _, s, n in sized:
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = sum(total.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * total[s]}
        if not above:
            target |= share
            break
        for s in above:
            target[s] = most * total[s]
            left -= target[s]
        open_ -= above
    return {s: (total[s], target[s]) for s in names}


def test_mixture(spark):
    rows = edge_rows()
    out = mixture.mixed(edge_documents(spark)).collect()
    want = _mix(rows)
    assert len(out) == len(rows)
    for s, (size, target) in want.items():
        own = [r for r in out if r.source == s]
        assert {r.source_size for r in own} == {size}
        assert own[0].target == pytest.approx(target)
        assert abs(sum(r.taken for r in own) - target) < 1
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    again = mixture.mixed(edge_documents(spark).repartition(5)).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, out))
    mixed = mixture.mix(edge_documents(spark))
    assert mixed.columns == SCHEMA.replace(",", "").split(" ")[::2]
    assert mixed.count() == sum(r.copies for r in out)
    assert mixture.mixed(edge_documents(spark).limit(0)).count() == 0
