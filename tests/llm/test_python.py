"""Operators that run numpy in tasks, against plain Python, libraries and exact round trips."""

from __future__ import annotations

import base64
import collections
import gzip
import hashlib
import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratum.llm import bpe, common, language_id, minhash, pseudo_likelihood, suffix_dedup, warc
from stratum.llm.queries import tokenizer_path
from tests.llm.cases import edge_documents, edge_rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_bpe_equals_library(library):
    own, rnd = bpe.Codec(tokenizer_path()), random.Random(1)
    alphabet = "aaab '  \n\t\r\x1c\x85\xa0 éß日本😀1２٣#<|endoftext|>ststhetheinging'll'ré\x00"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    texts += [t + "<|endoftext|>" + t[:5] for t in texts[:200]] + ["a" * 30000, " " * 3000, "the" * 1000, "!" * 999]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t).tolist() == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert all(own.whole(i) for i in own.parts)


def test_bpe_on_rows(spark, library):
    path = tokenizer_path()
    out = bpe.decode(bpe.encode(edge_documents(spark), path), path)
    got = collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in out.collect())
    want = collections.Counter()
    for r in edge_rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], tuple(ids), r[1] or ""] += 1
    assert got == want
    once = bpe.encode(edge_documents(spark), path, decoded="decoded")
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in once.collect()) == want
    assert bpe.encode(edge_documents(spark).limit(0), path, decoded="decoded").count() == 0


def test_bpe_decodes_any_ids(spark, library):
    path = tokenizer_path()
    part = library.encode("日", add_special_tokens=False).ids[:1]  # a piece of a character
    rows = spark.createDataFrame([(1, None), (2, []), (3, part), (4, part + part), (5, None)], "doc_id int, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(rows, path).collect()}
    assert got == {1: None, 5: None} | {
        i: library.decode(x, skip_special_tokens=False) for i, x in [(2, []), (3, part), (4, part + part)]
    }


def test_language_is_learnt(spark):
    rnd = random.Random(2)
    letters = {"x1": "abcd", "x2": "efgh", "x3": "éüßö"}
    rows = [(i, " ".join("".join(rnd.choice(letters[k]) for _ in range(5)) for _ in range(rnd.randint(3, 200))), k) for i, k in enumerate(list(letters) * 150)]
    rows += [(1000, None, "x1"), (1001, "12 34", "x1"), (1002, "", None), (None, "abcd abcd", None), (1003, rows[0][1] * 40, None)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double").repartition(4)
    out = {r.doc_id: r for r in language_id.identified(df).collect()}
    assert len(out) == len(rows)
    held = [r for r in rows[:450] if out[r[0]].held_out]
    assert 50 < len(held) < 150
    assert np.mean([out[r[0]].lang_pred == r[2] for r in held]) > 0.95
    assert [out[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert out[1003].lang_pred == out[0].lang_pred
    assert all(0 <= r.score <= 1 for r in out.values())
    none = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identified(none).collect()} == {"und"}
    assert language_id.identified(df.limit(0)).count() == 0


def _covered(texts: list, n: int = 200) -> list[tuple]:
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p : p + n] for b in data for p in range(len(b) - n + 1))
    out = []
    for b in data:
        hit = np.zeros(len(b) + 1, np.int32)
        for p in range(len(b) - n + 1):
            if seen[b[p : p + n]] > 1:
                hit[p] += 1
                hit[p + n] -= 1
        mask = np.cumsum(hit)[: len(b)] > 0
        kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
        out.append((len(b), int(mask.sum()), int((np.diff(np.append(0, mask.astype(int))) == 1).sum()), kept))
    return out


@pytest.mark.parametrize("hot", [50_000, 3])
def test_repeated_strings(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_ANCHOR", hot)
    rnd = random.Random(6)
    raw = lambda n: "".join(rnd.choice("abcdé ü日") for _ in range(n))
    shared = [raw(rnd.randint(150, 700)) for _ in range(12)]
    texts = ["".join(rnd.choice([raw(rnd.randint(0, 300)), rnd.choice(shared), rnd.choice(shared)[rnd.randint(0, 100) :]]) for _ in range(rnd.randint(0, 4))) for _ in range(90)]
    texts += [texts[3]] * 5 + [None, "", "to " * 300, "x" + "to " * 80, "to " * 66 + "t", "a" * 1000, "a" * 199, "a" * 200, "ab" * 90 + raw(50) + "ab" * 90]
    long = raw(4000)
    for i in range(15):
        edited = list(long)
        for _ in range(i):
            edited[rnd.randrange(4000)] = "Z"
        texts.append("".join(edited))
    df = spark.createDataFrame([(i if i % 17 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _salt string").repartition(3)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.removed(df).collect())
    assert got == collections.Counter((i if i % 17 else None, *x) for i, x in enumerate(_covered(texts)))
    cleaned = suffix_dedup.without_repeats(df)
    assert cleaned.columns == df.columns and cleaned.count() == len(texts)


def test_repeated_strings_edges(spark):
    rows = edge_rows()
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.removed(edge_documents(spark)).collect())
    assert got == collections.Counter((r[0], *x) for r, x in zip(rows, _covered([r[1] for r in rows]), strict=True))
    cleaned = suffix_dedup.without_repeats(edge_documents(spark))
    assert cleaned.columns == edge_documents(spark).columns
    assert suffix_dedup.removed(edge_documents(spark).limit(0)).count() == 0


def test_repeated_strings_of_one_character(spark):
    texts = ["a" * 20_000, "b" + "a" * 9_000 + "c", "ab" * 5_000, "x" * 199 + "y" * 199, "z" * 201]  # more than a block of anchors
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.removed(df).collect()}
    assert got == dict(enumerate(_covered(texts)))


def test_pieces_of_one_character_take_little_memory(spark, monkeypatch):
    class Rows:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(suffix_dedup, "arrow_batches", lambda rows: Rows())
    text = b"a" * 120_000
    data = np.frombuffer(text, np.uint8)
    wanted = np.unique(suffix_dedup.anchors(data, np.array([0]), np.array([len(data)]))[1]).view(np.int64)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([b"k" * 16]), pa.array([0], pa.int32()), pa.array([text.decode()]), pa.array([wanted.tolist()], pa.list_(pa.int64()))],
        ["_md5", "_salt", "_text", "_wanted"],
    )
    tracemalloc.start()
    packed = sum(b.num_rows for b in suffix_dedup._pieces(None, 1)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert packed == 1 and peak < 150e6


def test_repeated_strings_leave_little_behind(spark, monkeypatch, tmp_path):
    rnd, own = random.Random(4), common.shared_folder
    monkeypatch.setattr(common, "shared_folder", lambda spark, purpose: f"{tmp_path}/{own(spark, purpose).rsplit('/', 1)[1]}")
    raw = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = raw(500)
    df = spark.createDataFrame([(i, raw(20_000) + shared) for i in range(40)], "doc_id long, text string")
    assert suffix_dedup.removed(df).where("n_removed >= 500").count() == 40
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 40_000  # the anchors found several times, not all


def test_repeated_strings_exchange_texts_once(spark, capsys):
    rnd = random.Random(5)
    raw = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = raw(500)
    df = spark.createDataFrame([(i, raw(2_000) + shared, "x") for i in range(20)], "doc_id long, text string, lang string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        for result in (suffix_dedup.removed(df), suffix_dedup.without_repeats(df)):
            result.collect()
            result.explain()
            assert "ReusedExchange" in capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cut_characters_go_and_replacement_characters_stay(spark):
    rnd = random.Random(9)
    shared = "".join(rnd.choice("abcdef ") for _ in range(260))
    rows = [
        (0, "ab\ufffdc\u00e9" + shared + "\u00e9z\ufffd"), (1, "qq\u0129" + shared + "\u00e8y"),  # one byte of each is shared
        (2, "no cut \ufffd"), (3, None), (4, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: r.text for r in suffix_dedup.without_repeats(df).collect()}
    assert got == {0: "ab\ufffdcz\ufffd", 1: "qqy", 2: "no cut \ufffd", 3: None, 4: ""}


def _classes(rows: list[tuple], similarity: float = 0.8) -> dict:
    features = []
    for _, t in rows:
        w = WORD.findall(t or "")
        features.append(collections.Counter([tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []))
    df = collections.Counter(k for f in features for k in f)
    least = max(2, math.ceil(len(rows) * minhash.RARE))
    weight = [{k: c * math.log1p(len(rows) / df[k] if df[k] >= least else min(len(rows), 1 / minhash.RARE)) for k, c in f.items()} for f in features]
    root = list(range(len(rows)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(weight):
        for j in range(i):
            b = weight[j]
            less = sum(min(v, b[k]) for k, v in a.items() if k in b)
            every = sum(a.values()) + sum(b.values()) - less
            if (rows[i][1] or "") == (rows[j][1] or "") or less and less / every >= similarity:
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("small", [16, 2])
def test_near_duplicates(spark, monkeypatch, small):
    monkeypatch.setattr(minhash, "SMALL_BUCKET", small)
    rnd = random.Random(8)
    texts = []
    for _ in range(12):
        base = words(rnd, rnd.randint(30, 300)).split(" ")
        for _ in range(rnd.randint(1, 9)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 60))):
                w[rnd.randrange(len(w))] = words(rnd, 1)
            texts.append(" ".join(w))
    texts += [texts[0]] * 3 + ["", None, "one", "one", "two words"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, class_id int").repartition(3)
    groups = collections.defaultdict(set)
    for r in minhash.near_duplicates(df).collect():
        groups[r.class_id].add(r.doc_id)
    assert all(k == min(g) for k, g in groups.items())
    assert {frozenset(g) for g in groups.values()} == _classes(list(enumerate(texts)))
    one = minhash.one_of_each(df)
    assert one.columns == df.columns and {r.doc_id for r in one.collect()} == set(groups)


def test_links_connect_all_that_share_one_band(spark):
    """Two chains of 110 variants in one bucket that no other band splits: links connect them as brute force does."""
    rnd = random.Random(1)
    rows = []
    for _ in range(2):
        w = words(rnd, 400).split(" ")
        rows += [" ".join(w[2 * i : 2 * i + 60]) for i in range(110)]
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = minhash._text_rows(df).withColumn("_row", minhash._row_hash())
    idf = minhash.frequencies(df)
    signed = minhash._signed(texts.select("_md5", "_salt", "_row", F.col("_rest.doc_id").alias("_id"), "_text"), idf)
    signed = signed.withColumn("_bands", F.array(F.lit(7).cast("long"), *[F.xxhash64("_md5", F.lit(j)) for j in range(9)])).cache()
    node = {bytes(r._md5): r._id for r in signed.collect()}
    got = collections.defaultdict(set)
    for r in minhash.components(minhash.links(df, signed, idf)).collect():
        got[bytes(r.root)].add(node[bytes(r.node)])
    assert {frozenset(g) for g in got.values()} == _classes(rows) == {frozenset(range(110)), frozenset(range(110, 220))}


def test_near_duplicates_edges(spark):
    out = minhash.near_duplicates(edge_documents(spark)).collect()
    assert len(out) == len(edge_rows())
    assert {r.class_id for r in out if r.doc_id in (0, 2, 3)} == {0}
    one = minhash.one_of_each(edge_documents(spark))
    assert one.columns == edge_documents(spark).columns
    assert one.count() == len({r.class_id for r in out})
    assert minhash.near_duplicates(edge_documents(spark).limit(0)).count() == 0


def test_consistent_samples_agree_as_often_as_weights():
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 2**63, 300).astype(np.uint64)
    a, b = np.exp(rnd.normal(0, 1, 300)), np.exp(rnd.normal(0, 1, 300))
    owner = np.zeros(300, np.int64)
    same = np.mean([
        minhash.samples(owner, h, np.log(a).astype(np.float32), 1, k)[0] == minhash.samples(owner, h, np.log(b).astype(np.float32), 1, k)[0]
        for k in range(3000)
    ])
    assert same == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.03)


def test_components(spark):
    rnd = random.Random(9)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.root for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


@pytest.mark.parametrize("at_once", [0, 200_000])
def test_links_do_not_pass_the_driver(spark, monkeypatch, at_once):
    rnd, name = random.Random(4), lambda i: hashlib.md5(str(i).encode()).digest()
    edges = {(name(rnd.randrange(400)), name(400 + rnd.randrange(400))) for _ in range(300)}
    links, none = (spark.createDataFrame(pa.table(
        {"a": pa.array([a for a, _ in rows], pa.binary()), "b": pa.array([b for _, b in rows], pa.binary())}
    )) for rows in (edges, set()))
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))

    def refused(*args, **options):
        raise AssertionError("links are brought to the driver")

    with monkeypatch.context() as patched:
        for owner, method in ((type(links), "toArrow"), (type(links), "collect"), (type(spark), "createDataFrame")):
            patched.setattr(owner, method, refused)
        patched.setattr(minhash, "_LINKS_AT_ONCE", at_once, raising=False)
        patched.setattr(minhash, "components", lambda e: e.selectExpr("a AS node", "b AS root"))
        roots, empty = minhash._roots(links), minhash._roots(none)
    if at_once:
        assert {bytes(r.node): bytes(r.root) for r in roots.collect()} == {x: find(x) for x in root}
    assert roots.count() == (len(root) if at_once else len(edges)) and empty.count() == 0


def test_pseudo_likelihood(spark):
    """Text in its order is likelier than the same words shuffled; probabilities of a gap add up to one."""
    rnd = random.Random(3)
    nouns, verbs = [f"n{i}" for i in range(20)], [f"v{i}" for i in range(20)]
    sentence = lambda: f"the {rnd.choice(nouns)} then {rnd.choice(verbs)} now"
    rows = [(i, " ".join(sentence() for _ in range(30)), 0.0) for i in range(600)]
    shuffled = [(1000 + i, " ".join(rnd.sample(t.split(" "), 150)), 0.0) for i, t, _ in rows[:50]]
    edges = [(2000, None, 0.0), (2001, "", 0.0), (2002, "unseen", 0.0), (None, "the", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    network = pseudo_likelihood.fit(df)
    out = {r.doc_id: r for r in pseudo_likelihood.score(spark.createDataFrame(rows + shuffled + edges, df.schema), network).collect()}
    assert np.mean([out[i].score for i in range(50)]) > np.mean([out[1000 + i].score for i in range(50)]) + 0.1
    assert out[2000].n_tokens == out[2001].n_tokens == 0 and out[2000].score is None and out[2000].pseudo_log_likelihood == 0
    assert out[2002].n_tokens == 1 and out[None].pseudo_log_likelihood < 0
    total = sum(np.exp(network.log_probabilities(np.array([[1, 2, 3, 4]]), np.array([t]))[0]) for t in range(pseudo_likelihood.TOKENS))
    assert total == pytest.approx(1, abs=1e-4)
    assert pseudo_likelihood.score(df.limit(0), pseudo_likelihood.fit(df.limit(0))).count() == 0


def test_pseudo_likelihood_predicts_every_word_once():
    texts = [b"", *[b"word " * n for n in range(1, 400)], b" "]
    bounds = np.concatenate([[0], np.cumsum([len(t.split()) for t in texts])])
    turn = pseudo_likelihood.rounds(texts, bounds)
    shares = np.bincount(turn.astype(int), minlength=pseudo_likelihood.ROUNDS) / bounds[-1]
    assert len(turn) == bounds[-1] and len(shares) == pseudo_likelihood.ROUNDS
    assert shares.sum() == 1 and shares.min() > 0.9 / pseudo_likelihood.ROUNDS


@pytest.mark.parametrize("split", ["128m", "3000"])
def test_warc_round_trip(spark, split):
    """Magic strings and whole records inside payloads, cut into splits of any size."""
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [
        (1, "http://a", "<html>x</html>"), (2, None, "<html>x</html>"), (3, "u\r\nv", None), (4, "u", ""), (5, "u", "a WARC/1.1\r\n b"),
        (6, "é", "WARC/1.1\r\nWARC/1.1\r\n"), (7, "u", fake + fake + "tail é"), (8, "u", "x" * 9000 + fake), (9, "u", "\r\n\r\nfoo\r\n\r\n"),
        (None, "u", "nullid"), (10, "u", "dup"), (10, "u", "dup"), (11, "u", "é" * 2000),
        *[(100 + i, "u", f"p{i}" + "z" * (i * 37 % 300)) for i in range(150)],
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, offset int").repartition(3)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        out = warc.round_trip(df).collect()
        assert warc.round_trip(df.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    newest = {}
    for p, _, h in rows:
        newest[h or ""] = max(newest.get(h or "", -1), -1 if p is None else p)
    want = collections.Counter()
    for p, _, h in rows:
        b, revisit = (h or "").encode(), newest[h or ""] != (-1 if p is None else p)
        want[p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", newest[h or ""] if revisit else None] += 1
    assert collections.Counter(tuple(r)[:5] for r in out) == want
    assert all(r.intact for r in out)


def test_warc_headers_and_compressed_archives(spark, tmp_path):
    """Every record has the mandatory fields and an HTTP block; archives with a gzip member per record read alike."""
    pages = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (None, None, "no id"), (3, "http://c", None), (4, "http://d", "é")]
    plain, packed = tmp_path / "plain", tmp_path / "packed"
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), str(plain))
    packed.mkdir()
    seen, ids = collections.Counter(), set()
    for file in plain.glob("part-*"):
        data, members = file.read_bytes(), []
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            first, *lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            assert first == "WARC/1.1"
            assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
            assert re.fullmatch("<urn:[^>]+>", fields["WARC-Record-ID"])
            assert fields["Content-Type"] == "application/http; msgtype=response"
            assert not any(name.startswith("X-") for name in fields)
            length = int(fields["Content-Length"])
            http, _, payload = rest[:length].partition(b"\r\n\r\n")
            assert http.startswith(b"HTTP/1.1 200 OK\r\n") and rest[length : length + 4] == b"\r\n\r\n"
            if fields["WARC-Type"] == "response":
                assert int(http.rsplit(b"Content-Length: ", 1)[1]) == len(payload)
                assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
            else:
                assert payload == b"" and fields["WARC-Refers-To"] == "<urn:page:2>" and "WARC-Profile" in fields
            seen[fields["WARC-Type"]] += 1
            ids.add(fields["WARC-Record-ID"])
            members.append(gzip.compress(data[: len(head) + 4 + length + 4]))
            data = rest[length + 4 :]
        (packed / f"{file.stem}.warc.gz").write_bytes(b"".join(members))
    assert seen == {"response": 4, "revisit": 1} and len(ids) == 5
    rows = [collections.Counter(tuple(r) for r in warc.read(spark, str(p)).collect()) for p in (plain, packed)]
    assert rows[0] == rows[1] and sum(rows[0].values()) == 5 and all(r[-1] for r in rows[0])
