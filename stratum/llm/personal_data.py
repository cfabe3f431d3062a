"""Personal data: base patterns, and further spans that weak labelers, weighed against each other, let a classifier find."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import arrow_batches, stored

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: The classifier is fitted on so many patterns of votes and shape at most, those with the most candidates.
PATTERNS = 20_000

#: Characters before a candidate that the context labelers look at, and the likelihood from which it is a span.
CONTEXT, CUTOFF = 48, 0.5

# Word lists of the gazetteer and context labelers.
_DOMAIN_ENDS = frozenset("com org net edu gov mil int info biz io co de fr es uk us eu it nl ch at be ca au jp cn in br mx".split())
_ISSUERS = ("34", "35", "36", "37", "38", "4", "50", "51", "52", "53", "54", "55", "6011", "62", "64", "65")
_CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 351 353 358 420".split())
_SPEAKS_FOR = (
    frozenset("email e-mail mail mailto contact contacto correo courriel kontakt write from to".split()),
    frozenset("ip address host server ipv4 ipv6 adresse dirección login client peer".split()),
    frozenset("card visa mastercard amex credit debit karte kreditkarte carte tarjeta payment pay".split()),
    frozenset("phone tel telephone call mobile cell fax telefon handy téléphone teléfono llamar appeler anrufen".split()),
)
_SPEAKS_AGAINST = frozenset(
    "version v release isbn issn doi order invoice section chapter page serial build item sku license".split()
)

_AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_VEILED = re.compile(
    r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?[\[({] ?(?:at|AT|@) ?[\])}] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[({] ?(?:dot|DOT) ?[\])}]) ?[A-Za-z0-9-]{1,63})+"
)
_BRACKET_AT = re.compile(r"[\[({] ?(?:at|AT|@) ?[\])}]")
# Digits are taken whole: a match that could begin inside a run of them could begin with the run.
_QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_SIX = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMERIC = re.compile(r"[+(]?[0-9][0-9 ().-]*[0-9]")
_GROUPED = re.compile(
    r"(?<![0-9])(?:\+?[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[ ]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
)
_CARD_GROUPS = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])")
_HAS_NUMBER = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _emails(text: str) -> list[tuple[int, int]]:
    found, last = [], 0
    for m in _AFTER_AT.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, m.end()))
            last = m.end()
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of all base matches, by kind and start."""
    found = [(EMAIL, *s) for s in _emails(text)] if "@" in text else []
    if not _HAS_NUMBER.search(text):
        return found
    if "." in text:
        found += [(IP, *m.span()) for m in _QUAD.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _DIGIT_CHAIN.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            found.append((CARD, *m.span()))
    if "+" in text:
        found += [(PHONE, *m.span()) for m in _PLUS.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


def further_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates beside the base matches, none of which they overlap; those of one kind do not overlap each other."""
    found = []
    if _BRACKET_AT.search(text):
        found += [(EMAIL, *m.span()) for m in _VEILED.finditer(text)]
    if _HAS_NUMBER.search(text):
        if ":" in text:
            found += [(IP, *m.span()) for m in _SIX.finditer(text)]
        for chain in _NUMERIC.finditer(text):
            if chain.end() - chain.start() < 7:
                continue
            at = chain.start()
            found += [(IP, at + m.start(), at + m.end()) for m in _QUAD.finditer(chain.group())]
            found += [(CARD, at + m.start(), at + m.end()) for m in _CARD_GROUPS.finditer(chain.group())]
            found += [
                (PHONE, at + m.start(), at + m.end()) for m in _GROUPED.finditer(chain.group()) if 9 <= len(_digits(m.group())) <= 15
            ]
    if not found:
        return []
    covered = sorted((s, e) for _, s, e in taken)
    starts = np.array([s for s, _ in covered], np.int64)
    ends = np.maximum.accumulate([e for _, e in covered]) if covered else np.zeros(0, np.int64)
    out = []
    for kind, start, end in found:
        before = int(np.searchsorted(starts, end))
        if before == 0 or ends[before - 1] <= start:
            out.append((kind, start, end))
    return out


# --- labelers -----------------------------------------------------------------------------

LABELERS = ("pattern", "checksum", "gazetteer", "context", "counter_context", "neighbours")
#: What each labeler is taken to be worth before any text is seen: how often its votes are right.
FIRST_TRUST = (0.7, 0.95, 0.7, 0.8, 0.8, 0.6)
#: How often the checksum of real data is taken to fail, by misprints: the one reliability that votes do not change.
MISPRINTS = 0.01


def votes(text: str, kind: int, start: int, end: int) -> tuple[int, ...]:
    """1 for, -1 against, 0 for no opinion, from each labeler."""
    span = text[start:end]
    digits = _digits(span)
    before, after = text[start - 1 : start], text[end : end + 1]
    if kind == EMAIL:
        local, _, domain = span.partition("@") if "@" in span else (span.split()[0], "", re.sub(r"[\[({] ?(?:dot|DOT) ?[\])}]", ".", span))
        last = domain.rpartition(".")[2].strip().lower()
        pattern = 1 if re.fullmatch(r"[a-z]{2,24}", last) and local[:1] not in ".-" and ".." not in span else -1
        checksum = 1 if len(span) <= 254 and len(local) <= 64 else -1
        gazetteer = 1 if last in _DOMAIN_ENDS else 0
    elif kind == IP:
        parts = span.split(".")
        quad = len(parts) == 4
        pattern = 1 if not quad or all(p == "0" or p[0] != "0" for p in parts) and before != "." and after != "." else -1
        checksum = 1 if not quad or all(map(_small, parts)) else -1
        gazetteer = -1 if quad and not parts[0].strip("0") else 0
    elif kind == CARD:
        pattern = 1 if _CARD_GROUPS.fullmatch(span) else -1
        checksum = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(_ISSUERS) else 0
    else:
        groups = re.findall("[0-9]+", span)
        pattern = 1 if span.count("(") == span.count(")") and 2 <= len(groups) <= 6 and len(groups[-1]) >= 3 else -1
        checksum = 1 if 9 <= len(digits) <= 15 and len(set(digits)) > 2 else -1
        gazetteer = (1 if any(digits.startswith(c) for c in _CALLING_CODES) else -1) if span[0] == "+" else 0
    near = {w.lower() for w in _WORD.findall(text[max(0, start - CONTEXT) : start])}
    neighbours = -1 if (before and (before.isalnum() or before in "_/=#\\")) or (after and (after.isalnum() or after in "_/=\\")) else 1
    return (
        pattern, checksum, gazetteer, 1 if near & _SPEAKS_FOR[kind] else 0, -1 if near & _SPEAKS_AGAINST else 0, neighbours,
    )


_SHAPES = 24


def shape(text: str, kind: int, start: int, end: int) -> int:
    """What the span and its edges look like, as bits."""
    span = text[start:end]
    n = len(_digits(span))
    bits = [c in span for c in " -.()+@"]
    bits += [n < 9, 9 <= n < 11, 11 <= n < 13, 13 <= n < 16, n == 16, n > 16]
    for c in (text[start - 1 : start], text[end : end + 1]):
        bits += [c == "", c.isspace(), c.isalpha(), bool(c) and c in ".,;:!?", c == "\n"]
    bits.append(end - start > 40)
    return sum(b << i for i, b in enumerate(bits))


# --- aggregation of votes -----------------------------------------------------------------


def aggregated(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns: the likelihood that each is personal data, and the reliabilities.

    Labelers vote independently of each other given the truth.  ``reliability[l, y, v]`` is how often labeler
    l votes v - 1 where the truth is y.  Two pseudo-counts keep a labeler near ``FIRST_TRUST`` until votes say more;
    real data passes its checksum but for ``MISPRINTS``, so that weak labelers that agree do not overrule it.
    """
    trust = np.array(FIRST_TRUST)
    first = np.empty((len(trust), 2, 3))
    first[:, 1, 2], first[:, 1, 0], first[:, 0, 0], first[:, 0, 2] = trust * 0.8, (1 - trust) * 0.8, trust * 0.8, (1 - trust) * 0.8
    first[:, :, 1] = 0.2
    checksum = LABELERS.index("checksum")
    first[checksum, 1] = MISPRINTS, MISPRINTS, 1 - 2 * MISPRINTS
    reliability, prior = first.copy(), 0.5
    voted = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(float)  # pattern, labeler, vote
    for _ in range(rounds):
        logs = [np.einsum("plv,lv->p", voted, np.log(reliability[:, y])) + np.log(p) for y, p in ((0, 1 - prior), (1, prior))]
        likely = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        prior = float(((likely * counts).sum() + 1) / (counts.sum() + 2))
        for y, part in ((0, (1 - likely) * counts), (1, likely * counts)):
            seen = np.einsum("p,plv->lv", part, voted) + 2 * first[:, y]
            reliability[:, y] = seen / seen.sum(1, keepdims=True)
        reliability[checksum, 1] = first[checksum, 1]
    return likely, reliability


def _inputs(patterns: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    bits = (shapes[:, None] >> np.arange(_SHAPES)) & 1
    return np.concatenate([np.ones((len(patterns), 1)), patterns == 1, patterns == -1, bits], 1).astype(float)


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression on likelihoods as labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, grad)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class SpanModel:
    """Weights of the span classifier and reliabilities of the labelers, by kind."""

    weights: dict[int, np.ndarray] = field(default_factory=dict)
    reliability: dict[int, np.ndarray] = field(default_factory=dict)

    def likelihood(self, kind: int, vote: tuple[int, ...], form: int) -> float:
        if kind not in self.weights:
            return 0.0
        x = _inputs(np.array([vote]), np.array([form]))[0]
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[kind], -30, 30))))


def _code(vote: tuple[int, ...]) -> int:
    return sum((v + 1) * 3**i for i, v in enumerate(vote))


def _votes_of(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELERS)) % 3 - 1


def fit(documents: DataFrame) -> SpanModel:
    """Learn from the candidates of all ``documents``, without labels.

    All candidates, base ones included, are counted by kind, votes and shape.  Votes are weighed over all of them
    (at most 729 patterns a kind); the classifier is fitted on the ``PATTERNS`` most frequent ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    base = base_spans(text)
                    for kind, start, end in base + further_spans(text, base):
                        key = kind, _code(votes(text, kind, start, end)), shape(text, kind, start, end)
                        counted[key] = counted.get(key, 0) + 1
        rows = [(*k, n) for k, n in counted.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["kind", "votes", "shape", "n"])

    counts = arrow_batches(documents.select("text")).mapInArrow(run, "kind long, votes long, shape long, n long")
    found = stored(counts.groupBy("kind", "votes", "shape").agg(F.sum("n").alias("n")), "patterns")
    tallies = found.groupBy("kind", "votes").agg(F.sum("n").alias("n")).orderBy("kind", "votes").collect()
    frequent = found.orderBy(F.col("n").desc(), "kind", "votes", "shape").limit(PATTERNS).collect()
    model = SpanModel()
    for kind in range(len(KINDS)):
        own = [r for r in tallies if r.kind == kind]
        if not own:
            continue
        codes = np.array([r.votes for r in own])
        likely, model.reliability[kind] = aggregated(_votes_of(codes), np.array([float(r.n) for r in own]))
        by_code = dict(zip(codes.tolist(), likely, strict=True))
        seen = [r for r in frequent if r.kind == kind]
        if seen:
            x = _inputs(_votes_of(np.array([r.votes for r in seen])), np.array([r.shape for r in seen]))
            model.weights[kind] = fitted(x, np.array([by_code[r.votes] for r in seen]), np.array([float(r.n) for r in seen]))
    return model


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
            T.StructField("base", T.BooleanType()), T.StructField("score", T.DoubleType()),
        ]
    )
)


def spans_of(text: str, model: SpanModel) -> list[tuple[int, int, int, bool, float]]:
    """All spans of one text by kind and start: base ones, and further ones the classifier takes for personal data.

    Of further ones that overlap, the likeliest stays, then the first.
    """
    base = base_spans(text)
    likely = []
    for kind, start, end in further_spans(text, base):
        p = model.likelihood(kind, votes(text, kind, start, end), shape(text, kind, start, end))
        if p >= CUTOFF:
            likely.append((-p, start, kind, end))
    added: list[tuple[int, int, int, bool, float]] = []
    taken: list[tuple[int, int]] = []
    for p, start, kind, end in sorted(likely):
        if all(end <= s or e <= start for s, e in taken):
            taken.append((start, end))
            added.append((kind, start, end, False, -p))
    return sorted([(*b, True, 1.0) for b in base] + added)


def find(documents: DataFrame, model: SpanModel) -> DataFrame:
    """Replace ``text`` by ``spans``: kind, start and end (code points, end exclusive), whether base, likelihood.

    Null and empty texts have none.  Every row is looked at by itself, so repeated rows get equal spans, and an
    empty table an empty result; other columns are kept.
    """
    own = [f for f in documents.schema.fields if f.name not in ("text", "spans")]
    schema = T.StructType([*own, T.StructField("spans", SPANS)])
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": KINDS[k], "start": s, "end": e, "base": b, "score": p} for k, s, e, b, p in (spans_of(t, model) if t else ())]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in own], pa.array(found, kind_type)], schema.fieldNames())

    return arrow_batches(documents.select(*[f.name for f in own], "text")).mapInArrow(run, schema)


def redact(documents: DataFrame, model: SpanModel) -> DataFrame:
    """The same rows and columns, with every span of the texts replaced by its kind in brackets.

    Spans that overlap are replaced together, under the kind of the first of them.
    """
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                parts, end = [], 0
                for start, stop, kind in sorted((s, e, k) for k, s, e, _, _ in spans_of(text, model)) if text else ():
                    if start >= end:
                        parts += [text[end:start], f"[{KINDS[kind]}]"]
                    end = max(end, stop)
                out.append(text if not parts else "".join([*parts, text[end:]]))
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return arrow_batches(documents).mapInArrow(run, documents.schema)
