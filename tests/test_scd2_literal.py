"""The literal merge against a row-by-row replay of its statement sequence."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import types as T

from stratum.operators.scd2 import LiteralMerge, split_history
from stratum.schemas import silver_schema, staging_schema
from stratum.specs import SPECS

ENTITY = {"A": "flavours", "B": "ingredients", "C": "recipes", "D": "stocks"}
DAY = datetime(2024, 5, 5)


def same(a, b):
    return all(x is not None and y is not None and x == y for x, y in zip(a, b, strict=True))


def differs(a, b):
    return any(x is not None and y is not None and x != y for x, y in zip(a, b, strict=True))


def replay(spec, silver, staging):
    """Silver rows and staging statuses after one run, statement by statement."""
    key = lambda r: tuple(r[k] for k in spec.keys)
    old = lambda r: tuple(r[c] for c in spec.tracked)
    new = lambda r: tuple(r[spec.staging_column(c)] for c in spec.tracked)
    silver = [dict(r) for r in silver]
    waiting = [r for r in staging if r["merge_status"] == 0]
    groups: dict = {}
    for r in waiting:
        groups.setdefault(key(r), []).append(r)
    if spec.style == "B":
        rows = [max(g, key=lambda r: (r["inserted_at"], r["row_id"])) for g in groups.values()]
    elif spec.style == "C":
        newest = {k: max(r["inserted_at"] for r in g) for k, g in groups.items() if None not in k}
        rows = [r for r in staging if newest.get(key(r)) == r["inserted_at"]]
    else:
        rows = waiting

    def opened(r):
        out = {k: r[k] for k in spec.keys} | {c: r[spec.staging_column(c)] for c in spec.tracked}
        at = r["inserted_at"]
        return out | dict(valid_from=at, valid_to=None, active=True, load_timestamp=at, source_date=r["origin_date"])

    active = [s for s in silver if s["active"]]
    if spec.style == "A":
        known = [key(s)[0] for s in active]
        unseen = lambda r: not known or (None not in known and key(r)[0] is not None and key(r)[0] not in known)
    else:
        unseen = lambda r: not any(same(key(s), key(r)) for s in active)
    silver += [opened(r) for r in rows if unseen(r)]

    active = [s for s in silver if s["active"]]
    changed = [r for r in rows if any(same(key(s), key(r)) and differs(new(r), old(s)) for s in active)]
    changed_keys = {key(r) for r in changed}
    source = changed if spec.style in "CD" else rows
    for s in active:
        if key(s) in changed_keys:
            s["valid_to"] = max(r["inserted_at"] for r in source if key(r) == key(s))
            s["active"] = False
    chosen = changed if spec.style == "D" else [r for r in rows if key(r) in changed_keys]
    silver += [opened(r) for r in chosen]

    active = [s for s in silver if s["active"]]
    if spec.style == "A":
        done = [r for r in waiting if key(r) in changed_keys]
    elif spec.style == "B":
        done = [r for k, g in groups.items() if None not in k for r in g if r["inserted_at"] == max(x["inserted_at"] for x in g)]
    elif spec.style == "C":
        done = rows
    else:
        done = changed + [
            r for r in waiting
            if None in key(r) or any(same(key(s), key(r)) and same(new(r), old(s)) for s in active)
        ]
    ids = {r["row_id"] for r in done}
    status = Counter((r["row_id"], 1 if r["row_id"] in ids else r["merge_status"]) for r in staging)
    return silver, status


def random_tables(spec, seed, *, null_silver_key=False, empty_silver=False, scenarios=150):
    """Many small worlds with keys of their own: repeated versions, ties, NULLs, closed history."""
    rnd = random.Random(seed)
    kinds = {f.name: f.dataType for f in staging_schema(spec.entity).fields}

    def value(column, choices):
        pick = rnd.choice(choices)
        kind = kinds[spec.staging_column(column)]
        if pick is None or isinstance(kind, T.StringType):
            return pick
        number = 1 + "abc".index(pick)
        return float(number) if isinstance(kind, T.DoubleType) else number

    silver, staging = [], []
    for world in range(scenarios):
        def keys(world=world):
            first = None if rnd.random() < 0.03 else world * 10 + rnd.randint(1, 2)
            return {spec.keys[0]: first} | {k: value(k, "aaab" if rnd.random() < 0.97 else [None]) for k in spec.keys[1:]}

        for _ in range(rnd.randint(0, 4)):
            at = DAY + timedelta(hours=rnd.randint(0, 2))
            k = keys()
            if spec.style == "A" and not null_silver_key and k[spec.keys[0]] is None:
                continue
            active = rnd.choice([True, True, False, None])
            silver.append(
                k | {c: value(c, ["a", "b", None]) for c in spec.tracked}
                | dict(valid_from=at, valid_to=None if active else at, active=active, load_timestamp=at, source_date=date(2024, 5, 5))
            )
        for _ in range(rnd.randint(0, 5)):
            at = DAY + timedelta(days=rnd.randint(1, 2))
            row = keys() | {spec.staging_column(c): value(c, ["a", "a", "b", None]) for c in spec.tracked}
            row |= dict(row_id=len(staging) + 1, inserted_at=at, origin_date=at.date(), merge_status=int(rnd.random() < 0.15))
            row.setdefault("batch_value", 0)
            staging.append(row)
    return ([] if empty_silver else silver), staging


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in rows], schema)


CASES = [
    *[(style, {}, hot) for style in "ABCD" for hot in (False, True)],
    ("A", {"null_silver_key": True}, False),
    ("A", {"empty_silver": True}, False),
    ("D", {"empty_silver": True}, True),
]


@pytest.mark.parametrize(("style", "options", "hot"), CASES)
def test_merge_replays_the_statements(spark, style, options, hot):
    spec = SPECS[ENTITY[style]]
    silver, staging = random_tables(spec, 11, **options)
    schema = silver_schema(spec.entity)
    active, history = split_history(frame(spark, silver, schema))
    tuning = {"hot_rows": 1, "look": 1.0} if hot else {}
    merge = LiteralMerge(spec, active, frame(spark, staging, staging_schema(spec.entity)), **tuning)
    expected, status = replay(spec, silver, staging)
    names = schema.fieldNames()
    assert Counter(map(tuple, merge.result(history).collect())) == Counter(tuple(r[n] for n in names) for r in expected)
    assert Counter(map(tuple, merge.marked().select("row_id", "merge_status").collect())) == status
    if hot:
        assert merge.hot_staging is not None and (merge.hot_active is not None or not silver)


@pytest.mark.parametrize("style", "AD")
def test_broadcasting_pending_keys_changes_nothing(spark, style):
    spec = SPECS[ENTITY[style]]
    silver, staging = random_tables(spec, 5)
    active, history = split_history(frame(spark, silver, silver_schema(spec.entity)))
    pending = frame(spark, staging, staging_schema(spec.entity))
    plain = LiteralMerge(spec, active, pending).result(history)
    small = LiteralMerge(spec, active, pending, broadcast_pending=True).result(history)
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, small.collect()))


def test_two_versions_of_a_new_key_are_closed_and_inserted_again(spark):
    spec = SPECS["flavours"]
    schema, landed = silver_schema("flavours"), staging_schema("flavours")
    t1, t2 = DAY + timedelta(days=1), DAY + timedelta(days=2)
    staging = spark.createDataFrame(
        [(1, 7, "a", "x", t1, 0, t1.date(), 0), (2, 7, "b", "x", t2, 0, t2.date(), 0)], landed
    )
    merge = LiteralMerge(spec, spark.createDataFrame([], schema), staging)
    rows = {(r.name, r.valid_to, r.active) for r in merge.delta().collect()}
    assert rows == {("a", t2, False), ("b", t2, False), ("a", None, True), ("b", None, True)}
