"""Vector codes against a plain version of the rounds."""

import hashlib
import math
import random

import numpy as np
import pytest

from liftworks.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, position int, entry string"


def plain(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [
        (i, [math.floor(scale * x) for x in v], label)
        for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[list(cut[k][p]) for k in order] for p in range(parts)]

    def assigned():
        out = []
        for part in cut:
            found = []
            for p in range(parts):
                apart = [sum((a - b) ** 2 for a, b in zip(part[p], c)) for c in books[p]]
                found.append((apart.index(min(apart)), min(apart)))
            out.append(found)
        return out

    for _ in range(rounds):
        own = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                members = [cut[k][p] for k in range(len(cut)) if own[k][p][0] == e]
                if members:
                    books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    final = assigned()
    errors = [sum(d for _, d in f) for f in final]
    sums = {}
    for (_, _, label), err in zip(kept, errors):
        sums[label] = sums.get(label, 0) + err
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        [
            (i, "".join(f"{e:02x}" for e, _ in f), err, sums[label], sha)
            for (i, _, label), f, err in zip(kept, final, errors)
        ],
        key=str,
    )


def vectors(rng, n, width=32):
    heads = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(9)]
    rows = []
    for i in range(n):
        head = rng.choice(heads)
        rows.append((i * 3 - 20, [x + rng.gauss(0, 0.2) for x in head], rng.choice([1, 2, None])))
    # copies, repeated and null ids, vectors to drop
    rows += [(5000 + i, rows[0][1], 1) for i in range(150)] + [rows[1], (None, rows[2][1], 2), (None, rows[2][1], 2)]
    rows += [(-100, None, 1), (-99, [], 1), (-98, [math.nan] * width, 1), (-97, [math.inf] * width, None)]
    rows.append((-96, [0.5] * (width - 1) + [None], 2))
    rng.shuffle(rows)
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], m) for i, v, m in rows]


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", 0, "e") for r in rows], SCHEMA).repartition(3)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("members, rounds", [(200_000, 2), (40, 2), (40, 4), (200_000, 0)])
def test_equals_plain_rounds(spark, monkeypatch, members, rounds):
    monkeypatch.setattr(vector_codes, "MEMBERS", members)  # 40: owners split by salt
    rows = vectors(random.Random(members + rounds), 300)
    out = vector_codes.compress(table(spark, rows), rounds=rounds)
    assert found(out) == plain(rows, rounds=rounds)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("liftworks_")]


def test_few_vectors_and_none(spark):
    rows = [(3, [0.25] * 16, 1), (2, [-0.1] * 16, 1), (3, [0.25] * 16, None)]
    out = vector_codes.compress(table(spark, rows))
    assert found(out) == plain(rows)
    empty = vector_codes.compress(table(spark, [(1, None, 1)]))
    assert empty.columns == out.columns and empty.count() == 0
    assert vector_codes.compress(table(spark, [])).count() == 0


def test_wide_values_and_ties(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-300.0, 0.0, 300.5]) for _ in range(16)], i % 2) for i in range(200)]
    assert found(vector_codes.compress(table(spark, rows))) == plain(rows)


def test_what_raises(spark):
    for rows in ([(1, [0.1] * 17, 1)], [(1, [0.1] * 16, 1), (2, [0.1] * 32, 1)], [(1, [3e30] * 16, 1)]):
        with pytest.raises(ValueError):
            vector_codes.compress(table(spark, rows))
    with pytest.raises(ValueError):
        vector_codes.compress(table(spark, []), entries=300)


def test_only_changed_parts_move(spark):
    """Owners meet what moved without an exchange of the members that stay."""
    rng = np.random.default_rng(1)
    parts = rng.integers(-50, 50, (500, 4)).astype("<i2")
    shape = vector_codes.Shape(500, 4, "<i2")
    old, new = np.array([[[0, 0, 0, 0], [9, 9, 9, 9]]]), np.array([[[-5, 0, 0, 0], [9, 9, 9, 20]]])
    first = vector_codes.nearest(parts, old[0])[0]
    packed = list(vector_codes._packed(0, first, np.zeros(500, int), parts, 1, "<i2"))
    held = spark.createDataFrame(packed, vector_codes._MEMBERS)
    now = vector_codes._bucketed(vector_codes.reassigned(held, new, shape), 4, "placed", "moved")
    count = {
        r["moved"]: sum(len(x) // 8 for x in r["m"])
        for r in now.groupBy("moved").agg({"members": "collect_list"}).toDF("moved", "m").collect()
    }
    changed = int((vector_codes.nearest(parts, new[0])[0] != first).sum())
    assert 0 < changed < 250 and count == {True: changed, False: 500 - changed}
    came = vector_codes._bucketed(now.filter("moved").selectExpr("position", "target as entry", "salt", "members"), 4, "came")
    sums = vector_codes.owned_sums(now.filter("not moved"), came, 4, "<i2")
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    for t in (now, came):
        vector_codes._dropped(t)


def test_codes_decode_near_the_vectors(spark):
    rng = random.Random(6)
    rows = [r for r in vectors(rng, 200) if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    usable, books = vector_codes.fit(table(spark, rows))
    codes = vector_codes.encode(usable, books)
    back = vector_codes.decode(codes, books).collect()
    for r in back:
        whole = np.floor(np.array(r["vector"]) * 256)
        own = [np.floor(256 * np.array(v)) for i, v, _ in rows if i == r["vec_id"]]
        assert any(((whole - o) ** 2).sum() == r["error"] for o in own)
