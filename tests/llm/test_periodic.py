"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from liftworks.llm import periodic

from conftest import frame, TEXTS


def plain_lyndon(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def plain_runs(s, least=24, times=3):
    """Every maximal stretch of every period, smallest periods only."""
    names, out = {}, []
    items = np.array([names.setdefault(x, len(names)) for x in s], dtype=np.int64)
    for q in range(1, len(s) // times + 1):
        same = np.concatenate([[False], items[:-q] == items[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1]).tolist()
        for i, j in zip(edges[::2], edges[1::2]):
            n = j + q - i
            if n >= max(least, times * q) and not any(
                x <= i and x + m >= i + n and q % p == 0 for x, m, p in out
            ):
                out.append((i, n, q))
    return sorted(out)


def plain_rows(rows):
    """The contract's columns, text by text."""
    out = {}
    for doc_id, text in rows:
        words = [w for w in (text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        gone = {i for x, m, q in runs for i in range(x + q, x + m)}
        lines = "".join(f"{x},{m},{q}\n" for x, m, q in runs)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.setdefault(doc_id, []).append((
            len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
        ))
    return {k: sorted(v, key=str) for k, v in out.items()}


def found_rows(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    return {k: sorted(v, key=str) for k, v in out.items()}


def repetitive(rng, letters=3):
    s = [rng.randrange(letters) for _ in range(rng.randint(0, 10))]
    for _ in range(rng.randint(0, 4)):
        root = [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
        s += (root * rng.randint(1, 6))[: rng.randint(1, 50)]
        s += [rng.randrange(letters) for _ in range(rng.randint(0, 6))]
    return s


def test_lyndon_arrays():
    rng = random.Random(3)
    for _ in range(600):
        s = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 40))]
        assert periodic.lyndon(s) == plain_lyndon(s)


@pytest.mark.parametrize("least, times", [(24, 3), (6, 3), (9, 3), (12, 4), (25, 3)])
def test_runs_and_where_to_look(least, times):
    rng = random.Random(least)
    window = least - 2 * least // times + 1
    for _ in range(400):
        s = repetitive(rng)
        expected = plain_runs(s, least, times)
        items = np.array(s, dtype=np.int64)
        assert periodic.runs_of(items, least, times) == expected
        lo, hi = periodic.repeated_stretches(items, np.array([0, len(s)]), window)
        parts = [
            (x + a, n, q)
            for a, b in zip(lo.tolist(), hi.tolist())
            for x, n, q in periodic.runs_of(items[a:b], least, times)
        ]
        assert sorted(parts) == expected


def test_neighbouring_documents_stay_apart():
    texts = ["a b c " * 10, "a b c " * 10, "a b c " * 7, "", "x " * 30, "x " * 23]
    flat, bounds = periodic._arrays([t.encode().split() for t in texts])
    lo, hi = periodic.repeated_stretches(flat, bounds, 9)
    assert list(zip(lo.tolist(), hi.tolist())) == [(0, 30), (30, 60), (60, 81), (81, 111), (111, 134)]


def test_extensions_over_long_stretches():
    s = np.tile(np.arange(7), 5000)
    assert periodic.common_after(s, 0, 7) == len(s) - 7
    assert periodic.common_before(s, 20_000, 20_007) == 20_000
    assert periodic.runs_of(np.concatenate([[9], s, [8]])) == [(1, len(s), 7)]


def test_query_equals_brute_force(spark):
    rng = random.Random(5)
    rows = list(TEXTS)
    for i in range(100, 400):
        words = [f"w{x}" for x in repetitive(rng, rng.choice([2, 3, 40]))]
        rows.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    rows += [(400, "tie " * 24 + "x " + "tie " * 24), (None, "again " * 30), (None, "again " * 30)]
    # the long text and the paths of ties, null and repeated ids are all in one frame
    found = found_rows(periodic.digests(frame(spark, rows).repartition(3)))
    expected = plain_rows(rows)
    assert {k: (v, expected[k]) for k, v in found.items() if v != expected[k]} == {}
    assert found.keys() == expected.keys()


def test_tables(spark, docs, no_docs):
    assert periodic.digests(no_docs).count() == 0
    assert found_rows(periodic.digests(docs)) == plain_rows(TEXTS)
    whole = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert found_rows(periodic.digests(whole)) == plain_rows([tuple(r) for r in whole.collect()])


def test_texts_of_any_key(spark):
    rows = spark.createDataFrame([("k", "go " * 40, 1), (None, None, 2)], "id string, runs string, key int")
    out = {r["key"]: r for r in periodic.detect(rows, "id", "runs").collect()}
    assert [tuple(r) for r in out["k"]["runs"]] == [(0, 40, 1)] and out["k"]["collapsed"] == "go"
    assert out[None]["runs"] == [] and out[None]["collapsed"] == ""
    with pytest.raises(ValueError):
        periodic.detect(rows, "id", "runs", times=2)
