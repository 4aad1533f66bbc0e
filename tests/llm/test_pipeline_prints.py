"""The near_dedup stage takes operator 5's fingerprints and index."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from liftworks.llm import nearcopies, simhash


def texts():
    rng = random.Random(12)
    out = []
    for _ in range(30):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        out.append(" ".join(words))
        for k in (0, 0, 199, rng.randrange(200)):
            words = list(words)
            words[k] = f"v{rng.randrange(10**6)}"
            out.append(" ".join(words))
    return [*out, "", None, "one two"]


def test_stage_runs_the_index_of_operator_5_and_checks_its_pairs(spark, monkeypatch):
    given, checked = [], []
    links, verified = simhash.links, nearcopies.verified

    def seen(entries, *rest):
        given.append({r["fp"] for r in entries.collect()})
        return links(entries, *rest)

    def pairs_of(pairs, *rest):
        checked.append({(r["a"], r["b"]) for r in pairs.collect()})
        return verified(pairs, *rest)

    monkeypatch.setattr(simhash, "links", seen)
    monkeypatch.setattr(nearcopies, "verified", pairs_of)
    rows = texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert len(given) == 1 and len(checked) == 1
    words = [nearcopies.words_of((t or "").encode()) for t in rows]
    want = {simhash.fingerprint(w, nearcopies.SHINGLE) for w in words if w}
    assert {x % 2**64 for x in given[0]} == want
    assert len(kept) == 30 + 2  # copies differ in up to 4 of 200 words; empty and null texts are one


def test_pairs_join_what_the_fingerprints_join(spark):
    prints = [0, 0, 1, 7, 2**63 + 7, 2**40 + 2**50 - 1, 2**40 + 2**50 - 1, 2**20 + 2**30 + 2**41 + 2**51]
    rows = [(100 + i, p if p < 2**63 else p - 2**64) for i, p in enumerate(prints)]
    pairs = nearcopies.fingerprint_pairs(spark.createDataFrame(rows, "entry long, fp long").repartition(2))
    got = {(r["a"], r["b"]) for r in pairs.select(F.col("a"), F.col("b")).distinct().collect()}
    near = {(100 + i, 100 + j) for i in range(8) for j in range(i + 1, 8) if (prints[i] ^ prints[j]).bit_count() <= 3}
    assert got <= near

    def groups(links):
        least = {100 + i: 100 + i for i in range(8)}
        for _ in range(8):
            for a, b in links:
                least[a] = least[b] = min(least[a], least[b])
        return least

    assert groups(got) == groups(near)
