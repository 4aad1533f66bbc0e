"""Learned, packing, rollup and chat operators, and the pipeline."""

import itertools
import os
import shutil
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from liftworks.llm import chat, ordinal, packing, rollups, rules

DATA = os.environ.get("LIFTWORKS_TESTDATA", "/root/testdata")


# --- rules ------------------------------------------------------------------------------------


def test_rules_find_planted_thresholds():
    rng = np.random.default_rng(2)
    x = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = ((x["a"] > 0.8) & (x["b"] < 0.5)) | (x["c"] > 0.95)
    found = rules.learn(x, bad, rng.random(3000) < 0.66)
    rejected = np.logical_or.reduce([r.holds(x) for r in found])
    assert (rejected & bad).sum() > 0.9 * bad.sum() and (rejected & ~bad).sum() < 0.02 * bad.sum()
    assert {c.feature for r in found for c in r.conditions} == {"a", "b", "c"}


def test_rules_without_signal_reject_nothing():
    rng = np.random.default_rng(3)
    x = {"a": rng.random(500)}
    assert rules.learn(x, rng.random(500) < 0.1, rng.random(500) < 0.66) == []
    assert rules.learn(x, np.zeros(500, bool), np.ones(500, bool)) == []


def test_rules_on_edge_rows(docs, no_docs, labels):
    out = rules.apply(docs, labels)
    assert out.count() == docs.count()
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[2]["base_failed"] and not got[2]["kept"] and got[12]["n_repeat_words"] == 6
    assert rules.apply(no_docs, labels).count() == 0
    assert rules.apply(docs, labels.limit(0)).filter("kept = base_failed").count() == 0


def test_verdict_is_an_ordered_expression(spark):
    first = rules.Rule((rules.Condition("a", True, 0.5),))
    second = rules.Rule((rules.Condition("a", False, 0.7), rules.Condition("b", True, 1.0)))
    rows = spark.createDataFrame([(0.6, 1.0), (0.4, 1.0), (0.4, 0.0)], "a double, b double")
    got = [r[0] for r in rows.select(rules.verdict([first, second])).collect()]
    assert got == [1, 2, 0]


# --- ordinal regression -----------------------------------------------------------------------


def graded(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        grade = rng.randrange(3)
        words = [f"w{rng.randrange(300)}" for _ in range(30)]
        words += [f"{('poor', 'fair', 'good')[grade]}{rng.randrange(3)}" for _ in range(2)]
        rows.append((i, " ".join(words), grade))
    return spark.createDataFrame(rows, "doc_id long, text string, grade int")


def test_ordinal_held_out_grades(spark):
    model = ordinal.fit(graded(spark, 900, 1), graded(spark, 900, 1).select("doc_id", "grade"), 3, rounds=40)
    test = graded(spark, 300, 2)
    got = ordinal.score(test, model).join(test, "doc_id")
    right = got.filter("round(expected_grade) = grade").count()
    assert right > 0.9 * 300
    assert got.filter("p_grade_2 > p_grade_1 + 1e-12").count() == 0
    assert (np.diff(model.thresholds) > 0).all()


def test_ordinal_on_edge_rows(docs, no_docs, labels):
    out = ordinal.select(docs, labels)
    assert out.count() == docs.count() and out.filter("expected_grade is null").count() == 0
    assert ordinal.select(no_docs, labels).count() == 0
    assert ordinal.select(docs, labels.limit(0)).filter("not kept").count() == 0


# --- packing ----------------------------------------------------------------------------------


def padding(histogram, edges):
    return sum(n * (min(e for e in edges if e >= k) - k) for k, n in histogram.items())


def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(30):
        histogram = {k: rng.randint(1, 20) for k in rng.sample(range(1, 40), rng.randint(1, 9))}
        for buckets in (1, 2, 3, 12):
            edges = packing.boundaries(histogram, buckets)
            assert len(edges) <= buckets and edges[-1] == max(histogram)
            keys = sorted(histogram)
            best = min(
                padding(histogram, [*some, keys[-1]])
                for r in range(min(buckets, len(keys)))
                for some in itertools.combinations(keys[:-1], r)
            )
            assert padding(histogram, edges) == best


def test_packing_keeps_every_token_and_fills_batches(docs, no_docs):
    got = packing.pack(docs, max_length=512, buckets=3, budget=2048, lot_rows=4)
    tokens = docs.select(F.sum(F.expr(r"regexp_count(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')") + 1)).first()[0]
    rows = got.collect()
    assert sum(r["length"] for r in rows) == tokens
    by = {}
    for r in rows:
        assert r["length"] <= r["bucket_length"] <= 512
        by.setdefault(r["bucket_length"], {}).setdefault(r["batch"], []).append(r["slot"])
    for edge, batches in by.items():
        assert sorted(batches) == list(range(len(batches)))
        for k, slots in batches.items():
            assert sorted(slots) == list(range(len(slots))) and len(slots) * edge <= 2048
            assert k == len(batches) - 1 or len(slots) == 2048 // edge
    assert packing.pack(no_docs).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, max_length=10, budget=5)


# --- rollups ----------------------------------------------------------------------------------


def test_rollup_batches_count_once(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "en", "v", 3, 9), ("a", "en", "v", 4, None), (None, None, "v", 1, 1)],
        "source string, lang string, version string, n_tokens long, n_chars long",
    )
    totals = lambda r: {(x[0], x[1]): tuple(x)[3:] for x in r.totals().collect()}
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    assert totals(rollup) == {}
    assert rollup.commit("one", rollups.signed(rows, 1)) and not rollup.commit("one", rollups.signed(rows, 1))
    assert totals(rollup) == {("a", "en"): (2, 7, 9), (None, None): (1, 1, 1)}
    rollup.commit("two", rollups.signed(rows.filter("source is null"), -1))
    assert totals(rollup) == {("a", "en"): (2, 7, 9)}
    rollup.compact()
    rollup.compact()
    assert totals(rollup) == {("a", "en"): (2, 7, 9)} and rollup.batches() == {"one", "two"}
    assert not rollup.commit("two", rollups.signed(rows, -1))
    # a write that failed halfway doesn't count and can be sent again
    rollup.commit("three", rollups.signed(rows.filter("n_tokens = 4"), -1))
    os.remove(tmp_path / "r" / "batchthree" / "_SUCCESS")
    assert totals(rollup) == {("a", "en"): (2, 7, 9)}
    assert rollup.commit("three", rollups.signed(rows.filter("n_tokens = 4"), -1))
    assert totals(rollup) == {("a", "en"): (1, 3, 9)}
    with pytest.raises(ValueError):
        rollup.commit("bad/name", rollups.signed(rows, 1))


def test_rollup_folds_any_number_of_batches(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "en", "v", 3, 9)], "source string, lang string, version string, n_tokens long, n_chars long"
    ).coalesce(1)
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    one = rollups.signed(rows, 1)
    assert rollup.commit("first", one)
    for k in range(70):  # committed tables by the format's own rule: a batch's table and its _SUCCESS
        shutil.copytree(tmp_path / "r" / "batchfirst", tmp_path / "r" / f"batchnumber-{k}-of-a-long-name")
    rollup.compact()
    assert len(rollup._current()) == 1 and len(rollup.batches()) == 71
    assert not rollup.commit("number-5-of-a-long-name", one) and rollup.commit("another", one)
    assert rollup.totals().first()["n_docs"] == 72
    rollup.compact()
    assert len(rollup._current()) == 1 and rollup.totals().first()["n_docs"] == 72
    fold = rollup._current()[0]
    os.remove(tmp_path / "r" / fold / "_SUCCESS")  # a fold lost halfway: its batches count as before
    assert rollup.totals().first()["n_docs"] == 72 and len(rollup.batches()) == 72


def test_replay_on_edge_rows(docs, no_docs):
    got = {r["version"]: r for r in rollups.replay(docs).collect()}
    assert got["v1"]["n_docs"] == got["v2"]["n_docs"] == docs.select(F.coalesce("text", F.lit(""))).distinct().count() + 1
    assert rollups.replay(no_docs).count() == 0


# --- chat -------------------------------------------------------------------------------------


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(6)
    size = chat.STATES + chat.STATES**2 + chat.STATES * sum(chat._SIZES)
    model = chat.Model(rng.integers(0, 9, size).astype(float))
    seen = np.stack([rng.integers(0, s, 5) for s in chat._SIZES], axis=1)

    def worth(path):
        out = model.start[path[0]] + sum(model.step[a, b] for a, b in zip(path, path[1:]))
        return out + sum(f[s, v] for s, row in zip(path, seen) for f, v in zip(model.features, row))

    best = max(worth(p) for p in itertools.product(range(chat.STATES), repeat=5))
    assert np.isclose(worth(model.best(seen).tolist()), best)


def whole(frame, **layout):
    """Rendered text, number of turns and parts of each conversation."""
    out = {}
    rows = chat.format_conversations(frame, **layout).collect()
    for r in sorted(rows, key=lambda r: r["part"]):
        text, n, k = out.get(r["conv_id"], ("", 0, 0))
        assert r["part"] == k
        out[r["conv_id"]] = (text + r["rendered"], n + r["n_turns"], k + 1)
    return out


def test_chat_of_held_out_conversations(spark):
    """Rendered text of conversations the model has not seen, against their source turns."""
    conversations = spark.read.parquet(f"{DATA}/sf0.1/conversations.parquet")
    truth: dict = {}
    for r in conversations.orderBy("conv_id", "turn").collect():
        truth.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    got = {r["conv_id"]: r for r in chat.format_conversations(conversations).filter("held_out").collect()}
    assert len(got) > 0.1 * len(truth)
    right = [r["rendered"] == chat.render(truth[i]) for i, r in got.items()]
    print("rendered right:", sum(right) / len(right))
    assert sum(right) > 0.9 * len(right)


def long_talk(spark):
    """Conversation 1 has 50 turns, 2 has 7, and a third of the rows share a null id and no turn number."""
    rng = np.random.default_rng(3)
    words = ["yes", "Question: why?", "no\n\nand no", "  code()", "", "ok then", "a b " * 30]
    rows = [(c, t, ("user", "assistant")[t % 2], words[rng.integers(len(words))] + str(t)) for c, n in ((1, 50), (2, 7)) for t in range(n)]
    rows += [(None, None, "user", f"line {k % 9}") for k in range(30)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


def test_chat_parts_make_whole_conversations(spark):
    frame = long_talk(spark)
    want = whole(frame)
    assert {k: v[2] for k, v in want.items()} == {1: 1, 2: 1, None: 1}
    for layout in ({"part_turns": 4}, {"part_turns": 8, "range_rows": 10}, {"crowded": 5, "range_rows": 6}, {"part_bytes": 20}):
        got = whole(frame, **layout)
        assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}, layout
        assert got[1][2] > 1, layout


def test_chained_messages_give_the_best_path():
    rng = np.random.default_rng(8)
    size = chat.STATES + chat.STATES**2 + chat.STATES * sum(chat._SIZES)
    model = chat.Model(rng.integers(0, 9, size).astype(float))
    seen = np.stack([rng.integers(0, s, 40) for s in chat._SIZES], axis=1)
    cuts = [0, 7, 7, 8, 30, 40, 40]
    parts = [seen[a:b] for a, b in zip(cuts, cuts[1:])]
    path = [s for p, around in zip(parts, chat.chained([model.message(p) for p in parts])) for s in model.best(p, *around)]
    assert path == model.best(seen).tolist()
    assert chat.chained([np.zeros((0, chat.STATES))] * 2) == [(None, None)] * 2


def test_chat_on_edge_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, ""), (None, None, "tool", "x: y\n\nz"), (2, 0, "user", "User: hi"),
            (2, 0, "user", "User: hi"), (3, 100, "assistant", "a " * 5000)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = {(r["conv_id"], r["part"]): r for r in chat.format_conversations(frame).collect()}
    assert len(got) == 4 and got[(None, 0)]["n_turns"] >= 1
    assert chat.format_conversations(frame.limit(0)).count() == 0
    assert chat.turns_of("", chat.Model(np.zeros(chat.STATES + chat.STATES**2 + chat.STATES * sum(chat._SIZES)))) == []


def test_chat_keeps_what_a_turn_begins_and_ends_with():
    turns = [(0, "How?\n\n\n- one\n\n- two"), (1, "    code()\n\n    more()\n"), (0, ""), (1, "**So**\n\nbye"), (2, "")]
    turns += [(k % 3, f"{name.title()}: what is x?\n{name}: y") for k, name in enumerate(chat.NAMES)]
    turns += [(0, "\n\nUser: hi"), (1, "### user: x")]
    model = chat.Model(np.zeros(chat.STATES + chat.STATES**2 + chat.STATES * sum(chat._SIZES)))
    for seed in range(80):
        text, known = chat.compose(turns, seed)
        model.best = lambda *_, known=known: chat.states_of(known)
        assert chat.turns_of(text, model) == [(chat.ROLES[r], t) for r, t in turns], seed


# --- pipeline and packaging -------------------------------------------------------------------


def test_pipeline_stages(spark, docs, no_docs, labels, tmp_path):
    sf = str(tmp_path)
    labels.write.parquet(f"{sf}/labels.parquet")
    clean = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    real = f"{DATA}/sf0.001"
    at = clean
    for name, work in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, no_docs):
            out = work(spark, frame, sf)
            assert out.columns == frame.columns and out.count() <= frame.count(), name
        at = work(spark, at, real)
        at.write.parquet(f"{sf}/{name}")
        at = spark.read.parquet(f"{sf}/{name}")
    assert corpus_pipeline.run(spark, real).select("doc_id").distinct().count() == at.count()
    assert at.count() > 0.5 * clean.count()
    stats = rules.apply(clean, spark.read.parquet(f"{real}/labels.parquet"))
    first = corpus_pipeline.STAGES[0][1](spark, clean, real)
    assert first.count() == stats.filter("kept").count()


def test_stages_judge_rows_without_or_with_repeated_ids_one_by_one(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    good = [" ".join(f"w{k}x{i}" for i in range(80)) for k in range(3)]
    frame = spark.createDataFrame(
        [(None, good[0]), (None, "one"), (None, good[0]), (7, good[1]), (7, "two"), (7, good[2])],
        "doc_id long, text string",
    ).repartition(3)
    ruled = corpus_pipeline.quality_rules(spark, frame, sf)
    assert sorted(r["text"] for r in ruled.collect()) == sorted([good[0], *good])
    assert corpus_pipeline.quality_classifier(spark, ruled, sf).count() == 4
    kept = corpus_pipeline.near_dedup(spark, ruled, sf)
    assert sorted(r["text"] for r in kept.collect()) == good and kept.columns == frame.columns


def test_entry_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = (
        f"import sys; sys.path.insert(0, {root!r}); sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; q = e.queries(); print('lift_fast' in q, 'pipeline' in q)"
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["True", "False"], done.stderr[-1000:]
