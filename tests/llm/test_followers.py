"""Operator 1: what follows each single word, whatever their number."""

from collections import Counter

import numpy as np

from liftworks.llm import maxent


def corpus(kinds):
    """Filler words that take the classes of their own, and ``kinds`` rare pairs: the first words end alike, so
    they share a class; each has its own second word."""
    filler = " ".join(f"common{k % 31}" for k in range(31 * kinds))
    pairs = [f"first{k}xy second{k}" for k in range(kinds)]
    return [filler] * 3 + [" ".join(pairs)] * 6


def trained(n):
    ids = (i for i in range(10 * n + 100) if not maxent.held_out(i))
    return [next(ids) for _ in range(n)]


def frame(spark, texts, tests):
    held = (i for i in range(1000) if maxent.held_out(i))
    rows = [*zip(trained(len(texts)), texts), *((next(held), t) for t in tests)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_words_of_one_class_are_told_apart_by_what_follows(spark):
    kinds = 40
    second = {k: maxent.tail_class(b"second%d" % k) for k in range(kinds)}
    a, b = next((i, j) for i in range(kinds) for j in range(i) if second[i] != second[j])
    told = [f"first{i}xy second{i}" for i in (a, b)]
    other = [f"first{a}xy second{b}", f"first{b}xy second{a}"]  # the same to features of classes, both taken together
    docs = frame(spark, corpus(kinds), told + other)
    got = {r["text"]: r["score"] for r in maxent.score(docs, rounds=4).join(docs, "doc_id").filter("held_out").collect()}
    assert sum(got[t] for t in told) > sum(got[t] for t in other) + 0.5
    # any number of blocks gives the same
    again = {r["doc_id"]: r["score"] for r in maxent.score(docs.repartition(4), rounds=4).collect()}
    for r in maxent.score(docs.coalesce(1), rounds=4).collect():
        assert abs(again[r["doc_id"]] - r["score"]) < 1e-6 * abs(r["score"])


def test_cells_equal_plain_counts_and_grow_with_the_vocabulary(spark):
    features = {}
    for kinds in (40, 400):
        texts = corpus(kinds)
        docs = frame(spark, texts, ["first0xy second1 nowhere"])
        blocks = maxent.write_blocks(docs.repartition(3), maxent.words_of, lambda i: not maxent.held_out(i), 2)
        model = maxent.fit(blocks, 2, len(texts), rounds=1)
        want = Counter()
        for text in texts:
            words = text.encode().split()
            classes = [*model.classes(words).tolist(), 0]
            for i, word in enumerate(words):
                if classes[i] >= maxent.SINGLES:
                    want[word, classes[i - 1] if i else 0, classes[i + 1]] += 1
        got = Counter()
        for r in maxent.word_cells(blocks, model).collect():
            words = maxent.unpack_bytes(r["words"])
            held = np.repeat(np.arange(len(words)), maxent.unpack_ints(r["sizes"]))
            for w, cell, n in zip(held.tolist(), maxent.unpack_ints(r["cells"]).tolist(), maxent.unpack_ints(r["n"]).tolist()):
                got[words[w], cell // maxent.CLASSES, cell % maxent.CLASSES] += n
        got = Counter({k: n for k, n in got.items() if n})  # held-out documents have cells too
        assert got == want
        features[kinds] = len({(w, c) for w, _, c in got})
    assert features[400] > 9 * features[40]


def test_odds_are_a_step_of_scaling_and_add_up():
    rng = np.random.default_rng(3)
    c = maxent.CLASSES
    weights = maxent.Weights(*[rng.normal(size=p.shape) for p in maxent.Weights.zeros().parts()])
    chances = np.exp(weights.log_probabilities(np.arange(c**2)))
    classes = np.array([40, 40, 63])
    place = np.repeat(np.arange(4), c * c)[: 3 * c * c]  # every cell of three words
    cell = np.tile(np.arange(c * c), 3)
    n = np.zeros(len(place), dtype=np.int64)
    for w, skipped, follows, times in ((0, 7, 1, 3), (0, 7, 50, 1), (0, 7, 63, 6), (2, 0, 2, 2), (2, 9, 2, 5)):
        n[w * c * c + skipped * c + follows] = times
    added = maxent.word_features(place, cell, n, classes, chances.reshape(c, c, c)).reshape(3, c, c)
    for w in range(3):
        for skipped in range(c):
            context = skipped * c + classes[w]
            p = chances[context] * np.exp(added[w, skipped])
            assert abs(p.sum() - 1) < 1e-9
            if w == 1:  # never seen
                assert not added[w].any()
            if w == 0 and skipped == 7:  # all of its cells: the share among PRIOR more as expected
                seen = np.zeros(c)
                seen[[1, 50, 63]] = 3, 1, 6
                assert np.allclose(p, (seen + maxent.PRIOR * chances[context]) / (10 + maxent.PRIOR))
            if w == 2:
                assert p[2] > chances[context][2]
