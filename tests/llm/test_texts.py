"""Operators on texts against plain Python, edge cases included."""

import hashlib
import math
import os
import re
import random
import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from liftworks.sources import stage
from liftworks.llm import bpe, graph, maxent, nearcopies, rules, simhash, suffixes, syncmers, text

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def rows(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_words_split_at_ascii_space_only():
    for s in ("A b\tC\x0b\x0cd", "É x y", ""):
        assert text.words_of(s.encode()) == WORD.findall(s.encode().translate(text.LOWER))


def test_packed_values_round_trip():
    values = np.array([0, 1, 255, 2**31, 2**32 - 1], dtype=np.uint32)
    assert (text.unpack_ints(text.pack_ints(values)) == values).all()
    for items in ([], [b""], [b"a", b"", b"bc" * 500]):
        assert text.unpack_bytes(text.pack_bytes(items)) == items


# --- language model ---------------------------------------------------------------------------


def test_language_model_base_and_edges(docs):
    got = by_id(maxent.score(docs, rounds=3))
    tokens = [(i, WORD.findall(t.encode().translate(text.LOWER)) + [None]) for i, t in rows(docs)]
    counts = Counter(w for i, ws in tokens if not maxent.held_out(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert sum(map(len, got.values())) == len(tokens)
    for i, ws in tokens:
        r = next(r for r in got[i] if r["n_tokens"] == len(ws))
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base))
        assert r["n_known"] == sum(counts[w] > 0 for w in ws) and r["train_tokens"] == n
        assert r["score"] < 0 and r["held_out"] == maxent.held_out(i)


def test_language_model_probabilities_add_up():
    rng = np.random.default_rng(1)
    w = maxent.Weights(*[rng.normal(size=p.shape) for p in maxent.Weights.zeros().parts()])
    p = np.exp(w.log_probabilities(np.arange(maxent.CLASSES**2)))
    assert np.allclose(p.sum(axis=1), 1)


def test_language_model_training_approaches_the_counts(spark):
    rows = [(c * 64 + p, k, 100 + 50 * (k == p)) for c in range(3) for p in range(4) for k in range(5)]
    weights = maxent.train(spark.createDataFrame(rows, "context long, class int, n long"), rounds=40)
    got = np.exp(weights.log_probabilities(np.array([1 * 64 + 2])))[0]
    assert abs(got[2] - 150 / 550) < 0.02 and abs(got[3] - 100 / 550) < 0.02


def test_language_model_without_training_rows(no_docs, docs):
    assert maxent.score(no_docs).count() == 0
    held = next(i for i in range(100) if maxent.held_out(i))
    one = docs.filter("doc_id = 1").withColumn("doc_id", F.lit(held).cast("long"))
    r = maxent.score(one).first()
    assert r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0.0


def test_language_model_text_form():
    m = maxent.Model({b"the": 1}, np.ones(64, np.int64), np.ones(64, np.int64), maxent.Weights.zeros())
    again = maxent.load_weights(maxent.save_weights(m))
    assert again.singles == m.singles and (again.totals == m.totals).all()


# --- BPE --------------------------------------------------------------------------------------


def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_equals_the_library(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path())
    got = by_id(bpe.digests(docs, path()))
    for i, t in rows(docs):
        ids = library.encode(t, add_special_tokens=False).ids
        want = (
            len(ids),
            hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
        )
        assert want in [tuple(r)[1:] for r in got[i]]


def test_bpe_splits_as_the_library_does():
    from tokenizers import Tokenizer

    pre = Tokenizer.from_file(path()).pre_tokenizer
    cut, rng = bpe.splitter([]), random.Random(5)
    pool = "ab1 '!\n\t  é漢か🙂༌\U0001e900̀٣"
    for _ in range(2000):
        s = "".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))
        assert cut(s.encode()) == [s[a:b] for _, (a, b) in pre.pre_tokenize_str(s)]


def test_bpe_round_trip_through_the_piece_join(docs, no_docs):
    back = by_id(bpe.decode(bpe.encode(docs, path()), path()))
    for i, t in rows(docs):
        assert t in [r["text"] for r in back[i]]
    assert bpe.digests(no_docs, path()).count() == 0


# --- near-duplicates --------------------------------------------------------------------------


def plain_fingerprint(t):
    words = WORD.findall(t.encode().translate(text.LOWER))
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles or ([b" ".join(words)] if words else [])]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(docs):
    got = by_id(simhash.near_duplicates(docs))
    for i, t in rows(docs):
        assert f"{plain_fingerprint(t):016x}" in [r["fingerprint"] for r in got[i]]
    assert got[2][0]["component_id"] == got[3][0]["component_id"] == 2  # both empty
    assert got[8][0]["component_id"] == got[10][0]["component_id"] == 8
    assert len(got[5]) == 2 and got[5][0]["component_id"] == 5


def test_links_equal_brute_force_also_in_split_nodes(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    codes = set(base)
    for b in base[:8]:
        for _ in range(60):
            codes.add(b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 3))))
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    frame = spark.createDataFrame([(c,) for c in signed], "fp long")
    parent = {c: c for c in signed}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for i, a in enumerate(codes):
        for j in range(i):
            if bin(a ^ codes[j]).count("1") <= 3:
                x, y = root(signed[i]), root(signed[j])
                parent[max(x, y)] = min(x, y)
    want = {c: root(c) for c in signed}
    for split in (4096, 16):
        found = graph.components(simhash.links(frame, split))
        got = {r["node"]: r["component"] for r in found.collect()}
        assert {c: got.get(c, c) for c in signed} == want


def test_gray_rank_orders_gray_codes():
    codes = np.arange(1 << 10, dtype=np.uint64)
    gray = codes ^ (codes >> np.uint64(1))
    assert (simhash.gray_rank(gray) == codes).all()


def test_keep_one_of_each_group(docs, no_docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    assert 10 not in ids and ids.count(5) == 1 and None in ids and 3 not in ids
    assert simhash.keep_one(no_docs).count() == 0


def word_shingles(t):
    words = t.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_copies_equal_brute_force(spark, docs, no_docs):
    rng = random.Random(8)
    base = [[f"w{rng.randrange(500)}" for _ in range(rng.choice((30, 120, 300)))] for _ in range(12)]
    texts = [" ".join(b) for b in base]
    for k in range(110):
        words = list(base[k % 7])
        for _ in range(rng.randint(1, max(1, len(words) // 40))):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += ["", " ", None, "one two", "One  two"]
    sets = [word_shingles(t or "") for t in texts]
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a == sets[j] or both and 5 * both >= 4 * len(a | sets[j]):
                x, y = root(i), root(j)
                least[max(x, y)] = min(x, y)
    want = {root(i) for i in range(len(texts))}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for split in (nearcopies.SPLIT, 8):
        assert {r["doc_id"] for r in nearcopies.keep_one(frame, split).collect()} == want
    kept = nearcopies.keep_one(docs)
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    assert kept.columns == docs.columns and 10 not in ids and ids.count(5) == 1 and None in ids
    assert nearcopies.keep_one(no_docs).count() == 0


def test_a_large_group_of_near_copies_makes_no_row_per_pair(spark, monkeypatch):
    """2,000 near copies of one text: what is shuffled and sent back stays in proportion to them."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    texts = []
    for _ in range(2000):
        words = list(base)
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(120)] = f"v{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    sets = [word_shingles(t) for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    made = {}

    def counted(df, label="frame", *rest):
        made[label] = max(made.get(label, 0), (out := stage(df, label, *rest)).count())
        return out

    tasks = []
    run = nearcopies._run

    def seen(rows, *rest):
        tasks.append(rows.count())
        return run(rows, *rest)

    monkeypatch.setattr(nearcopies, "stage", counted)
    monkeypatch.setattr(nearcopies, "_run", seen)
    kept = {r["doc_id"] for r in nearcopies.keep_one(frame, 256).collect()}
    often = Counter(x for found in sets for x in found)
    at = {x: k for k, x in enumerate(x for x, n in often.items() if n > 1)}
    has = np.zeros((len(sets), len(at)), dtype=np.float32)
    for i, found in enumerate(sets):
        has[i, [at[x] for x in found if x in at]] = 1
    both, sizes = has @ has.T, np.array([len(x) for x in sets])
    alike = 5 * both >= 4 * (sizes[:, None] + sizes[None, :] - both)
    np.fill_diagonal(alike, True)
    label = np.arange(len(sets))
    while (new := np.where(alike, label[None, :], len(sets)).min(axis=1)).tolist() != label.tolist():
        label = new
    assert kept == set(label.tolist()) and 1 < len(kept) < 1000
    assert made["settled"] < 16 * 2000 and max(tasks) < 16 * 2000 * 2


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (300, 300)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[200 + i] == 100 for i in range(50))


# --- syncmers ---------------------------------------------------------------------------------


def test_syncmer_anchors_equal_their_definition(spark, docs):
    few = docs.filter("doc_id in (1, 7, 8, 11)")
    got = {(r["doc_id"], r["pos"]) for r in syncmers.anchors(few).collect()}
    s, w, want = syncmers.INNER, syncmers.WINDOW, set()
    for i, t in rows(few):
        b = t.encode()
        h = [xxhash.xxh64_intdigest(b[k : k + s], 42) for k in range(len(b) - s + 1)]
        h = [x - (1 << 64) if x >> 63 else x for x in h]
        for k in range(len(h) - w + 1):
            if min(h[k : k + w]) in (h[k], h[k + w - 1]):
                want.add((i, k))
    assert got == want


def test_syncmer_fingerprints(docs, no_docs):
    got = by_id(syncmers.fingerprints(docs))
    order = sorted(rows(docs), key=lambda x: (x[0] is not None, x[0] or 0))
    for k, (i, t) in enumerate(order):
        nxt, h = order[(k + 1) % len(order)][1], len(t) // 2
        edited = t[: len(t) - h] + nxt[:h]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        r = next(r for r in got[i] if r["edited_sha256"] == digest)
        assert r["n_chars"] == len(t)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if edited == t:
            assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1
    assert got[2][0]["fingerprint"] == got[3][0]["fingerprint"] == "" and got[2][0]["near_next"] == 1
    assert got[8][0]["fingerprint"] == got[10][0]["fingerprint"] != got[9][0]["fingerprint"]
    assert got[6][0]["near_edited"] > 0.3
    assert syncmers.fingerprints(no_docs).count() == 0


def test_following_documents_across_ranges(spark):
    rows = [(3 * i, f"text {i} of some") for i in range(57)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for per in (5, 1000):
        got = {r["doc_id"]: r["next"]["text"] for r in syncmers.followed(frame, lambda _: F.lit(1), per).collect()}
        assert got == {i: rows[(k + 1) % 57][1] for k, (i, _) in enumerate(rows)}


def test_rows_without_an_id_are_cut_into_ranges(spark):
    rows = [(None, f"text {k}") for k in range(60)] + [(7, f"same {k}") for k in range(60)] + [(9, "last")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = syncmers.followed(frame, lambda _: F.lit(1), 20).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out) == sorted((i or 0, t) for i, t in rows)
    # following from any row to the next visits every row once
    after = {r["text"]: r["next"]["text"] for r in out}
    seen, at = [], "last"
    for _ in rows:
        at = after[at]
        seen.append(at)
    assert sorted(seen) == sorted(t for _, t in rows)
    ids = [next(i for i, t in rows if t == x) for x in seen]
    assert ids == [None] * 60 + [7] * 60 + [9]
    ranges = syncmers.split_ranges(frame.select(F.xxhash64("text").alias("h")), ["h"], 20)
    assert ranges.count > 3


# --- rules' statistics ------------------------------------------------------------------------


def test_statistics(docs):
    got = by_id(rules.statistics(docs))
    for i, t in rows(docs):
        b = t.encode()
        words = WORD.findall(b)
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        inside = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in b.split(b"\n") if WORD.search(x)]
        want = (
            len(words),
            sum(len(w.decode()) for w in words),
            len(re.findall(rb"[#*$%&|<>]", b)),
            len(lines) - len(set(lines)),
            len(inside),
        )
        assert want in [tuple(r)[1:6] for r in got[i]]


# --- repeated passages ------------------------------------------------------------------------


def plain_removed(texts, length=suffixes.LENGTH):
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        out.append(gone)
    return out


def passage_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    texts = [prose(rng.randint(0, 80)) + rng.choice(shared) + prose(rng.randint(0, 60)) for _ in range(40)]
    for k in range(12):  # copies with one letter changed, and parts of passages
        t = texts[k]
        at = rng.randrange(len(t))
        texts.append(t[:at] + "Z" + t[at + 1 :])
        texts.append(prose(20) + t[at : at + rng.choice((150, 199, 200, 201, 260))] + prose(10))
    return texts + ["ab" * 300, "b" * 199, "b" * 200, "c" * 500, shared[0], "", prose(9) + "x" * 5000]


def test_removal_equals_brute_force(spark):
    texts = passage_texts(11)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    gone = plain_removed([t.encode() for t in texts])
    plain = suffixes.digests(frame).collect()
    by_hot = {
        r["id"]: suffixes.stretches(r["spans"])
        for r in suffixes._removed(frame.withColumnRenamed("doc_id", "id"), hot=2, range_blocks=50).collect()
    }
    for r in plain:
        t, g = texts[r["doc_id"]].encode(), gone[r["doc_id"]]
        edges = np.diff(np.concatenate([[0], g.astype(int), [0]]))
        want = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
        kept = bytes(np.frombuffer(t, np.uint8)[~g])
        assert tuple(r)[1:] == (len(t), int(g.sum()), len(want), hashlib.sha256(kept).hexdigest())
        assert by_hot.get(r["doc_id"], []) == want  # hot k-grams and many ranges


def test_removal_on_edge_rows(docs, no_docs):
    got = by_id(suffixes.digests(docs))
    gone = plain_removed([t.encode() for _, t in rows(docs)])
    for (i, t), g in zip(rows(docs), gone):
        assert (len(t.encode()), int(g.sum())) in [(r["n_bytes"], r["n_removed"]) for r in got[i]]
    out = suffixes.without_repeats(docs)
    assert out.columns == docs.columns
    kept = by_id(out)
    assert kept[2][0]["text"] is None and kept[10][0]["text"] == ""
    assert suffixes.digests(no_docs).count() == 0 and suffixes.without_repeats(no_docs).count() == 0


def test_long_texts_are_cut_without_loss(monkeypatch, spark):
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 700)
    texts = [t for t in passage_texts(4) if t]
    b = [t.encode() for t in texts]
    found = {}
    for held in suffixes._segments(range(len(b)), b):
        for i, at, part in held:
            found.setdefault(i, set()).update(range(at, at + len(part) - suffixes.LENGTH + 1))
    for i, t in enumerate(b):
        assert found.get(i, set()) == set(range(len(t) - suffixes.LENGTH + 1))


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(8)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 9))).encode() for _ in range(300)]
    for k in (1, 2, 5, 8):
        runs = [sorted(words[i::k]) for i in range(k)]
        coded = [(r, suffixes.neighbour_prefixes(r, 16).tolist()) for r in runs]
        order, shared = suffixes.merge_runs(coded)
        merged = [runs[r][i] for r, i in order]
        assert merged == sorted(words)
        assert shared[1:] == [len(os.path.commonprefix(p)) for p in zip(merged, merged[1:])]
    assert suffixes.merge_runs([]) == ([], [])
    assert suffixes.front_decode(*suffixes.front_code(sorted(words))) == sorted(words)
