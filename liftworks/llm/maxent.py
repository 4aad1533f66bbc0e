"""Operator 1: hashed maximum-entropy language model with a class-factored softmax.

A token's probability is ``P(class | two tokens before) * P(token | class)``.

* Classes: the end of text and the most frequent words are classes of their own; all other words,
  seen or not, share classes by a hash of their last two bytes.
* ``P(class | context)`` is a softmax over sparse features: bias, previous class (n-gram), the
  class before it (skip), and both together hashed into buckets.
* ``P(token | class)`` is the add-one estimate within the class, unseen words counting as one more.
* Every word without a class of its own has a feature for each class that follows it in training, by
  the whole word: these have no fixed number, they grow with the vocabulary.

Training counts contexts over all training documents, so the model sees every token; the weights of the
class features follow the gradient "seen minus expected", computed by Spark tasks over the context
counts each round. A position has one previous word, so given those weights the words don't share
features: each one's are fitted by a step of iterative scaling, "seen over expected" with a prior, in the
shelf task that holds the word. Scores are made block by block in numpy.

Null texts are empty: they hold the end token only. Without any training document all counts are
zero and weights stay zero. A null doc_id counts as the empty string in the split. Equal rows are
scored each; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from liftworks.llm.blocks import Numbers, shelves_for, write_blocks
from liftworks.llm.text import pack_ints, unpack_bytes, unpack_ints, words_of
from liftworks.sources import stage

SINGLES = 32  # classes of one token: the end and the most frequent words
CLASSES = 64
JOINT = 1024  # buckets of class pairs
ROUNDS = 24
STEP = 0.4
RIDGE = 0.5
PRIOR = 10.0  # positions after a word that count as much as what the class features expect there
SHELF_BYTES = 6 << 20  # bytes of text for which there is a shelf task
SLICE = 4096  # words whose features are fitted at once


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def tail_class(word: bytes) -> int:
    return SINGLES + zlib.crc32(word[-2:]) % (CLASSES - SINGLES)


def joint_bucket(contexts: np.ndarray) -> np.ndarray:
    return (contexts.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(7)).astype(np.int64) % JOINT


@dataclass(frozen=True)
class Weights:
    """Weights by class of each feature: bias, previous class, skipped class, hashed pair."""

    bias: np.ndarray
    previous: np.ndarray
    skipped: np.ndarray
    joint: np.ndarray

    @staticmethod
    def zeros() -> Weights:
        return Weights(
            np.zeros(CLASSES), *[np.zeros((n, CLASSES)) for n in (CLASSES, CLASSES, JOINT)]
        )

    def parts(self) -> list[np.ndarray]:
        return [self.bias, self.previous, self.skipped, self.joint]

    def log_probabilities(self, contexts: np.ndarray) -> np.ndarray:
        """Natural log of P(class | context), one row per context (skipped * CLASSES + previous)."""
        x = (
            self.bias
            + self.previous[contexts % CLASSES]
            + self.skipped[contexts // CLASSES]
            + self.joint[joint_bucket(contexts)]
        )
        x -= x.max(axis=1, keepdims=True)
        return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Model:
    singles: dict[bytes, int]  # class of each frequent word
    totals: np.ndarray  # training tokens by class
    kinds: np.ndarray  # distinct training tokens by class
    weights: Weights

    @property
    def tokens(self) -> int:
        return int(self.totals.sum())

    @property
    def vocabulary(self) -> int:
        return int(self.kinds.sum())

    def classes(self, words: list[bytes]) -> np.ndarray:
        get = self.singles.get
        return np.fromiter((get(w) or tail_class(w) for w in words), np.int64, len(words))


def _totals(batches):
    """Per shelf task: frequent words, and tokens and distinct words by tail class."""
    counts: Counter = Counter()
    for b in batches:
        for words, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for w, k in zip(unpack_bytes(words), unpack_ints(n).tolist()):
                counts[w] += k
    tokens, kinds = Counter(), Counter()
    for w, n in counts.items():
        if n:
            tokens[tail_class(w)] += n
            kinds[tail_class(w)] += 1
    top = sorted(((-n, w) for w, n in counts.items() if n))[: SINGLES - 1]
    rows = [("top", w, -n, 1) for n, w in top]
    rows += [("tail", b"%d" % c, tokens[c], kinds[c]) for c in tokens]
    names = ["kind", "name", "tokens", "kinds"]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(c, t)
                for c, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.int64(), pa.int64()))
            ],
            names=names,
        )


def _block_parts(rows: pd.DataFrame):
    """Distinct words of a block by number, and its chunks of documents."""
    words: dict[int, bytes] = {}
    shelves = rows[rows["shelf"].notna()]
    for numbers, blob in zip(shelves["lengths"], shelves["words"]):
        words.update(zip(unpack_ints(numbers).tolist(), unpack_bytes(blob)))
    chunks = rows[rows["shelf"].isna()]
    return [words[i] for i in range(len(words))], chunks


def _sequence(classes: np.ndarray, words: np.ndarray, lengths: np.ndarray):
    """Classes of a chunk with an end (class 0) after each document, their contexts, and where the
    ends are."""
    ends = np.cumsum(lengths.astype(np.int64) + 1) - 1
    out = np.zeros(len(words) + len(lengths), dtype=np.int64)
    inside = np.ones(len(out), dtype=bool)
    inside[ends] = False
    out[inside] = classes[words]
    previous = np.concatenate([[0], out[:-1]])[: len(out)]
    skipped = np.concatenate([[0, 0], out[:-2]])[: len(out)]
    skipped[previous == 0] = 0  # nothing before the first token
    return out, skipped * CLASSES + previous, inside, ends


def context_counts(blocks: DataFrame, model: Model) -> DataFrame:
    """(context, class, n) over the training documents."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        names, chunks = _block_parts(rows)
        classes = model.classes(names)
        cells = np.zeros(CLASSES**3, dtype=np.int64)
        for flags, lengths, words in zip(chunks["flags"], chunks["lengths"], chunks["words"]):
            lengths = unpack_ints(lengths)
            out, contexts, _, _ = _sequence(classes, unpack_ints(words), lengths)
            trained = np.repeat(np.frombuffer(flags, np.uint8) > 0, lengths + 1)
            cells += np.bincount((contexts * CLASSES + out)[trained], minlength=len(cells))
        at = np.flatnonzero(cells)
        return pd.DataFrame({"context": at // CLASSES, "class": at % CLASSES, "n": cells[at]})

    return (
        blocks.select("block", "shelf", "flags", "lengths", "words")
        .groupBy("block")
        .applyInPandas(run, "context long, class int, n long")
        .groupBy("context", "class")
        .agg(F.sum("n").alias("n"))
    )


def _previous_words(words: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Number of the word before each token, -1 before the first of a document."""
    tokens = np.full(len(inside), -1, dtype=np.int64)
    tokens[inside] = words
    return np.concatenate([[-1], tokens[:-1]])[: len(tokens)]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all items of the spans, one span after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def _block_cells(classes: np.ndarray, chunks: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """What follows the words of a block: sorted cells (word, skipped class, class that follows) as one number,
    and how often each is in training documents. Words with a class of their own have none: the class
    features tell them."""
    keys, counts = [], []
    for flags, lengths, words in zip(chunks["flags"], chunks["lengths"], chunks["words"]):
        words, lengths = unpack_ints(words), unpack_ints(lengths)
        out, contexts, inside, _ = _sequence(classes, words, lengths)
        key = _cells(_previous_words(words, inside), contexts, out)
        trained = np.repeat(np.frombuffer(flags, np.uint8) > 0, lengths + 1)[key >= 0]
        key, at = np.unique(key[key >= 0], return_inverse=True)
        keys.append(key)
        counts.append(np.bincount(at[trained], minlength=len(key)))
    return _added(keys, counts)


def _cells(before: np.ndarray, contexts: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The cell of each position, -1 where there is none."""
    key = before * CLASSES**2 + contexts // CLASSES * CLASSES + out
    return np.where((before >= 0) & (contexts % CLASSES >= SINGLES), key, -1)


def _of_words(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the cells of each word start, and how many there are."""
    starts = np.searchsorted(keys, numbers.astype(np.int64) * CLASSES**2)
    return starts, np.searchsorted(keys, (numbers.astype(np.int64) + 1) * CLASSES**2) - starts


def word_cells(blocks: DataFrame, model: Model) -> DataFrame:
    """The shelf rows of each block with the cells of their words.

    ``sizes`` has each word's number of cells, ``cells`` the skipped class times CLASSES plus the class
    that follows, ``n`` how often in training.
    """
    schema = "block long, shelf int, numbers binary, words binary, counts binary, sizes binary, cells binary, n binary"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        names, chunks = _block_parts(rows)
        keys, counts = _block_cells(model.classes(names), chunks)
        shelves = rows[rows["shelf"].notna()]
        parts = []
        for block, shelf, numbers, words, seen in zip(*(shelves[c] for c in ("block", "shelf", "lengths", "words", "counts"))):
            starts, sizes = _of_words(keys, unpack_ints(numbers))
            at = _spans(starts, sizes)
            blobs = (pack_ints(x) for x in (sizes, keys[at] % CLASSES**2, counts[at]))
            parts.append((block, shelf, numbers, words, seen, *blobs))
        return pd.DataFrame(parts, columns=[f.split()[0] for f in schema.split(", ")])

    sides = blocks.select("block", "shelf", "flags", "lengths", "words", "counts")
    return sides.groupBy("block").applyInPandas(run, schema)


def word_features(
    place: np.ndarray, cell: np.ndarray, n: np.ndarray, classes: np.ndarray, chances: np.ndarray
) -> np.ndarray:
    """For each cell the natural log to add to that of P(class | context) by the class features.

    ``place`` (ascending), ``cell`` and ``n`` are the words' distinct cells, ``classes`` the class of each
    word, ``chances`` is P(class | context) by skipped and previous class. The odds of a class that
    was seen after a word in training are times 1 + gain there. With one skipped class only, the result is
    the share of what was seen among ``PRIOR`` positions more that are as expected.
    """
    out = np.zeros(len(place))
    of = classes[place]
    order = np.argsort(of, kind="stable")  # words stay in order within a class
    borders = np.searchsorted(of[order], np.arange(CLASSES + 1))
    for k in range(SINGLES, CLASSES):
        mine = order[borders[k] : borders[k + 1]]
        words = np.unique(place[mine])
        for at in range(0, len(words), SLICE):
            part = words[at : at + SLICE]
            used = mine[slice(*np.searchsorted(place[mine], (part[0], part[-1] + 1)))]
            word, code, times = np.searchsorted(part, place[used]), cell[used], n[used]
            size = len(part) * CLASSES
            before = np.bincount(word * CLASSES + code // CLASSES, times, size).reshape(-1, CLASSES)
            seen = np.bincount(word * CLASSES + code % CLASSES, times, size).reshape(-1, CLASSES)
            expected = before @ chances[:, k]
            gain = np.zeros_like(seen)
            w, c = np.nonzero(seen)
            gain[w, c] = seen[w, c] * before.sum(axis=1)[w] / (PRIOR * expected[w, c])
            whole = gain @ chances[:, k].T  # by skipped class
            out[used] = np.log1p(gain[word, code % CLASSES]) - np.log1p(whole[word, code // CLASSES])
    return out


def word_weights(blocks: DataFrame, shelves: int, model: Model) -> DataFrame:
    """(block, numbers, answers, added): for the words of each block and shelf their training counts, and what
    ``word_features`` gives for their cells in the block, one number a cell."""

    def run(batches):
        held = [b for b in batches if b.num_rows]  # compressed words and cells
        numbers, keys, counts = Numbers(), [], []
        total = np.zeros(1024, np.int64)
        rows = []  # of each row the words' numbers
        for b in held:
            for words, seen, sizes, cells, n in zip(*(b.column(k).to_pylist() for k in (2, 3, 4, 5, 6))):
                words = unpack_bytes(words)
                own = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                rows.append(own)
                if len(numbers) > len(total):
                    total = np.concatenate([total, np.zeros(len(numbers), np.int64)])
                total[own] += unpack_ints(seen)  # a block has a word once
                keys.append(np.repeat(own, unpack_ints(sizes)) * CLASSES**2 + unpack_ints(cells))
                counts.append(unpack_ints(n).astype(np.int64))
        if (total >= 1 << 32).any():
            raise OverflowError("a word occurs too often for packed counts")
        keys, counts = _added(keys, counts)  # the parts are let go
        chances = np.exp(model.weights.log_probabilities(np.arange(CLASSES**2))).reshape(CLASSES, CLASSES, CLASSES)
        added = word_features(
            keys // CLASSES**2, keys % CLASSES**2, counts, model.classes(list(numbers)), chances
        ).astype("<f4")
        replies = iter(rows)
        for b in held:
            answers, blobs = [], []
            for sizes, cells in zip(b.column(4).to_pylist(), b.column(5).to_pylist()):
                own = next(replies)
                wanted = np.repeat(own, unpack_ints(sizes)) * CLASSES**2 + unpack_ints(cells)
                answers.append(pack_ints(total[own]))
                blobs.append(added[np.searchsorted(keys, wanted)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(answers, pa.binary()), pa.array(blobs, pa.binary())],
                names=["block", "numbers", "answers", "added"],
            )

    return (
        word_cells(blocks, model)
        .repartition(shelves, "shelf")
        .drop("shelf")
        .mapInArrow(run, "block long, numbers binary, answers binary, added binary")
    )


def train(cells: DataFrame, rounds: int = ROUNDS) -> Weights:
    """Weights after ``rounds`` of gradient updates over the context counts.

    Each step is scaled by the larger of its feature's seen and expected counts, so that rare
    features cannot overshoot. The table has at most CLASSES**3
    rows; tasks send back one gradient each.
    """
    # in one order, so that sums are the same in every run
    cells = cells.repartition(4, "context").sortWithinPartitions("context", "class")
    cells = stage(cells, "context_counts")
    weights = Weights.zeros()
    first = cells.groupBy("class").agg(F.sum("n").alias("n")).collect()  # one row per class
    share = np.full(CLASSES, 0.5)
    for row in first:
        share[row["class"]] += row["n"]
    weights.bias[:] = np.log(share / share.sum())
    if not first:
        return Weights.zeros()

    def gradients(batches):
        rows = [b.to_pandas() for b in batches]
        if not rows:
            return
        rows = pd.concat(rows)
        contexts, at = np.unique(rows["context"].to_numpy(), return_inverse=True)
        seen = np.zeros((len(contexts), CLASSES))
        seen[at, rows["class"].to_numpy()] = rows["n"].to_numpy()
        expected = np.exp(weights.log_probabilities(contexts)) * seen.sum(axis=1, keepdims=True)
        out = []
        for x in (seen, expected):
            parts = [np.zeros_like(p) for p in weights.parts()]
            parts[0] += x.sum(axis=0)
            np.add.at(parts[1], contexts % CLASSES, x)
            np.add.at(parts[2], contexts // CLASSES, x)
            np.add.at(parts[3], joint_bucket(contexts), x)
            out.append(np.concatenate([p.ravel() for p in parts]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x.tobytes()], pa.binary()) for x in out], names=["seen", "expected"]
        )

    for _ in range(rounds):
        sums = cells.mapInArrow(gradients, "seen binary, expected binary").collect()
        seen, expected = (sum(np.frombuffer(s[i]) for s in sums) for i in (0, 1))
        flat = np.concatenate([p.ravel() for p in weights.parts()])
        flat = flat + STEP * (seen - expected - RIDGE * flat) / (np.maximum(seen, expected) + RIDGE)
        sizes = np.cumsum([p.size for p in weights.parts()])[:-1]
        weights = Weights(
            *[a.reshape(p.shape) for a, p in zip(np.split(flat, sizes), weights.parts())]
        )
    return weights


def fit(blocks: DataFrame, shelves: int, train_docs: int, rounds: int = ROUNDS) -> Model:
    shelf_words = blocks.filter("shelf is not null").select("shelf", "words", "counts")
    totals = stage(
        shelf_words.repartition(shelves, "shelf")
        .drop("shelf")
        .mapInArrow(_totals, "kind string, name binary, tokens long, kinds long"),
        "word_totals",
    )
    top = (
        totals.filter("kind = 'top'")
        .orderBy(F.desc("tokens"), "name")
        .limit(SINGLES - 1)
        .collect()
    )
    tails = totals.filter("kind = 'tail'").groupBy("name").agg(
        F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")
    )
    tokens, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for row in tails.collect():  # one row per tail class
        tokens[int(row["name"])], kinds[int(row["name"])] = row["tokens"], row["kinds"]
    singles = {}
    for i, row in enumerate(top, 1):
        word = bytes(row["name"])
        singles[word] = i
        tokens[i], kinds[i] = row["tokens"], 1
        tokens[tail_class(word)] -= row["tokens"]
        kinds[tail_class(word)] -= 1
    tokens[0], kinds[0] = train_docs, int(train_docs > 0)
    model = Model(singles, tokens, kinds, Weights.zeros())
    return Model(singles, tokens, kinds, train(context_counts(blocks, model), rounds))


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Scores of all ``docs``; the model learns from those that ``held_out`` doesn't name."""
    shelves = shelves_for(docs, SHELF_BYTES)
    blocks = write_blocks(docs, words_of, lambda i: not held_out(i), shelves)
    flags = F.col("flags")
    train_docs = (
        blocks.filter("shelf is null")
        .agg(F.sum(F.length(F.regexp_replace(F.hex(flags), "00|(01)", "$1")) / 2))
        .first()[0]
    )
    model = fit(blocks, shelves, int(train_docs or 0), rounds)
    return _scores(blocks, word_weights(blocks, shelves, model), model)


def _scores(blocks: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )

    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        names, chunks = _block_parts(rows)
        classes = model.classes(names)
        counts = np.zeros(len(names), dtype=np.int64)
        for numbers, blob in zip(replies["numbers"], replies["answers"]):
            counts[unpack_ints(numbers)] = unpack_ints(blob)
        keys, _ = _block_cells(classes, chunks)
        added = np.zeros(len(keys), "<f4")
        for numbers, blob in zip(replies["numbers"], replies["added"]):
            added[_spans(*_of_words(keys, unpack_ints(numbers)))] = np.frombuffer(blob, "<f4")
        whole = model.tokens + model.vocabulary + 1
        base = np.log10(counts + 1.0) - np.log10(whole)
        within = np.log10(counts + 1.0) - np.log10(
            model.totals[classes] + model.kinds[classes] + 1.0
        )
        within[classes < SINGLES] = 0.0
        end_base = np.log10(model.totals[0] + 1.0) - np.log10(whole)
        out = []
        for ids, flags, lengths, words in zip(
            chunks["doc_ids"], chunks["flags"], chunks["lengths"], chunks["words"]
        ):
            words, lengths = unpack_ints(words), unpack_ints(lengths)
            sequence, contexts, inside, ends = _sequence(classes, words, lengths)
            distinct, at = np.unique(contexts, return_inverse=True)
            table = model.weights.log_probabilities(distinct) / np.log(10)
            scores = table[at, sequence]
            cells = _cells(_previous_words(words, inside), contexts, sequence)
            scores[cells >= 0] += added[np.searchsorted(keys, cells[cells >= 0])] / np.log(10)
            scores[inside] += within[words]
            bases = np.full(len(sequence), end_base)
            bases[inside] = base[words]
            known = np.full(len(sequence), int(model.totals[0] > 0))
            known[inside] = counts[words] > 0
            starts = np.concatenate([[0], ends[:-1] + 1])
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array(list(ids), dtype="Int64"),
                        "held_out": np.frombuffer(flags, np.uint8) == 0,
                        "n_tokens": lengths.astype(np.int64) + 1,
                        "n_known": np.add.reduceat(known, starts),
                        "train_tokens": model.tokens,
                        "base_score": np.add.reduceat(bases, starts),
                        "score": np.add.reduceat(scores, starts),
                    }
                )
            )
        return pd.concat(out)

    sides = blocks.select("block", "shelf", "doc_ids", "flags", "lengths", "words")
    return sides.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, schema)


def save_weights(model: Model) -> str:
    """Text form of a fitted model without the features of single words, which are no driver's to hold."""
    return json.dumps(
        {
            "singles": {w.hex(): i for w, i in model.singles.items()},
            "totals": model.totals.tolist(),
            "kinds": model.kinds.tolist(),
            "weights": [p.tolist() for p in model.weights.parts()],
        }
    )


def load_weights(text: str) -> Model:
    d = json.loads(text)
    return Model(
        {bytes.fromhex(w): i for w, i in d["singles"].items()},
        np.array(d["totals"]),
        np.array(d["kinds"]),
        Weights(*[np.array(p) for p in d["weights"]]),
    )
