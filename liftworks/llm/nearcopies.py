"""Near-duplicate stage: word shingles of five, exact Jaccard similarity of 0.8 or more.

Texts with the same words are one entry. Operator 5 goes first: entries of equal SimHash fingerprint (of
the same shingles), and fingerprints that its Gray-order index links, are pairs to be verified. Three of
64 bits hold only part of the pairs at 0.8, so all others are found by least hashes. An entry's signature is ``BANDS * ROWS`` least hashes of its
shingles; two entries are compared if all hashes of a band are equal in both, which two texts of
similarity 0.8 miss in one of 4,700 cases. Compared pairs whose signatures agree in fewer than
``AGREE`` places are left out (0.8 comes out so low less than once in 10,000); all others are
decided by their shingle sets, so no pair below 0.8 links.

Comparing. First every entry meets the least entry of each of its nodes (band, hashes); a large
group of copies joins by that, at one row per entry. In nodes that still hold more than one component,
entries of different components are compared by signature, and those that have someone to meet bring
their shingle sets to the node's tasks (``across``), which verify pairs and keep a forest of what is
joined. No table has a row per pair: what a task sends back are fewer links than it has entries.

Null texts are empty; texts without words are one entry. Texts with fewer words than a shingle are
one shingle. An empty table gives an empty one. Rows are told apart by a number of their own, in a column
whose name no other one has; all columns are kept as they are.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from liftworks.llm import simhash
from liftworks.llm.graph import components
from liftworks.llm.rows import free_name, numbered
from liftworks.llm.simhash import Forest
from liftworks.llm.text import binaries, words_of
from liftworks.sources import stage

SHINGLE = 5
BANDS = 16
ROWS = 4
PLACES = BANDS * ROWS
AGREE = 34
SPLIT = 1024
PART_BYTES = 16 << 20  # of shingle sets in a part, about
MEMO = 200_000  # words whose hash a task remembers

_DRAWS = np.random.Generator(np.random.PCG64(5))
_TURNS = _DRAWS.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_SCALE = _DRAWS.integers(1, 2**63, PLACES, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Hashes(dict):
    """Hash of each word."""

    def __missing__(self, word):
        if len(self) > MEMO:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 42)
        return found


def shingles(words: list[bytes], hashes: Hashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    n = len(words)
    h = np.fromiter((hashes[w] for w in words), np.uint64, n)
    width = min(n, SHINGLE)
    total = np.zeros(n - width + 1 if n else 0, dtype=np.uint64)
    for k in range(width):
        x = h[k : n - width + 1 + k] * _TURNS[k]
        total += (x ^ (x >> np.uint64(32))) * _MIX
    total = (total ^ (total >> np.uint64(29))) * _MIX
    return np.unique(total ^ (total >> np.uint64(32)))


def signature(found: np.ndarray) -> bytes:
    """Sixteen bits of the least hash in each place; empty without shingles."""
    if not len(found):
        return b""
    least = np.full(PLACES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 4096):
        x = found[None, at : at + 4096] * _SCALE[:, None]
        np.minimum(least, (x ^ (x >> np.uint64(31))).min(axis=1), out=least)
    return ((least * _MIX) >> np.uint64(48)).astype("<u2").tobytes()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two shingle sets is 0.8 or more."""
    small, large = sorted((len(a), len(b)))
    if 5 * small < 4 * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (small + large - both)


def prints(docs: DataFrame) -> DataFrame:
    """(row, entry, sig, doc_id, text, fp): of every document, ``text`` the hash of its text and ``fp`` its
    SimHash fingerprint."""

    def run(batches):
        hashes = Hashes()
        for b in batches:
            entries, sigs, texts, fps = [], [], [], []
            for text in binaries(b.column(1)):
                words = words_of(text)
                entries.append(xxhash.xxh64_intdigest(b" ".join(words), 3))
                sigs.append(signature(shingles(words, hashes)))
                texts.append(xxhash.xxh64_intdigest(text, 4))
                fps.append(simhash.fingerprint(words, SHINGLE))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(np.array(entries, dtype=np.uint64).view(np.int64)),
                    pa.array(sigs, pa.binary()),
                    b.column(2),
                    pa.array(np.array(texts, dtype=np.uint64).view(np.int64)),
                    pa.array(np.array(fps, dtype=np.uint64).view(np.int64)),
                ],
                names=["row", "entry", "sig", "doc_id", "text", "fp"],
            )

    rows = docs.select(F.col("__row").alias("row"), "text", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "row long, entry long, sig binary, doc_id long, text long, fp long")


def fingerprint_pairs(entries: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``entries`` (entry, fp) by operator 5: each entry with the least one of its fingerprint,
    and those least ones along the links of the fingerprints' index."""
    least = stage(entries.groupBy("fp").agg(F.min("entry").alias("a")), "fingerprints")
    equal = entries.join(least, "fp").filter("entry != a").select("a", F.col("entry").alias("b"))
    links = simhash.links(least.select("fp")).toDF("left", "right")
    linked = links.join(least.toDF("left", "a"), "left").join(least.toDF("right", "b"), "right")
    return equal.union(linked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _alike(batches):
    """Pairs whose signatures agree in ``AGREE`` places."""
    for b in batches:
        left, right = (
            np.frombuffer(b"".join(b.column(k).to_pylist()), "<u2").reshape(-1, PLACES) for k in (2, 3)
        )
        near = (left == right).sum(axis=1) >= AGREE
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(
            pa.array(near)
        )


def _similar(batches):
    """Pairs whose texts are similar."""
    hashes, held = Hashes(), {}
    for b in batches:
        out = []
        for x, y, left, right in zip(
            b.column(0).to_pylist(), b.column(1).to_pylist(), binaries(b.column(2)), binaries(b.column(3))
        ):
            sets = []
            for key, text in ((x, left), (y, right)):
                if key not in held:
                    if len(held) > 64:
                        held.clear()
                    held[key] = shingles(words_of(text), hashes)
                sets.append(held[key])
            out.append(similar(*sets))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(
            pa.array(out, pa.bool_())
        )


def verified(pairs: DataFrame, entries: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose texts are similar."""
    pairs = stage(pairs, "pairs")
    used = pairs.select(F.col("a").alias("entry")).union(pairs.select("b")).distinct()
    places = entries.join(used, "entry").select(F.col("least.row").alias("__row"), "entry")
    texts = stage(docs.select("__row", "text").join(places, "__row").select("entry", "text"), "texts")
    left = texts.select(F.col("entry").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("entry").alias("b"), F.col("text").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return stage(both.mapInArrow(_similar, "a long, b long"), "similar")


def shared_here(sigs: np.ndarray, sig: np.ndarray, band: int) -> np.ndarray:
    """Whether each of ``sigs`` first meets ``sig`` in this band and agrees in enough places. Two entries
    are compared in the first band they share, so once."""
    same = sigs == sig
    bands = same.reshape(len(sigs), BANDS, ROWS).all(axis=2)
    return bands[:, band] & ~bands[:, :band].any(axis=1) & (same.sum(axis=1) >= AGREE)


def _groups(batches, held_rows: int = 20_000, held_bytes: int = 16 << 20):
    """Sorted rows as tables that never cut a task's group (band, bits, i, j), with group numbers."""
    held: list[pa.RecordBatch] = []

    def arrays(table):
        new = np.zeros(table.num_rows, dtype=bool)
        for k in ("band", "bits", "i", "j"):
            key = table.column(k).to_numpy()
            new[1:] |= key[1:] != key[:-1]
        return np.cumsum(new), table

    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) < held_rows and sum(x.nbytes for x in held) < held_bytes:
            continue
        group, table = arrays(pa.Table.from_batches(held).combine_chunks())
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield group[:cut], table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield arrays(pa.Table.from_batches(held).combine_chunks())


def _compared(batches):
    """Per group: the table's arrays, and for each entry the places of those to compare it with."""
    for group, table in _groups(batches):
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        label, side, band = (table.column(k).to_numpy() for k in ("label", "side", "band"))
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(-1, PLACES)

        def meets(start, end):
            own = np.arange(start, end)
            split = 0 < side[own].sum() < len(own)
            for i in own[side[own] == 0].tolist() if split else own.tolist():
                others = own[side[own] == 1] if split else own[own > i]
                others = others[label[others] != label[i]]
                if len(others):
                    near = others[shared_here(sigs[others], sigs[i], band[i])]
                    if len(near):
                        yield i, near

        yield table, zip(starts.tolist(), [*starts[1:].tolist(), len(group)]), meets


def _open(batches):
    """(entry, band, bits) of entries that have someone to be compared with."""
    for table, groups, meets in _compared(batches):
        some = np.zeros(table.num_rows, dtype=bool)
        for start, end in groups:
            for i, near in meets(start, end):
                some[i] = some[near] = True
        at = pa.array(np.flatnonzero(some))
        yield pa.RecordBatch.from_arrays(
            [table.column(k).take(at).combine_chunks() for k in ("entry", "band", "bits")],
            names=["entry", "band", "bits"],
        )


def _settled(batches):
    """Links (a, b) that join components inside each task's group: a pair is verified only if no links so
    far join it, so there are fewer links than entries."""
    for table, groups, meets in _compared(batches):
        entry, label = table.column("entry").to_numpy(), table.column("label").to_numpy()
        sets = table.column("found").combine_chunks()
        links: list[tuple[int, int]] = []

        @functools.lru_cache(maxsize=256)
        def found(i):
            return np.frombuffer(sets[i].as_buffer(), np.uint64)

        for start, end in groups:
            at = {x: k for k, x in enumerate(np.unique(label[start:end]).tolist())}
            forest = Forest(len(at))
            place = [at[x] for x in label[start:end].tolist()]
            for i, near in meets(start, end):
                for j in near.tolist():
                    a, b = place[i - start], place[j - start]
                    if forest.root(a) != forest.root(b) and similar(found(i), found(j)):
                        forest.join(a, b)
                        links.append((int(entry[i]), int(entry[j])))
        rows = np.array(links, dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["a", "b"])


def _tasks(held: DataFrame, split: int, bytes_of=None) -> DataFrame:
    """``held`` (entry, band, bits, label, ...) of nodes with more than one component, cut into tasks.

    A node's largest component need not be compared with itself: its entries are dealt to parts, and
    meet the slices of all others. So a node with n entries of which k are not in the largest
    component has about n + k * n / split rows, not its square.
    """
    size = F.sum(bytes_of) if bytes_of is not None else F.lit(0)
    labels = held.groupBy("band", "bits", "label").agg(F.count(F.lit(1)).alias("n"), size.alias("size"))
    nodes = labels.groupBy("band", "bits").agg(
        F.max(F.struct("n", "label")).alias("top"), F.max_by("size", F.struct("n", "label")).alias("top_size"),
        F.sum("n").alias("n"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("labels"),
    )

    def parts(rows, size):
        return F.greatest(F.ceil(rows / split), F.ceil(size / PART_BYTES), F.lit(1)).cast("int")

    nodes = stage(
        nodes.filter("labels > 1").select(
            "band", "bits", F.col("top.label").alias("top"),
            parts(F.col("n") - F.col("top.n"), F.col("size") - F.col("top_size")).alias("slices"),
            parts(F.col("top.n"), F.col("top_size")).alias("parts"),
        ),
        "mixed_nodes",
    )
    large, mark = F.col("label") == F.col("top"), F.xxhash64("entry", F.lit(7))
    rows = held.join(nodes, ["band", "bits"]).withColumn(
        "part",
        F.when(large, F.col("slices") + F.pmod(mark, "parts")).otherwise(F.pmod(mark, "slices")).cast("int"),
    )
    last = F.col("slices") - 1 + F.when(large, 0).otherwise(F.col("parts"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return rows.select(
        "entry", "label", "band", "bits",
        F.least("part", "other").alias("i"),
        F.greatest("part", "other").alias("j"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
    )


def _run(tasks: DataFrame, work, schema: str) -> DataFrame:
    keys = ["band", "bits", "i", "j"]
    return tasks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(work, schema)


def across(members: DataFrame, named: DataFrame, entries: DataFrame, docs: DataFrame, split: int = SPLIT) -> DataFrame:
    """Links (a, b) between similar entries of one node and different components, enough to join these.

    ``members`` (entry, band, bits), ``named`` (entry, sig, label) and ``entries`` are written tables.
    First signatures alone say which entries have someone to meet; only these are looked at again with
    their shingle sets, one row per entry and task, and settled there.
    """
    labels = named.select("entry", "label")
    held = members.select("entry", "band", "bits").join(labels, "entry")
    tasks = _tasks(held, split).join(named.select("entry", "sig"), "entry")
    some = _run(tasks, _open, "entry long, band int, bits long").distinct()
    some = stage(some, "open")
    places = entries.join(some.select("entry").distinct(), "entry").select(F.col("least.row").alias("__row"), "entry")

    def sets(batches):
        hashes = Hashes()
        for b in batches:
            found = [shingles(words_of(t), hashes).tobytes() for t in binaries(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["entry", "found"])

    texts = docs.select("__row", "text").join(places, "__row").select("entry", "text")
    texts = stage(texts.mapInArrow(sets, "entry long, found binary"), "sets")
    sized = texts.select("entry", F.length("found").alias("bytes"))
    held = some.join(labels, "entry").join(sized, "entry")
    tasks = _tasks(held, split, bytes_of=F.col("bytes"))
    tasks = tasks.join(named.select("entry", "sig"), "entry").join(texts, "entry")
    return stage(_run(tasks, _settled, "a long, b long"), "settled")


def _labelled(entries: DataFrame, links: DataFrame) -> DataFrame:
    """``entries`` with ``label``, the least entry of their component."""
    groups = components(links).select(F.col("node").alias("entry"), F.col("component").alias("label"))
    return entries.join(groups, "entry", "left").withColumn("label", F.coalesce("label", "entry"))


def keep_one(docs: DataFrame, split: int = SPLIT) -> DataFrame:
    """Rows that are the first of their component, all columns: the least doc_id (null last), then
    the least hash of the text. Ids need not be there or differ; rows are told apart by number.
    """
    columns = docs.columns
    row = free_name(docs)
    docs = numbered(docs, row)
    given, docs = docs, docs.select(F.col(row).alias("__row"), "doc_id", "text")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text", "row")
    entries = stage(prints(docs), "prints").groupBy("entry").agg(
        F.min(order).alias("least"), F.min("sig").alias("sig"), F.min("fp").alias("fp")
    )
    entries = stage(entries, "entries")
    node = F.struct(
        F.col("k").alias("band"), F.expr(f"xxhash64(substring(sig, k * {2 * ROWS} + 1, {2 * ROWS}))").alias("bits")
    )
    held = (
        entries.filter("length(sig) > 0")
        .select("entry", "sig", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("k"))
        .select("entry", node.alias("node"))
        .select("entry", "node.*")
    )
    sizes = held.groupBy("band", "bits").agg(F.count(F.lit(1)).alias("n"), F.min("entry").alias("first"))
    sizes = stage(sizes.filter("n > 1").drop("n"), "nodes")
    members = stage(held.join(sizes, ["band", "bits"]), "members")
    stars = members.filter("entry != first").select(F.col("first").alias("a"), F.col("entry").alias("b"))
    printed = fingerprint_pairs(entries.filter("length(sig) > 0").select("entry", "fp"))
    stars = stage(stars.union(printed).distinct(), "stars")
    sigs = entries.select("entry", "sig")
    stars = (
        stars.join(sigs.toDF("a", "left"), "a").join(sigs.toDF("b", "right"), "b")
        .select("a", "b", "left", "right")
        .mapInArrow(_alike, "a long, b long")
    )
    links = verified(stars, entries, docs)
    named = stage(_labelled(sigs, links), "named")
    links = links.union(across(members, named, entries, docs, split))
    first = _labelled(entries, links).groupBy("label").agg(F.min("least").alias("least"))
    return given.join(first.select(F.col("least.row").alias(row)), row, "left_semi").select(columns)
