"""Operator 5: SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint has a bit set if over half of the document's shingle hashes have it. Fingerprints
link at ``DISTANCE`` or fewer differing bits.

Index. Equal fingerprints are one entry. If two fingerprints differ in at most 3 of 64 bits, then
one of four 16-bit bands is equal in both, so the upper nodes of the index are the shared masked
patterns (band, bits). Inside an upper node the entries are sorted by Gray rank, where neighbours
differ in few bits, and cut into lower nodes of ``LEAF`` entries. A lower node keeps the bits that
all its entries share. Two lower nodes whose shared bits already differ in more than ``DISTANCE``
places are pruned as wholes; differences accumulate from node to entry for the rest.

An upper node of more than ``SPLIT`` entries is cut into parts, and every pair of parts is a task of
its own, so that no task holds a whole hot node. A task sends back at most one link per entry that
it joined (a spanning forest of its links), which loses no component.

Null and empty texts have fingerprint zero and link like any other. Null doc_ids stay as rows with
a null component. Texts with fewer words than a shingle are one shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from liftworks.llm.graph import components
from liftworks.llm.rows import free_name, numbered
from liftworks.llm.text import binaries, words_of
from liftworks.sources import stage

SHINGLE = 3
SEED = 42
DISTANCE = 3
BANDS = 4  # DISTANCE + 1 bands of 16 bits
LEAF = 64
SPLIT = 4096


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    n = len(words)
    if not n:
        return 0
    text = b" ".join(words)
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(text, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: n - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(text[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(raw), 65536):
        bits = np.unpackbits(raw[at : at + 65536], axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per document, ``fp`` the 64 bits as a long."""

    def run(batches):
        for b in batches:
            prints = [fingerprint(words_of(t), shingle) for t in binaries(b.column(1))]
            prints = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints)], names=["doc_id", "fp"])

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(run, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _nodes(codes: np.ndarray):
    """Lower nodes of sorted codes: starts, bits that are one in all, bits that are zero in all."""
    starts = np.arange(0, len(codes), LEAF)
    return starts, np.bitwise_and.reduceat(codes, starts), ~np.bitwise_or.reduceat(codes, starts)


def near_pairs(left: np.ndarray, right: np.ndarray, distance: int = DISTANCE):
    """Index pairs (i, j) of codes at most ``distance`` bits apart; both sides in Gray order."""
    starts, ones, zeros = _nodes(left)
    others, other_ones, other_zeros = _nodes(right)
    for k, at in enumerate(starts):
        apart = np.bitwise_count((ones[k] & other_zeros) | (zeros[k] & other_ones))
        open_nodes = np.flatnonzero(apart <= distance)
        if not len(open_nodes):
            continue
        mine = left[at : at + LEAF]
        theirs = np.concatenate(
            [np.arange(others[n], min(others[n] + LEAF, len(right))) for n in open_nodes]
        )
        for lo in range(0, len(theirs), 1 << 14):
            part = theirs[lo : lo + (1 << 14)]
            near = np.bitwise_count(mine[:, None] ^ right[part][None, :]) <= distance
            i, j = np.nonzero(near)
            yield i + at, part[j]


class Forest:
    """Union by smallest root; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.links.append((i, j))
            self.parent[max(a, b)] = min(a, b)


def _whole_tasks(batches):
    """(group number, side, code) of the sorted rows, never cutting a group."""
    held: list[pa.RecordBatch] = []

    def arrays(table):
        keys = [table.column(k).to_numpy() for k in ("band", "bits", "i", "j")]
        new = np.zeros(table.num_rows, dtype=bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        return np.cumsum(new), table

    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) < 50_000:
            continue
        group, table = arrays(pa.Table.from_batches(held).combine_chunks())
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield group[:cut], table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held:
        yield arrays(pa.Table.from_batches(held).combine_chunks())


def _small_pairs(group: np.ndarray, codes: np.ndarray):
    """Pairs within groups of at most one lower node: every distance of places at once."""
    for lag in range(1, LEAF):
        if lag >= len(codes):
            break
        same = group[lag:] == group[:-lag]
        if not same.any():
            break
        near = same & (np.bitwise_count(codes[lag:] ^ codes[:-lag]) <= DISTANCE)
        i = np.flatnonzero(near)
        yield i, i + lag


def _links(batches):
    for group, table in _whole_tasks(batches):
        codes = table.column("fp").to_numpy().view(np.uint64)
        side = table.column("side").to_numpy()
        order = np.lexsort((gray_rank(codes), side, group))
        group, codes, side = group[order], codes[order], side[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(starts, len(group)))
        forest = Forest(len(codes))
        small = np.repeat(sizes <= LEAF, sizes)
        at = np.flatnonzero(small)
        for i, j in _small_pairs(group[at], codes[at]):
            for a, b in zip(at[i].tolist(), at[j].tolist()):
                forest.join(a, b)
        for start, size in zip(starts[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist()):
            mine = codes[start : start + size]
            cut = int((side[start : start + size] == 0).sum())
            left, right = (mine[:cut], mine[cut:]) if 0 < cut < size else (mine, mine)
            shift = cut if 0 < cut < size else 0
            for i, j in near_pairs(left, right):
                for a, b in zip((i + start).tolist(), (j + start + shift).tolist()):
                    if a != b:
                        forest.join(a, b)
        signed = codes.view(np.int64)
        pairs = np.array(forest.links, dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed[pairs[:, 0]]), pa.array(signed[pairs[:, 1]])], names=["a", "b"]
        )


def links(entries: DataFrame, split: int = SPLIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that give all their components."""
    width = 64 // BANDS
    bands = F.array(
        *[
            F.struct(
                F.lit(k).alias("band"),
                F.shiftrightunsigned("fp", k * width).bitwiseAND((1 << width) - 1).alias("bits"),
            )
            for k in range(BANDS)
        ]
    )
    held = entries.select("fp", F.explode(bands).alias("node")).select("fp", "node.*")
    sizes = held.groupBy("band", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / split).cast("int")
    placed = held.join(sizes.withColumn("parts", parts), ["band", "bits"]).withColumn(
        "part", F.pmod(F.xxhash64(F.col("fp"), F.lit(7)), "parts").cast("int")
    )
    # a part meets itself and every other part of its node
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    tasks = placed.select("fp", "band", "bits", "part", other).select(
        "fp",
        "band",
        "bits",
        F.least("part", "other").alias("i"),
        F.greatest("part", "other").alias("j"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
    )
    keys = ["band", "bits", "i", "j"]
    # many small groups share a Python batch
    return tasks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_links, "a long, b long")


def _named(prints: DataFrame, order) -> DataFrame:
    """(fp, component, least) of every fingerprint; ``least`` is its rows' least ``order``."""
    entries = stage(prints.groupBy("fp").agg(F.min(order).alias("least")), "entries")
    groups = components(links(entries.select("fp")))
    named = entries.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    return stage(named, "named")  # later joins then have plain sides, which Spark splits if skewed


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document; repeated rows stay."""
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    named = _named(prints, F.col("doc_id"))
    least = stage(
        named.groupBy("component").agg(F.min("least").alias("component_id")), "components"
    )
    table = named.join(least, "component").select("fp", "component_id")
    return prints.join(table, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows that are the first of their component, all columns: the least doc_id (null last), then
    the least hash of the text. Ids need not be there or differ; rows are told apart by number.
    """
    columns, row = docs.columns, free_name(docs)
    docs = numbered(docs, row)
    prints = stage(
        fingerprints(docs.select(F.col(row).alias("doc_id"), "text")).join(
            docs.select(
                F.col(row).alias("row"), F.col("doc_id").cast("long").alias("own"), F.xxhash64("text").alias("text")
            ),
            F.col("doc_id") == F.col("row"),
        ),
        "fingerprints",
    )
    order = F.struct(F.col("own").isNull().alias("none"), "own", "text", "row")
    first = _named(prints, order).groupBy("component").agg(F.min("least").alias("least"))
    return docs.join(first.select(F.col("least.row").alias(row)), row, "left_semi").select(columns)
