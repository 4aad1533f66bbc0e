"""Operator 9: exact removal of repeated passages by a distributed merge sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else.

Which suffixes. Every window of ``LENGTH`` bytes has an *anchor*, the position of its least k-gram
hash; equal windows have their anchors at the same place, so windows are compared through the
suffixes at their anchors only. Consecutive windows with one anchor form a *block* of text around
it: the suffix from the anchor on, and what is left of the anchor. Blocks whose k-gram occurs once
in the corpus repeat nothing. Equal blocks are pre-aggregated into one with its count.

Sort. Each task sorts the suffixes of its blocks into runs and front-codes them: of each suffix only
what differs from the one before is sent. A range of the order (cut by a sample, never through a
k-gram) merges its runs with a loser tree whose nodes know the prefix they share with the last
winner: of two suffixes the one sharing more comes first without looking at a byte, and bytes are
compared only from the shared prefix on. The merge yields the common prefix of all neighbours.

Verdict. Window ``o`` bytes before its anchor is repeated if another block agrees in ``o`` bytes to
the left and ``LENGTH - o`` to the right. For each ``o``, neighbours in suffix order with that
prefix, and in the order of reversed left sides, are clusters; a block is repeated there if it
shares both clusters with another, or stands for several equal blocks.

A k-gram with more than ``HOT`` different blocks is not put into one task: its windows are dealt by
their own hash (128 bits) and counted.

Null texts are empty. Repeated rows are documents of their own, so their long texts go. Results per
row, whatever the ids: null or repeated doc_ids are replaced by row numbers inside.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from liftworks.llm.rows import free_name, numbered
from liftworks.llm.text import binaries
from liftworks.sources import stage

LENGTH = 200
GRAM = 40
SPAN = LENGTH - GRAM + 1  # k-grams of a window, and windows that can share an anchor
GROUP_BYTES = 2 << 20  # text looked at together
RANGE_BLOCKS = 20_000
RUN_BLOCKS = 40_000
HOT = 20_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.Generator(np.random.PCG64(9)).integers(1, 2**63, 256, dtype=np.uint64)


# --- anchors ----------------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def blocks_of(data: np.ndarray, ends: np.ndarray):
    """Blocks of texts laid end to end: first and last window, anchor, k-gram and content hash.

    Content and k-gram hashes are differences of running sums of powers, so any stretch costs one
    multiplication. ``data`` is shorter than 2**24.
    """
    n = len(data)
    empty = np.zeros(0, dtype=np.int64)
    if n < LENGTH:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    powers = np.cumprod(np.full(n, _ODD))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * powers)])
    back = np.cumprod(np.full(n, _INVERSE))

    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * back[: n - GRAM + 1])
    place = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << 24) - 1)
    least = (sliding_min((grams & ~low) | place, SPAN) & low).astype(np.int64)
    windows = np.arange(len(least))
    owner = np.searchsorted(ends, windows, side="right")
    inside = windows + LENGTH <= ends[np.minimum(owner, len(ends) - 1)]
    new = np.ones(len(least), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new & inside)
    # the last window of a block: before the next block, or the last that fits its text
    following = np.append(np.flatnonzero(new)[1:], len(least))
    last = following[np.searchsorted(np.flatnonzero(new), first)] - 1
    last = np.minimum(last, ends[owner[first]] - LENGTH)
    anchor = least[first]
    content = (sums[last + LENGTH] - sums[first]) * back[first]
    shape = ((anchor - first) * 1024 + (last - first)).astype(np.uint64)
    return first, last, anchor, grams[anchor], mixed(mixed(content) + shape * _MIX)


def _segments(ids, texts):
    """Groups of (id, offset, bytes); long texts are cut so that each window is in one segment."""
    held, size = [], 0
    for i, text in zip(ids, texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), GROUP_BYTES):
            part = text[at : at + GROUP_BYTES + LENGTH - 1]
            if len(part) >= LENGTH:
                held.append((i, at, part))
                size += len(part)
            if size >= GROUP_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _anchors(batches, with_place: bool):
    for b in batches:
        for held in _segments(b.column(0).to_pylist(), binaries(b.column(1))):
            data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
            ends = np.cumsum([len(p) for _, _, p in held])
            first, last, anchor, gram, content = blocks_of(data, ends)
            out = {"gram": gram.view(np.int64)}
            if with_place:
                owner = np.searchsorted(ends, first, side="right")
                base = np.array([at for _, at, _ in held]) - np.concatenate([[0], ends[:-1]])
                out["content"] = content.view(np.int64)
                out["id"] = np.array([i for i, _, _ in held], dtype=np.int64)[owner]
                out["span"] = (((first + base[owner]) << 8 | last - first) << 8) | anchor - first
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in out.values()], names=list(out))


def repeated_blocks(docs: DataFrame) -> DataFrame:
    """(gram, content, id, span) of the blocks whose k-gram occurs twice or more.

    ``span`` holds first window, windows - 1 and anchor - first, in 48, 8 and 8 bits.
    """
    grams = docs.mapInArrow(lambda b: _anchors(b, False), "gram long")
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    often = stage(often, "often")  # the join below then has plain sides, which Spark splits if skewed
    places = docs.mapInArrow(
        lambda b: _anchors(b, True), "gram long, content long, id long, span long"
    )
    return stage(places.join(often, "gram"), "repeated_blocks")


# --- sorted runs ------------------------------------------------------------------------------


def as_matrix(items: list[bytes], width: int) -> np.ndarray:
    """Byte strings as rows, filled up with zeros."""
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in items), np.uint8).reshape(-1, width)


def neighbour_prefixes(items: list[bytes], width: int) -> np.ndarray:
    """Length of the common prefix of each string with the one before; 0 for the first."""
    out = np.zeros(len(items), dtype=np.int64)
    for at in range(1, len(items), 20_000):
        m = as_matrix(items[at - 1 : at + 20_000], width)
        apart = m[1:] != m[:-1]
        same = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
        out[at : at + 20_000] = same
    lengths = np.fromiter(map(len, items), np.int64, len(items))
    out[1:] = np.minimum(out[1:], np.minimum(lengths[1:], lengths[:-1]))
    return out


def front_code(items: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Sorted strings as shared lengths, own lengths and what each adds."""
    shared = neighbour_prefixes(items, LENGTH)
    own = np.fromiter(map(len, items), np.int64, len(items)) - shared
    rest = b"".join(x[s:] for x, s in zip(items, shared.tolist()))
    return shared.astype(np.uint8).tobytes(), own.astype(np.uint8).tobytes(), rest


def front_decode(shared: bytes, own: bytes, rest: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for s, n in zip(shared, own):
        last = last[:s] + rest[at : at + n]
        at += n
        out.append(last)
    return out


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, which share ``known`` bytes."""
    most = min(len(a), len(b))
    while known < most:
        x, y = a[known : known + 32], b[known : known + 32]
        if x != y:
            n = min(len(x), len(y))
            d = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
            return known + (n if not d else n - (d.bit_length() + 7) // 8)
        known += len(x)
    return most


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Loser tree over sorted runs (strings, common prefix with the one before).

    Gives (run, place) in order and each string's common prefix with the one before it. A node
    keeps the loser and the prefix that it shares with the winner that passed; the winner shares
    with the last output what its run says. So known prefixes are never compared again.
    """
    k = 1
    while k < max(1, len(runs)):
        k *= 2
    place, shared = [0] * k, [0] * k
    strings = [r[0] for r in runs] + [[] for _ in range(k - len(runs))]
    prefixes = [r[1] for r in runs] + [[] for _ in range(k - len(runs))]
    losers = [0] * k

    def beats(a: int, b: int) -> bool:
        """Whether run a's head comes first; the other's shared prefix is then with it."""
        x, y = strings[a], strings[b]
        if place[a] >= len(x):
            return False
        if place[b] >= len(y):
            return True
        if shared[a] != shared[b]:
            return shared[a] > shared[b]
        s, t = x[place[a]], y[place[b]]
        h = common(s, t, shared[a])
        first = (s[h:] , a) <= (t[h:], b)
        shared[b if first else a] = h
        return first

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = build(2 * node), build(2 * node + 1)
        if beats(a, b):
            losers[node] = b
            return a
        losers[node] = a
        return b

    order, out = [], []
    winner = build(1)
    while place[winner] < len(strings[winner]):
        at = place[winner]
        order.append((winner, at))
        out.append(shared[winner])
        place[winner] = at + 1
        if at + 1 < len(strings[winner]):
            shared[winner] = prefixes[winner][at + 1]
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                winner, losers[node] = losers[node], winner
            node //= 2
    if out:
        out[0] = 0
    return order, out


# --- verdict ----------------------------------------------------------------------------------


def repeated_windows(
    right_shared: np.ndarray, left: list[bytes], least: np.ndarray, most: np.ndarray, many: np.ndarray
) -> np.ndarray:
    """For blocks in suffix order: whether the window ``o`` bytes before the anchor is repeated, by
    block and ``o``. Windows of a block have ``o`` from ``least`` to ``most``."""
    n = len(left)
    order = np.array(sorted(range(n), key=left.__getitem__), dtype=np.int64)
    left_shared = neighbour_prefixes([left[i] for i in order.tolist()], SPAN)
    out = np.zeros((n, SPAN), dtype=bool)
    cluster = np.empty(n, dtype=np.int64)
    for o in range(SPAN):
        here = np.flatnonzero((least <= o) & (o <= most))
        if not len(here):
            continue
        cluster[order] = np.cumsum(left_shared < o) if o else 0
        key = np.cumsum(right_shared < LENGTH - o)[here] * (n + 1) + cluster[here]
        ranks = np.argsort(key, kind="stable")
        ranked = key[ranks]
        same = np.zeros(len(here), dtype=bool)
        twins = ranked[1:] == ranked[:-1]
        same[1:] |= twins
        same[:-1] |= twins
        out[here[ranks[same]], o] = True
        out[here[many[here]], o] = True
    return out


def _intervals(repeated: np.ndarray, most: np.ndarray) -> list[bytes]:
    """Per block: first and last repeated window of each stretch, counted from the first window."""
    out = []
    for row, d in zip(repeated, most.tolist()):
        windows = np.flatnonzero(row[d::-1]) if d + 1 < SPAN else np.flatnonzero(row[::-1])
        if not len(windows):
            out.append(b"")
            continue
        cuts = np.flatnonzero(np.diff(windows) > 1)
        starts = windows[np.concatenate([[0], cuts + 1])]
        lasts = windows[np.concatenate([cuts, [len(windows) - 1]])]
        out.append(np.stack([starts, lasts], axis=1).astype(np.uint8).tobytes())
    return out


_RUN = (
    "range int, grams binary, contents binary, many binary, least binary, most binary, "
    "shared binary, own binary, rest binary, left_own binary, lefts binary"
)


def _texts_with_blocks(batches):
    """(text, gram, content, many, first, windows - 1, anchor - first) of each block."""
    for b in batches:
        for text, rows in zip(binaries(b.column(0)), b.column(1).to_pylist()):
            for r in rows:
                span = r["span"]
                yield text, r["gram"], r["content"], r["n"] > 1, span >> 16, span >> 8 & 255, span & 255


def sorted_runs(texts: DataFrame, cuts: list[bytes]) -> DataFrame:
    """Front-coded runs of the blocks' suffixes, one row per run and range."""
    bounds = np.array([int.from_bytes(c.ljust(8, b"\0")[:8], "big") for c in cuts], dtype=np.uint64)

    def run(batches):
        held = []

        def rows():
            held.sort(key=lambda x: x[0])
            heads = np.array([int.from_bytes(x[0][:8], "big") for x in held], dtype=np.uint64)
            ranges = np.searchsorted(bounds, heads, side="right")
            for at in np.split(np.arange(len(held)), np.flatnonzero(np.diff(ranges)) + 1):
                part = [held[i] for i in at.tolist()]
                right, left, gram, content, many, least, most = zip(*part)
                yield (
                    int(ranges[at[0]]), np.array(gram).tobytes(), np.array(content).tobytes(),
                    bytes(many), bytes(least), bytes(most), *front_code(list(right)),
                    bytes(map(len, left)), b"".join(left),
                )

        def out():
            columns = list(zip(*rows()))
            kinds = [pa.int32(), *[pa.binary()] * 10]
            names = [f.split()[0] for f in _RUN.split(", ")]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

        for text, gram, content, many, first, windows, d in _texts_with_blocks(batches):
            a = first + d
            right, left = text[a : first + windows + LENGTH], text[first:a][::-1]
            held.append((right, left, gram, content, many, d - windows if d > windows else 0, d))
            if len(held) >= RUN_BLOCKS:
                yield out()
        if held:
            yield out()

    return texts.mapInArrow(run, _RUN)


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """Verdicts of the blocks of one range."""
    runs, sides = [], []
    for r in rows.itertuples():
        strings = front_decode(r.shared, r.own, r.rest)
        runs.append((strings, list(r.shared)))
        ends = np.cumsum(np.frombuffer(r.left_own, np.uint8).astype(np.int64)).tolist()
        sides.append([r.lefts[a:b] for a, b in zip([0, *ends], ends)])
    order, shared = merge_runs(runs)
    starts = np.cumsum([0, *[len(r[0]) for r in runs]])
    at = np.array([starts[r] + i for r, i in order], dtype=np.int64)

    def column(name, dtype):
        return np.concatenate([np.frombuffer(x, dtype) for x in rows[name]])[at]

    most = column("most", np.uint8).astype(np.int64)
    repeated = repeated_windows(
        np.array(shared, dtype=np.int64),
        [sides[r][i] for r, i in order],
        column("least", np.uint8).astype(np.int64),
        most,
        column("many", np.uint8) > 0,
    )
    out = pd.DataFrame(
        {
            "gram": column("grams", np.int64),
            "content": column("contents", np.int64),
            "repeats": _intervals(repeated, most),
        }
    )
    return out[out["repeats"].map(len) > 0]


def _cut_points(docs: DataFrame, ranges: int) -> list[bytes]:
    """Byte strings that cut the order of suffixes into ``ranges``, from a bounded sample."""
    if ranges <= 1:
        return []
    wanted, slots = 32 * ranges, 1 << 40
    n = docs.count()
    share = min(1.0, wanted / max(1, n))
    picked = docs.filter(F.pmod(F.xxhash64("id"), F.lit(slots)) < int(share * slots)).select(
        F.expr("substring(cast(text as binary), 1 + pmod(xxhash64(id, 5), greatest(1, octet_length(text))), 8)").alias("x")
    )
    sample = sorted(bytes(r[0]) for r in picked.collect() if r[0])  # about 32 a range
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []


def _hot_windows(texts: DataFrame) -> DataFrame:
    """Verdicts for blocks of k-grams with very many different blocks: windows counted by hash."""

    def run(batches):
        rows = []

        def out():
            columns = list(zip(*rows))
            rows.clear()
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["window", "gram", "content", "at", "n"],
            )

        for text, gram, content, many, first, windows, _ in _texts_with_blocks(batches):
            for i in range(windows + 1):
                piece = hashlib.blake2b(text[first + i : first + i + LENGTH], digest_size=16).digest()
                rows.append((piece, gram, content, i, 1 + many))
            if len(rows) >= 20_000:
                yield out()
        if rows:
            yield out()

    rows = texts.mapInArrow(run, "window binary, gram long, content long, at int, n int")
    often = rows.groupBy("window").agg(F.sum("n").alias("n")).filter("n > 1").select("window")
    found = rows.join(often, "window").groupBy("gram", "content").agg(
        F.array_sort(F.collect_list("at")).alias("at")
    )

    def stretches(batches):
        for b in batches:
            spans = [
                b"".join(bytes([i, i]) for i in at) for at in b.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(spans, pa.binary())],
                names=["gram", "content", "repeats"],
            )

    return found.mapInArrow(stretches, "gram long, content long, repeats binary")


def _removed(docs: DataFrame, hot: int = HOT, range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """(id, spans) of the rows of ``docs`` (id, text) that have repeated stretches."""
    blocks = repeated_blocks(docs.select("id", "text"))
    distinct = blocks.groupBy("gram", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "span")).alias("one")
    )
    distinct = stage(distinct.select("gram", "content", "n", "one.*"), "distinct_blocks")
    kinds = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"))
    hot_grams = kinds.filter(F.col("kinds") > hot).select("gram")
    any_hot = hot_grams.limit(1).count() > 0

    def texts(of: DataFrame) -> DataFrame:
        held = of.groupBy("id").agg(
            F.collect_list(F.struct("gram", "content", "n", "span")).alias("blocks")
        )
        return docs.select("id", "text").join(held, "id").select("text", "blocks")

    plain = distinct.join(hot_grams, "gram", "left_anti") if any_hot else distinct
    ranges = distinct.count() // range_blocks + 1
    runs = sorted_runs(texts(plain), _cut_points(docs, ranges))
    verdicts = runs.groupBy("range").applyInPandas(_merged, "gram long, content long, repeats binary")
    if any_hot:
        verdicts = verdicts.union(_hot_windows(texts(distinct.join(hot_grams, "gram"))))
    verdicts = stage(verdicts, "verdicts")
    spans = blocks.join(verdicts, ["gram", "content"]).groupBy("id").agg(
        F.collect_list(F.struct("span", "repeats")).alias("spans")
    )
    return spans


def stretches(spans) -> list[tuple[int, int]]:
    """Maximal removed runs [from, to) of a document."""
    found = []
    for s in spans or ():
        first = s["span"] >> 16
        r = s["repeats"]
        found += [(first + r[k], first + r[k + 1] + LENGTH) for k in range(0, len(r), 2)]
    found.sort()
    out: list[list[int]] = []
    for a, b in found:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def keep(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in runs:
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return b"".join(out)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    docs = numbered(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))

    def run(batches):
        for b in batches:
            rows = []
            for text, spans in zip(binaries(b.column(1)), b.column(2).to_pylist()):
                runs = stretches(spans)
                rows.append((
                    len(text), sum(b - a for a, b in runs), len(runs),
                    hashlib.sha256(keep(text, runs)).hexdigest(),
                ))
            columns = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    found = docs.join(_removed(docs.select("id", "text")), "id", "left")
    return found.select(F.col("doc_id").cast("long"), "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; characters cut in two go as a whole.

    ``n_chars``, if there is such a column, is counted anew. Null texts stay null.
    """
    columns, row = docs.columns, free_name(docs)
    spans_name = free_name(docs, "__spans")
    given = numbered(docs, row)
    found = _removed(given.select(F.col(row).alias("id"), F.coalesce("text", F.lit("")).alias("text")))
    kept = given.join(found.select(F.col("id").alias(row), F.col("spans").alias(spans_name)), row, "left")

    def run(batches):
        for b in batches:
            texts = []
            for null, text, spans in zip(
                b.column("text").is_null().to_pylist(),
                binaries(b.column("text")),
                b.column(spans_name).to_pylist(),
            ):
                texts.append(None if null else keep(text, stretches(spans)).decode("utf-8", "ignore"))
            out = [pa.array(texts, pa.string()) if n == "text" else b.column(n) for n in columns]
            yield pa.RecordBatch.from_arrays(out, names=columns)

    out = kept.select(*columns, spans_name).mapInArrow(run, docs.schema)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out
