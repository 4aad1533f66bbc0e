"""Vector code compression: product codebooks by Lloyd rounds whose members stay with their owners.

Vectors become integers (``floor(scale * x)``) and are cut into equal parts; each position has a codebook
of entries, and a vector's code is the nearest entry of each part. All arithmetic is on integers, so
results don't depend on the order of adding.

Rounds. The parts are dealt once to owners by (position, entry, salt), where the salt splits an entry that
holds many parts, up to all of them. An owner keeps its members as packed rows in a table bucketed by its
key. In a round each owner adds up the members it holds (one row of sums), the new entries follow from
one small sum by (position, entry), and the owners compare their members with the new entries: members
that keep their entry are written where they are, only those that change it are shuffled, to their new
owner, who takes them in before it adds up again. Bucketed reads meet without an exchange.

The last assignment needs no owners: the codebooks have ``entries * dimensions`` numbers, so every task
encodes the vectors it reads, and errors are added up by label.

Rows whose vector is null, empty, or has null or non-finite components are dropped. Null ids come last
among the smallest; equal ids are ordered by their vectors; repeated rows count as often as they
come. Fewer vectors than entries give as many entries; an empty table gives no rows. Vectors of
different lengths, lengths that are no multiple of the parts, and components too large for exact sums
(see ``_shape``) raise. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from liftworks.sources import fresh_dir, release, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Members of an owner, about.
MEMBERS = 200_000
#: Bytes of members in a bucket, about.
BUCKET_BYTES = 64 << 20
#: Vectors whose parts a task packs together.
PACK = 1 << 16

_OWNER = ["position", "entry", "salt"]
_MEMBERS = "position int, entry int, salt int, members binary"


@dataclass(frozen=True)
class Shape:
    """What the vectors of a table are like."""

    rows: int
    width: int  # of a part
    kind: str  # numpy type that holds any component

    @property
    def salts(self) -> int:
        return max(1, math.ceil(self.rows / MEMBERS))


def usable(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that can be encoded."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.filter(v.isNotNull() & (F.size(v) > 0) & fine)
    return rows.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), v.alias("vector"))


def _shape(rows: DataFrame, parts: int, scale: int) -> Shape | None:
    size = F.size("vector")
    found = rows.agg(
        F.count(F.lit(1)), F.min(size), F.max(size), F.max(F.array_max("vector")), F.min(F.array_min("vector"))
    ).first()
    n, least, most, high, low = found
    if not n:
        return None
    if least != most or least % parts:
        raise ValueError(f"vectors must all have one length, a multiple of {parts}")
    peak = math.ceil(scale * max(abs(high), abs(low))) + 1
    if (2 * peak) ** 2 * least >= 2**53:
        raise ValueError("components are too large for exact sums")
    return Shape(n, least // parts, "<i2" if peak < 2**15 else "<i4")


def _integers(column, scale: int, dtype=np.int64) -> np.ndarray:
    """Vectors of an Arrow list column as rows of integers."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).astype(dtype).reshape(n, -1)


def nearest(part: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each row of ``part`` (ties to the lower) and its squared distance."""
    x, c = part.astype(np.float64), codebook.astype(np.float64)  # exact, see ``_shape``
    apart = (c * c).sum(axis=1)[None, :] - 2.0 * (x @ c.T)
    entry = apart.argmin(axis=1)
    return entry, ((x * x).sum(axis=1) + apart[np.arange(len(x)), entry]).astype(np.int64)


def _packed(position: int, entry: np.ndarray, salt: np.ndarray, part: np.ndarray, salts: int, kind: str):
    """Rows (position, entry, salt, members) of one position's parts."""
    owner = entry.astype(np.int64) * salts + salt
    order = np.argsort(owner, kind="stable")
    owner, part = owner[order], np.ascontiguousarray(part[order], dtype=kind)
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else owner
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(owner)]):
        yield position, int(owner[lo]) // salts, int(owner[lo]) % salts, part[lo:hi].tobytes()


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"members": pa.binary(), "moved": pa.bool_()}
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds.get(n, pa.int32())) for n, c in zip(names, columns)], names=names
    )


def dealt(rows: DataFrame, codebooks: np.ndarray, shape: Shape, scale: int) -> DataFrame:
    """Members by (position, entry, salt) under ``codebooks``."""
    parts, width = codebooks.shape[0], shape.width
    salts, kind = shape.salts, shape.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, held, size = 0, [], 0

        def out():
            nonlocal turn, held, size
            x = np.concatenate(held)
            salt = (np.arange(len(x)) + turn) % salts
            turn, held, size = (turn + len(x)) % salts, [], 0
            packed = []
            for p in range(parts):
                part = x[:, p * width : (p + 1) * width]
                packed += _packed(p, nearest(part, codebooks[p])[0], salt, part, salts, kind)
            return _batch(packed, ["position", "entry", "salt", "members"])

        for b in batches:
            if b.num_rows:
                held.append(_integers(b.column(0), scale))
                size += b.num_rows
            if size >= PACK:
                yield out()
        if held:
            yield out()

    return rows.select("vector").mapInArrow(run, _MEMBERS)


def _bucketed(df: DataFrame, buckets: int, label: str, *partitions: str) -> DataFrame:
    """``df`` written to the shared folder, bucketed by owner."""
    spark = df.sparkSession
    path, name = fresh_dir(spark, label), f"liftworks_{label}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(buckets, *_OWNER).option("path", path)
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)
    table = spark.table(name)
    table._named, table._staged_at = name, path
    return table


def _dropped(table: DataFrame | None) -> None:
    """Forget a bucketed table and delete its files."""
    if table is not None:
        table.sparkSession.sql(f"DROP TABLE {table._named}")
        release(table)


def owned_sums(stays: DataFrame | None, arrivals: DataFrame, width: int, kind: str) -> DataFrame:
    """One row (position, entry, n, sums) per owner, from the members it holds and those that came."""

    def add(held: pa.Table, came: pa.Table) -> pa.Table:
        first = held if held.num_rows else came
        total, n = np.zeros(width, dtype=np.int64), 0
        for table in (held, came):
            for chunk in table.column("members").to_pylist():
                part = np.frombuffer(chunk, dtype=kind).reshape(-1, width)
                total += part.sum(axis=0, dtype=np.int64)
                n += len(part)
        return pa.table(
            {
                "position": first.column("position")[:1],
                "entry": first.column("entry")[:1],
                "n": pa.array([n], pa.int64()),
                "sums": pa.array([total.tolist()], pa.list_(pa.int64())),
            }
        )

    schema = "position int, entry int, n bigint, sums array<bigint>"
    came = arrivals.select(*_OWNER, "members")
    if stays is None:
        return came.groupBy(*_OWNER).applyInArrow(lambda t: add(t.slice(0, 0), t), schema)
    held = stays.select(*_OWNER, "members")
    return held.groupBy(*_OWNER).cogroup(came.groupBy(*_OWNER)).applyInArrow(add, schema)


def updated(codebooks: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Entries moved to the floor of their members' means; entries without members stay."""
    totals = (
        sums.select("position", "entry", "n", F.posexplode("sums").alias("item", "total"))
        .groupBy("position", "entry", "item")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    out = codebooks.copy()
    for r in totals.collect():  # entries times dimensions at most
        out[r["position"], r["entry"], r["item"]] = r["total"] // r["n"]
    return out


def reassigned(members: DataFrame, codebooks: np.ndarray, shape: Shape) -> DataFrame:
    """Members under new ``codebooks``, in place: ``target`` is the entry, ``moved`` if it is another one."""
    width, salts, kind = shape.width, shape.salts, shape.kind
    names = ["position", "entry", "salt", "members", "target", "moved"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for position, entry, salt, blob in zip(*(b.column(k).to_pylist() for k in range(4))):
                part = np.frombuffer(blob, dtype=kind).reshape(-1, width)
                now = nearest(part, codebooks[position])[0]
                for _, target, s, some in _packed(position, now, np.full(len(now), salt), part, salts, kind):
                    rows.append((position, entry, s, some, target, target != entry))
            yield _batch(rows, names)

    return members.select(*_OWNER, "members").mapInArrow(run, _MEMBERS + ", target int, moved boolean")


def train(
    rows: DataFrame, codebooks: np.ndarray, shape: Shape, rounds: int = ROUNDS, scale: int = SCALE
) -> np.ndarray:
    """Codebooks after ``rounds`` of assigning and updating, starting from ``codebooks``."""
    if not rounds:
        return codebooks
    size = shape.rows * codebooks.shape[0] * shape.width * np.dtype(shape.kind).itemsize
    buckets = min(rows.sparkSession.sparkContext.defaultParallelism, 4) + size // BUCKET_BYTES
    first = dealt(rows, codebooks, shape, scale).repartition(buckets, *_OWNER)
    placed, stays, arrivals = None, None, _bucketed(first, buckets, "members")
    for k in range(rounds):
        codebooks = updated(codebooks, owned_sums(stays, arrivals, shape.width, shape.kind))
        if k + 1 < rounds:
            members = arrivals if stays is None else stays.select(*_OWNER, "members").union(arrivals)
            now = _bucketed(reassigned(members, codebooks, shape), buckets, "placed", "moved")
            moving = now.filter("moved").select("position", F.col("target").alias("entry"), "salt", "members")
            came = _bucketed(moving.repartition(buckets, *_OWNER), buckets, "arrivals")
            _dropped(placed)
            _dropped(arrivals)
            placed, stays, arrivals = now, now.filter("not moved"), came
    _dropped(placed)
    _dropped(arrivals)
    return codebooks


def starting_codebooks(rows: DataFrame, shape: Shape, parts: int, entries: int, scale: int) -> np.ndarray:
    """Parts of the vectors with the smallest ids, ascending."""
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * scale))
    order = [F.col("vec_id").asc_nulls_last(), whole.asc()]
    first = rows.orderBy(*order).limit(entries).select(whole.alias("whole")).collect()
    values = np.array([r["whole"] for r in first], dtype=np.int64)
    return np.ascontiguousarray(values.reshape(len(first), parts, shape.width).transpose(1, 0, 2))


def encode(rows: DataFrame, codebooks: np.ndarray, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error) of every vector: the code as two hex digits a part."""
    parts, width = codebooks.shape[0], codebooks.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            x = _integers(b.column(2), scale).reshape(n, parts * width) if n else np.zeros((0, parts * width))
            code, error = np.zeros((n, parts), dtype=np.uint8), np.zeros(n, dtype=np.int64)
            for p in range(parts):
                entry, apart = nearest(x[:, p * width : (p + 1) * width], codebooks[p])
                code[:, p] = entry
                error += apart
            text = code.tobytes().hex()
            hexed = [text[k : k + 2 * parts] for k in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(hexed, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    return rows.select("vec_id", "label", "vector").mapInArrow(run, schema)


def decode(codes: DataFrame, codebooks: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``codes`` with ``vector``, the middles of the integers its code stands for."""
    parts, _, width = codebooks.shape
    values = ((codebooks + 0.5) / scale).astype(np.float32)
    names = [f.name for f in codes.schema]
    at = names.index("code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = np.frombuffer(bytes.fromhex("".join(b.column(at).to_pylist())), np.uint8).reshape(-1, parts)
            whole = np.concatenate([values[p][code[:, p]] for p in range(parts)], axis=1)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (parts * width))
            vectors = pa.ListArray.from_arrays(ends, pa.array(whole.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, vectors], names=[*names, "vector"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema)
    return codes.mapInArrow(run, f"{fields}, vector array<float>")


def fit(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray | None]:
    """The usable rows of ``vectors`` and their codebooks (part, entry, item); None without rows."""
    if not 1 <= entries <= 256:
        raise ValueError("a code holds at most 256 entries a part")
    rows = usable(vectors, key, vector, label)
    shape = _shape(rows, parts, scale)
    if shape is None:
        return rows, None
    start = starting_codebooks(rows, shape, parts, entries, scale)
    return rows, train(rows, start, shape, rounds, scale)


def compress(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector."""
    rows, codebooks = fit(vectors, **options)
    scale = options.get("scale", SCALE)
    if codebooks is None:
        codebooks = np.zeros((PARTS, 1, 1), dtype=np.int64)
        digest = hashlib.sha256(b"").hexdigest()
        rows = rows.limit(0)
    else:
        digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    codes = stage(encode(rows, codebooks, scale), "codes")
    totals = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
