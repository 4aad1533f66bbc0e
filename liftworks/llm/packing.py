"""Operator 3: packing into optimal length buckets.

Lengths are words plus an end token. Documents longer than ``max_length`` are cut into sequences of
at most that length; all of them are packed. One global histogram of sequence lengths (at most
``max_length`` rows) feeds a dynamic program that chooses the ``buckets`` boundaries of least total
padding. Inside a bucket, sequences form batches of at most ``budget`` padded tokens.

Places in a bucket are counted in two steps: per (bucket, lot), where a lot is a hash of the
document, and over the lots' totals. So no task holds a bucket.

Null and empty texts are one sequence of the end token. Repeated rows are packed each, null ids
too; ties in the program go to the smaller boundary. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

MAX_LENGTH = 2048
BUCKETS = 12
BUDGET = 65_536
LOT_ROWS = 20_000

#: A word: a run of characters other than space and 0x09-0x0D.
WORD = r"[^\\x20\\x09-\\x0D]+"


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Bucket lengths of least total padding: each sequence is padded to the next boundary.

    cost[k][j] is the least padding of the j shortest lengths in k buckets. The last bucket of j
    lengths starts at or after that of j - 1 lengths, so each row is filled by divide and conquer.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    m = len(lengths)
    if not m:
        return []
    n = np.array([histogram[i] for i in lengths.tolist()], dtype=np.int64)
    count = np.concatenate([[0], np.cumsum(n)])
    tokens = np.concatenate([[0], np.cumsum(n * lengths)])
    infinite = np.iinfo(np.int64).max // 4
    cost = np.full(m + 1, infinite, dtype=np.int64)
    cost[0] = 0
    choice = []
    for _ in range(min(buckets, m)):
        row = np.full(m + 1, infinite, dtype=np.int64)
        row[0] = 0
        best = np.zeros(m + 1, dtype=np.int64)
        work = [(1, m, 0, m - 1)]
        while work:
            low, high, left, right = work.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(left, min(right, j - 1) + 1)
            padded = cost[i] + (count[j] - count[i]) * lengths[j - 1] - (tokens[j] - tokens[i])
            at = int(np.argmin(padded))
            row[j], best[j] = padded[at], i[at]
            work += [(low, j - 1, left, int(i[at])), (j + 1, high, int(i[at]), right)]
        choice.append(best)
        cost = row
    out, j = [], m
    for best in reversed(choice):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(best[j])
    return sorted(out)


def sequences(docs: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """(doc_id, piece, length): every document as sequences of at most ``max_length`` tokens."""
    n = F.expr(f"regexp_count(coalesce(text, ''), '{WORD}')").cast("long") + 1
    cut = docs.select("doc_id", n.alias("n"))
    last = F.ceil(F.col("n") / max_length) - 1
    return cut.select(
        "doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece")
    ).select(
        "doc_id",
        F.col("piece").cast("int"),
        F.least(F.lit(max_length), F.col("n") - F.col("piece") * max_length).cast("int").alias("length"),
    )


def pack(
    docs: DataFrame,
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    lot_rows: int = LOT_ROWS,
) -> DataFrame:
    """(doc_id, piece, length, bucket_length, batch, slot) of every sequence.

    ``batch`` counts the batches of a bucket from 0, ``slot`` the sequences of a batch.
    """
    if budget < max_length:
        raise ValueError("the budget must hold one sequence of max_length")
    rows = sequences(docs, max_length)
    counts = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # max_length rows
    histogram = {r["length"]: r["n"] for r in counts}
    edges = boundaries(histogram, buckets) or [max_length]
    lots = sum(histogram.values()) // lot_rows + 1
    bucket = F.lit(edges[-1])
    for edge in reversed(edges[:-1]):
        bucket = F.when(F.col("length") <= edge, edge).otherwise(bucket)
    placed = rows.withColumns(
        {"bucket_length": bucket, "lot": F.pmod(F.xxhash64("doc_id", "piece"), F.lit(lots))}
    )
    sizes = placed.groupBy("bucket_length", "lot").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket_length").orderBy("lot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        "bucket_length", "lot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("bucket_length", "lot").orderBy("doc_id", "piece")
    at = F.col("start") + F.row_number().over(inside) - 1
    each = F.floor(F.lit(budget) / F.col("bucket_length")).cast("long")
    return (
        placed.join(starts, ["bucket_length", "lot"])
        .withColumn("__at", at)
        .select(
            "doc_id",
            "piece",
            "length",
            F.col("bucket_length").cast("int"),
            F.floor(F.col("__at") / each).cast("long").alias("batch"),
            (F.col("__at") % each).cast("int").alias("slot"),
        )
    )
