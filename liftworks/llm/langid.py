"""Language identification by the nearest of several centroids per language.

A text is its byte n-grams of orders 2 to 4 (ASCII letters in lower case, UTF-8 bytes of other letters as
they are, all else one blank), hashed to ``DIM`` buckets, weighted ``(1 + log tf) * idf`` and scaled to
length one. Document frequencies are counted over all training texts. Each language's training vectors
are clustered by spherical k-means into at most ``CLUSTERS`` centroids, on a sample of about
``PER_LANG`` different texts of the language (the bound of the fit's memory: one group of
``PER_LANG * DIM`` numbers per language). A text gets the language of the centroid of largest cosine, ties
to the language that sorts first.

Rejection by distance: a centroid remembers the cosine that all but ``OUTLIERS`` of its members reach. A
text that is farther from its nearest centroid than that is marked ``rejected``: it is unlike what was
learned, so its language is the nearest one only. Texts that are null or have no letter (Unicode) are
``und`` with score 0 and are rejected; so are all texts if nothing could be learned.

Centroids go to all tasks: ``languages * CLUSTERS * DIM`` floats, 64 KB each, which is why over
``MAX_LANGS`` languages raise. Fits and predictions read each row by itself, so null and repeated ids and
groups of copies do no harm: copies are one text of the sample. Rows with a null ``lang`` or text teach
nothing. Only the named columns are read.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from liftworks.llm.text import DOC_ID, TEXT, binaries

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 14
DIM = 1 << BITS
ORDERS = (2, 3, 4)
CLUSTERS = 4
PER_LANG = 1000
STEPS = 12
OUTLIERS = 0.005
MAX_LANGS = 300
UNKNOWN = "und"
#: Bytes of a text whose n-grams are held at once.
STRETCH = 1 << 20

_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode(errors="replace")))


def gram_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a text and how often each occurs."""
    flat = b" " + b" ".join(text.translate(_LETTERS).split()) + b" "
    total = np.zeros(DIM, dtype=np.int64)
    most = max(ORDERS)
    for at in range(0, len(flat), STRETCH):
        b = np.frombuffer(flat[at : at + STRETCH + most - 1], dtype=np.uint8).astype(np.uint32)
        here = min(STRETCH, len(flat) - at)
        for order in ORDERS:
            n = min(here, len(b) - order + 1)
            if n <= 0:
                continue
            code = np.full(n, order, dtype=np.uint32)
            for k in range(order):
                code = code * np.uint32(0x01000193) + b[k : k + n]
            code = (code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1)
            total += np.bincount(code >> np.uint32(32 - BITS), minlength=DIM)
    bucket = np.flatnonzero(total)
    return bucket, total[bucket]


def vector(text: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse unit vector of a text; empty without n-grams."""
    bucket, n = gram_counts(text)
    weight = (1.0 + np.log(n)) * idf[bucket]
    return bucket, (weight / max(np.sqrt((weight * weight).sum()), 1e-300)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Centroids as columns of ``weights``; ``langs`` and ``least`` (cosine) go with them."""

    idf: np.ndarray
    langs: tuple[str, ...]
    weights: np.ndarray
    least: np.ndarray


def clusters(x: np.ndarray, k: int, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of unit rows: centroids, and the cosine that most members reach.

    Starts from the row nearest to the mean, then the rows farthest from all starts; everything is decided
    by the rows' order, so a fit repeats itself.
    """

    def unit(v):
        return v / np.maximum(np.sqrt((v * v).sum(axis=-1, keepdims=True)), 1e-30)

    first = int((x @ unit(x.mean(axis=0))).argmax())
    starts, near = [first], x @ x[first]
    while len(starts) < min(k, len(x)):
        nxt = int(near.argmin())
        if near[nxt] > 0.999:
            break
        starts.append(nxt)
        near = np.maximum(near, x @ x[nxt])
    centers, before = x[starts], None
    for _ in range(steps):
        own = (x @ centers.T).argmax(axis=1)
        if before is not None and (own == before).all():
            break
        before = own
        centers = np.stack(
            [unit(x[own == c].mean(axis=0)) if (own == c).any() else centers[c] for c in range(len(centers))]
        )
    like = x @ centers.T
    own = like.argmax(axis=1)
    used = [c for c in range(len(centers)) if (own == c).any()]
    least = [float(np.quantile(like[own == c, c], OUTLIERS)) for c in used]
    return centers[used], np.array(least)


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """In how many of ``texts`` (text) each bucket occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIM, dtype=np.int64)
        for b in batches:
            for text in binaries(b.column(0)):
                total[gram_counts(text)[0]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(DIM, dtype=np.int64)
    counted = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in counted.collect():  # DIM rows at most
        out[r["bucket"]] = r["n"]
    return out


def fit(docs: DataFrame, text: str = TEXT, lang: str = "lang") -> Model | None:
    """Centroids of the rows with a language and a text; None if there are none."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null")
    sizes = {
        r["lang"]: r["n"]
        for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGS + 1).collect()
    }
    if not sizes:
        return None
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"over {MAX_LANGS} languages")
    seen = document_frequencies(rows.select("text"))
    idf = (np.log((1 + sum(sizes.values())) / (1 + seen)) + 1).astype(np.float32)
    # a text is in or out by its own hash, so copies are one
    share = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, PER_LANG / n))])
    mark = F.xxhash64("text", F.lit(12))
    drawn = rows.withColumn("mark", mark).filter(
        F.pmod("mark", F.lit(1_000_000)) < F.lit(1_000_000) * share[F.col("lang")]
    )
    drawn = drawn.groupBy("lang", "mark").agg(F.min("text").alias("text"))

    def cluster(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("mark").to_numpy(), kind="stable")
        texts = binaries(table.column("text").combine_chunks().take(pa.array(order)))
        x = np.zeros((len(texts), DIM), dtype=np.float32)
        for i, t in enumerate(texts):
            bucket, weight = vector(t, idf)
            x[i, bucket] = weight
        x = x[(x * x).sum(axis=1) > 0]
        if not len(x):
            return pa.table({"lang": pa.array([], pa.string()), "cluster": pa.array([], pa.int32()),
                             "least": pa.array([], pa.float64()), "center": pa.array([], pa.binary())})
        centers, least = clusters(x, CLUSTERS)
        return pa.table({
            "lang": pa.array([table.column("lang")[0].as_py()] * len(centers), pa.string()),
            "cluster": pa.array(range(len(centers)), pa.int32()),
            "least": pa.array(least, pa.float64()),
            "center": pa.array([c.astype("<f4").tobytes() for c in centers], pa.binary()),
        })

    found = drawn.groupBy("lang").applyInArrow(cluster, "lang string, cluster int, least double, center binary")
    centers = sorted(found.collect(), key=lambda r: (r["lang"], r["cluster"]))  # MAX_LANGS * CLUSTERS at most
    if not centers:
        return None
    weights = np.stack([np.frombuffer(r["center"], "<f4") for r in centers], axis=1)
    return Model(
        idf, tuple(r["lang"] for r in centers), np.ascontiguousarray(weights), np.array([r["least"] for r in centers])
    )


def predict(model: Model | None, rows: DataFrame, text: str = TEXT) -> DataFrame:
    """``rows`` without ``text``, with ``lang_pred``, ``score`` (the cosine) and ``rejected``."""
    kept = [c for c in rows.columns if c != text]
    names = [*kept, "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores, out = [], np.zeros(b.num_rows), []
            for i, t in enumerate(binaries(b.column(len(kept)))):
                best = None
                if model is not None and has_letter(t):
                    bucket, weight = vector(t, model.idf)
                    like = weight @ model.weights[bucket]
                    best = int(like.argmax())
                    scores[i] = min(max(float(like[best]), 0.0), 1.0)
                langs.append(UNKNOWN if best is None else model.langs[best])
                out.append(best is None or scores[i] < model.least[best])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(kept)], pa.array(langs, pa.string()), pa.array(scores), pa.array(out, pa.bool_())],
                names=names,
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text]
    schema = ", ".join([*fields, "lang_pred string", "score double", "rejected boolean"])
    return rows.select(*kept, text).mapInArrow(run, schema)


def held_out(doc_id: str = DOC_ID, parts: int = 5) -> Column:
    """Whether a document is kept from the fit; null without an id."""
    return F.crc32(F.col(doc_id).cast("string")) % parts == 0


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every document, learning from those not held out.
    Rows without an id are neither learned from nor held out."""
    model = fit(docs.filter(~held_out()))
    rows = docs.select(DOC_ID, F.coalesce(held_out(), F.lit(False)).alias("held_out"), TEXT)
    return predict(model, rows)
