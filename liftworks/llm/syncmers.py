"""Operator 6: document fingerprints from closed syncmers, in DataFrame functions only.

A k-mer of a text's bytes is a closed syncmer if the least hash of its inner substrings (s-mers)
lies at its first or last position. Whether a k-mer is chosen depends on its own bytes alone, so
equal passages have equal anchors wherever they stand. ``anchors`` gives all of them by position.

A fingerprint keeps the ``SKETCH`` anchors of least s-mer hash, as a sorted list. Only positions
whose s-mer hash is low enough for the text's length are looked at; where that leaves too few
anchors, all positions are. Likeness is the share of anchors two texts have in common (Dice),
estimated from the least anchors of their union.

Null texts are empty. Empty texts have an empty fingerprint and are alike to each other only; other
texts without any syncmer have one anchor, the whole text. Documents follow each other by doc_id
(null first), then by the text's hash, and the last is followed by the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from liftworks.operators.ordered import split_ranges

INNER = 9  # bytes of an s-mer
WINDOW = 6  # s-mers in a k-mer
KMER = INNER + WINDOW - 1
SKETCH = 32
LOOKED_AT = 40  # expected positions looked at in a text; most give two anchors
ROWS_PER_RANGE = 8192


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once.

    A column of an inner projection would not do: Catalyst may put its expression in the place of
    each use, here once per position.
    """
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _hash(at: str) -> str:
    return f"xxhash64(substring(b, {at}, {INNER}))"


def _chosen(positions: str) -> str:
    """Array of (s-mer hash, k-mer hash, position) of the syncmers with an edge among positions."""
    # position i is the first s-mer of k-mer i and the last one of k-mer i - WINDOW + 1
    after = f"forall(sequence(i + 1, i + {WINDOW - 1}), j -> {_hash('j')} >= h)"
    before = f"forall(sequence(i - {WINDOW - 1}, i - 1), j -> {_hash('j')} >= h)"
    kmer = f"xxhash64(substring(b, {{}}, {KMER}))"
    here = f"named_struct('s', h, 'k', {kmer}, 'pos', {{}})"
    first = f"IF(i + {KMER - 1} <= n AND {after}, array({here.format('i', 'i')}), array())"
    start = f"i - {WINDOW - 1}"
    last = f"IF(i >= {WINDOW} AND {before}, array({here.format(start, start)}), array())"
    found = _let("h", _hash("i"), f"concat({first}, {last})")
    return f"flatten(transform({positions}, i -> {found}))"


_ALL = f"sequence(1, n - {INNER - 1})"


def anchors(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, pos, kmer) of every closed syncmer of every text; ``pos`` counts bytes from 0."""
    none = "CAST(array() AS ARRAY<STRUCT<s: BIGINT, k: BIGINT, pos: INT>>)"
    found = f"IF(n < {KMER}, {none}, {_chosen(_ALL)})"
    bound = _let("b", f"CAST(coalesce({text}, '') AS BINARY)", _let("n", "length(b)", found))
    rows = docs.select("doc_id", F.explode(F.expr(bound)).alias("a"))
    # a k-mer with its least s-mer at both edges is found twice
    return rows.select("doc_id", (F.col("a.pos") - 1).alias("pos"), F.col("a.k").alias("kmer")).distinct()


def sketch(text: str) -> Column:
    """The least anchors of a text that isn't null: an array of (s-mer hash, k-mer hash)."""
    few = float(LOOKED_AT)
    # the greatest hash of positions looked at, by the text's length
    limit = f"IF(n <= {few}, {2**63 - 1}L, CAST(-{2**63}D + {2**64}D * ({few}D / n) AS BIGINT))"
    low = f"filter({_ALL}, i -> {_hash('i')} <= top)"

    def least(source: str) -> str:
        pairs = f"transform({source}, a -> named_struct('s', a.s, 'k', a.k))"
        return f"slice(array_sort(array_distinct({pairs})), 1, {SKETCH})"

    more = f"IF(size(part) < {SKETCH} AND n > {few}, {least(_chosen(_ALL))}, part)"
    found = _let("part", least(_chosen(low)), more)
    none = "CAST(array() AS ARRAY<STRUCT<s: BIGINT, k: BIGINT>>)"
    found = f"IF(n < {KMER}, {none}, {_let('top', limit, found)})"
    whole = "array(named_struct('s', xxhash64(b), 'k', xxhash64(b, 1)))"
    out = _let("found", found, f"IF(size(found) = 0 AND n > 0, {whole}, found)")
    return F.expr(_let("b", f"CAST({text} AS BINARY)", _let("n", "length(b)", out)))


def likeness(a: str, b: str) -> Column:
    """Estimated share of anchors in common, 0 to 1."""
    union = f"slice(array_sort(array_union({a}, {b})), 1, {SKETCH})"
    both = f"size(array_intersect(array_intersect({union}, {a}), {b}))"
    jaccard = f"{both} / size({union})"
    return F.expr(
        f"CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1D "
        f"WHEN size({a}) = 0 OR size({b}) = 0 THEN 0D "
        f"ELSE 2 * ({jaccard}) / (1 + {jaccard}) END"
    )


def as_string(sketch: str) -> Column:
    """Anchors in order, sixteen hex digits of the k-mer hash each."""
    return F.expr(f"lower(array_join(transform({sketch}, a -> lpad(hex(a.k), 16, '0')), ''))")


def followed(docs: DataFrame, make=sketch, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``docs`` (doc_id, text) with their sketch (``make``) and the next document's text and sketch.

    Documents are cut into ranges of doc_id, rows that share one or have none by a hash of the text; only
    the first document of each range is looked up by another range.
    """
    order = {
        "__has": F.col("doc_id").isNotNull().cast("int"),  # rows without an id come first
        "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
        "__hash": F.xxhash64("text"),
    }
    keyed = docs.select("doc_id", "text").withColumns(order)
    ranges = split_ranges(keyed.select(*order), list(order), rows_per_range)
    plain = ranges.assign(keyed).drop(*order)
    placed = plain.withColumn("sketch", make("text"))
    key = F.struct("doc_id", F.xxhash64("text"))
    window = Window.partitionBy("__range").orderBy("doc_id", F.xxhash64("text"))
    led = placed.withColumn("next", F.lead(F.struct("text", "sketch")).over(window))
    # sketched after the choice: one document per range
    firsts = plain.groupBy("__range").agg(F.min_by("text", key).alias("text"))
    firsts = firsts.select("__range", F.struct("text", make("text").alias("sketch")).alias("first"))
    present = [r[0] for r in plain.select("__range").distinct().collect()]  # one row per range
    present.sort(key=lambda r: (r is not None, r))
    turns = [(r, present[(i + 1) % len(present)]) for i, r in enumerate(present)]
    turn = docs.sparkSession.createDataFrame(turns, "__range int, __next int")
    after = turn.join(firsts.withColumnRenamed("__range", "__next"), "__next").select("__range", "first")
    return led.join(after, "__range", "left").select(
        "doc_id", "text", "sketch", F.coalesce("next", "first").alias("next")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how alike they are."""
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = followed(whole).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
        F.substring(F.col("next.text"), F.lit(1), half),
    )
    pairs = pairs.select(
        "doc_id", "n_chars", edited.alias("edited"), "sketch", F.col("next.sketch").alias("next_sketch")
    )
    pairs = pairs.withColumn("edited_sketch", sketch("edited"))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_string("sketch").alias("fingerprint"),
        as_string("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"),
        likeness("sketch", "next_sketch").alias("near_next"),
    )
