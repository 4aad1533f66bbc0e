"""Encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftworks.functions import binary_map, one_hot, remap_level
from liftworks.operators import condition as con
from liftworks.operators import encode as enc
from liftworks.operators import profiles
from liftworks.plans import bindings as b
from liftworks.plans.registry.core import FEATURES_SQL, query, r6, tidy, with_views

# Categories of the text features in the shared tables.
_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_STATUSES = ("F", "O", "P")
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

_KEYS = ("o_orderkey", "fold")


def _binary_sql(level: str, high: str) -> str:
    return (
        f"CAST(CASE WHEN {level} IS NULL THEN NULL WHEN {level} IN ({high}) THEN 1 ELSE 0 END AS DOUBLE)"
    )


def _one_hot_sql(column: str, categories) -> str:
    return ", ".join(
        f"CAST(coalesce({column}, 'nan') = '{c}' AS DOUBLE) AS \"{column}__{c}\"" for c in categories
    )


_REMAPPED = "CASE WHEN lvl_b = 2 THEN 4 ELSE lvl_b END"
_TEXT_SQL = ", ".join(
    [
        _one_hot_sql("c_mktsegment", _SEGMENTS),
        _one_hot_sql("o_orderpriority", _PRIORITIES),
        _one_hot_sql("o_orderstatus", _STATUSES),
    ]
)
_CONT_SQL = r6("CAST(cont AS FLOAT)")


@query(
    "binary_map",
    with_views(FEATURES_SQL)
    + f"""
SELECT o_orderkey, {_binary_sql('lvl_a', '3, 4, 5')} AS a_012, {_binary_sql('lvl_b', '4, 5')} AS b_0123
FROM features""",
)
def binary_map_query(spark, sf_dir):
    return tidy(
        b.features(spark, sf_dir).select(
            "o_orderkey",
            binary_map(F.col("lvl_a"), *enc.LOW_0_2).alias("a_012"),
            binary_map(F.col("lvl_b"), *enc.LOW_0_3).alias("b_0123"),
        )
    )


@query(
    "remap_2to4",
    with_views(FEATURES_SQL)
    + f" SELECT o_orderkey, CAST({_REMAPPED} AS DOUBLE) AS lvl_b FROM features",
)
def remap_2to4(spark, sf_dir):
    df = b.features(spark, sf_dir)
    return tidy(df.select("o_orderkey", remap_level(F.col("lvl_b"), 2, 4).alias("lvl_b")))


_NUMERIC = ("lvl_a", "lvl_b", "flag", "cont", "dec")


def _numeric_features(spark, sf_dir):
    df = con.bool_to_int(b.features(spark, sf_dir))
    return df.withColumn("dec", F.col("lvl_a") / 2.0)


@query(
    "detect_0_5",
    with_views(FEATURES_SQL)
    + " UNION ALL ".join(
        f"""
SELECT '{n}' AS field, count(DISTINCT {e}) <= 7 AND min({e}) >= 0 AND max({e}) <= 5 AS is_ordinal
FROM features"""
        for n, e in {
            "lvl_a": "lvl_a", "lvl_b": "lvl_b", "flag": "CAST(flag AS INTEGER)", "cont": "cont",
            "dec": "lvl_a / 2.0",
        }.items()
    ),
)
def detect_0_5(spark, sf_dir):
    return enc.detect_ordinal(_numeric_features(spark, sf_dir), _NUMERIC)


_TEXTS = ("c_mktsegment", "o_orderpriority", "o_orderstatus", "c_name")


@query(
    "cardinality_guard",
    with_views(FEATURES_SQL)
    + " UNION ALL ".join(
        f"""
SELECT '{c}' AS field, count(DISTINCT {c}) AS n_unique, count(DISTINCT {c}) <= 100 AS safe FROM features"""
        for c in _TEXTS
    ),
)
def cardinality_guard(spark, sf_dir):
    return enc.cardinality(b.features(spark, sf_dir), _TEXTS)


@query(
    "guard_report",
    with_views(FEATURES_SQL)
    + " UNION ALL ".join(
        f"""
SELECT '{c}' AS field, least(count(DISTINCT {c}), 101) AS n_unique,
       count(DISTINCT {c}) <= 100 AS exact, true AS near FROM features"""
        for c in _TEXTS
    ),
)
def guard_report(spark, sf_dir):
    """Exact counts up to the guard; above it, whether the estimate lies within four standard errors."""
    df = b.features(spark, sf_dir)
    report = enc.guard_report(df, _TEXTS).join(
        enc.cardinality(df, _TEXTS).select("field", F.col("n_unique").alias("true_count")), "field"
    )
    error = 4 * 1.04 / 2 ** (profiles.BITS / 2)
    near = F.abs(F.col("n_unique") - F.col("true_count")) <= F.when(F.col("exact"), 0.0).otherwise(error * F.col("true_count"))
    count = F.when(F.col("exact"), F.col("n_unique")).otherwise(F.lit(101).cast("long"))
    return report.select("field", count.alias("n_unique"), "exact", near.alias("near"))


@query(
    "one_hot",
    with_views(FEATURES_SQL)
    + f" SELECT o_orderkey, {_one_hot_sql('o_orderpriority', _PRIORITIES)} FROM features",
)
def one_hot_query(spark, sf_dir):
    df = b.features(spark, sf_dir)
    found = enc.fit_categories(df, ["o_orderpriority"])
    columns = one_hot(F.col("o_orderpriority"), "o_orderpriority", found["o_orderpriority"])
    return tidy(df.select("o_orderkey", *columns))


_CODES_SQL = """
priorities AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code
               FROM (SELECT DISTINCT o_orderpriority FROM features WHERE fold <= 5)),
names AS (SELECT c_name AS v, row_number() OVER (ORDER BY c_name) - 1 AS code
          FROM (SELECT DISTINCT c_name FROM features WHERE fold <= 5))"""


@query(
    "label_codes",
    with_views(FEATURES_SQL, _CODES_SQL)
    + """
SELECT o_orderkey, CAST(coalesce(p.code, -1) AS DOUBLE) AS o_orderpriority,
       CAST(coalesce(n.code, -1) AS DOUBLE) AS c_name
FROM features LEFT JOIN priorities p ON o_orderpriority = p.v LEFT JOIN names n ON c_name = n.v""",
)
def label_codes(spark, sf_dir):
    """Codes fitted on the training folds: few categories inline, many by join."""
    df = b.features(spark, sf_dir).select(*_KEYS, "o_orderpriority", "c_name")
    state = enc.fit_encoder(
        df.filter(F.col("fold") <= 5), "mapped", {"o_orderpriority": "ordered"}, exclude=_KEYS
    )
    return tidy(state.transform(df, keep=["o_orderkey"]))


def _encoded(spark, sf_dir, scheme, mapping=None, include=None):
    df = con.bool_to_int(b.features(spark, sf_dir))
    train = df.filter(F.col("fold") <= 5)
    state = enc.fit_encoder(train, scheme, mapping, include=include, exclude=_KEYS, on_wide="drop")
    return tidy(state.transform(df, keep=["o_orderkey"]))


def _encode_sql(levels: str) -> str:
    return (
        with_views(FEATURES_SQL)
        + f" SELECT o_orderkey, {levels}, {_CONT_SQL} AS cont, {_TEXT_SQL} FROM features"
    )


@query(
    "encode_type1",
    _encode_sql(
        "CAST(lvl_a AS DOUBLE) AS lvl_a, CAST(lvl_b AS DOUBLE) AS lvl_b, CAST(flag AS DOUBLE) AS flag"
    ),
)
def encode_type1(spark, sf_dir):
    return _encoded(spark, sf_dir, "ordinal")


@query(
    "encode_type2",
    _encode_sql(
        f"{_binary_sql('lvl_a', '3, 4, 5')} AS lvl_a, {_binary_sql('lvl_b', '3, 4, 5')} AS lvl_b, "
        "0.0::DOUBLE AS flag"
    ),
)
def encode_type2(spark, sf_dir):
    return _encoded(spark, sf_dir, "binary")


_MAPPING = {
    "lvl_a": "binary_lo_high",
    "lvl_b": "ohe_map2to4",
    "flag": "ordered",
    "cont": "drop",
    "c_mktsegment": "group_ohe",
    "o_orderpriority": "not_specified",
    "o_orderstatus": "ohe",
    "c_name": "ohe",
}


@query(
    "encode_type3",
    with_views(FEATURES_SQL, _CODES_SQL)
    + f"""
SELECT o_orderkey, {_binary_sql('lvl_a', '4, 5')} AS lvl_a,
       {', '.join(f'''CAST(coalesce(CAST({_REMAPPED} AS VARCHAR) || '.0', 'nan') = '{c}' AS DOUBLE) AS "lvl_b__{c}"'''
                  for c in ('0.0', '1.0', '3.0', '4.0', 'nan'))},
       CAST(flag AS DOUBLE) AS flag,
       {_one_hot_sql('c_mktsegment', _SEGMENTS)}, CAST(coalesce(p.code, -1) AS DOUBLE) AS o_orderpriority,
       {_one_hot_sql('o_orderstatus', _STATUSES)}
FROM features LEFT JOIN priorities p ON o_orderpriority = p.v""",
)
def encode_type3(spark, sf_dir):
    return _encoded(spark, sf_dir, "mapped", _MAPPING)


@query(
    "encode_type3_levels",
    with_views(FEATURES_SQL)
    + f"""
SELECT o_orderkey, {_binary_sql('lvl_a', '3, 4, 5')} AS lvl_a, CAST({_REMAPPED} AS DOUBLE) AS lvl_b
FROM features""",
)
def encode_type3_levels(spark, sf_dir):
    """Remaining strategies, with a whitelist on the encoded names."""
    mapping = {"lvl_a": "binary_low_hi", "lvl_b": "h_map2to4", "c_name": "drop"}
    return _encoded(spark, sf_dir, "mapped", mapping, include=["lvl_a", "lvl_b"])


@query(
    "encode_type4",
    _encode_sql(
        f"{_binary_sql('lvl_a', '3, 5')} AS lvl_a, {_binary_sql('lvl_b', '3, 5')} AS lvl_b, "
        "0.0::DOUBLE AS flag"
    ),
)
def encode_type4(spark, sf_dir):
    return _encoded(spark, sf_dir, "custom")


@query(
    "encode_unseen",
    with_views(FEATURES_SQL)
    + f" SELECT o_orderkey, {_one_hot_sql('o_orderstatus', ('F', 'O'))} FROM features",
)
def encode_unseen(spark, sf_dir):
    """Fitted without pending orders: their status encodes to all zeros."""
    df = b.features(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    train = df.filter(F.col("o_orderstatus") != "P")
    state = enc.fit_encoder(train, "ordinal", exclude=["o_orderkey"], on_wide="drop")
    return tidy(state.transform(df, keep=["o_orderkey"]))
