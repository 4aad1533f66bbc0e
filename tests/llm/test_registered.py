"""Registered queries of the subpackage."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import DATA, connect, differences  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from liftworks.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = f"{DATA}/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()


def test_queries_equal_their_sql(spark):
    duck = connect(SF)
    for name, sql in ORACLES.items():
        if name in QUERIES:
            assert differences(QUERIES[name](spark, SF).toPandas(), duck.execute(sql).df()) == "", name


def test_learned_queries_are_repeatable(spark):
    first, second = (QUERIES["op7_ordinal"](spark, SF).toPandas() for _ in range(2))
    assert differences(first, second) == "" and len(first) == 200
