"""Comparison of a registered query with its SQL on the shared tables."""

import glob
import os

import duckdb
import numpy as np

DATA = os.environ.get("LIFTWORKS_TESTDATA", "/root/testdata")


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return pdf.sort_values(list(pdf.columns), kind="stable", ignore_index=True)


def differences(spark_pdf, sql_pdf):
    """Empty string if equal, else what differs."""
    a, b = _sorted(spark_pdf), _sorted(sql_pdf)
    if list(a.columns) != list(b.columns):
        return f"columns {list(a.columns)} != {list(b.columns)}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    out = []
    for c in a.columns:
        x, y = a[c], b[c]
        if str(x.dtype) != str(y.dtype):
            out.append(f"{c}: type {x.dtype} != {y.dtype}")
        if x.dtype.kind == "f" and y.dtype.kind == "f":
            same = (x == y) | (x.isna() & y.isna())
        else:
            same = (x == y) | (x.isna() & y.isna())
        if not bool(np.all(same)):
            at = int(np.argmin(same.to_numpy()))
            out.append(f"{c}: {int((~same).sum())} differ, e.g. {x[at]!r} != {y[at]!r}")
    return "; ".join(out)
