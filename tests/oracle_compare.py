"""Compare a Spark query with its DuckDB oracle: names, types and row multiset."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import os

import duckdb
from pyspark.sql import types as T

VIEW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in VIEW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    return con


def spark_type_name(t: T.DataType) -> str:
    if isinstance(t, T.IntegerType):
        return "INTEGER"
    if isinstance(t, T.LongType):
        return "BIGINT"
    if isinstance(t, T.StringType):
        return "VARCHAR"
    if isinstance(t, T.DoubleType):
        return "DOUBLE"
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    if isinstance(t, T.TimestampNTZType):
        return "TIMESTAMP"
    if isinstance(t, T.BooleanType):
        return "BOOLEAN"
    return t.simpleString().upper()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v.normalize() if v == v else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def compare(spark_df, con, sql: str) -> dict:
    s_cols = [f.name for f in spark_df.schema.fields]
    s_types = [spark_type_name(f.dataType) for f in spark_df.schema.fields]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = [str(t) for t in rel.types]
    s_rows = spark_df.collect()
    d_rows = rel.fetchall()
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    result = {
        "names_match": sorted(s_cols) == sorted(d_cols),
        "types_match": False,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "values_match": False,
    }
    if not result["names_match"]:
        result["detail"] = f"spark {s_cols} vs oracle {d_cols}"
        return result
    result["types_match"] = all(s_types[i] == d_types[d_index[s_cols[i]]] for i in order)
    if not result["types_match"]:
        result["detail"] = str([(s_cols[i], s_types[i], d_types[d_index[s_cols[i]]])
                                for i in order if s_types[i] != d_types[d_index[s_cols[i]]]])
    s_bag = collections.Counter(tuple(_norm(r[i]) for i in order) for r in s_rows)
    d_bag = collections.Counter(tuple(_norm(r[d_index[s_cols[i]]]) for i in order)
                                for r in d_rows)
    result["values_match"] = s_bag == d_bag
    if not result["values_match"]:
        only_s = list((s_bag - d_bag).items())[:3]
        only_d = list((d_bag - s_bag).items())[:3]
        result["detail"] = (result.get("detail", "") +
                            f" cols={[s_cols[i] for i in order]} only_spark={only_s} "
                            f"only_oracle={only_d}")
    return result
