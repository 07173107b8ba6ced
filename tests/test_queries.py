"""Every query with SQL against DuckDB on the smallest tables."""

import decimal
import math

import numpy as np
import pandas as pd
import pytest

from curlew import queries

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (np.ndarray, list, tuple)):
        return str([plain(x) for x in v])
    if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (float, np.floating, decimal.Decimal)):
        return f"{float(v):.9g}"
    return str(v)


def rows(df):
    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    got, wanted = queries.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got) == rows(wanted)


@pytest.mark.parametrize("files", [1, 2])
def test_lines_of_one_number_and_part_keep_the_tables_order(spark, tmp_path, files):
    lines = pd.DataFrame([(o, 1, 7, s) for o in range(40) for s in (90 - o, 50, 8 + 2 * o)], columns=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    path = tmp_path / "lineitem.parquet"
    if files == 1:
        lines.to_parquet(path)
    else:
        path.mkdir()
        for i in range(files):
            lines[i * 61 : (i + 1) * 61 if i + 1 < files else None].to_parquet(path / f"{i}.parquet")
    con = duckdb.connect()
    con.execute("SET threads = 1")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{path}{'/*.parquet' * (files > 1)}')")
    got = queries.target_refs_visible(spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(con.execute(queries.SQL["target_refs_visible"]).df())
    assert set(got[got.l_orderkey == 0].needed) == {"n7,n90"}


def test_capability_cover_meets_the_minimum(spark, sf_dir):
    chosen = [r["grp"] for r in queries.capability_cover(spark, sf_dir).collect()]
    e = queries.table(spark, sf_dir, "events").toPandas()
    inside = e[("u" + e.user_id.astype(str)).isin(chosen)]
    assert len(set(chosen)) == len(chosen) and (inside.event_type.value_counts() >= 20).all() and set(inside.event_type) == set(e.event_type)


def test_coverage_fold_equals_a_plain_fold(spark, sf_dir):
    import json

    from curlew.streaming.coverage import observe_once

    got = {r["session_id"]: r for r in queries.coverage_fold(spark, sf_dir).collect()}
    for user, part in queries.table(spark, sf_dir, "events").toPandas().sort_values("event_id").groupby("user_id"):
        state = (1.0, 0.0, False, False, 0, 0, 0)
        for r in part.itertuples():
            k, cents = json.loads(r.props)["k"], int(r.value * 100)
            s = dict(coverage_requested=k % 7, coverage_missing=k % 5, page_has_more=k % 2 == 0, page_returned=cents % 9, page_total=cents % 13, frontier_size=k % 4, conflicts=int(k % 31 == 0),
                     confidence_is_unknown=r.event_type == "error", answer_is_null=r.event_type == "view", unvisited_links=cents % 3, total_links=cents % 4)
            state = observe_once(state, s, cents % 2)
        g = got[user]
        assert (round(g["deviation"], 9), round(g["dim_gap"], 9), g["saturated"], g["conflict_blocking"], g["stall_streak"], g["steps"]) == (round(state[0], 9), round(state[1], 9), state[2], state[3], state[4], state[6])


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
