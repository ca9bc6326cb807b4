"""What the steps write and shuffle: plans and results on rows of their own."""

from __future__ import annotations

import datetime as dt
import math
from types import SimpleNamespace

import pytest

from patronage.operators import nearest, staging
from patronage.plans import edw, enrich as en
from patronage.queries import enrich as queries


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tables_out_of_large_ones_are_written_where_their_rows_lie(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    source, plans, written = spark.read.parquet(f"{tmp_path}/t"), [], staging._written
    monkeypatch.setattr(staging, "_written", lambda df, name: plans.append(plan(df)) or written(df, name))
    assert staging.stage_table(source.selectExpr("id + 1 as id"), "small-source", [source]).count() == 1000
    monkeypatch.setattr(staging, "MANY_TASKS", 0)
    assert staging.stage_table(source.selectExpr("id + 1 as id"), "large-source", [source]).count() == 1000
    assert staging.stage_table(source, "unknown-source").count() == 1000
    assert ["Rebalance" in p for p in plans] == [True, False, True]


def test_dedup_transactions_drop_other_members_before_the_distinct(spark):
    day = dt.date(2001, 5, 1)
    lines = spark.createDataFrame([(1, 10, day, 5, "r", "n"), (1, 10, day, 5, "r", "n"), (2, 11, day, 5, "r", "n"), (None, 12, day, 5, "r", "n")],
                                  "member_key bigint, trxn_id bigint, trxn_date date, store_key bigint, register_nbr string, trxn_nbr string")
    history = spark.createDataFrame([(7, 1, False, day), (8, 1, False, day), (9, 2, True, day)],
                                    "old_member_key bigint, new_member_key bigint, is_invalid boolean, last_updated_date date")
    stores = spark.createDataFrame([(5, 105)], "store_key bigint, store_id bigint")
    orders = spark.createDataFrame([(10, "X10", day)], "trxn_id bigint, exp_order_id string, ingest_date date")
    out = edw.dedup_transactions(lines, history, stores, orders, "2001-03-01", "2001-08-01")
    assert [(r.member_key, r.store_id, r.exp_order_id) for r in out.collect()] == [(1, 105, "X10")]
    # the plan is printed from the top: both distincts stand above the join to the changed members
    text = plan(out)
    assert text.count("Aggregate [") == 2 and text.rindex("Aggregate [") < text.index("Join Inner")


def test_last_purchase_reads_the_lines_once(spark):
    d = dt.date
    lines = spark.createDataFrame([
        (1, d(2001, 1, 1), 5, 1.0), (1, d(2001, 1, 2), 5, 2.0), (1, d(2001, 1, 2), 7, 4.0), (1, d(2001, 1, 2), 7, 8.0),
        (2, None, 3, 1.0), (2, d(2001, 1, 2), 9, 2.0), (3, d(2001, 1, 1), None, 1.0), (3, d(2001, 1, 1), 2, 2.0),
        (-1, d(2001, 1, 1), 1, 9.0), (None, d(2001, 1, 1), 1, 9.0)], "member_key bigint, trxn_date date, at int, amount double")
    out = en.last_purchase(lines, "at", "amount")
    assert sorted(map(tuple, out.collect())) == [(1, d(2001, 1, 2), 7, 12.0), (2, None, 3, 1.0), (3, d(2001, 1, 1), None, 1.0)]
    assert plan(out).count("LogicalRDD") == 1


@pytest.mark.parametrize("name", ["enrich_store_distance", "enrich_store_state"])
def test_nearest_stores_do_not_run_the_purchases_again(spark, monkeypatch, name):
    w = SimpleNamespace(
        enr=spark.createDataFrame([(1, 30.0, -90.0), (1, 30.0, -90.0), (2, None, None)], "member_key bigint, latitude double, longitude double"),
        trxn=spark.createDataFrame([(1, 4, 9, dt.date(2001, 1, 1), 2.0)], "member_key bigint, store_key bigint, trxn_id bigint, trxn_date date, retail_amount double"),
        store=spark.createDataFrame([(4, 30.0, -91.0, "01", "OPEN", "RETAIL"), (5, 31.0, -90.0, "01", "OPEN", "RETAIL")],
                                    "store_key bigint, latitude double, longitude double, district_code string, open_closed_ind string, retail_web_flag string"))
    found, search = [], en.nearest_stores
    monkeypatch.setattr(en, "nearest_stores", lambda members, stores: found.append(plan(members)) or search(members, stores))
    out = getattr(queries, name)(w)
    assert sorted(r.member_key for r in out.collect()) == [1, 1, 1, 1, 2]
    assert "retail_amount" not in found[0]


@pytest.mark.parametrize("finest", [nearest.FINEST, 8.0])
def test_members_meet_lists_of_stores_and_keep_two(spark, monkeypatch, finest):
    # with the larger finest side no cube is cut and each one's stores lie in several lists
    monkeypatch.setattr(nearest, "FINEST", finest)
    monkeypatch.setattr(nearest, "MOST", 16)
    stores = [(i, 40.0 + (i * 7 % 40) / 1000, -80.0 + (i * 11 % 50) / 1000) for i in range(90)]
    stores += [(500, 40.0, -80.0), (501, 40.0, -80.0), (501, 40.0, -80.0)]
    members = [(1, 40.01, -79.99), (2, 40.0, -80.0), (3, -10.0, 20.0), (4, None, -80.0)]
    out = nearest.nearest_stores(spark.createDataFrame(members, "member_key bigint, latitude double, longitude double"),
                                 spark.createDataFrame(stores, "store_key bigint, latitude double, longitude double"))
    place = lambda la, lo: (math.cos(math.radians(la)) * math.cos(math.radians(lo)), math.cos(math.radians(la)) * math.sin(math.radians(lo)), math.sin(math.radians(la)))
    want = {4: (None, None)}
    for k, la, lo in members[:3]:
        rank = sorted((round(math.dist(place(la, lo), place(a, b)), 12), s) for s, a, b in stores)
        want[k] = (rank[0][1], rank[1][1])
    assert {r.member_key: (r.closest_store_key, r.second_closest_store_key) for r in out.collect()} == want
    assert "Generate inline" in plan(out)
