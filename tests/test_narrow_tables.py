"""What the derived tables of a warehouse hold and how often they are written, on rows of their own."""

from __future__ import annotations

import datetime as dt

import pytest

from patronage import warehouse
from patronage.plans import dedup as dd, edw
from patronage.queries import REGISTRY
from patronage.warehouse import Warehouse


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def shop(spark, tmp_path, monkeypatch):
    """(warehouse of a few rows, written tables as (name, columns, plan))"""
    day = "timestamp '2001-05-01' + make_interval(0, 0, 0, cast(id % 7 as int))"
    tables = {
        "region": "cast(id as int) as r_regionkey, 'R' as r_name",
        "customer": "id as c_custkey, cast(1 as int) as c_nationkey, 1.5D as c_acctbal, 'S' as c_mktsegment",
        "supplier": "id as s_suppkey, 'S' as s_name, cast(1 as int) as s_nationkey, 2.5D as s_acctbal",
        "part": "id as p_partkey, 'P' as p_name, 'B' as p_brand, 'T' as p_type, cast(id as int) as p_size, 3.5D as p_retailprice",
        "orders": f"id as o_orderkey, id % 30 as o_custkey, 'O' as o_orderstatus, 10.0D + id as o_totalprice, {day} as o_orderdate, '2-HIGH' as o_orderpriority",
        "lineitem": f"id % 40 as l_orderkey, id % 9 as l_partkey, id % 5 as l_suppkey, cast(1 + id % 7 as int) as l_linenumber, 2.0D as l_quantity, 50.0D + id as l_extendedprice,"
                    f" 0.1D as l_discount, 'N' as l_returnflag, 'F' as l_linestatus, {day} as l_shipdate",
        "events": f"id as event_id, {day} as ts, id as user_id, 'view' as event_type, 1.0D as value, '' as props"}
    sizes = {"region": 5, "supplier": 6, "part": 60, "lineitem": 200}
    for name, columns in tables.items():
        spark.range(sizes.get(name, 50)).selectExpr(*[columns] if "," not in columns else [c.strip() for c in split(columns)]).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    written, stage_table = [], warehouse.stage_table

    def record(df, name, *args, **kwargs):
        written.append((name.split("/")[1], df.columns, plan(df)))
        return stage_table(df, name, *args, **kwargs)

    monkeypatch.setattr(warehouse, "stage_table", record)
    return Warehouse(spark, str(tmp_path)), written


def split(columns: str) -> list[str]:
    """Select items at commas outside brackets."""
    out, depth = [""], 0
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


@pytest.mark.parametrize("name,lines", [("trxn_unify", 4), ("edw_transaction_detail", 6), ("edw_customer", 7)])
def test_lines_are_written_with_the_columns_of_the_job(shop, name, lines):
    w, written = shop
    got = REGISTRY[name].build(w).select(*[c for c, _ in REGISTRY[name].schema]).collect()
    narrow = [c for n, c, _ in written if n.startswith("w_trxn")]
    assert [len(c) for c in narrow] == [lines] and "w_exp_sum" not in [n for n, _, _ in written]
    # the whole tables, once written, give the same rows
    for whole in ("w_trxn", "w_trxn_head", "w_tender_history", "w_exp_sum"):
        w[whole]
    before = len(written)
    again = REGISTRY[name].build(w).select(*[c for c, _ in REGISTRY[name].schema]).collect()
    assert got and sorted(map(str, got)) == sorted(map(str, again))
    assert not any(n.startswith("w_trxn") for n, _, _ in written[before:])


def test_preferred_place_is_found_without_a_window(spark):
    d = dt.date
    rows = spark.createDataFrame([
        (1, 10, d(2001, 1, 1), "a"), (1, 11, d(2001, 1, 2), "b"), (1, 12, d(2001, 1, 1), "a"),  # more visits win over a later one
        (2, 10, d(2001, 1, 1), "a"), (2, 11, d(2001, 1, 2), "b"),  # the later one
        (3, 11, d(2001, 1, 1), "b"), (3, 10, d(2001, 1, 1), "c"), (3, 12, d(2001, 1, 1), None),  # place, nulls last
        (4, 10, None, "a"), (4, 11, d(1999, 1, 1), "b"),  # no date comes last
        (5, 10, d(2001, 1, 1), None), (None, 10, d(2001, 1, 1), "n")], "member_key bigint, trxn_id bigint, trxn_date date, place string")
    out = edw._visits(rows, "place", ["first"])
    assert {r.member_key: r.first for r in out.collect()} == {1: "a", 2: "b", 3: "b", 4: "b", 5: None, None: "n"}
    assert {r.member_key: r.first for r in edw._visits(rows, "place", ["first", "second"]).collect()} == {1: "a", 2: "b", 3: "b", 4: "b", 5: None, None: "n"}
    assert "Window" not in plan(out)


def test_customers_are_dealt_before_their_columns_are_computed(shop, monkeypatch):
    w, written = shop
    monkeypatch.setattr(warehouse, "TASK_BYTES", 500)
    rows = REGISTRY["golden_eligible"].build(w).collect()
    plans = {n: p for n, _, p in written}
    assert "w_dup_member" not in plans and rows
    for name in ("w_member", "w_dup_card", "w_dup_email", "w_dup_phone"):
        assert "Rebalance" not in plans[name] and "Repartition" in plans[name]
    assert plans["w_member"].index("Project") < plans["w_member"].index("Repartition")
    small = Warehouse(w.spark, w.folder)
    monkeypatch.setattr(warehouse, "TASK_BYTES", 1 << 20)
    assert sorted(map(str, REGISTRY["golden_eligible"].build(small).collect())) == sorted(map(str, rows))


def test_rekeying_joins_the_members_to_their_contacts_once(shop, monkeypatch):
    w, written = shop
    calls, inputs, values = [], dd.dedup_inputs, dd.contact_values
    monkeypatch.setattr(dd, "dedup_inputs", lambda *a: calls.append("inputs") or inputs(*a))
    monkeypatch.setattr(dd, "contact_values", lambda *a: calls.append("contacts") or values(*a))
    out = REGISTRY["rekey_fact"].build(w)
    assert out.count() == 50 and sorted(calls) == ["contacts", "inputs"]
    assert "w_tender_history" not in [n for n, _, _ in written]
