"""Shared operators, hot keys included."""

import math
import random

from pyspark.sql import functions as F

from patronage.operators import aggregates as ag, columns as co, filters as fi, joins as jo, ranking as rk, sets as st
from patronage.operators import nearest as near, rewrite as rw
from patronage.operators.nearest import nearest_stores
from patronage.operators.sequence import generate_sequence, number_rows, place_within
from patronage.operators.sizing import broadcast_if_small
from patronage.operators.skew import left_join_known
from patronage.plans import dedup as dd


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_keeps_null_rows(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "a int")
    yes, no = fi.split_by(df, F.col("a") > 2)
    assert yes.count() == 1 and no.count() == 2
    yes, no = fi.split_by(df, F.col("a") > 2, keep_null=False)
    assert yes.count() + no.count() == 2


def test_sequence_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("v"))
    got = generate_sequence(df, "n", [F.col("v")], 100).orderBy("v").collect()
    assert [r.n for r in got] == list(range(101, 5101))


def test_sequence_with_one_hot_order_value(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("g"), "id")
    got = generate_sequence(df, "n", [F.col("g"), F.col("id")]).collect()
    assert sorted(r.n for r in got) == list(range(1, 3001))
    by_n = sorted(got, key=lambda r: r.n)
    assert [(r.g, r.id) for r in by_n] == sorted((r.g, r.id) for r in got)


def test_sequence_of_nothing(spark):
    assert generate_sequence(spark.range(0), "n", [F.col("id")]).count() == 0


def test_rows_are_numbered_where_they_lie(spark):
    df = spark.range(0, 5000, 1, 7).withColumn("v", F.col("id") % 3)
    start = spark.createDataFrame([(100,)], "max_key bigint")
    out = number_rows(df, "n", start)
    assert "rangepartitioning" not in plan(out) and "hashpartitioning(id" not in plan(out)
    got = out.collect()
    assert sorted(r.n for r in got) == list(range(101, 5101)) and sorted(r.id for r in got) == list(range(5000))
    assert [r.n for r in sorted(got, key=lambda r: r.id)] == list(range(101, 5101))  # the order of the files
    assert number_rows(df.limit(0), "n").count() == 0


def test_place_within_a_hot_key(spark):
    rows = [("hot", i * 37 % 3001) for i in range(3001)] + [(f"k{i % 50}", i) for i in range(500)] + [(None, i) for i in range(70)]
    df = spark.createDataFrame(rows, "k string, v bigint").repartition(6)
    by = {}
    for r in place_within(df, ["k"], [F.col("v")], "at").collect():
        by.setdefault(r.k, []).append((r.at, r.v))
    want = {}
    for k, v in rows:
        want.setdefault(k, []).append(v)
    assert {k: [v for _, v in sorted(x)] for k, x in by.items()} == {k: sorted(v) for k, v in want.items()}
    assert all(sorted(at for at, _ in x) == list(range(len(x))) for x in by.values())


def test_lists_of_a_key_do_not_depend_on_other_keys(spark):
    rows = [(1, i, i * 2) for i in range(950)] + [(2, i, i) for i in range(30)] + [(None, 5, None), (None, 5, 1)]
    def lists(rows):
        got = ag.lists_by_place(spark.createDataFrame(rows, "k int, id bigint, v bigint").repartition(5), ["k"], ["v"], ["id"], length=100).collect()
        return {(r.k, r.list_no): (r.grouped_count, [(x.id, x.v) for x in r.grouped_data]) for r in got}
    before = lists(rows)
    assert {k: len(v[1]) for k, v in before.items() if k[0] == 1} == {(1, i): 100 if i < 9 else 50 for i in range(10)}
    assert before[(2, 0)] == (30, [(i, i) for i in range(30)]) and before[(None, 0)] == (2, [(5, None), (5, 1)])
    assert [x for i in range(10) for x in before[(1, i)][1]] == [(i, i * 2) for i in range(950)]
    after = lists(rows + [(1, 10_000 + i, 0) for i in range(40_000)])
    assert {k: v for k, v in after.items() if k[0] != 1} == {k: v for k, v in before.items() if k[0] != 1}
    assert max(len(v[1]) for v in after.values()) == 100


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(0, 1000).select((F.col("id") % 2).alias("k"), "id")
    out = rk.latest_per_key(df, "k", [F.col("id").desc()])
    assert sorted((r.k, r.id) for r in out.collect()) == [(0, 998), (1, 999)]
    assert "WindowGroupLimit" in plan(out)


def test_ties_and_counts_of_a_hot_key(spark):
    df = spark.range(0, 900).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 10).alias("k"), "id")
    counted = rk.with_key_aggregates(df, ["k"], n=F.count(F.lit(1)))
    want = {}
    for r in df.collect():
        want[r.k] = want.get(r.k, 0) + 1
    assert all(r.n == want[r.k] for r in counted.collect()) and counted.count() == 900
    best = rk.keep_best_ties(df.withColumn("v", F.col("id") % 2), ["k"], F.col("v"))
    assert all(r.v == 0 for r in best.collect() if r.k is None)
    assert "Window" not in plan(counted)


def test_mark_best_flags_one_row_per_key(spark):
    df = spark.range(0, 100).select((F.col("id") % 7).alias("k"), "id")
    got = rk.mark_best(df, ["k"], [F.col("id")], "best").collect()
    assert len(got) == 100 and sorted(r.id for r in got if r.best) == list(range(7))


def test_group_by_as_list_splits_large_groups_and_loses_nothing(spark):
    df = spark.range(0, 1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"), "id", (F.col("id") * 2).alias("v"))
    got = ag.group_by_as_list(df, ["k"], ["v"], ["id"], chunks=16).collect()
    hot = [r for r in got if r.k == 1]
    assert len(hot) == 16 and max(len(r.grouped_data) for r in hot) < 200
    assert sorted(x.id for r in got for x in r.grouped_data) == list(range(1000))
    assert all(r.grouped_count == 700 for r in hot)


def test_group_by_as_list_bounds_its_arrays(spark):
    """The largest key sets the number of chunks of every key."""
    df = spark.range(0, 6000).select(F.when(F.col("id") < 5000, 1).otherwise(2).alias("k"), "id")
    got = ag.group_by_as_list(df, ["k"], [], ["id"], chunks=2, limit=100).collect()
    assert {r.k: sum(r.k == x.k for x in got) for r in got} == {1: 50, 2: 50}
    assert max(len(r.grouped_data) for r in got) < 200
    assert sorted(x.id for r in got for x in r.grouped_data) == list(range(6000))


def test_rowhash_copies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "A "), (3, "b"), (4, None)], "id int, v string")
    firsts, copies = st.dedup_rowhash(df, ["v"], [F.col("id")])
    assert sorted(r.id for r in firsts.collect()) == [1, 3, 4] and [r.id for r in copies.collect()] == [2]


def test_align_and_defaults(spark):
    df = spark.createDataFrame([("7", "x")], "a string, z string")
    out = co.align_to_schema(df, "a bigint, b date, c_key bigint", {"c_key": -1})
    assert out.dtypes == [("a", "bigint"), ("b", "date"), ("c_key", "bigint")] and tuple(out.first()) == (7, None, -1)
    assert co.default_fill_columns(df, "a string, m_key int, q int", zero=True).first()[2] == 0


def test_update_keys_and_merge(spark):
    dim = spark.createDataFrame([("a", 1)], "code string, code_key bigint")
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    row = jo.update_keys(df, ["x", "y"], dim, "code", "code_key").first()
    assert (row.x_key, row.y_key) == (1, -1)
    l = spark.createDataFrame([(1, "l"), (2, None)], "k int, v string")
    r = spark.createDataFrame([(2, "r"), (3, "r")], "k int, v string")
    got = {x.k: (x.v, x.side) for x in jo.full_outer_merge(l, r, ["k"]).collect()}
    assert got == {1: ("l", "left"), 2: ("r", "both"), 3: ("r", "right")}


def test_broadcast_needs_a_known_size(spark):
    small, large = spark.range(10), spark.range(10 ** 9)
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_small(small)) and not hinted(broadcast_if_small(large))


def miles(a, b):
    la1, lo1, la2, lo2 = map(math.radians, (*a, *b))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * math.asin(min(1, math.sqrt(h))) * 6371.0 * 1000 * 0.000621371


def test_nearest_stores_against_brute_force(spark):
    rnd = random.Random(5)
    # a third of the members in one town, stores in clusters and far away, across the date line and at the poles
    stores = [(i, rnd.uniform(39, 41), rnd.uniform(-84, -82)) for i in range(40)]
    stores += [(100, 89.0, 10.0), (101, -60.0, 179.5), (102, -60.1, -179.6), (103, 0.0, 0.0)]
    members = [(i, 40.0 + rnd.random() / 50, -83.0 + rnd.random() / 50) for i in range(60)]
    members += [(100 + i, rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for i in range(120)] + [(999, None, 1.0)]
    got = {r.member_key: r for r in nearest_stores(
        spark.createDataFrame(members, "member_key int, latitude double, longitude double"),
        spark.createDataFrame(stores, "store_key int, latitude double, longitude double")).collect()}
    assert len(got) == len(members) and got[999].closest_store_key is None
    for k, la, lo in members[:-1]:
        order = sorted((miles((la, lo), (s[1], s[2])), s[0]) for s in stores)
        assert abs(got[k].distance - order[0][0]) < 1e-6 and abs(got[k].second_distance - order[1][0]) < 1e-6
        assert got[k].closest_store_key == order[0][1]


def check_nearest(spark, members, stores):
    m = spark.createDataFrame(members, "member_key int, latitude double, longitude double")
    s = spark.createDataFrame(stores, "store_key int, latitude double, longitude double")
    got = {r.member_key: r for r in nearest_stores(m, s).collect()}
    for k, la, lo in members:
        order = sorted((miles((la, lo), (x[1], x[2])), x[0]) for x in stores)
        assert abs(got[k].distance - order[0][0]) < 1e-6 and abs(got[k].second_distance - order[1][0]) < 1e-6
        assert miles((la, lo), next((x[1], x[2]) for x in stores if x[0] == got[k].closest_store_key)) < order[0][0] + 1e-6
    homes, around = near.candidates(m, s)
    return max(r["count"] for r in homes.join(around, near.CUBE).groupBy("_m").count().collect())


def test_members_far_from_a_corner_full_of_stores_meet_few(spark, monkeypatch):
    monkeypatch.setattr(near, "MOST", 64)
    rnd = random.Random(9)
    stores = [(i, rnd.uniform(40.0, 40.5), rnd.uniform(-83.5, -83.0)) for i in range(1500)]
    members = [(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(60)]
    members += [(100 + i, rnd.uniform(39.8, 40.7), rnd.uniform(-83.7, -82.8)) for i in range(60)]
    assert check_nearest(spark, members, stores) <= near.MOST


def test_stores_in_one_place_and_next_to_a_town(spark, monkeypatch):
    """A mall of 300 stores at one point, a row of stores next to it, and two stores alone."""
    monkeypatch.setattr(near, "MOST", 64)
    stores = [(1000 - i, 40.0, -83.0) for i in range(300)] + [(2000 + i, 40.0 + i * 1e-5, -83.0) for i in range(1, 200)] + [(3000, 10.0, 10.0), (3001, 10.001, 10.0)]
    members = [(1, 40.0, -83.0), (2, 40.0005, -83.0001), (3, 10.0, 10.0), (4, -40.0, 97.0), (5, 40.002, -83.0), (6, 41.0, -83.0)]
    assert check_nearest(spark, members, stores) <= near.MOST


def test_unknown_keys_are_dealt_over_all_tasks(spark):
    """Nine of ten rows have no key to look up: no task of the join holds more than its share."""
    n = 20_000
    df = spark.range(n).select(F.col("id").alias("member_key"), F.when(F.col("id") % 20 == 0, F.lit(None)).when(F.col("id") % 10 > 0, F.lit(-1)).otherwise(F.col("id")).cast("long").alias("household_key"))
    out = spark.range(10, n, 40).select(F.col("id").alias("household_key"), F.lit("YES").alias("flag")).unionByName(
        spark.createDataFrame([(-1, "WRONG")], "household_key long, flag string"))
    known = F.col("household_key").isNotNull() & (F.col("household_key") != -1)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("-1", "false", "16")):
        spark.conf.set(k, v)
    try:
        joined = left_join_known(df, out, ["household_key"], known, ["member_key"]).withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("part").count().collect()]
        rows = joined.select("member_key", "household_key", "flag").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 16 and max(sizes) < 1.3 * n / 16
    want = {i: ("YES" if i % 40 == 10 else None) for i in range(n)}
    assert len(rows) == n and {r.member_key: r.flag for r in rows} == want


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, "v", float(i)) for i in range(2000)] + [(None, "n", 0.0)]
    schema = "member_key bigint, v string, amount double"
    rw.store_by_key(spark.createDataFrame(rows, schema), "member_key", path, 40)
    files = lambda: {f.relative_to(path) for f in (tmp_path / "t").rglob("*.parquet")}
    before = files()
    moves = spark.createDataFrame([(5, 900, False), (17, 901, False), (30, 31, True)], "old_member_key bigint, new_member_key bigint, is_invalid boolean")
    parts = dd.rekey_stored(spark, path, moves, lambda r: dd.rekey_fact(r, moves, None), 40)
    assert 1 <= len(parts) <= 4
    kept = {f for f in before if int(str(f).split("=")[1].split("/")[0]) not in parts}
    assert kept and kept == before & files()
    new = {5: 900, 17: 901}
    want = sorted(((new.get(k, k), v, a) for k, v, a in rows), key=repr)
    assert sorted(map(tuple, rw.read_by_key(spark, path).collect()), key=repr) == want
    assert rw.rewrite_keys(spark, path, "member_key", moves.select("old_member_key").limit(0), lambda r: r, 40) == []


def test_part_left_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rw.store_by_key(spark.range(3).withColumnRenamed("id", "k"), "k", path, 50)
    rw.rewrite_keys(spark, path, "k", spark.createDataFrame([(1,)], "k bigint"), lambda r: r.filter("k <> 1"), 50)
    assert sorted(r.k for r in rw.read_by_key(spark, path).collect()) == [0, 2]
