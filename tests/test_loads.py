"""Invariants of dimension loads, transforms and indicators."""

import datetime as dt

from pyspark.sql import functions as F

from patronage.operators.sets import union_all
from patronage.plans import consent as cs, facts as fa, history as hs, kpi, scd, scoring as sc, transform as tf

D = dt.date
DIM = "sk bigint, k string, v string, w string, last_updated_date date, status string, batch_id string"


def dim(spark, *rows):
    return spark.createDataFrame([(*r, D(2001, 1, 1), "current", "1") for r in rows], DIM)


def test_scd_inserts_updates_and_keeps(spark):
    old = dim(spark, (5, "a", "x", None), (6, "b", "x", "y"), (7, "c", "x", "y"))
    src = spark.createDataFrame([("A ", "X", None), ("b", "x", "z"), ("d", "n", None)], "k string, v string, w string")
    current, history = scd.scd2_load(src, old, ["k"], "sk", "2", D(2001, 2, 2))
    got = {r.k.strip().lower(): (r.sk, r.action_cd, r.w) for r in current.collect()}
    assert got == {"a": (5, "NCD", None), "b": (6, "U", "z"), "c": (7, "NCD", "y"), "d": (8, "I", None)}
    assert sorted(r.k for r in history.collect()) == ["b", "d"]


def test_scd_sees_a_value_that_moves_into_a_null(spark):
    old = dim(spark, (1, "a", None, "x"))
    src = spark.createDataFrame([("a", "x", None)], "k string, v string, w string")
    assert scd.change_set(src, old, ["k"], "sk").first().action_cd == "U"


def test_second_identical_load_changes_nothing(spark):
    src = spark.createDataFrame([("a", "1", None), ("b", None, "2")], "k string, v string, w string")
    current, _ = scd.scd2_load(src, dim(spark).limit(0), ["k"], "sk", "1", D(2001, 1, 1))
    again, history = scd.scd2_load(src, current.drop("action_cd").select(*[c.split()[0] for c in DIM.split(", ")]), ["k"], "sk", "2", D(2001, 2, 2))
    assert {r.action_cd for r in again.collect()} == {"NCD"} and history.count() == 0


def test_full_load_drops_rows_without_source(spark):
    old = dim(spark, (1, "a", "x", None), (2, "b", "x", None))
    src = spark.createDataFrame([("a", "x", None)], "k string, v string, w string")
    assert scd.change_set(src, old, ["k"], "sk", incremental=False).count() == 1


def test_segments(spark):
    rows = [(15, 63.0, 200, 10, 1), (8, 90.0, 200, 10, 2), (20, 50.0, 200, 10, 3), (5, 200.0, 200, 10, 5), (1, 10.0, 200, 10, 11), (1, 10.0, 100, 10, 14),
            (2, 10.0, 10, 5, 15), (1, 10.0, 900, 500, 16), (1, 10.0, 1000, 1080, 17), (1, 10.0, 2000, 1081, 0), (6, 71.0, 200, 10, 4), (None, None, 9, 9, None)]
    df = spark.createDataFrame(rows, "trips int, ads double, days_since_first int, days_since_last int, want int")
    assert [r.got for r in df.select(sc.segment_of().alias("got")).collect()] == [r[4] for r in rows]


def test_consent_dates_move_only_with_the_value(spark):
    rows = spark.createDataFrame([(1, "X"), (2, None), (3, "X")], "member_key bigint, do_not_direct_mail string")
    cur = spark.createDataFrame([(1, "DM", "YES", D(2000, 1, 1), 1), (2, "DM", "YES", D(2000, 1, 1), 2), (3, "DM", "NO", D(2000, 1, 1), 3)],
                                "member_key bigint, consent_type string, consent_value string, consent_date date, consent_history_id bigint")
    got = {r.member_key: (r.consent_value, r.consent_date) for r in cs.dm_consent(rows, cur, "card_statement", D(2001, 8, 1)).collect()}
    assert got == {1: ("NO", D(2001, 8, 1)), 2: ("YES", D(2000, 1, 1)), 3: ("NO", D(2000, 1, 1))}


def test_merge_takes_the_newest_filled_value(spark):
    rows = spark.createDataFrame([(1, D(2001, 1, 1), "a", "old", "x"), (1, D(2001, 2, 1), "b", "", None), (-1, D(2001, 1, 1), "c", "z", "z")],
                                 "member_key bigint, d date, id string, n string, m string")
    got = tf.merge_member_info(rows, "d", "id").collect()
    assert [(r.member_key, r.n, r.m) for r in got] == [(1, "old", "x")]


def test_zip_split(spark):
    rows = [("123456789", None), ("12345", None), ("123456", "77"), (None, None)]
    df = spark.createDataFrame(rows, "zip_code string, zip4 string")
    assert [tuple(r) for r in tf.zip_split(df).select("zip_code", "zip4", "zip_full").collect()] == [
        ("12345", "6789", "12345-6789"), ("12345", None, "12345"), ("12345", "77", "12345-6"), (None, None, None)]


def test_periods_use_sunday_weeks(spark):
    rows = [("k", None, 1.0, D(2001, 7, d)) for d in (21, 22, 25, 26)] + [("k", None, 4.0, D(2001, 7, 19))]
    df = spark.createDataFrame(rows, "kpi_name string, kpi_attribute_name string, kpi_attribute_value double, business_date date")
    r = kpi.kpi_periods(df, "2001-07-26").first()  # a Thursday
    assert (r.wtd_val, r.business_date_cnt, r.business_date_minus_one, r.sdlw, r.last_week_wtd_val, r.mtd) == (3.0, 1.0, 1.0, 4.0, 4.0, 8.0)
    assert r.change_per_wtd == -25.0


def test_tender_buckets_sum_to_the_total(spark):
    rows = [(1, k, 1, 10.0 + k) for k in (1, 21, 4, 16, 11, 99)]
    df = spark.createDataFrame(rows, "trxn_id bigint, tender_type_key bigint, tender_id bigint, tender_amount double")
    r = fa.tender_buckets(df).first()
    parts = [r[c] for c in ("plcc_amount", "credit_card_amount", "cash_amount", "check_amount", "gift_card_amount", "other_amount")]
    assert abs(sum(parts) - r.ttl_amount) < 1e-9 and r.other_amount == 109.0


def test_first_load_key_modes(spark):
    rows = spark.createDataFrame([("9", "a", 1), ("8", "a", 2), ("-1", "b", 1)], "sk string, k string, o int")
    order = [-F.col("o")]
    per_row = hs.hist_dim_load(rows, "sk", ["k"], order, "1")
    assert sorted(r.sk for r in per_row.filter("status = 'history'").collect()) == [-1, 0, 1, 2, 3]
    keep = hs.hist_dim_load(rows, "sk", ["k"], order, "1", mode="keep", defaults=False)
    assert sorted((r.sk, r.status) for r in keep.collect()) == [(8, "current"), (8, "history"), (9, "history")]


def test_compare(spark):
    a = spark.createDataFrame([(1, "x", " "), (2, "y", "q"), (3, "z", None)], "k int, v string, w string")
    b = spark.createDataFrame([(1, "X", None), (2, "yy", None)], "k int, v string, w string")
    counts, rows, columns = hs.compare_tables(a, b, ["k"])
    assert tuple(counts.first()) == (3, 2, 2, 1) and tuple(columns.first()) == (1, 1)
    assert [tuple(r) for r in rows.collect()] == [(2, "y:yy", "q")]


def test_compare_joins_only_ranges_that_differ(spark):
    """Ten changed rows, three new and two lost ones among 20,000."""
    a = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 97).cast("string").alias("v"), F.lit("W").alias("w"))
    change = (F.col("k") % 2000 == 7)
    b = (a.withColumn("v", F.when(change, "other").otherwise(F.col("v"))).withColumn("w", F.lit("w")).filter("k not in (11, 12)")
         .unionByName(spark.range(30_000, 30_003).select(F.col("id").alias("k"), F.lit("1").alias("v"), F.lit("w").alias("w")))
         .unionByName(spark.createDataFrame([(None, "x", "y")], "k bigint, v string, w string")))
    one, two = (hs._digested(d, ["k"], ["v", "w"], b) for d in (a, b))
    differ = hs.open_ranges(one, two)
    assert one.join(differ, ["_r0", "_r1"], "left_semi").count() <= 15
    counts, rows, columns = hs.compare_tables(a, b, ["k"])
    assert tuple(counts.first()) == (20_000, 20_002, 19_998, 10) and tuple(columns.first()) == (10, 0)
    assert sorted(r.k for r in rows.collect()) == [7 + 2000 * i for i in range(10)]
    same = hs.compare_tables(a, a.repartition(3), ["k"])
    assert tuple(same[0].first()) == (20_000, 20_000, 20_000, 0) and same[1].count() == 0


def test_stored_dimension_stays_where_it_lies(spark, tmp_path):
    """The join of a batch with a bucketed dimension shuffles the source once and the dimension never."""
    rows = [(i, f" Key{i} " if i else None, i if i % 7 else None, "v", D(2001, 1, 1), "current", "1") for i in range(200)]
    old = spark.createDataFrame(rows, "sk bigint, k string, d bigint, v string, last_updated_date date, status string, batch_id string")
    stored = scd.store_dimension(old, ["k", "d"], "t_stored_dimension", str(tmp_path / "dim"))
    source = spark.createDataFrame([(f"key{i} " if i else None, i if i % 7 else None, "v" if i % 2 else "w") for i in range(0, 400, 3)], "k string, d bigint, v string")
    changes = scd.change_set(scd._latest(source, ["k", "d"], None, stored), stored, ["k", "d"], "sk")
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    plain = scd.change_set(scd.dedup_source(source, ["k", "d"]), old, ["k", "d"], "sk")
    assert sorted(map(tuple, changes.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    assert {r.action_cd for r in changes.collect()} == {"I", "U", "NCD"}
    loads = [scd.scd2_load(source, d, ["k", "d"], "sk", "2", D(2001, 2, 2)) for d in (stored, old)]
    for a, b in zip(*loads):
        assert a.columns == b.columns and sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_keys_of_other_types_match_as_text(spark):
    old = spark.createDataFrame([(1, 7, D(2000, 1, 1), "x", D(2001, 1, 1)), (2, None, None, "y", D(2001, 1, 1))], "sk bigint, k bigint, d date, v string, last_updated_date date")
    src = spark.createDataFrame([(" 7", D(2000, 1, 1), "x"), (None, None, "z"), ("8", None, "n")], "k string, d date, v string")
    got = {(r.sk, r.action_cd) for r in scd.change_set(src, old, ["k", "d"], "sk").collect()}
    assert got == {(1, "NCD"), (2, "U"), (None, "I")}
