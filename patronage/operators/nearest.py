"""Two nearest stores per member, without pairing every member with every store.

Points live on the unit sphere in cubes of several sizes. If a cube of side g holds two or
more stores, then every member in that cube has two stores within the cube's diagonal, so
its two nearest stores lie at most two cubes away in each direction. Each member therefore
uses the finest size whose own cube has two stores, and meets only stores of the cubes
around. The coarsest size covers the whole globe, so the answer is always exact.

A cube may still have very many stores around it: a member far from all of them, or one at the
edge of a town full of them. Such a cube is cut into smaller ones as far as members live in
them, and a smaller cube keeps only stores that may be among the two nearest of a point in it:
a store goes if two others are nearer from everywhere in the cube. So a member meets a bounded
number of stores wherever it lives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geo import haversine_miles
from .ranking import latest_per_key
from .sets import union_all
from .sizing import DEFAULT_LIMIT, broadcast_if_small
from .staging import stage

# cube sides on the unit sphere, halved from level to level (about 4 miles at the finest);
# the coarsest cube holds everything
SIDES = [2.0 ** -k for k in range(10, -1, -1)] + [4.0]
LAST = len(SIDES) - 1
REACH = 2  # a cube's diagonal is below two sides
CELL = ["level", "a", "b", "c"]
# the planner does not count that each store becomes a row per level
LEVEL_LIMIT = DEFAULT_LIMIT // len(SIDES)


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    la, lo = F.radians(F.col(lat).cast("double")), F.radians(F.col(lon).cast("double"))
    return df.withColumns({"_x": F.cos(la) * F.cos(lo), "_y": F.cos(la) * F.sin(lo), "_z": F.sin(la)})


def _cell(side: Column) -> dict[str, Column]:
    return {n: F.floor((F.col(c) + 1) / side).cast("int") for n, c in zip("abc", ("_x", "_y", "_z"))}


def _per_level(df: DataFrame) -> DataFrame:
    """One row per level with the cube of the point."""
    each = df.withColumn("level", F.explode(F.lit(list(range(len(SIDES))))))
    return each.withColumns(_cell(_side(F.col("level"))))


def _side(level: Column) -> Column:
    return F.element_at(F.lit(SIDES), level + 1)


MOST = 1024      # stores that a member meets at most
CUT = 8          # a crowded cube is cut in so many along each side
FINEST = 2.0 ** -24
CUBE = ["side", "a", "b", "c"]


def nearest_stores(members: DataFrame, stores: DataFrame, member_key="member_key", store_key="store_key",
                   lat="latitude", lon="longitude") -> DataFrame:
    """(member_key, closest_store_key, second_closest_store_key, distance, second_distance);
    members without coordinates get nulls, ties go to the smaller store key."""
    homes, around = candidates(members, stores, member_key, store_key, lat, lon)
    # ranked by the straight line, which grows with the distance and needs no trigonometry
    line = lambda s: sum(((F.col(f"_{c}") - s[f"_s{c}"]) * (F.col(f"_{c}") - s[f"_s{c}"]) for c in "xyz"), F.lit(0.0))
    # a member meets the stores of its cube as one list and hands on two of them: pairs with all
    # of them, up to MOST for a member, are never rows that have to be sorted
    ranked = F.sort_array(F.transform("_list", lambda s: F.struct(line(s).alias("_d"), s["_s"], s["_slat"], s["_slon"])))
    two = homes.join(broadcast_if_small(_lists(around)), CUBE).select("_m", "_mlat", "_mlon", F.slice(ranked, 1, 2).alias("_two"))
    pairs = two.select("_m", "_mlat", "_mlon", F.inline("_two"))
    top = latest_per_key(pairs, "_m", [F.col("_d"), F.col("_s")], n=2, rank_col="_r")
    miles = haversine_miles(F.col("_mlat"), F.col("_mlon"), F.col("_slat"), F.col("_slon"))
    place = lambda i, c: F.max(F.when(F.col("_r") == i, c))
    wide = top.groupBy("_m").agg(
        place(1, F.col("_s")).alias("closest_store_key"), place(2, F.col("_s")).alias("second_closest_store_key"),
        place(1, miles).alias("distance"), place(2, miles).alias("second_distance"))
    return members.select(member_key).join(wide, F.col(member_key) == F.col("_m"), "left").drop("_m")


def candidates(members: DataFrame, stores: DataFrame, member_key="member_key", store_key="store_key",
               lat="latitude", lon="longitude") -> tuple[DataFrame, DataFrame]:
    """(located members with their cube, stores that each of these cubes has to look at). The
    second is a written table whose size is known: within the limit it is sent to every task,
    beyond it a join shuffles by cube and hot cubes are split."""
    located = members.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    m = _on_sphere(located.select(F.col(member_key).alias("_m"), F.col(lat).alias("_mlat"), F.col(lon).alias("_mlon")), "_mlat", "_mlon")
    known = (stores.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
             .select(F.col(store_key).alias("_s"), F.col(lat).alias("_slat"), F.col(lon).alias("_slon")))
    # of stores in one place only two can ever count
    s = _on_sphere(latest_per_key(known, ["_slat", "_slon"], [F.col("_s")], n=2), "_slat", "_slon")
    s_cells = _per_level(s.withColumnsRenamed({"_x": "_sx", "_y": "_sy", "_z": "_sz"}).withColumns(
        {"_x": F.col("_sx"), "_y": F.col("_sy"), "_z": F.col("_sz")})).drop("_x", "_y", "_z")

    # usable cubes: at most one row per store and level
    good = (s_cells.groupBy(*CELL).agg(F.count("*").alias("_n"))
            .filter((F.col("_n") >= 2) | (F.col("level") == LAST)).drop("_n"))
    point = ["_m", "_mlat", "_mlon", "_x", "_y", "_z"]
    # members are spread by key once; every later step by member keeps that placement
    m = m.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_m")
    finest = (_per_level(m).join(broadcast_if_small(good, LEVEL_LIMIT), CELL).groupBy(*point).agg(F.min("level").alias("level")))
    m_cell = finest.withColumns(_cell(_side(F.col("level"))))

    # stores around each cube that is in use, found once per cube and not once per member
    used = m_cell.select(*CELL).distinct()
    steps = F.when(F.col("level") == LAST, F.array(F.lit(0))).otherwise(F.lit(list(range(-REACH, REACH + 1))))
    for axis in "abc":
        used = used.withColumn(f"_d{axis}", F.explode(steps)).withColumn(f"_n{axis}", F.col(axis) + F.col(f"_d{axis}")).drop(f"_d{axis}")
    around = (used.join(broadcast_if_small(s_cells.withColumnsRenamed({x: f"_n{x}" for x in "abc"}), LEVEL_LIMIT), ["level", "_na", "_nb", "_nc"])
              .select(_side(F.col("level")).alias("side"), "a", "b", "c", *STORE))
    return _uncrowded(m_cell.select(*point, _side(F.col("level")).alias("side"), "a", "b", "c"), stage(around))


STORE = ["_s", "_slat", "_slon", "_sx", "_sy", "_sz"]
PARTS = 64       # lists of a cube that is too small to be cut


def _lists(around: DataFrame) -> DataFrame:
    """The stores of each cube in one list of at most MOST. Cubes of the finest side are not cut;
    their stores are dealt over several lists."""
    part = F.when(F.col("side") > FINEST, F.lit(0)).otherwise(F.pmod(F.xxhash64(*STORE), F.lit(PARTS)).cast("int"))
    return stage(around.groupBy(*CUBE, part.alias("_part")).agg(F.collect_list(F.struct(*STORE)).alias("_list")).drop("_part"))


def _uncrowded(homes: DataFrame, around: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same with no cube above MOST stores: crowded ones are cut until none is left."""
    crowded = _crowded(around)
    if crowded is None:
        return homes, around
    homes, settled = stage(homes), []
    while crowded is not None:
        there = broadcast_if_small(crowded)
        few, many = around.join(there, CUBE, "left_anti"), around.join(there, CUBE, "left_semi")
        settled.append((homes.join(there, CUBE, "left_anti"), few))
        small = F.col("side") / CUT
        homes = stage(homes.join(there, CUBE, "left_semi").withColumns({f"_{c}0": F.col(c) for c in CUBE}).withColumns(
            {"side": small} | _cell(small)))
        parts = homes.select(*CUBE, *[F.col(f"_{c}0") for c in CUBE]).distinct()
        inside = parts.join(broadcast_if_small(many.withColumnsRenamed({c: f"_{c}0" for c in CUBE})), [f"_{c}0" for c in CUBE])
        around, homes = stage(_possible(inside.select(*CUBE, *STORE))), homes.drop(*[f"_{c}0" for c in CUBE])
        crowded = _crowded(around)
    settled.append((homes, around))
    return union_all([h for h, _ in settled]), stage(union_all([a for _, a in settled]))


def _crowded(around: DataFrame) -> DataFrame | None:
    cubes = around.filter(F.col("side") > FINEST).groupBy(*CUBE).agg(F.count("*").alias("_n")).filter(F.col("_n") > MOST).drop("_n")
    return None if cubes.isEmpty() else stage(cubes)


def _possible(inside: DataFrame) -> DataFrame:
    """Stores that may be among the two nearest of some point of their cube. A point x of the
    sphere is nearer to t than to s where x (t - s) > 0, which is least in a corner of the cube;
    t is each of the two stores nearest to the middle."""
    mid = {c: (F.col(n) + 0.5) * F.col("side") - 1 for c, n in zip("xyz", "abc")}
    away = sum(((mid[c] - F.col(f"_s{c}")) * (mid[c] - F.col(f"_s{c}")) for c in "xyz"), F.lit(0.0))
    store = F.struct(away.alias("d"), F.col("_s").alias("s"), *[F.col(f"_s{c}").alias(c) for c in "xyz"])
    one = inside.groupBy(*CUBE).agg(F.min(store).alias("_t1"))
    rows = inside.join(broadcast_if_small(one), CUBE)
    two = rows.filter(F.col("_s") != F.col("_t1.s")).groupBy(*CUBE).agg(F.min(store).alias("_t2"))
    rows = rows.join(broadcast_if_small(two), CUBE, "left")

    def nearer(t: str) -> Column:
        step = {c: F.col(f"{t}.{c}") - F.col(f"_s{c}") for c in "xyz"}
        return sum((mid[c] * step[c] - F.col("side") / 2 * F.abs(step[c]) for c in "xyz"), F.lit(0.0)) > 1e-12

    return rows.filter(~F.coalesce(nearer("_t1") & nearer("_t2"), F.lit(False))).select(*CUBE, *STORE)
