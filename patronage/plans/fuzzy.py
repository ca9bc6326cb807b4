"""Near-duplicate texts within blocks, exactly and without forming all pairs of a block.

The score is the token-sort ratio: upper-case, drop everything but letters, digits and
blanks, sort the words, and compare: round(100 * (L - d) / L) with L the total length and d
the insert/delete distance. A score of at least T bounds d by L * (100.5 - T) / 100, so two
texts that pass differ in few places: cut the shorter one in (bound + 1) segments, and at
least one of them occurs unchanged in the longer one, shifted by at most the bound. Texts are
therefore joined on equal segments (an equi-join on block, length, place and segment) and
only those pairs are scored. Segments and score are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.components import connected_components
from ..operators.skew import join_back

THRESHOLD = 94  # fixed value: score that counts as the same


def norm(c: Column) -> Column:
    """Upper-case words of letters and digits, sorted and joined by blanks."""
    clean = F.trim(F.regexp_replace(F.upper(c), "[^A-Z0-9 ]", ""))
    return F.array_join(F.array_sort(F.split(clean, " +")), " ")


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence of two texts at hand, outside of any plan."""
    ends: list[int] = []
    for ch in a:
        place = [b.find(ch, start) + 1 for start in [0, *ends]]
        ends = [min(new or old, old) for new, old in zip(place, [*ends, len(b) + 1]) if new or old <= len(b)]
    return len(ends)


def ratio(a: str, b: str) -> int:
    total = len(a) + len(b)
    return (400 * common_length(a, b) + total) // (2 * total) if total else 100


def common_length_of(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two text columns.

    A dynamic programme over the characters of a. Its row holds, for each length, the earliest
    place of b at which a common subsequence of that length ends. A character moves an end
    forward to its first place in b behind the end before, so a row follows from the last one
    without a loop over b.
    """
    none = F.length(b) + 1

    def step(ends: Column, ch: Column) -> Column:
        def end(old: Column, i: Column) -> Column:
            place = F.call_function("locate", ch, b, F.coalesce(F.get(ends, i - 1), F.lit(0)) + 1)
            return F.least(old, F.when(place > 0, place).otherwise(none))
        return F.filter(F.transform(F.concat(ends, F.array(none)), end), lambda e: e < none)

    chars = F.filter(F.split(a, ""), lambda ch: ch != "")
    return F.aggregate(chars, F.array().cast("array<int>"), step, F.size)


def ratio_of(a: Column, b: Column) -> Column:
    """100 * (total - distance) / total, rounded half up in whole numbers; 100 for two empty texts."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 100).otherwise(_div(400 * common_length_of(a, b) + total, 2 * total))


def _div(a: Column, b: Column | int) -> Column:
    return F.floor(a / b).cast("int")


def max_distance(total: Column, threshold: int) -> Column:
    """Largest insert/delete distance at which texts of this total length still pass."""
    return _div(total * (201 - 2 * threshold), 200)


def _bound(length: Column, threshold: int) -> Column:
    """Largest distance of a text of this length to a longer one that still passes."""
    c = 201 - 2 * threshold
    longest = _div(length * (200 + c), 200 - c)
    return max_distance(length + longest, threshold)


def _cuts(length: Column, bound: Column) -> Column:
    """Even segments of a text, one more than the bound: array of (place, at, width), at from 0."""
    parts = bound + 1
    base = _div(length, parts)
    short = parts - (length - base * parts)  # segments of the smaller width come first
    return F.transform(F.sequence(F.lit(0), bound), lambda i: F.struct(
        i.alias("place"), (base * i + F.greatest(F.lit(0), i - short)).alias("at"), (base + (i >= short).cast("int")).alias("width")))


def own_segments(df: DataFrame, threshold: int) -> DataFrame:
    """(block, text, len, place, segment): segments of each text as the shorter one of a pair."""
    n = F.length("text")
    cut = df.select("block", "text", n.alias("len"), F.explode(_cuts(n, _bound(n, threshold))).alias("cut"))
    return cut.select("block", "text", "len", "cut.place", F.col("text").substr(F.col("cut.at") + 1, F.col("cut.width")).alias("segment"))


def possible_segments(df: DataFrame, threshold: int) -> DataFrame:
    """(block, text, len, place, segment): what each text holds at the places where a segment of
    a text of length len, its own or a smaller one, may occur in it."""
    c = 201 - 2 * threshold
    n, least = F.length("text"), F.ceil(F.length("text") * (200 - c) / F.lit(200 + c)).cast("int")
    each = df.select("block", "text", F.explode(F.sequence(least, n)).alias("len"))
    each = each.withColumn("bound", _bound(F.col("len"), threshold))
    cut = each.select("block", "text", "len", "bound", F.explode(_cuts(F.col("len"), F.col("bound"))).alias("cut"))
    first = F.greatest(F.lit(0), F.col("cut.at") - F.col("bound"))
    last = F.least(F.length("text") - F.col("cut.width"), F.col("cut.at") + F.col("bound"))
    found = F.array_distinct(F.transform(F.sequence(first, last), lambda p: F.col("text").substr(p + 1, F.col("cut.width"))))
    return cut.filter(first <= last).select("block", "text", "len", "cut.place", F.explode(found).alias("segment"))


def similar_texts(df: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(block, a, b, score) for distinct texts a < b of one block that reach the threshold.
    Input: one row per distinct (block, text)."""
    sizes = df.groupBy("block").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    multi = join_back(df.select("block", "text"), sizes, ["block"])
    index = own_segments(multi, threshold).withColumnRenamed("text", "short")
    probe = possible_segments(multi, threshold).withColumnRenamed("text", "long")
    met = (index.join(probe, ["block", "len", "place", "segment"])
           .filter(F.col("short") != F.col("long"))
           .select("block", F.least("short", "long").alias("a"), F.greatest("short", "long").alias("b")).distinct())
    return met.withColumn("score", ratio_of(F.col("a"), F.col("b"))).filter(F.col("score") >= threshold)


def fuzzy_pairs(rows: DataFrame, block: Column, text: Column, threshold: int = THRESHOLD,
                key: str = "member_key", connected: bool = False) -> DataFrame:
    """(key, identifier): the group that each member with a near copy in its block belongs to.

    Members with the same text are one node, named by its smallest key. By default a node joins
    the last of its pairs in the order of (both texts, score), so clusters of more than two
    nodes fall apart into pairs, as in the reference. Connected groups hold all nodes that near
    copies lead to, and are named by their smallest and largest key.
    """
    tagged = rows.select(F.col(key).alias("_key"), block.alias("block"), norm(text).alias("text"))
    nodes = tagged.groupBy("block", "text").agg(F.min("_key").alias("rep"), F.max("_key").alias("last"),
                                                F.count(F.lit(1)).alias("copies"))
    pairs = similar_texts(nodes, threshold)
    one = nodes.select("block", F.col("text").alias("a"), F.col("rep").alias("ka"))
    two = nodes.select("block", F.col("text").alias("b"), F.col("rep").alias("kb"))
    keyed = pairs.join(one, ["block", "a"]).join(two, ["block", "b"])
    best = _connected(nodes, keyed) if connected else _last_pairs(nodes, keyed)
    return join_back(tagged, best, ["block", "text"]).select(F.col("_key").alias(key), "identifier")


def _name(low: str, high: str) -> Column:
    return F.concat_ws("|", F.col(low).cast("string"), F.col(high).cast("string"))


def _last_pairs(nodes: DataFrame, keyed: DataFrame) -> DataFrame:
    """(block, text, identifier) by the last pair of each node."""
    swap = F.col("ka") > F.col("kb")
    keyed = keyed.select("block", "a", "b", F.struct(
        F.when(swap, F.concat("b", "a")).otherwise(F.concat("a", "b")).alias("texts"), "score",
        F.concat_ws("|", F.least("ka", "kb").cast("string"), F.greatest("ka", "kb").cast("string")).alias("id")).alias("p"))
    both = keyed.select("block", F.explode(F.array("a", "b")).alias("text"), "p")
    copies = nodes.filter("copies > 1").select("block", "text", F.struct(
        F.concat("text", "text").alias("texts"), F.lit(100).alias("score"), _name("rep", "last").alias("id")).alias("p"))
    return both.unionByName(copies).groupBy("block", "text").agg(F.max("p")["id"].alias("identifier"))


def _connected(nodes: DataFrame, keyed: DataFrame) -> DataFrame:
    """(block, text, identifier) by connected nodes; a node is known by its smallest key."""
    roots = connected_components(keyed.select(F.col("ka").alias("a"), F.col("kb").alias("b")))
    rooted = nodes.join(roots, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("root", "rep"))
    groups = rooted.groupBy("root").agg(F.max("last").alias("end"), F.sum("copies").alias("size")).filter("size > 1")
    return join_back(rooted, groups, ["root"]).select("block", "text", _name("root", "end").alias("identifier"))
