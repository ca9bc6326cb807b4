"""Jaccard join of word n-gram sets by PartEnum signatures.

A pair of sets that is similar enough differs in few elements: with threshold g and the
smaller set of size a, in at most (1 - g) / g * a. Cut the domain of elements (64-bit hashes
of n-grams) into more parts than that, and at least one part holds the same elements of both
sets. A set therefore has one signature for each of its first m(a) non-empty parts, the hash
of all elements in that part, and similar sets share a signature.

* The number of parts depends on the size band of the smaller set. A set takes part in its
  own band and, where it may be the larger partner of a set of the band below, in that too.
* m(a) = floor((1 - g) / g * a) + 1 is not smaller for the larger set, and both take parts in
  the same order, so the argument holds although not all parts are listed. It also holds if
  parts with few elements, which unlike sets share by chance, are passed over by both.
* Only a set with too few parts of enough elements also lists its first m(a) non-empty parts,
  and one with too few of those its first n-grams by hash order, as many as a prefix filter
  needs; two such sets meet there.

So no link is lost, whatever the data. Equal sets count once: all steps work on one 64-bit
fingerprint for each distinct set. Sets with a signature in common are candidates and are
compared exactly, element by element.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.sizing import broadcast_if_small
from ..operators.skew import join_back
from .components import components
from .staging import staged
from .words import chunks, mix, runs, words

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BAND = 1.5         # ratio of the largest to the smallest size of a band
SPARE = 1.3        # parts for each part that must agree
SMALL = 16         # members of one signature that are paired without blocks
BLOCK = 1024       # members of one signature that are compared as one block
LEAST_BINS = 256   # of a sketch
UNITS = 100        # thresholds are whole percents, so that sizes compare exactly


def ngram_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of the n-grams of its lower-cased words)."""
    for lo, hi, piece in chunks(texts):
        w = words(piece, lower=True)
        for i in range(hi - lo):
            own = w.of(i)
            yield lo + i, np.unique(runs(own, min(n, len(own)))) if len(own) else own


def fingerprint(s: np.ndarray) -> int:
    """One 64-bit number for a set."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(s).sum(dtype=np.uint64) + np.uint64(len(s))]))[0].view(np.int64))


def sketch(s: np.ndarray) -> bytes:
    """Counts of elements by hash range, one byte each, a power of two of them. The summed
    differences of two sketches are at most the number of elements in which the sets differ,
    also after neighbouring ranges are added up or counts stop at 255."""
    bins = max(LEAST_BINS, 1 << int(len(s) // 3).bit_length())
    got = np.bincount((s >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64), minlength=bins)
    return np.minimum(got, 255).astype(np.uint8).tobytes()


def folded(sketches: list[bytes], bins: int) -> np.ndarray:
    """Sketches as rows of `bins` counts."""
    return np.stack([np.frombuffer(x, np.uint8).reshape(bins, -1).sum(1, dtype=np.int32) for x in sketches])


def near(x: np.ndarray, size: int, ys: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of sketches can be similar enough to sketch x, by sizes and differences."""
    low, high = np.minimum(sizes, size), np.maximum(sizes, size)
    # similarity of at least percent bounds the difference by (100 - percent) / (100 + percent) of both sizes
    fits = UNITS * low >= percent * high
    differ = np.abs(ys - x).sum(1)
    return fits & ((UNITS + percent) * differ <= (UNITS - percent) * (sizes + size))


def band_table(largest: int) -> np.ndarray:
    """Smallest size of each band, up to one beyond the largest size."""
    low = [1]
    while low[-1] <= largest:
        low.append(max(low[-1] + 1, int(np.ceil(low[-1] * BAND))))
    return np.array(low)


def needed(size: int, percent: int) -> int:
    """Parts of which one must agree: one more than the elements in which sets may differ."""
    return (UNITS - percent) * size // percent + 1


def least_content(percent: int) -> int:
    """Elements that a part must hold to be listed first: as many as leave enough such parts,
    at both ends of a band, for sets of average spread."""
    top = percent / (UNITS - percent) / SPARE  # elements of a part, for the largest sets of a band
    count = 1
    while (SPARE * _at_least(count + 1, top) >= 1.04 and SPARE * BAND * _at_least(count + 1, top / BAND) >= 1.04):
        count += 1
    return count


def _at_least(count: int, mean: float) -> float:
    return 1 - sum(math.exp(-mean) * mean ** k / math.factorial(k) for k in range(count))


def signatures(s: np.ndarray, percent: int, low: np.ndarray, content: int) -> np.ndarray:
    """Signatures of one sorted set of hashes; content is least_content(percent)."""
    size = len(s)
    band = int(np.searchsorted(low, size, side="right")) - 1
    out = []
    for b in (band, band - 1):
        top = int(low[b + 1]) - 1
        if b < band and (b < 0 or percent * size > UNITS * top):
            break  # no set of the lower band is large enough
        want = needed(min(size, top), percent)
        parts = 1 if needed(top, percent) == 1 else math.ceil(SPARE * needed(top, percent)) + 2
        part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        salt = np.uint64((b + 1) * 0x632BE59BD9B4E019 & (2 ** 64 - 1))
        sums = mix(np.add.reduceat(mix(s ^ salt), at) + mix(part[at] + salt))
        full = sums[np.diff(np.append(at, size)) >= (content if parts > 1 else 1)]
        out.append(full[:want])
        if len(full) < want:
            out.append(mix(sums[:want] ^ salt))
        if len(at) < want:
            first = size - -(-percent * size // UNITS) + 1
            out.append(mix(s[:first] ^ np.uint64(0xA0761D6478BD642F) ^ salt))
    return np.concatenate(out)


def _profile(n: int):
    def run(batches):
        for batch in batches:
            key, size = [], []
            for _, s in ngram_sets(batch.column(1), n):
                size.append(len(s))
                key.append(fingerprint(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(key, pa.int64())],
                                             names=["doc_id", "n_shingles", "set_key"])
    return run


def _signature_rows(n: int, percent: int):
    def run(batches):
        low, seen, content = band_table(1 << 20), set(), least_content(percent)
        for batch in batches:
            out, keys, held = [], [], 0
            for _, s in ngram_sets(batch.column(0), n):
                if not len(s) or (key := fingerprint(s)) in seen:
                    continue  # a copy within the task brings nothing new
                seen.add(key)
                if len(s) >= low[-1]:
                    low = band_table(2 * len(s))
                sig = signatures(s, percent, low, content)
                out.append(sig)
                keys.append(np.full(len(sig), key, np.int64))
                held += len(sig)
                if held > 200_000:
                    yield _pairs(out, keys)
                    out, keys, held = [], [], 0
            if out:
                yield _pairs(out, keys)
    return run


def _pairs(out: list, keys: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(keys))],
                                      names=["sig", "node"])


def _set_rows(n: int):
    def run(batches):
        seen = set()
        for batch in batches:
            keys, sets, held = [], [], 0
            for _, s in ngram_sets(batch.column(0), n):
                if not len(s) or (key := fingerprint(s)) in seen:
                    continue
                seen.add(key)
                keys.append(key)
                sets.append(s.view(np.int64))
                held += len(s)
                if held > 500_000:
                    yield _lists(keys, sets)
                    keys, sets, held = [], [], 0
            if keys:
                yield _lists(keys, sets)
    return run


def _lists(keys: list, sets: list) -> pa.RecordBatch:
    sizes = [len(s) for s in sets]
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    marks = pa.array([sketch(s.view(np.uint64)) for s in sets], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), marks,
                                       pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets)))], names=["node", "size", "sketch", "s"])


def ngram_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_key, component_id) for each row of docs: documents whose sets
    of n-grams have a Jaccard similarity of at least percent / 100, and all they reach, carry
    the smallest id among them.

    A text of fewer than n words has its whole sequence as its only n-gram. A null, empty or
    blank text has an empty set, no set_key and is alone. Rows with a null id take part; their
    component is the smallest known id, else null. Repeated rows and ids stay as rows. Extra
    columns of docs are ignored. An empty table gives an empty result.

    Work at scale: the text is read for the fingerprints, for the signatures (one shuffle of
    two numbers for each, about a quarter of the n-grams) and for the sets of candidates. Equal
    sets are one node, so a group of copies adds no pairs; in a group of near copies every
    member meets one leader for each signature, and then only members of different components
    are compared, in blocks, and only pairs that their sketches allow become rows. Copies and hot leaders join on keys that can be split.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = staged(docs.mapInArrow(_profile(n), "doc_id long, n_shingles long, set_key long"), "profile")
    nodes = staged(rows.filter("set_key is not null").groupBy(F.col("set_key").alias("node")).agg(
        F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("size")), "nodes")
    shared = shared_signatures(docs, n, percent)
    sets = candidate_sets(docs, nodes, shared, n)
    first = shared.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    edges = staged(linked(possible(first, nodes, sets, percent), sets, percent), "links")
    rest = staged(linked(open_pairs(shared, components(edges), nodes, sets, percent), sets, percent), "links")
    roots = components(edges.unionByName(rest))
    rooted = staged(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    label = join_back(rooted, smallest, ["root"]).select(F.col("node").alias("set_key"), "component_id")
    alone = rows.filter("set_key is null").withColumn("component_id", F.col("doc_id"))
    return (join_back(rows.filter("set_key is not null"), label, ["set_key"])
            .unionByName(alone).select("doc_id", "n_shingles", "component_id", "set_key"))


def candidate_sets(docs: DataFrame, nodes: DataFrame, shared: DataFrame, n: int) -> DataFrame:
    """(node, size, sketch, s) of all nodes that share a signature with another one, one row each."""
    involved = staged(shared.select("node").distinct().join(nodes, "node"), "involved")
    ids = broadcast_if_small(involved.select("doc_id").filter("doc_id is not null").distinct())
    texts = docs.join(ids, "doc_id", "left_semi").select("text").unionByName(docs.filter("doc_id is null").select("text"))
    made = texts.mapInArrow(_set_rows(n), "node long, size long, sketch binary, s array<long>")
    return staged(made.dropDuplicates(["node"]), "sets")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, compared element by element."""
    left = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    both = pairs.distinct().join(left, "a").join(right, "b")
    na, nb = F.size("sa"), F.size("sb")
    common = F.size(F.array_intersect("sa", "sb"))
    return (both.filter(UNITS * F.least(na, nb) >= percent * F.greatest(na, nb))
            .filter(UNITS * common >= percent * (na + nb - common)).select("a", "b"))


def shared_signatures(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(sig, node, leader) for signatures of at least two nodes. The leader is the node that
    meets the most others over all signatures, so that it tends to be the same one."""
    by_sig = Window.partitionBy("sig")
    shared = (docs.select("text").mapInArrow(_signature_rows(n, percent), "sig long, node long")
              .withColumn("least", F.min("node").over(by_sig)).withColumn("most", F.max("node").over(by_sig))
              .filter("least <> most").select("sig", "node").distinct())
    shared = staged(shared.withColumn("n", F.count("node").over(by_sig)), "shared")
    meets = shared.groupBy("node").agg(F.sum("n").alias("meets"))
    leaders = (shared.join(meets, "node").groupBy("sig").agg(F.max_by("node", F.struct("meets", "node")).alias("leader")))
    return staged(join_back(shared.select("sig", "node"), leaders, ["sig"]).select("sig", "node", "leader"), "led")


def possible(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes, and then sketches, do not rule out."""
    def run(batches):
        for t in batches:
            keep = []
            for sa, ka, sb, kb in zip(*(t.column(i).to_pylist() for i in range(2, 6))):
                bins = min(len(ka), len(kb))
                keep.append(bool(near(folded([ka], bins)[0], sa, folded([kb], bins), np.array([sb]), percent)[0]))
            yield t.filter(pa.array(keep, pa.bool_())).select([0, 1])

    size = nodes.select("node", "size")
    fits = UNITS * F.least("sa", "sb") >= percent * F.greatest("sa", "sb")
    sized = (pairs.join(size.select(F.col("node").alias("a"), F.col("size").alias("sa")), "a")
             .join(size.select(F.col("node").alias("b"), F.col("size").alias("sb")), "b").filter(fits))
    both = (sized.join(sets.select(F.col("node").alias("a"), F.col("sketch").alias("ka")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("sketch").alias("kb")), "b"))
    return both.select("a", "b", "sa", "ka", "sb", "kb").mapInArrow(run, "a long, b long")


def open_pairs(shared: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a signature and that sizes and sketches do
    not rule out.

    A signature whose members have one root needs nothing. Otherwise all its members outside
    the largest component there meet the members of other components. Up to SMALL members are
    paired in their row, and a pair of several signatures is compared once. More are compared
    as blocks of about BLOCK members in arrays: only pairs that may be similar become rows,
    and a signature with very many members is many blocks.
    """
    now = shared.select("sig", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    now = staged(now, "rooted")
    kinds = now.groupBy("sig", "root").agg(F.count(F.lit(1)).alias("n"))
    main = (kinds.groupBy("sig").agg(F.max_by("root", F.struct("n", "root")).alias("main"),
                                     F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")).filter("kinds > 1").drop("kinds"))
    now = staged(join_back(now, main, ["sig"]).select("sig", "node", "root", "main", "total"), "open")
    odd = F.col("root") != F.col("main")
    few = now.filter(F.col("total") <= SMALL).groupBy("sig").agg(F.collect_list(F.struct("node", "root", odd.alias("odd"))).alias("m"))
    met = F.flatten(F.transform(F.filter("m", lambda x: x["odd"]), lambda x: F.transform(
        F.filter("m", lambda y: (x["root"] != y["root"]) & (~y["odd"] | (x["node"] < y["node"]))),
        lambda y: F.struct(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")))))
    paired = possible(few.select(F.explode(met).alias("p")).select("p.*").distinct(), nodes, sets, percent)
    now = now.filter(F.col("total") > SMALL).join(sets.select("node", "size", "sketch"), "node")
    many = F.ceil(F.col("total") / BLOCK)
    member = F.struct("node", "root", odd.alias("odd"), "size", "sketch")
    blocks = staged(now.groupBy("sig", F.pmod(F.xxhash64("node"), many).alias("block"))
                    .agg(F.collect_list(member).alias("m")), "blocks")
    seekers = blocks.select("sig", F.filter("m", lambda x: x["odd"]).alias("x")).filter(F.size("x") > 0)

    def run(batches):
        for t in batches:
            for k in range(t.num_rows):
                xs, ys = t.column(0)[k].as_py(), t.column(1)[k].as_py()
                bins = min(len(e["sketch"]) for e in (*xs, *ys))
                kx, ky = folded([e["sketch"] for e in xs], bins), folded([e["sketch"] for e in ys], bins)
                size, node, root = (np.array([e[c] for e in ys], np.int64) for c in ("size", "node", "root"))
                in_main = ~np.array([e["odd"] for e in ys], bool)
                a, b = [], []
                for e, kind in zip(xs, kx):
                    other = (root != e["root"]) & (in_main | (node > e["node"]))
                    if other.any():
                        at = np.flatnonzero(other)
                        hit = node[at[near(kind, e["size"], ky[at], size[at], percent)]]
                        a.extend([e["node"]] * len(hit))
                        b.extend(hit.tolist())
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    met = seekers.join(blocks.select("sig", F.col("m").alias("y")), "sig").select("x", "y").mapInArrow(run, "a long, b long")
    return paired.unionByName(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def without_near_copies(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of docs without those that are linked with a document of a smaller id. Columns
    stay as they are; texts without words and rows with a null id stay; rows with one id are
    one document."""
    groups = ngram_components(docs, n, percent, id_col, text_col)
    gone = staged(groups.filter("doc_id > component_id").select("doc_id").distinct(), "near-copies")
    return docs.join(broadcast_if_small(gone.withColumnRenamed("doc_id", "_gone")), F.col(id_col) == F.col("_gone"), "left_anti")
