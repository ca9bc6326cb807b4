"""SimHash fingerprints and their near copies by meet-in-the-middle ball hashing.

Two fingerprints at distance 2 both lie at distance 1 from a third one, so if each emits its ball
of radius 1, the two balls meet and the shuffle brings the pair together. Links reach to distance
3, which has no whole half. Two exact forms bring it down:

* `_masked`: cut the 64 bits into three fields. Some field holds at least one of three differing
  bits, so with that field masked the distance is at most 2 and balls of radius 1 meet. 131
  variants for each fingerprint, at most 43 fixed bits; pairs that meet are verified on all bits.
* `_ball`: whole fingerprints that differ in three bits have unlike parities, and two of the three
  bits lie in the same half of the word. Even ones emit radius 1, odd ones radius 1 and the pairs
  of bits within a half. Whoever meets at a variant of radius 1 is linked, without verification.

The first form is cheap but many fingerprints may agree under a mask. Variants of more than CROWD
members are not paired: their members go to the second form, in which every member of a variant
is linked with one leader there, so that no group becomes pairs, whatever its size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..operators.skew import join_back
from .components import components
from .staging import staged
from .words import mix

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
SEED = 42
RADIUS = 3
FIELDS = ((0, 21), (21, 42), (42, 64))  # bits from, to
CROWD = 32         # members of one masked variant that are compared with each other
SLICE = 1 << 16    # shingles whose bits are counted at once
ROWS = 200_000     # variants of one batch


def shingle_hashes(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of k lower-cased words, joined by blanks; of all words if they are fewer."""
    own = (text or "").encode().lower().split()  # bytes: A-Z only, and blanks of ASCII only
    if not own:
        return np.zeros(0, np.uint64)
    k = min(k, len(own))
    plain = b" ".join(own)
    size = np.fromiter(map(len, own), np.int64, len(own))
    end = np.cumsum(size + 1) - 1
    begin = (end - size)[:len(own) - k + 1]
    return np.fromiter((xxhash.xxh64_intdigest(plain[a:b], SEED) for a, b in zip(begin.tolist(), end[k - 1:].tolist())), np.uint64, len(begin))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes, as a signed number; zero without hashes."""
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SLICE):
        part = np.ascontiguousarray(hashes[i:i + SLICE]).view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view(np.int64)[0])


def _fingerprints(batches):
    for b in batches:
        texts = b.column(1)
        marks = [fingerprint(shingle_hashes(texts[i].as_py())) for i in range(len(texts))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks, pa.int64())], names=["doc_id", "mark"])


def masked_variants(marks: np.ndarray) -> np.ndarray:
    """A row for each fingerprint: hashes of its balls of radius 1 under each mask."""
    out = []
    for number, (low, high) in enumerate(FIELDS):
        mask = np.uint64((1 << 64) - (1 << high) + (1 << low) - 1)
        flips = np.array([0] + [1 << j for j in range(64) if not low <= j < high], np.uint64)
        out.append(mix(((marks & mask)[:, None] ^ flips) + np.uint64(number * 0x632BE59BD9B4E019 & (2 ** 64 - 1))))
    return np.concatenate(out, axis=1)


ONE = np.array([0] + [1 << j for j in range(64)], np.uint64)
TWO = np.array([1 << i | 1 << j for half in (0, 32) for i in range(half, half + 32) for j in range(half, i)], np.uint64)


def _rows(keys: np.ndarray, marks: np.ndarray, **more) -> pa.RecordBatch:
    held = {"key": keys.ravel().view(np.int64), "mark": np.repeat(marks.view(np.int64), keys.shape[1]), **more}
    return pa.RecordBatch.from_arrays([pa.array(v) for v in held.values()], names=list(held))


def _masked(batches):
    for b in batches:
        marks = b.column(0).to_numpy().view(np.uint64)
        step = ROWS // 131
        for i in range(0, len(marks), step):
            yield _rows(masked_variants(marks[i:i + step]), marks[i:i + step])


def _ball(batches):
    for b in batches:
        marks = b.column(0).to_numpy().view(np.uint64)
        odd = np.bitwise_count(marks) % 2 == 1
        for flips, own, far in ((ONE, marks, False), (TWO, marks[odd], True)):
            step = ROWS // len(flips)
            for i in range(0, len(own), step):
                part = own[i:i + step]
                yield _rows(part[:, None] ^ flips, part, far=np.full(len(part) * len(flips), far))


def _whole_runs(batches, names: list[str], keep: int) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first one, in pieces that end where its value changes. A
    run of more than `keep` rows comes in pieces that each repeat its first rows; so a piece
    of a long run is never shorter than `keep` rows."""
    held = [np.zeros(0, np.int64)] * len(names)
    for b in batches:
        now = [np.concatenate([h, b.column(c).to_numpy(zero_copy_only=False)]) for h, c in zip(held, names)]
        if not len(now[0]):
            continue
        last = int(np.searchsorted(now[0], now[0][-1]))
        if last:
            yield [c[:last] for c in now]
        held = [c[last:] for c in now]
        if len(held[0]) > keep:
            yield held
            held = [c[:keep] for c in held]
    if len(held[0]):
        yield held


def _links(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
    right = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
    return pa.RecordBatch.from_arrays([pa.array(a), right], names=["a", "b"])


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= RADIUS


def _meet(batches):
    """Verified pairs of the members of one variant; (member, null) for those of a crowd."""
    for key, mark in _whole_runs(batches, ["key", "mark"], CROWD + 1):
        _, of, size = np.unique(key, return_inverse=True, return_counts=True)
        crowd = size[of] > CROWD
        if crowd.any():
            yield _links(np.unique(mark[crowd]), None)
        use = ~crowd & (size[of] > 1)
        key, mark = key[use], mark[use]
        for d in range(1, CROWD):
            at = np.flatnonzero(key[d:] == key[:-d]) if len(key) > d else np.zeros(0, np.int64)
            if not len(at):
                break
            a, b = mark[at], mark[at + d]
            near = close(a, b) & (a != b)
            if near.any():
                yield _links(a[near], b[near])


def _lead(batches):
    """(leader, member) of each variant: rows of radius 1 come first, and the first row leads."""
    for key, far, mark in _whole_runs(batches, ["key", "far", "mark"], 1):
        first = np.searchsorted(key, key)
        led = ~far[first].astype(bool) & (mark[first] != mark)
        a, b = mark[first][led], mark[led]
        near = close(a, b)
        if near.any():
            yield _links(a[near], b[near])


def fingerprint_links(marks: DataFrame) -> DataFrame:
    """(a, b): links whose closure is that of all pairs of the distinct fingerprints `mark` that
    differ in RADIUS bits at most. Every pair of them is linked directly or, in a crowd, over leaders."""
    met = staged(marks.mapInArrow(_masked, "key long, mark long").repartition("key").sortWithinPartitions("key", "mark")
                 .mapInArrow(_meet, "a long, b long").distinct(), "met")
    crowd = met.filter("b is null").select(F.col("a").alias("mark"))
    led = (crowd.mapInArrow(_ball, "key long, mark long, far boolean").repartition("key").sortWithinPartitions("key", "far", "mark")
           .mapInArrow(_lead, "a long, b long"))
    return met.filter("b is not null").unionByName(led)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs: documents whose fingerprints
    differ in at most three bits, and all they reach, carry the smallest id among them.

    Null, empty and blank texts have fingerprint zero, which links like any other; a text of one
    or two words has one shingle. Rows with a null id take part; their component is the smallest
    known id, else null. Repeated rows and ids stay as rows, other columns are ignored, and an
    empty table gives an empty result. Equal fingerprints are one node before any variant is formed.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = staged(docs.mapInArrow(_fingerprints, "doc_id long, mark long"), "marks")
    nodes = staged(rows.groupBy("mark").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(fingerprint_links(nodes.select("mark")))
    rooted = staged(nodes.join(roots.withColumnRenamed("node", "mark"), "mark", "left").withColumn("root", F.coalesce("root", "mark")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    label = join_back(rooted.select("mark", "root"), smallest, ["root"]).select("mark", "component_id")
    return join_back(rows, label, ["mark"]).select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")
