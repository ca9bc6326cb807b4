"""Removal of repeated passages with FM-indexes of shards.

A window is n consecutive words; words of windows that also start earlier in the corpus go.
To compare every document with every shard would be quadratic, so text is routed by content:
the smallest hash of the short word runs in a window (its anchor) depends on the window alone,
equal windows have equal anchors, and neighbouring windows mostly share theirs. Stretches of
windows with one anchor go to the anchor's shard, where all equal windows meet. Anchors that
occur once in the corpus cannot hold a repeated window and are left out before any text moves.

A shard indexes its stretches in corpus order and streams them through its own index:
backward search gives the matching statistics, and of runs that reach n words the earliest
place is located. Equal stretches are collapsed to the earliest before, and documents with
equal word sequences to the first of them, so that copies never meet in one task.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..operators.sizing import broadcast_if_small
from ..operators.skew import join_back
from .fm_index import earlier_windows
from .staging import staged
from .words import chunks, mix, runs, words

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 20
ANCHOR = 8              # words of the runs whose smallest hash is the anchor
LONGEST = 64            # windows of a stretch
SHARD_WORDS = 400_000   # words of a shard
HOT = 300_000           # an anchor whose stretches hold more words sends each window to a key of its own
LAST_ID = 2 ** 63 - 1   # stands for a null id: later than every other
DOC = ["doc_id", "sub"]  # a document: rows of one id, or of a null id and one text
NOTHING = hashlib.sha256(b"").hexdigest()


def sequence_key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def _profile(batches):
    for b in batches:
        for lo, hi, piece in chunks(b.column(1)):
            n, key, sha = [], [], []
            for text in piece.to_pylist():
                own = text.encode().split()
                digest = hashlib.sha256(b" ".join(own))
                n.append(len(own))
                key.append(sequence_key(digest.digest()))
                sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(key, pa.int64()),
                                              pa.array(sha, pa.string())], names=["doc_id", "sub", "n_words", "seq", "all_sha256"])


def stretches(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor) of the stretches in the words of a chunk; doc says whose they are."""
    none = np.zeros(0, np.int64)
    if len(hashes) < n:
        return none, none, none.astype(np.uint64)
    k = min(ANCHOR, n)
    g = runs(hashes, k)
    span = n - k + 1
    low, size = g, 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[:len(low) - (span - size)], low[span - size:])
    whole = doc[:len(low)] == doc[n - 1:]
    fresh = whole & np.concatenate([[True], ~whole[:-1] | (low[1:] != low[:-1])])
    at = np.flatnonzero(whole)
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(low)), 0))
    fresh |= whole & ((np.arange(len(low)) - begin) % LONGEST == 0)
    starts = np.flatnonzero(fresh)
    return starts, np.diff(np.searchsorted(at, np.append(starts, len(low)))), low[starts]


def _both(doc: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return mix(anchor ^ mix(doc.astype(np.uint64)))


def near_repeats(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Document and run, as one hash, of runs that occur again so soon in the same document
    that both places may be in one stretch."""
    k = min(ANCHOR, n)
    g = runs(hashes, k)
    again = np.zeros(len(g), bool)
    for d in range(1, n - k + 2):
        again[:-d] |= g[d:] == g[:-d]
    at = np.flatnonzero(again)
    return _both(doc[at], g[at])


def _anchor_rows(n: int):
    def run(batches):
        for b in batches:
            for lo, hi, piece in chunks(b.column(1)):
                w = words(piece)
                ids, subs = (b.column(c).slice(lo, hi - lo).to_numpy(zero_copy_only=False) for c in (0, 2))
                doc = np.repeat(np.arange(len(w)), np.diff(w.first))
                start, count, anchor = stretches(w.hashes, doc, n)
                if not len(start):
                    continue
                own = doc[start]
                order = np.lexsort((anchor, own))
                own, anchor, size = own[order], anchor[order], (count + n - 1)[order]
                fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (anchor[1:] != anchor[:-1])])
                at = np.flatnonzero(fresh)
                pieces = np.diff(np.append(at, len(own)))
                own_at, anchor_at = own[at], anchor[at]
                twice = (pieces > 1) | np.isin(_both(own_at, anchor_at), near_repeats(w.hashes, doc, n))
                yield pa.RecordBatch.from_arrays([pa.array(anchor_at.view(np.int64)), pa.array(ids[own_at].astype(np.int64)), pa.array(subs[own_at].astype(np.int64)),
                                                  pa.array(np.where(twice, 2, 1).astype(np.int64)), pa.array(np.add.reduceat(size, at))],
                                                 names=["anchor", "doc_id", "sub", "n", "words"])
    return run


def _stretch_rows(n: int):
    def run(batches):
        sent = set()
        for b in batches:
            texts, base = b.column(1), 0
            for lo, hi, piece in chunks(texts):
                ids = list(zip(*(b.column(c).slice(lo, hi - lo).to_pylist() for c in (0, 2))))
                firsts = b.column(3).slice(lo, hi - lo).to_pylist()
                known = _flat(b.column(4), lo, hi)
                hot = _flat(b.column(5), lo, hi)
                yield from _chunk_stretches(piece, ids, firsts, known, hot, n, sent)
    return run


def _flat(column: pa.Array, lo: int, hi: int) -> np.ndarray:
    return np.unique(column.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def _chunk_stretches(piece, ids, firsts, known, hot, n, sent):
    w = words(piece)
    doc = np.repeat(np.arange(len(w)), np.diff(w.first))
    start, count, anchor = stretches(w.hashes, doc, n)
    use = np.isin(anchor, known)
    start, count, anchor = start[use], count[use], anchor[use]
    is_hot = np.isin(anchor, hot)
    out: dict[str, list] = {k: [] for k in ("key", "h", "doc_id", "sub", "seq", "start", "n", "seg", "again")}
    plain, begins, ends = w.normal()
    begins, ends, first_word, doc = begins.tolist(), ends.tolist(), w.first.tolist(), doc.tolist()
    keys, marks, docs, subs, seqs, places, sizes, segs, agains = out.values()
    last, seq, within = -1, 0, set()
    for s, c, a, h in zip(start.tolist(), count.tolist(), anchor.view(np.int64).tolist(), is_hot.tolist()):
        d = doc[s]
        if d != last:
            last, within = d, set()
            seq = sequence_key(hashlib.sha256(plain[begins[first_word[d]]:ends[first_word[d + 1] - 1]]).digest())
        if seq not in firsts[d]:
            continue  # an earlier document has the same words
        for s, size in ([(x, n) for x in range(s, s + c)] if h else [(s, c + n - 1)]):
            seg = plain[begins[s]:ends[s + size - 1]]
            mark = int.from_bytes(hashlib.blake2b(seg, digest_size=8).digest(), "big", signed=True)
            again = mark in within
            within.add(mark)
            new = not again and mark not in sent
            if new:
                if len(sent) > 2_000_000:
                    sent.clear()
                sent.add(mark)
            keys.append(mark if h else a)
            marks.append(mark)
            docs.append(ids[d][0])
            subs.append(ids[d][1])
            seqs.append(seq)
            places.append(s - first_word[d])
            sizes.append(size)
            segs.append(seg if new else None)
            agains.append(again)
    if out["key"]:
        kinds = (*[pa.int64()] * 6, pa.int32(), pa.binary(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


STRETCH = "key long, h long, doc_id long, sub long, seq long, start long, n int, seg binary, again boolean"
SPAN = "doc_id long, sub long, seq long, low long, high long"


def _search(n: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("sub", "ascending"), ("start", "ascending")])
        segs = [s.split(b" ") for s in table.column("seg").to_pylist()]
        # the only stretch of its anchor meets no other; it is searched if it may repeat itself
        key = table.column("key").to_numpy()
        _, of, many = np.unique(key, return_inverse=True, return_counts=True)
        use = np.flatnonzero([m > 1 or n < 3 or len(set(zip(s, s[1:], s[2:]))) < len(s) - 2 for m, s in zip(many[of].tolist(), segs)])
        table, segs = table.take(pa.array(use)), [segs[i] for i in use]
        if not segs:
            return pa.table({c: pa.array([], pa.int64()) for c in (*DOC, "seq", "low", "high")})
        codes: dict[bytes, int] = {}
        sizes = np.array([len(s) for s in segs], np.int64)
        flat = np.fromiter((codes.setdefault(x, len(codes) + 1) for s in segs for x in s), np.int64, int(sizes.sum()))
        at = np.concatenate([[0], np.cumsum(sizes + 1)])
        text = np.zeros(at[-1], np.int64)
        inside = np.ones(at[-1], bool)
        inside[at[1:] - 1] = False
        text[inside] = flat
        count = np.maximum(sizes - n + 1, 0)
        of = np.repeat(np.arange(len(segs)), count)
        offset = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        hit = earlier_windows(text, at[of] + offset, n)
        of, offset = of[hit], offset[hit]
        # windows that follow each other are one interval
        fresh = np.concatenate([[True], (of[1:] != of[:-1]) | (offset[1:] != offset[:-1] + 1)])[:len(of)]
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(of)) - 1 if len(of) else first
        doc, sub, seq, start = (table.column(c).to_numpy() for c in (*DOC, "seq", "start"))
        return pa.table({"doc_id": pa.array(doc[of[first]], pa.int64()), "sub": pa.array(sub[of[first]], pa.int64()), "seq": pa.array(seq[of[first]], pa.int64()),
                         "low": pa.array(start[of[first]] + offset[first], pa.int64()), "high": pa.array(start[of[last]] + offset[last] + n, pa.int64())})
    return run


def _cut_rows(batches):
    for b in batches:
        for lo, hi, piece in chunks(b.column(1)):
            ids, subs, marks = (b.column(c).slice(lo, hi - lo).to_pylist() for c in (0, 2, 3))
            out = []
            for doc_id, sub, text, parts in zip(ids, subs, piece.to_pylist(), marks):
                own = text.encode().split()
                seq = sequence_key(hashlib.sha256(b" ".join(own)).digest())
                keep = np.ones(len(own), bool)
                for p in parts:
                    if p["seq"] == seq:
                        keep[p["low"]:p["high"]] = False
                kept = b" ".join(x for x, k in zip(own, keep) if k)
                out.append((doc_id, sub, seq, int((~keep).sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 4, pa.string(), pa.string()))],
                                             names=["doc_id", "sub", "seq", "n_removed", "kept_sha256", "kept"])


CUT = "doc_id long, sub long, seq long, n_removed long, kept_sha256 string, kept string"


def repeated_spans(docs: DataFrame, profile: DataFrame, n: int) -> DataFrame:
    """(doc_id, sub, seq, low, high): word ranges to remove from documents that are the first with
    their word sequence. docs: (doc_id, text, sub)."""
    firsts = staged(profile.filter(F.col("n_words") >= n).groupBy("seq").agg(F.min(F.struct(*DOC)).alias("d")).select("d.*", "seq"), "firsts")
    # anchors that occur at least twice, and how many words their stretches have
    anchors = docs.mapInArrow(_anchor_rows(n), "anchor long, doc_id long, sub long, n long, words long")
    often = staged(anchors.groupBy("anchor").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).filter("n >= 2").drop("n"), "anchors")
    found = anchors.select("anchor", *DOC).join(often, "anchor")
    by_doc = (found.groupBy(*DOC).agg(F.collect_list("anchor").alias("known"),
                                      F.collect_list(F.when(F.col("words") > HOT, F.col("anchor"))).alias("hot")))
    first_seqs = firsts.groupBy(*DOC).agg(F.collect_set("seq").alias("firsts"))
    wanted = staged(by_doc.join(first_seqs, DOC).select(*DOC, "firsts", "known", "hot"), "wanted")
    parts = staged(docs.join(wanted, DOC).select("doc_id", "text", "sub", "firsts", "known", "hot")
                   .mapInArrow(_stretch_rows(n), STRETCH), "stretches")
    earliest = F.struct(*DOC)
    first = staged(parts.filter(~F.col("again")).groupBy("key", "h").agg(
        F.min(earliest).alias("d"), F.min_by("start", earliest).alias("start"), F.min_by("seq", earliest).alias("seq"),
        F.max("n").alias("n"), F.first("seg", ignorenulls=True).alias("seg")).select("key", "h", "d.*", "start", "seq", "n", "seg"), "first-stretches")
    # every later occurrence of a stretch goes as a whole
    place = first.select("key", "h", F.struct(*DOC).alias("d"))
    whole = (parts.select("key", "h", *DOC, "seq", "start", "n", "again").join(place, ["key", "h"])
             .filter(F.col("again") | (earliest != F.col("d")))
             .select(*DOC, "seq", F.col("start").alias("low"), (F.col("start") + F.col("n")).alias("high")))
    total = first.agg(F.sum("n")).first()[0] or 0
    shard = F.pmod(F.xxhash64("key"), F.lit(max(1, -(-total // SHARD_WORDS))))
    inner = (first.select("key", *DOC, "seq", "start", "seg", shard.alias("shard")).groupBy("shard").applyInArrow(_search(n), SPAN))
    # written one after the other: a shard takes much longer than a part of the join
    return staged(whole, "whole").unionByName(staged(inner, "inner"))


def without_repeats(docs: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) for each row of docs: every word goes
    that lies in a window of n words whose words also start earlier, in a document with a
    smaller id or earlier in the same one. `kept` is null where the text stays as it is or
    goes as a whole.

    Null, empty and blank texts have no words; texts under n words lose none. Rows with one id
    are one document, and rows with equal id and words do not remove each other. Rows with a
    null id are later than all others and each is a document of its own, in the order of a
    hash of their texts; only those with the same text count as one. Other columns are ignored,
    an empty table stays empty. Texts are read whole.
    """
    known = F.col(id_col).isNotNull()
    text = F.col(text_col).cast("string")
    sub = F.when(known, F.lit(0)).otherwise(F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(LAST_ID)).bitwiseOR(F.lit(1)))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc_id"), text.alias("text"), sub.cast("long").alias("sub"))
    profile = staged(rows.mapInArrow(_profile, "doc_id long, sub long, n_words long, seq long, all_sha256 string"), "words")
    by_doc = staged(repeated_spans(rows, profile, n).groupBy(*DOC).agg(F.collect_list(F.struct("seq", "low", "high")).alias("parts")), "parts")
    ids = broadcast_if_small(by_doc.select(*DOC))
    cut = staged(rows.join(ids, DOC, "left_semi").join(by_doc, DOC).select("doc_id", "text", "sub", "parts")
                 .mapInArrow(_cut_rows, CUT).dropDuplicates([*DOC, "seq"]), "cut")
    first = profile.filter(F.col("n_words") >= n).groupBy("seq").agg(F.min(F.struct(*DOC)).alias("first"))
    out = join_back(profile, first, ["seq"], "left").join(cut, [*DOC, "seq"], "left")
    copy = F.coalesce(F.struct(*DOC) != F.col("first"), F.lit(False))
    return out.select(
        F.when(F.col("sub") == 0, F.col("doc_id")).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, NOTHING).otherwise(F.coalesce("kept_sha256", "all_sha256")).alias("kept_sha256"),
        F.when(~copy, F.col("kept")).alias("kept"))
