"""The registered queries themselves on tables with nulls, repeated rows, ties and clashing names."""

import hashlib

import pytest
from llm_tables import documents  # noqa: F401
from patronage.llm.queries import QUERIES
from pyspark.sql import types as T

LONG = " ".join(f"word{i}" for i in range(60))
PAGES = "page_id long, url string, html string, record_id string, size int, digest string, value string"


@pytest.fixture
def folder(spark, tmp_path):
    def make(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make


def test_pages(spark, folder):
    """Null ids: an empty record id in the archive, a null page_id in the result."""
    big = "x" * 1500
    rows = [(None, None, big), (None, "u", big), (1, "u", big), (7, "u", big), (7, "u", big), (2, "u", None), (None, "u", None), (None, "u", "y" * 2000), (3, "u", ""), (4, "u", "é" * 500)]
    pages = spark.createDataFrame([(*r, "r", 1, "d", "v") for r in rows], PAGES)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in QUERIES["op4_warc_normalise"](spark, folder(pages=pages)).collect()), key=repr)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    again = lambda i, t: t == big and i != 7
    assert got == sorted(((i, len((t or "").encode()), sha(t), "revisit" if again(i, t) else "response", 7 if again(i, t) else None) for i, _, t in rows), key=repr)


def test_no_pages(spark, folder):
    assert QUERIES["op4_warc_normalise"](spark, folder(pages=spark.createDataFrame([], PAGES))).count() == 0


def removed(rows, key):
    """n_removed by brute force; key orders the documents."""
    first, out = {}, []
    own = [(key(d, t), d, (t or "").split()) for d, t in rows]
    for k, _, w in own:
        for i in range(len(w) - 19):
            at = tuple(w[i:i + 20])
            first[at] = min(first.get(at, (k, i)), (k, i))
    for k, d, w in own:
        gone = set()
        for i in range(len(w) - 19):
            if first[tuple(w[i:i + 20])] < (k, i):
                gone |= set(range(i, i + 20))
        out.append((d, len(w), len(gone)))
    return sorted(out, key=repr)


def test_repeats_with_null_ids(spark, folder, documents):
    """Null ids are documents of their own, in the order of a hash of the text, after all others."""
    tail = " ".join(f"other{i}" for i in range(40))
    rows = [(None, LONG), (None, "a b c " + LONG), (None, "a b c " + LONG), (None, LONG + " " + tail), (5, tail), (None, None), (None, ""), (None, "x " + tail),
            (9, LONG[:200]), (2 ** 63 - 1, "z " + tail), (5, tail), (None, LONG + "\n" + LONG)]
    hashes = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").selectExpr("t", "(xxhash64(t) & 9223372036854775807L) | 1 as h").collect()}
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in QUERIES["op9_substring_dedup"](spark, folder(documents=documents(rows))).collect()), key=repr)
    assert got == removed(rows, lambda d, t: (2 ** 63 - 1, hashes[t or ""]) if d is None else (d, 0))


def test_two_null_ids(spark, folder, documents):
    rows = [(None, LONG), (None, "a b c " + LONG)]
    got = sorted(r.n_removed for r in QUERIES["op9_substring_dedup"](spark, folder(documents=documents(rows))).collect())
    assert got == [0, 60]


def test_conversations(spark, folder):
    """Null ids, turns, roles and texts: the query and its SQL give the same rows."""
    import duckdb
    from patronage.llm.queries import ORACLES
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (1, None, None, "no role"), (None, 0, "user", "alone"), (None, 1, "assistant", "alone"), (None, 0, "user", "alone"),
            (2, 0, "assistant", "<|im_end|> <\\|x"), (2, 0, "assistant", "same turn"), (3, 1, "", "")]
    path = folder(conversations=spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, turns string, n long"))
    got = QUERIES["op3_chat_format"](spark, path).collect()
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}/conversations.parquet/*.parquet'")
    cur = con.execute(ORACLES["op3_chat_format"])
    names = [d[0] for d in cur.description]
    assert sorted((tuple(r[c] for c in names) for r in got), key=repr) == sorted(cur.fetchall(), key=repr)
    assert len(got) == 7
