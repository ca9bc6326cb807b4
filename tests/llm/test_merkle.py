"""The distributed tree against a plain one over the whole list."""

import zlib
from hashlib import sha256

import pytest
from llm_tables import documents  # noqa: F401
from patronage.llm import merkle


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def tree(nodes):
    """(root, siblings of each node by level)"""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, a in enumerate(at):
            run = level[a - a % 3:a - a % 3 + 3]
            paths[i].append((run[:a % 3], run[a % 3 + 1:]))
        at = [a // 3 for a in at]
        level = [digest(*level[i:i + 3]) for i in range(0, len(level), 3)]
    return (level or [None])[0], paths


def fold(d, path):
    for left, right in path:
        d = digest(*left, d, *right)
    return d


def plain(rows):
    sources, out = {}, []
    for r in rows:
        sources.setdefault(r.source, []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s] = sorted(((leaf(r, r.text), r) for r in sources[s]), key=lambda x: (x[1].doc_id is not None, x[1].doc_id or 0, x[0]))
    trees = [tree([d for d, _ in sources[s]]) for s in names]
    root, above = tree([t[0] for t in trees])
    for s, (subroot, paths), top in zip(names, trees, above):
        for (d, r), path in zip(sources[s], paths):
            path = path + top
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and r.text is not None
            folded = fold(leaf(r, r.text.replace("\n", "")) if tampered else d, path)
            out.append((r.doc_id, d, subroot, root, digest(*(x for left, right in path for x in left + right)), folded, folded == root))
    return sorted(out, key=repr)


def result(docs):
    return sorted((tuple(r) for r in merkle.audited(merkle.manifest(merkle.document_leaves(docs))).collect()), key=repr)


def rows(n):
    out = [(i, f"line {i}\nand more\n" if i % 3 else f"text {i}", "big") for i in range(n)]
    out += [(1000 + i, "a\nb", f"host{i}") for i in range(14)] + [(2000 + i, "x\n", "mid") for i in range(12)]
    return out + [(None, "a\nb", "big"), (None, None, None), (5, "line", "big"), (5, "line", "big"), (7, "", None), (8, "\n", "ü")]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_equals_plain_tree(spark, documents, monkeypatch, levels):
    """With blocks of 3 and 9 leaves the tree is built in several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** levels)
    docs = documents(rows(60)).repartition(5)
    got = result(docs)
    assert got == plain(docs.collect())
    assert {r[6] for r in got} == {True, False}


def test_groups(spark, documents):
    docs = documents([(1, "a", "s"), (2, "b", "s"), (3, "c", "t")])
    m = merkle.manifest(merkle.document_leaves(docs))
    got = {r.group: r for r in m.groups.collect()}
    leaves = {r.doc_id: leaf(r, r.text) for r in docs.collect()}
    assert got["t"].subroot == leaves[3] and got["t"].n_leaves == 1  # a lone leaf is its subroot
    assert got["s"].subroot == digest(leaves[1], leaves[2]) and got["s"].root == digest(got["s"].subroot, got["t"].subroot)


def test_one_row_and_none(spark, documents):
    assert result(documents([])) == []
    (only,) = result(documents([(4, "one", "s")]))
    assert only[1] == only[2] == only[3] == only[5] and only[4] == digest()
    assert result(documents([(None, None, None)]))[0][6]


def test_states_are_kept_per_slot():
    sub = merkle.Subtree([str(i).encode() * 8 for i in range(7)], 2)
    for slot in range(7):
        changed = [b"x" if i == slot else str(i).encode() * 8 for i in range(7)]
        assert sub.fold(slot, b"x") == merkle.Subtree(changed, 2).root
        assert sub.fold(slot, str(slot).encode() * 8) == sub.root
