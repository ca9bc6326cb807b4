"""Benchmark leaks: exact, in other case, with other numbers and names, and near misses."""

import numpy as np
import pyarrow as pa

from llm_tables import documents  # noqa: F401
from patronage.llm import decontaminate as dc
from patronage.llm.words import runs

ITEMS = [
    (1, "Alice has 12 apples and gives 5 apples to Bob on 3 days. How many apples has Alice left after 3 days of this?"),
    (2, "A train drives 60 km in 2 hours, how far will the same train drive in 7 hours at this speed?"),
    (3, "short item of five words"),
    (4, "the quick brown fox jumps over the lazy dog while the old cat sleeps below the warm stove"),
    (5, None), (6, ""), (7, "1 2 3 4 5 6 7 8 9 10 11 12"), (4, "the quick brown fox jumps over the lazy dog while the old cat sleeps below the warm stove"),
]
FILL = "some clean words before it and "


def found(spark, documents, rows, items=ITEMS):
    items = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'z' as doc_id", "1 as h")
    return {(r.doc_id, r.item_id): r for r in dc.leaks(documents(rows), items).collect()}


def test_leaks(spark, documents):
    t = {i: x for i, x in ITEMS}
    rows = [
        (10, FILL + t[1] + " more"), (11, t[4].upper()), (12, t[4].replace(" ", "\n")), (13, FILL + t[3] + " tail"),
        (14, t[2].replace("60", "95").replace("2 hours", "4 hours").replace("7", "9")),
        (15, t[1].replace("Bob", "Eve").replace("12", "700").replace("5", "41")),
        (16, t[1].replace("to Bob", "to Bob and Carol Jones Smith")),
        (20, " ".join(t[4].split()[:9])),                      # under half of the item
        (21, "clean text about foxes and dogs and a cat"), (22, None), (23, ""), (24, "12 13 14 15 16 17 18 19 20 21 22 23 24"),
        (25, "filler " * 30_000 + t[4]), (11, t[4]), (None, t[4]),
        # a copy with one other number: the windows without it are the item's own
        (26, "Alice has 12 apples and gives 5 apples to Bob on 3 days. How many apples has Alice left after 4 days of this?"),
    ]
    got = found(spark, documents, rows)
    assert set(got) == {(10, 1), (11, 4), (12, 4), (13, 3), (14, 2), (15, 1), (16, 1), (25, 4), (26, 1)}
    assert got[10, 1].coverage == 1 and got[10, 1].n_changed == 0
    assert got[14, 2].n_changed == 3 and got[15, 1].n_changed == 3


def test_unicode_case(spark, documents):
    item = [(1, "La éai éonleeau pour an éonqueê aivi ai éenaitreoiaux éoiré anvitre èenreré")]
    assert set(found(spark, documents, [(1, FILL + item[0][1].upper())], item)) == {(1, 1)}


def test_empty(spark, documents):
    assert found(spark, documents, []) == {} and found(spark, documents, [(1, "text")], []) == {}


def test_bit_table_only_helps(spark, documents, monkeypatch):
    """A table that lets everything pass gives the same rows."""
    rows = [(10, FILL + ITEMS[3][1]), (11, "clean words only in this one and nothing else at all")]
    want = found(spark, documents, rows)
    monkeypatch.setattr(dc, "FILTER_BITS", 4)
    assert found(spark, documents, rows) == want


def test_windows_are_all_windows():
    t = np.arange(20, dtype=np.uint64)
    h, good = dc.windows(t, np.zeros(20, bool), 8)
    assert len(h) == 13 and good.all() and (h == runs(t, 8, salt=8)).all()


def test_templates():
    forms = list(dc.templates(pa.array(["He paid 3.50 dollars to New York, then 12kg. Then Anna left"], pa.large_string())))
    assert len(forms) == 2
    (_, names, values, slots), (_, plain, _, _) = forms
    assert len(values) == len(names) == len(slots)
    assert (names == dc.NUMBER).sum() == 2 and (names == dc.UNIT).sum() == 2 and (names == dc.NAME).sum() == 2
    assert not (plain == dc.NAME).any()


def test_names_that_open_sentences(spark, documents):
    """A changed name is met where it starts a sentence, too."""
    item = [(1, "Tom has 5 apples and 3 pears. Tom gives 2 apples to Ann.")]
    rows = [(1, "Read this. " + item[0][1].replace("Tom", "Sam")), (2, FILL + item[0][1].replace("Tom", "Sam").replace("Ann", "Mary Lee") + " Next one"),
            (3, item[0][1].replace("apples", "plums").replace("pears", "nuts"))]
    got = found(spark, documents, rows, item)
    assert set(got) == {(1, 1), (2, 1)} and got[1, 1].n_changed == 1


def test_each_form_has_its_own_coverage(spark, documents):
    """An item of long names whose names are all replaced is covered in full by the form without them."""
    text = ("Did Anna Maria Lopez Garcia and Juan Carlos Perez Ruiz meet Elena Sofia Torres Diaz near the old bridge "
            "in San Jose del Cabo today")
    other = text
    for a, b in (("Anna Maria Lopez Garcia", "Eve Smith"), ("Juan Carlos Perez Ruiz", "Tom Lee Brown"), ("Elena Sofia Torres Diaz", "Mary"),
                 ("San Jose", "Santa Rosa"), ("Cabo", "Mar")):
        other = other.replace(a, b)
    got = found(spark, documents, [(1, other), (2, "Did Eve and Tom Lee go to see the old bridge in Santa Rosa del Mar today")], [(1, text)])
    assert set(got) == {(1, 1)} and got[1, 1].coverage == 1 and got[1, 1].n_changed == 5


def test_slots_follow_the_majority(spark, documents):
    """One value for two slots is a leak, and one odd value costs the windows over it only."""
    train = ITEMS[1][1]
    three = "Put 3 red balls into the first box and 3 blue balls into the second box and then 3 green balls into the last of all boxes"
    rows = [(1, train.replace("2 hours", "4 hours").replace("7", "4")), (2, three.replace("3 green", "4 green")),
            (3, three.replace("3", "8").replace("8 green", "9 green")),
            (4, three.replace("3 red", "5 red").replace("3 blue", "6 blue").replace("3 green", "7 green"))]
    got = found(spark, documents, rows, [ITEMS[1], (9, three)])
    assert set(got) == {(1, 2), (2, 9), (3, 9)}
    assert got[1, 2].coverage == 1 and got[1, 2].n_changed == 2
    assert got[2, 9].n_changed == 0 and got[3, 9].n_changed == 1 and got[2, 9].n_windows == got[3, 9].n_windows


def test_copies_of_items_of_numbers(spark, documents):
    """Items with too few literals for a template are found as they are, and only so."""
    items = [(1, "What is 12 + 7?"), (2, "Add 3 km to 5 km and 7 km"), ITEMS[6]]
    rows = [(1, FILL + "what is 12 + 7? Tell me"), (2, "Please ADD 3 km to 5 km and 7 km now"), (3, "count 1 2 3 4 5 6 7 8 9 10 11 12 13 up"),
            (4, "What is 12 + 8?"), (5, "Add 4 km to 5 km and 7 km"), (6, "12 11 10 9 8 7 6 5 4 3 2 1"), (7, "what is 7 + 12")]
    got = found(spark, documents, rows, items)
    assert set(got) == {(1, 1), (2, 2), (3, 7)} and all(r.coverage == 1 and r.n_changed == 0 for r in got.values())


def test_rows_without_id_leave_too(spark, documents):
    """A null id does not keep a row that holds an item; null texts stay."""
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents([(42, ITEMS[3][1]), (None, FILL + ITEMS[3][1]), (None, "clean text without id"), (None, None), (1, "clean text")])
    left = dc.without_leaks(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, ""), (0, "clean text without id"), (1, "clean text")]


def test_names_in_small_letters_and_spelled_numbers(spark, documents):
    books = "Put three red books on the left shelf and two blue books on the right shelf before the bell rings again"
    rows = [(1, ITEMS[0][1].replace("Alice", "Eve").replace("Bob", "Dan").lower()), (2, FILL + books.replace("three", "four").replace("two", "seven")),
            (3, books.replace("books", "pens").replace("shelf", "table")), (4, "eve and dan have three red books and two blue shelves on some days")]
    got = found(spark, documents, rows, [ITEMS[0], (8, books)])
    assert set(got) == {(1, 1), (2, 8)} and got[2, 8].n_changed == 2


def plain_windows(text, form):
    """(template, values, is_slot) of one text and form, token by token."""
    import re
    low = text.lower()
    out, end = [], 0
    for m in re.finditer(r"[^\W\d_]+|\d+", text):
        w, between = m.group(), text[end:m.start()]
        fresh = not out or any(c in between for c in ".!?:\n")
        kind = None
        if form == dc.EXACT:
            out.append([None, [w.lower()]])
            continue
        if w.isdigit() or low[m.start():m.end()] in dc.NUMBER_WORDS:
            kind = "number"
        elif out and out[-1][0] == "number" and w.lower() in dc.UNITS:
            kind = "unit"
        elif form != dc.PLAIN and ((w[0].isupper() and (form == dc.OPENING or not fresh)) or w.lower() in dc.GIVEN_NAMES):
            kind = "name"
        if out and kind in ("number", "name") and out[-1][0] == kind and (kind == "number" or not fresh):
            out[-1][1].append(w.lower())
        else:
            out.append([kind, [w.lower()]])
        end = m.end()
    return [(k or " ".join(ws)) for k, ws in out], [tuple(ws) for _, ws in out], [k is not None for k, _ in out]


def plain_leaks(docs, items):
    """Documents that hold an item, by trying every place of every form against every window."""
    from collections import Counter
    out = set()
    for item_id, text in items:
        for form in (*dc.TEMPLATES, dc.EXACT):
            t, v, s = plain_windows(text, form)
            n = min(dc.WINDOW, len(t))
            places = [k for k in range(len(t) - n + 1) if n and sum(not x for x in s[k:k + n]) >= min(n, dc.LEAST_LITERALS)]
            if form == dc.PLAIN:
                loose = len(places) < len(t) - n + 1
            if form == dc.EXACT and not loose:
                continue
            for doc_id, other in docs:
                lines = {}
                for view in (*dc.TEMPLATES, dc.EXACT):
                    dt, dv, ds = plain_windows(other, view)
                    for j in range(len(dt) - n + 1):
                        for k in places:
                            if dt[j:j + n] == t[k:k + n] and ds[j:j + n] == s[k:k + n]:
                                lines.setdefault(j - k, set()).add((k, tuple(dv[j:j + n])))
                hit = set()
                for found_at in lines.values():
                    seen = {(k + i, v[k + i], u[i]) for k, u in found_at for i in range(n) if s[k + i]}
                    votes = {}
                    for p, a, b in seen:
                        votes.setdefault(a, Counter())[b] += 1
                    kept = {}
                    for a, c in votes.items():
                        (b, most), *rest = c.most_common()
                        kept[a] = b if not rest or rest[0][1] < most else None
                    for k, u in found_at:
                        pairs = [(v[k + i], u[i]) for i in range(n) if s[k + i]]
                        if all(a == b for a, b in pairs) or all(kept[a] == b for a, b in pairs):
                            hit.add(k)
                if places and len(hit) / len(places) >= dc.COVERAGE:
                    out.add((doc_id, item_id))
    return out


def test_against_every_place(spark, documents):
    """Generated items in copies with other names, numbers, units and case, cut or mixed, against plain loops."""
    rng = np.random.default_rng(12)
    names, words = ["Alice", "Bob", "Zorblax", "Qwenta", "Eve"], "box train apple river stone lamp green quickly under every bell moves gives takes left".split()
    pick = lambda xs: xs[rng.integers(0, len(xs))]

    def sentence():
        return " ".join(str(rng.integers(1, 99)) + pick([" km", " days", ""]) if x < 2 else pick(names) if x < 4 else pick(["three", "twelve"]) if x == 4 else pick(words)
                        for x in rng.integers(0, 16, rng.integers(10, 26)))

    items = [(i, sentence() + pick([".", "?", ". " + sentence().capitalize()])) for i in range(12)]
    docs = []
    for i, text in items:
        other = text
        for a in names:
            other = other.replace(a, pick(names + ["Carmon", "Ivan"]))
        other = " ".join(str(rng.integers(1, 99)) if w.isdigit() and rng.integers(0, 2) else w for w in other.split(" "))
        half = text.split(" ")[:len(text.split(" ")) * 6 // 10]
        docs += [(100 + i, FILL + text), (200 + i, other), (300 + i, other.lower()), (400 + i, " ".join(half)), (500 + i, text.replace("apple", "pear").replace("box", "bag")),
                 (600 + i, sentence()), (700 + i, text.upper())]
    got = set(found(spark, documents, docs, items))
    want = plain_leaks(docs, items)
    assert {(d, i) for d, i in got if d < 700} == {(d, i) for d, i in want if d < 700} and 20 < len(want)
    assert {(700 + i, i) for i, _ in items} <= got
