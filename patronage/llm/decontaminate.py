"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so that a question with other numbers or
names has the same template. Windows of template tokens of the documents are hash-joined with
those of the benchmark. A document holds an item when enough of the item's windows are found
with slots that agree: within a match, a value of the item stands for the value of the document
that most of its places have. Windows with another value there do not count, and where no value
has more places than any other, none of the windows over these places does. Windows with the
item's own values always count. Different values of the item may stand for the same one.
Numbers may be spelled out, and common given names are names in small letters, too.

Every text also has windows without placeholders for names, in small letters: leaks whose
letter case has changed are met by those. A third form takes capitals at the start of a
sentence for names too: a changed name that opens a sentence is met by that.

A window of hardly more than placeholders says nothing about its text. An item with such places
also has an exact form, words and numbers as they are, so that copies of it are found.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..operators.sizing import broadcast_if_small
from .staging import staged
from .words import BASE, chunks, mix, runs, tokens

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 8           # template tokens; an item with fewer is one window
LEAST_LITERALS = 4   # tokens of a window that are no placeholders (or all, in a shorter one)
COVERAGE = 0.5       # share of an item's windows that a document must hold
FILTER_BITS = 28     # size of the bit table that documents' windows pass first, at most
SPARSE = 16          # bits of it for each window of the benchmark
TABLE_PARTS = 8      # of the benchmark, each with a bit table of its own before they are joined

# Units that follow a number
UNITS = ("mm cm m km in inch inches ft feet foot yd yard yards mile miles mg g kg lb lbs oz pound pounds ton tons ml l litre litres "
         "liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year "
         "years percent degrees dollars dollar cents cent euro euros usd eur kmh mph w kw kwh v hz gb mb kb").split()
# Numbers that are spelled out (without those that are also articles)
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
                "thirty forty fifty sixty seventy eighty ninety hundred thousand million null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf "
                "zwanzig dreißig hundert tausend deux trois quatre cinq sept huit neuf dix onze douze vingt trente cent mille dos tres cuatro cinco seis "
                "siete ocho nueve diez once doce veinte treinta cien mil").split()
# Common given names that are no common words
GIVEN_NAMES = ("alice anna anne ben bob carol carlos carla charlie clara claire dan daniel dave david diego elena eli elias emily emma eric eva eve fatima felix "
               "fred george greta hannah hans helen henry hugo ian ines ivan jacob james jan jane jean jennifer jenny jessica jim joe john jorge jose juan "
               "julia julie karen karl kate kevin klaus laura leo leon lena linda lisa liam louis lucas lucy luis lukas luke maria marie mario martin mary "
               "max maya michael miguel mike mia natalie nina noah nora oliver olivia oscar pablo paul paula pedro peter philip pierre rachel ralph robert "
               "rosa ruth sam samuel sandra sara sarah simon sofia sophie stefan stella steve susan theo thomas tim tina tom toni ursula victor walter "
               "william wolfgang yusuf zoe").split()
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x9B05688C2B3E6C1F))

# Forms of a template: names inside sentences are slots, no names are, capitals that open a sentence are as well, there
# are no slots at all (only of items that have places of too few literals with numbers and units as slots)
NAMES, PLAIN, OPENING, EXACT = range(4)
TEMPLATES = (NAMES, PLAIN, OPENING)

KINDS = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 0 anything else
KINDS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KINDS[48:58] = 2


def word_hashes(listed: list[str]) -> np.ndarray:
    return np.unique(tokens(pa.array([" ".join(listed)], pa.large_string()), KINDS).hashes)


def _among(hashes: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return listed[np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)] == hashes


def templates(piece: pa.Array, forms: Iterable[int] = (NAMES, PLAIN)) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, template, values, is_slot) for each form and text. Neighbouring numbers are one
    slot, and so are neighbouring names of one sentence."""
    w = tokens(pc.utf8_lower(piece), KINDS)
    first = tokens(piece, KINDS)  # same tokens: letters stay letters in lower case
    count = len(w.hashes)
    if not count:
        return
    units, spelled, given = (word_hashes(x) for x in (UNITS, NUMBER_WORDS, GIVEN_NAMES))
    doc = np.repeat(np.arange(len(w)), np.diff(w.first))
    opens = np.zeros(count, bool)
    opens[w.first[:-1][np.diff(w.first) > 0]] = True
    byte = w.data[w.starts]
    number = (KINDS[byte] == 2) | _among(w.hashes, spelled)
    after = np.concatenate([[False], number[:-1]]) & ~opens
    unit = after & ~number & _among(w.hashes, units)
    stops = np.concatenate([[0], np.cumsum(np.isin(w.data, np.frombuffer(b".!?:\n", np.uint8)))])
    fresh = opens | (stops[w.starts] > stops[np.concatenate([[0], w.ends[:-1]])])
    byte, second = first.data[first.starts], first.data[np.minimum(first.starts + 1, len(first.data) - 1)]
    capital = ((byte >= 65) & (byte <= 90)) | ((byte == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    for form in forms:
        if form == EXACT:
            for i in range(len(w)):
                if len(w.of(i)):
                    yield i, w.of(i), w.of(i), np.zeros(len(w.of(i)), bool)
            continue
        template = w.hashes.copy()
        template[number], template[unit] = NUMBER, UNIT
        slot = number | unit
        again = after & number
        if form != PLAIN:
            name = (capital if form == OPENING else capital & ~fresh) & ~number | _among(w.hashes, given)
            template[name] = NAME
            slot = slot | name
            again = again | (name & np.concatenate([[False], name[:-1]]) & ~fresh)
        kept = ~again
        # the value of a slot also covers the tokens that were merged into it
        values = np.add.reduceat(mix(w.hashes + np.uint64(BASE)), np.flatnonzero(kept)) if not kept.all() else mix(w.hashes + np.uint64(BASE))
        t, s, d = template[kept], slot[kept], doc[kept]
        at = np.searchsorted(d, np.arange(len(w) + 1))
        for i in range(len(w)):
            if at[i + 1] > at[i]:
                yield i, t[at[i]:at[i + 1]], values[at[i]:at[i + 1]], s[at[i]:at[i + 1]]


def windows(template: np.ndarray, slot: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of n tokens, and whether it has enough literal tokens."""
    h = runs(template, n, salt=n)
    literal = np.concatenate([[0], np.cumsum(~slot)])
    return h, literal[n:] - literal[:-n] >= min(n, LEAST_LITERALS)


def _item_rows(batches):
    for b in batches:
        ids, text = b.column(0).to_pylist(), b.column(1)
        out: dict[str, list] = {k: [] for k in ("item_id", "form", "n", "at", "h", "v", "p")}
        for lo, hi, piece in chunks(text):
            loose = set()
            for form in (*TEMPLATES, EXACT):
                for i, t, v, s in templates(piece, (form,)):
                    if form == EXACT and i not in loose:
                        continue
                    n = min(WINDOW, len(t))
                    h, good = windows(t, s, n)
                    if form == PLAIN and not good.all():
                        loose.add(i)
                    for k in np.flatnonzero(good):
                        out["item_id"].append(ids[lo + i])
                        out["form"].append(form)
                        out["n"].append(n)
                        out["at"].append(int(k))
                        out["h"].append(int(h[k].view(np.int64)))
                        out["v"].append(_slots(v, s, k, n))
                        out["p"].append((np.flatnonzero(s[k:k + n]) + k).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(out["item_id"], pa.int64()), pa.array(out["form"], pa.int32()),
                                          pa.array(out["n"], pa.int32()), pa.array(out["at"], pa.int32()),
                                          pa.array(out["h"], pa.int64()), pa.array(out["v"], pa.list_(pa.int64())),
                                          pa.array(out["p"], pa.list_(pa.int32()))], names=list(out))


def _slots(v: np.ndarray, s: np.ndarray, k: int, n: int) -> list[int]:
    return v[k:k + n][s[k:k + n]].view(np.int64).tolist()


def _doc_rows(bits: bytes, plan: list[tuple[tuple[int, ...], list[int]]]):
    def run(batches):
        table = np.frombuffer(bits, np.uint8)
        mask = np.uint64(8 * len(bits) - 1)

        def known(h):
            at = h & mask
            return table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
        for b in batches:
            for lo, hi, piece in chunks(b.column(1)):
                ids = b.column(0).slice(lo, hi - lo).to_pylist()
                doc, place, key, value, seen = [], [], [], [], {}
                for forms, sizes in plan:
                    for i, t, v, s in templates(piece, forms):
                        for n in sizes:
                            if len(t) < n:
                                continue
                            h, good = windows(t, s, n)
                            for k in np.flatnonzero(good & known(h)):
                                if seen.get((i, n, int(h[k]))) == k:
                                    continue  # another form of the text has this window
                                seen[i, n, int(h[k])] = k
                                doc.append(ids[i])
                                place.append(int(k))
                                key.append(int(h[k].view(np.int64)))
                                value.append(_slots(v, s, k, n))
                if doc:
                    yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(place, pa.int64()), pa.array(key, pa.int64()),
                                                      pa.array(value, pa.list_(pa.int64()))], names=["doc_id", "place", "h", "u"])
    return run


def _bit_rows(size: int):
    def run(batches):
        bits = np.zeros(size // 8, np.uint8)
        for b in batches:
            at = np.unique(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(size - 1))
            np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])
    return run


def bit_table(known: DataFrame) -> np.ndarray:
    """Bits of the benchmark's windows, SPARSE for each of them but 2^FILTER_BITS at most. The
    driver joins TABLE_PARTS tables, whatever the benchmark's partitions."""
    count = known.count()
    size = 1 << min(FILTER_BITS, max(3, (SPARSE * count).bit_length()))
    bits = np.zeros(size // 8, np.uint8)
    for r in known.select("h").coalesce(TABLE_PARTS).mapInArrow(_bit_rows(size), "bits binary").toLocalIterator():
        bits |= np.frombuffer(r["bits"], np.uint8)
    return bits


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, form, n, at, h, v, p, total): distinct windows of each form of an item, with the
    values and places of their slots, and the number of places that the form's windows start at."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).dropna()
    rows = staged(rows.mapInArrow(_item_rows, "item_id long, form int, n int, at int, h long, v array<long>, p array<int>").distinct(), "items")
    total = rows.groupBy("item_id", "form").agg(F.countDistinct("at").alias("total"))
    return staged(rows.join(total, ["item_id", "form"]), "items-total")


def leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, n_windows, coverage, n_changed): documents that hold an item.

    n_windows counts the places of the item whose window is found, with its own values or consistent ones;
    coverage is their share of all places; n_changed counts item values that the document
    replaces. All three are those of the form of the item that the document covers best. Null, empty and blank texts hold nothing. Of an item without a window of enough
    literal tokens, only copies with its own numbers are found. Repeated rows of a document count once. A null doc_id or
    item_id has no row. Other columns are ignored.

    Documents are read once and not moved. Their windows pass a bit table whose size follows
    from the number of benchmark windows, and what passes is joined exactly by hash with all of
    them; a benchmark of any size is only ever joined. A window that very many
    documents hold joins on a key that can be split; all later groups are one document and
    one item.
    """
    known = item_windows(items)
    bits = bit_table(known)
    sizes = known.select((F.col("form") == EXACT).alias("exact"), "n").distinct().collect()  # at most WINDOW numbers for each
    plan = [(forms, sorted(r["n"] for r in sizes if r["exact"] == exact)) for forms, exact in ((TEMPLATES, False), ((EXACT,), True))]
    plan = [(forms, n) for forms, n in plan if n]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    found = rows.mapInArrow(_doc_rows(bits.tobytes(), plan), "doc_id long, place long, h long, u array<long>")
    # windows that pass the bit table by chance are joined away
    met = found.join(known, "h").filter(F.size("u") == F.size("v"))
    met = staged(met.select("doc_id", "item_id", "form", "total", "at", (F.col("place") - F.col("at")).alias("line"), "u", "v", "p"), "met")
    lines = ["doc_id", "item_id", "form", "line"]
    slots = met.select(*lines, F.explode(F.arrays_zip("p", "u", "v")).alias("x")).select(*lines, "x.p", "x.u", "x.v")
    # the values of the document that stand for one of the item, those of most places first
    values = (slots.groupBy(*lines, "v", "u").agg(F.countDistinct("p").alias("places")).groupBy(*lines, "v")
              .agg(F.sort_array(F.collect_list(F.struct("places", "u")), asc=False).alias("by")))
    single = (F.size("by") == 1) | (F.get("by", 0)["places"] > F.get("by", 1)["places"])
    values = staged(values.select(*lines, "v", F.when(single, F.get("by", 0)["u"]).alias("kept"), (F.size("by") > 1).alias("torn")), "values")
    torn = values.filter("torn").select(*lines, "v", "kept")
    bad = (met.filter("u <> v").select(*lines, "at", F.col("u").alias("us"), F.explode(F.arrays_zip("u", "v")).alias("x"))
           .select(*lines, "at", "us", "x.u", "x.v").join(torn, [*lines, "v"]).filter("kept is null or kept <> u")
           .select(*lines, "at", F.col("us").alias("u")).distinct())
    changed = values.groupBy(*lines).agg(F.countDistinct(F.when(F.col("kept") != F.col("v"), F.col("v"))).alias("changed"))
    own = F.col("u") == F.col("v")
    good = met.filter(own).unionByName(met.filter(~own).join(bad, [*lines, "at", "u"], "left_anti").select(*met.columns)).join(changed, lines, "left")
    forms = good.groupBy("doc_id", "item_id", "form").agg(F.countDistinct("at").alias("n_windows"), F.first("total").alias("total"),
                                                          F.coalesce(F.max("changed"), F.lit(0)).alias("n_changed"))
    best = F.max(F.struct((F.col("n_windows") / F.col("total")).alias("coverage"), "n_windows", "n_changed")).alias("best")
    return (forms.groupBy("doc_id", "item_id").agg(best).filter(F.col("best.coverage") >= coverage)
            .select("doc_id", "item_id", "best.n_windows", "best.coverage", "best.n_changed"))


def without_leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Rows of docs that hold no item, columns as they are. A row with a null id is known by a
    64-bit hash of its text instead; rows with a null text are kept."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.when(F.col("text").isNotNull(), F.xxhash64("text")))
    held = leaks(docs.select(key.alias("doc_id"), "text"), items, coverage).select(F.col("doc_id").alias("_held")).distinct()
    return docs.join(broadcast_if_small(staged(held, "held")), key == F.col("_held"), "left_anti")
