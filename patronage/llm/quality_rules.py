"""Quality rules of documents and of their hosts, in DataFrame functions only.

Each text gets counts, a verdict for each rule and a base verdict. Failures of each rule are then
counted by host, and the host's failure rate is shrunk towards the rate of all hosts with an
empirical beta prior of that rule, so that a host with few documents is not condemned by
chance. Documents of a host fall with it if its shrunk rate of any rule is over the limit:
rules that one text may well break, such as symbols, count where a host breaks them as a habit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.sizing import broadcast_if_small
from ..operators.skew import join_back
from .staging import staged

# fixed values of the base rules
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
BLANK = r"[\x20\x09-\x0D]+"

# fixed values of the rules that judge hosts only: percent of the characters of words, and of lines
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
RULES = ("base_failed", "too_short", "too_repetitive", "too_many_symbols", "too_many_dup_lines")

# limits of the empirical prior's weight, in documents
PRIOR_LEAST, PRIOR_MOST = 1.0, 1e6


def word_array(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Number of words in windows that occur at least twice in the array of words.

    Windows are sorted by hash and place; those equal to a neighbour are repeated. Their
    places, sorted, each bring the words that the window before does not cover. All of it
    stays within the row: no explode, no shuffle.
    """
    h = F.transform(words, lambda w: F.xxhash64(w))
    last = F.size(words) - WINDOW
    return F.when(last < 1, F.lit(0)).otherwise(_covered(_repeated_places(h, last))).cast("long")


def _repeated_places(h: Column, last: Column) -> Column:
    def one(x: Column) -> Column:  # binds the array once, so that it is not built for each element
        n = F.size(x)
        return F.filter(F.transform(x, lambda e, i: F.when(
            ((i > 0) & (x[F.greatest(i - 1, F.lit(0))]["k"] == e["k"]))
            | ((i < n - 1) & (x[F.least(i + 1, n - 1)]["k"] == e["k"])), e["i"])), lambda e: e.isNotNull())

    windows = F.flatten(F.transform(F.array(h), lambda a: F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        F.xxhash64(*[a[i + k] for k in range(WINDOW)]).alias("k"), i.alias("i")))))
    return F.sort_array(F.flatten(F.transform(F.array(F.sort_array(windows)), one)))


def _covered(places: Column) -> Column:
    def one(x: Column) -> Column:
        return F.aggregate(x, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("p")),
                           lambda s, p: F.struct((s["n"] + F.least(F.lit(WINDOW), p - s["p"])).alias("n"), p.alias("p")))["n"]
    return one(places)


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host, counts, base_failed) for each row of docs: `broken_rules` without the rest."""
    return broken_rules(docs, id_col, text_col, host_col).drop("n_lines", *RULES[1:])


def broken_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host, counts, n_lines, and for each of RULES whether it is broken) for each row of docs.

    A null, empty or blank text has zero words and fails the base rule. Texts of any length
    are read whole. Windows are compared by a 64-bit hash within one text. Other columns of
    docs are ignored; repeated rows stay.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("t")).select(
        "doc_id", "host", word_array(F.col("t")).alias("words"),
        F.length(F.translate("t", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    counted = base.select(
        "doc_id", "host", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"))
    over = lambda part, percent, whole: 100 * F.col(part) > percent * F.col(whole)
    short, repeats = F.col("n_words") < MIN_WORDS, over("n_repeat_words", MAX_REPEAT_PERCENT, "n_words")
    return counted.withColumns(dict(zip(RULES, (
        short | repeats, short, repeats, over("n_symbols", MAX_SYMBOL_PERCENT, "word_chars"), over("n_dup_lines", MAX_DUP_LINE_PERCENT, "n_lines")))))


def host_verdicts(rows: DataFrame, limit: float = 0.5) -> DataFrame:
    """(host, n_docs, n_failed, host_rate, rates, host_ok) for rows with host, base_failed
    and any others of RULES. n_failed and host_rate are those of the base rule, `rates` has the
    shrunk rates of all rules there are by name.

    The prior of a rule is fitted by moments to the rates of all hosts: with mean m and variance
    v its weight is m (1 - m) / v - 1 documents, held between PRIOR_LEAST and PRIOR_MOST. The
    shrunk rate is (failed + m * weight) / (documents + weight). A null host is a host of its own.
    """
    rules = [r for r in RULES if r in rows.columns]
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), *[F.count_if(r).alias(f"f_{r}") for r in rules])
    rate = {r: F.col(f"f_{r}") / F.col("n_docs") for r in rules}
    prior = hosts.agg(*[F.avg(x).alias(f"m_{r}") for r, x in rate.items()], *[F.var_pop(x).alias(f"v_{r}") for r, x in rate.items()])

    def shrunk(r: str) -> Column:
        m, v = F.col(f"m_{r}"), F.col(f"v_{r}")
        weight = F.when(v > 0, F.least(F.greatest(m * (1 - m) / v - 1, F.lit(PRIOR_LEAST)), F.lit(PRIOR_MOST))).otherwise(PRIOR_MOST)
        return (F.col(f"f_{r}") + m * weight) / (F.col("n_docs") + weight)

    # the prior is one row
    both = hosts.join(F.broadcast(prior)).select("host", "n_docs", F.col("f_base_failed").alias("n_failed"), F.struct(*[shrunk(r).alias(r) for r in rules]).alias("rates"))
    worst = F.array_max(F.array(*[F.col(f"rates.{r}") for r in rules]))
    return both.select("host", "n_docs", "n_failed", F.col("rates.base_failed").alias("host_rate"), "rates", (worst <= limit).alias("host_ok"))


def quality_verdicts(docs: DataFrame, limit: float = 0.5) -> DataFrame:
    """broken_rules plus kept: the base verdict passes, and so do those of the host for all rules.

    The counts are written once, in narrow rows. Failures are summed before the shuffle; the
    verdicts come back by a broadcast while the written table of hosts is small, else by a
    join that splits a host with very many documents.
    """
    rows = staged(broken_rules(docs), "rules")
    hosts = staged(host_verdicts(rows, limit).select("host", "host_ok"), "hosts")
    small = broadcast_if_small(hosts)
    if small is hosts:
        out = join_back(rows, hosts, ["host"])
    else:
        right = small.withColumnRenamed("host", "_host")
        out = rows.join(right, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("host_ok")).drop("host_ok")
