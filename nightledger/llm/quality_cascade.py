"""Quality rules as a short-circuit cascade.

A rule rejects a text. Its cost and its selectivity are measured on a sample of
the rows: the time its expression takes over the written sample, beyond that of
reading the texts, and which rows it rejects. The rules are then ordered by
rejections per cost, each among the rows that the rules before it let pass, and
become one conditional expression, so a rule is evaluated only for rows that no
earlier rule has rejected. The verdict does not depend on the order, which may
differ from run to run where costs are close.

``judged`` reports base statistics of every row, so rules on these alone cost
next to nothing there and come first; what the other rules need (lines,
capitals) is computed only for rows that get to them.

The sample are the rows whose seeded hash falls into one of SAMPLE_OF
residues: a fixed share of any table. Only counts by pattern of rejecting
rules (at most 2^rules) and mean sizes reach the driver.

Everything is built-in expressions. Repeated five-word windows are found in
each row by sorted 64-bit window hashes; within a text of a million words two
different windows meet with odds below 1e-7.

Defined results: null text has no words; a text without words fails the rule
on word count; an empty sample orders the rules by cost alone. Rows repeat as
they come; extra columns are ignored by ``statistics`` and kept by ``cascade``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import SPACES, stored
from nightledger.llm.mixing import let

SAMPLE_OF, WINDOW = 64, 5
SYMBOLS = "#*$%&|<>"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps a function from feature name to column to a boolean column.

    Cost in nanoseconds: a row's characters times ``char`` plus its words times
    ``word``. The given numbers hold where there is no sample to measure.
    """

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]
    char: float
    word: float = 0.0


BASE = (
    Rule("few_words", lambda f: f("n_words") < 10, 1.0, 40.0),
    Rule("repeated_windows", lambda f: 100 * f("n_repeat_words") > 20 * f("n_words"), 1.0, 400.0),
)
RULES = BASE + (
    Rule("symbols", lambda f: 5 * f("n_symbols") > f("n_words"), 4.0, 40.0),
    Rule("repeated_lines", lambda f: 2 * f("n_dup_lines") > f("n_lines"), 3.0),
    Rule("capitals", lambda f: 2 * f("n_capitals") > f("word_chars"), 12.0),
    Rule("word_length", lambda f: (f("word_chars") > 15 * f("n_words")) | (f("word_chars") < 2 * f("n_words")), 3.0, 40.0),
)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def lines(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.translate(x, " " + SPACES, "") != "")


def repeated_words(w: Column, k: int = WINDOW) -> Column:
    """Words inside k-word windows that the array holds twice or more."""
    hashes = F.when(F.size(w) > k, F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k))))

    def places(h):
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        at = let(ordered, lambda s: F.array_sort(F.transform(
            F.filter(F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.when(
                ((j > 0) & (F.get(s, j - 1)["h"] == F.get(s, j)["h"])) | F.coalesce(F.get(s, j + 1)["h"] == F.get(s, j)["h"], F.lit(False)),
                F.get(s, j)["i"])), lambda x: x.isNotNull()), lambda x: x)))
        start = F.struct(F.lit(-k).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(at, start, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(k), i - acc["last"])).alias("n")),
                           lambda acc: acc["n"])
    # most texts repeat no window: a set of hashes tells
    return F.coalesce(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), places(h))), F.lit(0).cast("long"))


def removed(text: Column, symbols: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, symbols, ""))).cast("long")


def features(text: Column) -> dict[str, Column]:
    """Every feature as an expression of its own over the text."""
    t = F.coalesce(text, F.lit(""))
    return {
        "n_words": F.size(words(t)).cast("long"),
        "word_chars": F.length(F.translate(t, " " + SPACES, "")).cast("long"),
        "n_symbols": removed(t, SYMBOLS),
        "n_lines": F.size(lines(t)).cast("long"),
        "n_dup_lines": let(lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_capitals": (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("long"),
        "n_repeat_words": let(words(t), lambda w: repeated_words(w)),  # a second parameter would be the index
    }


def base_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, text, the base features) of every row of (doc_id, text); words are cut once."""
    f = features(F.col("text"))
    cut = let(words(F.coalesce("text", F.lit(""))), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    rest = [f[n].alias(n) for n in FEATURES if n not in ("n_words", "n_repeat_words")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", cut.alias("cut")).select("doc_id", "text", "cut.*", *rest)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, all features) of every row of (doc_id, text)."""
    f = features(F.col("text"))
    return base_statistics(docs).withColumns({n: f[n] for n in f if n not in FEATURES}).drop("text")


def order(docs: DataFrame, rules=RULES, feature: Callable[[str], Column] | None = None, seed: int = 1) -> list[Rule]:
    """The rules by rejections per cost on the sample of ``docs`` (doc_id, text and the columns that ``feature`` uses)."""
    feature = feature or features(F.col("text")).__getitem__
    picked = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), "text")), F.lit(SAMPLE_OF)) == 0
    own = [F.col(f"`{c}`") for c in docs.columns if c == "text" or c in FEATURES]
    sample = stored(docs.where(picked).select(*own), "rules")
    bits = [F.when(r.rejects(feature), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules)]
    n_words, chars = features(F.col("text"))["n_words"], F.length(F.coalesce("text", F.lit("")))
    seen = (sample.select(sum(bits[1:], bits[0]).alias("mask"), n_words.alias("n_words"), chars.alias("chars")).groupBy("mask")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("n_words").alias("words")).collect())
    patterns = [(r["mask"], r["n"], r["chars"], r["words"]) for r in seen]
    return ranked(measured(sample, rules, feature, sum(p[2] for p in patterns)) if patterns else rules, patterns)


def measured(sample: DataFrame, rules, feature: Callable[[str], Column], chars: int, runs: int = 2) -> list[Rule]:
    """The rules with the time that each takes on the sample, per character: the best of ``runs`` counts of its rejections."""
    def seconds(column: Column) -> float:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            sample.agg(F.sum(column)).collect()
            best = min(best, time.perf_counter() - start)
        return best
    read = seconds(F.length("text"))
    # a rule that costs no more than reading still costs something, or any rejection would be worth any price
    spent = [max(seconds(r.rejects(feature).cast("int")) - read, 0.01 * read) for r in rules]
    return [replace(r, char=1e9 * t / max(chars, 1), word=0.0) for r, t in zip(rules, spent, strict=True)]


def ranked(rules, patterns: list[tuple[int, int, int, int]]) -> list[Rule]:
    """Greedy order from (mask of rejecting rules, rows, characters, words) of the sample."""
    left, out = list(enumerate(rules)), []
    rows = sorted(patterns)
    while left:
        chars, words_ = (sum(r[i] for r in rows) or 1 for i in (2, 3))

        def gain(x):
            i, rule = x
            return (-sum(r[1] for r in rows if r[0] >> i & 1) / (rule.char * chars + rule.word * words_), rule.char + rule.word, rule.name)
        best = min(left, key=gain)
        left.remove(best)
        out.append(best[1])
        rows = [r for r in rows if not r[0] >> best[0] & 1]
    return out


def verdict(rules: list[Rule], feature: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are then not evaluated."""
    out = F.lit(None).cast("string")
    for r in reversed(rules):
        out = F.when(r.rejects(feature), F.lit(r.name)).otherwise(out)
    return out


def cascade(docs: DataFrame, rules=RULES, column: str = "rejected_by") -> DataFrame:
    """``docs`` with the name of the rule that rejects each row, null for rows to keep.

    Features are evaluated only as far as a row gets in the cascade.
    """
    f = features(F.col("text"))
    return docs.withColumn(column, verdict(order(docs, rules), f.__getitem__))


def judged(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, the base statistics, base_failed, kept, rejected_by) of every row.

    Rules come in the order that the sample gives them; a feature that is no
    base statistic is evaluated only in rows that no earlier rule has rejected.
    """
    f = features(F.col("text"))

    def feature(name: str) -> Column:
        return F.col(name) if name in FEATURES else f[name]
    rows = base_statistics(docs)
    failed = BASE[0].rejects(F.col) | BASE[1].rejects(F.col)
    first = verdict(order(rows, rules, feature), feature)
    return rows.select("doc_id", *FEATURES, failed.alias("base_failed"), first.alias("rejected_by")).select(
        "doc_id", *FEATURES, "base_failed", (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"), "rejected_by")
