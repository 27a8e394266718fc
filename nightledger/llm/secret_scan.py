"""Secrets by fixed patterns and a battery of randomness tests.

Patterns give the base spans. The battery looks at every other run of
LEAST or more encoding characters. Its encoding is inferred (decimal, hex,
single-case letters, letters with digits, base64) and three statistics are
taken over it: equal symbol pairs, which is the chi-squared statistic of
alphabet uniformity up to scale; runs of character classes; and the lag-one
serial correlation of its codes.

Two hypotheses are weighed. Under "ordinary text" symbols follow the
frequencies that the runs of all documents have within the alphabet, and
classes change as often as they do there: uniformity and class changes above
that give two p-values (sub-Gaussian tail bounds of the exact means and
variances), combined by Fisher's method. Under "random" the three statistics
must look like those of uniform symbols. A run is a secret if the first is
rejected under false-discovery control and the second is not.

The control is a weighted Benjamini-Hochberg threshold over the runs of all
documents. Weights grow with length, as longer runs can show more, and
average to one. Only a histogram of p-values (BINS rows) and a
symbol table (one row a character) reach the driver.

Positions come from the pieces between the matches: lengths of pieces and
matches are summed along the text. Everything is built-in expressions. The
spans and runs of all rows, without texts, are written once to the
shared folder.

Defined results: null is an empty text; spans are code points, end exclusive;
without runs, or where all runs look alike, nothing is added. Repeated rows
repeat; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import stored
from nightledger.llm.mixing import let

KINDS = ("assign", "access", "hex", "random")
ALPHA, LEAST, BINS, LONGEST = 0.01, 20, 2000, 64   # level, least run, histogram, length at which weights stop growing
ACCEPT = 4.0                                     # standard deviations allowed to a random run


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = ("(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|" + _either_case("api") + "_?" + _either_case("key")
          + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}"}  # least lengths end a run's match or nothing
RUN = f"[A-Za-z0-9+/_-]{{{LEAST},}}"
ALPHABETS = (("decimal", "[0-9]"), ("hex", "[0-9a-f]"), ("HEX", "[0-9A-F]"), ("lower", "[a-z]"), ("upper", "[A-Z]"),
             ("lower36", "[0-9a-z]"), ("upper36", "[0-9A-Z]"), ("letters", "[A-Za-z]"), ("base64", "[A-Za-z0-9+/_-]"))
SIZES = {"decimal": 10, "hex": 16, "HEX": 16, "lower": 26, "upper": 26, "lower36": 36, "upper36": 36, "letters": 52, "base64": 64}


def found(text: Column, pattern: str) -> Column:
    """array<struct<start,end,value>> of all matches, in code points.

    Matches are folded in groups, so building the array is not quadratic.
    """
    def places(x):
        n = F.size(x["m"])
        groups = F.sequence(F.lit(0), F.floor((n - 1) / 256).cast("int"))

        def one(acc, i):
            start = acc["at"] + F.length(F.get(x["p"], i))
            return let(F.struct(start.alias("s"), (start + F.length(F.get(x["m"], i))).alias("e")), lambda s: F.struct(
                s["e"].alias("at"), F.array_append(acc["out"], F.struct(s["s"].alias("start"), s["e"].alias("end"), F.get(x["m"], i).alias("value"))).alias("out")))
        none = F.array().cast("array<struct<start:int,end:int,value:string>>")

        def group(acc, g):
            part = F.aggregate(F.sequence(g * 256, F.least(g * 256 + 255, n - 1)), F.struct(acc["at"].alias("at"), none.alias("out")), one)
            return let(part, lambda z: F.struct(z["at"].alias("at"), F.array_append(acc["all"], z["out"]).alias("all")))
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,value:string>>>").alias("all"))
        return F.when(n > 0, F.flatten(F.aggregate(groups, begin, group, lambda acc: acc["all"])))
    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return F.coalesce(F.when(text.rlike(pattern), let(both, places)), F.array().cast("array<struct<start:int,end:int,value:string>>"))


def base_spans(text: Column) -> Column:
    """array<struct<start,order,end,kind>> of the patterns."""
    def of(kind):
        spans = found(text, PATTERNS[kind])
        if kind == "assign":
            spans = F.filter(spans, lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 12)
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), s["end"].alias("end"),
                                                     F.lit(kind).alias("kind")))
    return F.array_sort(F.concat(*map(of, PATTERNS)))


def encoding(run: Column) -> Column:
    out = F.lit("base64")
    for name, symbols in reversed(ALPHABETS[:-1]):
        out = F.when(run.rlike(f"^{symbols}+$"), name).otherwise(out)
    return out


def measured(run: Column) -> Column:
    """struct: enc, n, pairs (equal symbol pairs), changes (of class), serial (correlation)."""
    codes = F.transform(F.sequence(F.lit(1), F.length(run)), lambda i: F.ascii(F.substring(run, i, F.lit(1))))
    kind = lambda c: F.when(c >= 97, 1).when(c >= 65, 2).when(c.between(48, 57), 3).otherwise(4)

    def of(c):
        n = F.size(c)
        # counts by symbol from the sorted codes: each equal neighbour adds the length of its run so far
        start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0).cast("long").alias("sum"))
        pairs = F.aggregate(F.array_sort(c), start, lambda a, x: let(F.when(a["last"] == x, a["run"] + 1).otherwise(0), lambda r: F.struct(
            x.alias("last"), r.alias("run"), (a["sum"] + r).alias("sum"))), lambda a: a["sum"])
        changes = F.aggregate(F.sequence(F.lit(1), n - 1), F.lit(0), lambda a, i: a + F.when(kind(F.get(c, i)) != kind(F.get(c, i - 1)), 1).otherwise(0))
        mean = F.aggregate(c, F.lit(0).cast("double"), lambda a, x: a + x, lambda a: a / n)
        serial = let(mean, lambda m: F.aggregate(F.sequence(F.lit(1), n - 1), F.lit(0.0), lambda a, i: a + (F.get(c, i) - m) * (F.get(c, i - 1) - m))
                     / F.nullif(F.aggregate(c, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)), F.lit(0.0)))
        return F.struct(encoding(run).alias("enc"), n.alias("n"), pairs.alias("pairs"), changes.alias("changes"), F.coalesce(serial, F.lit(1.0)).alias("serial"))
    return let(codes, of)


def candidates(text: Column, base: Column) -> Column:
    """Runs outside the base spans with their statistics."""
    free = F.filter(found(text, RUN), lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (b["end"] > r["start"])))
    return F.transform(free, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["value"].alias("value"), measured(r["value"]).alias("m")))


def ordinary(symbols: dict[str, int], changes: float) -> dict[str, tuple[float, float, float]]:
    """By encoding: chance of an equal pair, of an equal triple, and of a class change in ordinary runs."""
    import re
    out = {}
    for name, kind in ALPHABETS:
        f = [n for c, n in symbols.items() if re.fullmatch(kind, c)]
        total = sum(f) or 1
        f = [x / total for x in f] or [1.0]
        out[name] = (sum(x**2 for x in f), sum(x**3 for x in f), min(max(changes, 1e-3), 0.5))
    return out


def p_value(m: Column, null: dict[str, tuple[float, float, float]]) -> Column:
    """Combined p-value against ordinary text."""
    def of(i):
        return F.create_map(*[F.lit(x) for name in null for x in (name, float(null[name][i]))])[m["enc"]]
    n, k2, k3, c = m["n"].cast("double"), of(0), of(1), of(2)
    tail = lambda z: F.when(z < 0, 0.5 * F.exp(-z * z / 2)).otherwise(1.0)
    var = n * (n - 1) / 2 * (k2 - k2 * k2) + n * (n - 1) * (n - 2) * F.greatest(k3 - k2 * k2, F.lit(0.0))
    uniform = tail((m["pairs"] - n * (n - 1) / 2 * k2) / F.sqrt(F.greatest(var, F.lit(1e-9))))
    classes = F.when(m["enc"].isin("decimal", "lower", "upper"), 1.0).otherwise(tail(((n - 1) * c - m["changes"]) / F.sqrt((n - 1) * c * (1 - c))))
    return let(-F.log(F.greatest(uniform, F.lit(1e-200))) - F.log(F.greatest(classes, F.lit(1e-200))), lambda x: F.exp(-x) * (1 + x))


def looks_random(m: Column) -> Column:
    """Whether all three statistics are near those of uniform symbols."""
    k = F.create_map(*[F.lit(x) for name in SIZES for x in (name, float(SIZES[name]))])[m["enc"]]
    n = m["n"].cast("double")
    mean, sd = n * (n - 1) / 2 / k, F.sqrt(n * (n - 1) / 2 / k * (1 - 1 / k))
    one_class = m["enc"].isin("decimal", "lower", "upper")
    return ((m["pairs"] - mean <= ACCEPT * sd) & (F.abs(m["serial"]) * F.sqrt(n) <= ACCEPT) & (one_class | (8 * m["changes"] >= n)))


def threshold(histogram: dict[int, int], alpha: float = ALPHA) -> float:
    """Largest weighted p-value accepted, from counts by floor(-4 ln p); 0.0: none."""
    total, seen, best = sum(histogram.values()), 0, 0.0
    for b in sorted(histogram, reverse=True):
        seen += histogram[b]
        top = math.exp(-b / 4)                     # no p-value of the bin is above
        if top <= alpha * seen / total:
            best = top
    return best


def scan(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(doc_id, spans array<struct<start,order,end,kind>>) of every row of (doc_id, text).

    ``order`` is the kind's place in KINDS; the first three are base kinds.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    first = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select("doc_id", "text", base_spans(F.col("text")).alias("base"))
             .select("doc_id", "base", candidates(F.col("text"), F.col("base")).alias("runs")))
    rows = stored(first, "secrets")
    runs = rows.where(F.size("runs") > 0).select(F.explode("runs").alias("r")).select("r.value", "r.m")
    symbols = {r["c"]: r["n"] for r in runs.select(F.explode(F.split("value", "")).alias("c")).where("c != ''").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = runs.agg(F.sum("m.changes").alias("c"), F.sum(F.col("m.n") - 1).alias("n"), F.avg(F.least(F.col("m.n"), F.lit(LONGEST))).alias("w")).first()
    if not symbols:
        return rows.select("doc_id", F.col("base").alias("spans"))
    null = ordinary(symbols, totals["c"] / totals["n"])

    def weighted(m):
        return p_value(m, null) / (F.least(m["n"], F.lit(LONGEST)) / F.lit(float(totals["w"])))
    place = F.greatest(F.lit(0), F.least(F.lit(BINS), F.floor(-4 * F.log(F.greatest(weighted(F.col("m")), F.lit(1e-300))))))
    histogram = {int(r["b"]): r["n"] for r in runs.select(place.alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = threshold(histogram, alpha)
    added = F.transform(F.filter("runs", lambda r: (weighted(r["m"]) <= most) & looks_random(r["m"])), lambda r: F.struct(
        r["start"].alias("start"), F.lit(KINDS.index("random")).alias("order"), r["end"].alias("end"), F.lit("random").alias("kind")))
    return rows.select("doc_id", F.array_sort(F.concat("base", added)).alias("spans"))


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of the operator's output."""
    base = F.filter("spans", lambda s: s["order"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"),
                          spelled(F.col("spans")).alias("spans"))
