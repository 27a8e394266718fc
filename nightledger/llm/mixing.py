"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Every row has a size in words and a seeded hash. A source is cut into
   blocks by that hash: a block is a random set of rows of about BLOCK_WORDS
   words (more where the whole would exceed MAX_BLOCKS blocks), so a hot
   source is many small groups.
2. Targets: sources in code-point order (null last) weigh WEIGHTS, repeating,
   and share SHARE of all words; no target exceeds CAP times its source.
3. A source is drawn whole as often as its target allows; of the last pass
   blocks are drawn in their random order, and the block in which the target
   falls is cut at the row that comes nearest.
4. The exact block quotas of all sources are the root of a tree over the
   output shards. Each node splits its quotas between two halves by a
   multivariate hypergeometric draw (conditional draws source by source, each
   by inversion), so every shard gets its exact number of blocks and the mix
   of sources is that of a random deal.
5. Each source's permuted blocks go to the shards in ranges of these quotas,
   disjoint by construction, and the rows of a shard are ordered by a hash.

All draws come from seeded hashes, so reruns agree. Everything is DataFrame
expressions; per source and per block tables are small sums of the input.
The tree keeps one number per source in a row, so sources are expected to be
few (thousands); rows, blocks and shards are not.

Defined results: null or blank text has size 0 and is taken 0 words; null
sources are one source; a null id falls back to the text for its hash;
rows that repeat an id share their fate; an empty table gives no rows. Extra
columns are kept by ``mix``; its own columns are refused if already present.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import stored

WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2.0
BLOCK_WORDS, MAX_BLOCKS, SHARD_WORDS = 100_000, 1_000_000, 20_000_000
OWN = ("mix_shard", "mix_copy", "mix_order")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.coalesce(doc_id.cast("string"), text))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Marked items among ``drawn`` of ``total`` without replacement, by inversion of u in [0, 1).

    Weights are relative to the mode and cover 12 standard deviations, beyond
    which they vanish in double precision.
    """
    t, k, n = (x.cast("double") for x in (total, marked, drawn))
    mean = F.when(total > 0, n * k / t).otherwise(0.0)
    sd = F.when(total > 1, F.sqrt(mean * (1 - k / t) * (t - n) / (t - 1))).otherwise(0.0)
    low, high = F.greatest(F.lit(0).cast("long"), drawn + marked - total), F.least(drawn, marked)
    near = lambda x: F.least(F.greatest(x.cast("long"), low), high)
    bounds = F.struct(near(F.floor(mean - 12 * sd - 2)).alias("a"), near(F.floor((n + 1) * (k + 1) / (t + 2))).alias("m"),
                      near(F.ceil(mean + 12 * sd + 2)).alias("b"))
    rise = lambda x: (k - x + 1) * (n - x + 1) / (x * (t - k - n + x))  # noqa: E731  p(x) / p(x - 1)
    seq = lambda a, b, by: F.when((b - a) * by >= 0, F.sequence(a, b, F.lit(by).cast("long"))).otherwise(F.array().cast("array<long>"))
    pair = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))

    def step(ratio):
        return lambda acc, x: let(acc["w"] * ratio(x), lambda w: F.struct(w.alias("w"), (acc["s"] + w).alias("s")))

    def pick(s):
        down = F.aggregate(seq(s["m"], s["a"] + 1, -1), pair, step(lambda x: 1 / rise(x)))
        up = F.aggregate(seq(s["m"] + 1, s["b"], 1), pair, step(rise))
        start = let(F.struct(down.alias("d"), up.alias("u")), lambda z: F.struct(
            z["d"]["w"].alias("w"), z["d"]["w"].alias("c"), (u * (1 + z["d"]["s"] + z["u"]["s"])).alias("goal"), s["a"].alias("x")))
        walk = lambda acc, x: F.when(acc["c"] > acc["goal"], acc).otherwise(let(acc["w"] * rise(x), lambda w: F.struct(
            w.alias("w"), (acc["c"] + w).alias("c"), acc["goal"].alias("goal"), x.alias("x"))))
        return F.aggregate(seq(s["a"] + 1, s["b"], 1), start, walk)["x"]
    return let(bounds, pick)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, words) -> with target: weighted shares of ``share`` of all words, held at the cap.

    Raising every share until the whole is given out stops the sources in the
    order of cap over weight; sums before each in that order tell which stop.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    s = (sizes.withColumn("w", w).withColumn("most", cap * F.col("words")).withColumn("ratio", F.col("most") / F.col("w"))
         .withColumn("whole", share * F.sum("words").over(every)).withColumn("all_w", F.sum("w").over(every))
         .withColumn("level", (F.col("whole") - F.coalesce(F.sum("most").over(by_cap), F.lit(0.0)))
                     / (F.col("all_w") - F.coalesce(F.sum("w").over(by_cap), F.lit(0.0))))
         .withColumn("full", F.col("ratio") <= F.col("level")))
    given = lambda c: F.sum(F.when(F.col("full"), F.col(c)).otherwise(0.0)).over(every)
    level = (F.col("whole") - given("most")) / F.nullif(F.col("all_w") - given("w"), F.lit(0.0))
    return s.withColumn("target", F.when(F.col("full"), F.col("most")).otherwise(F.least(F.col("most"), F.col("w") * level))).select(
        *sizes.columns, "target")


def split_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, quota) -> (source, shard, quota): exact quotas dealt over equal shards.

    ``shards`` is a power of two; the capacity of a node is halved, the left
    half rounded up.
    """
    level = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct(F.col("at"), F.col("quota")))).alias("q")).select(
        F.lit(0).cast("long").alias("node"), "q")
    for _ in range(shards.bit_length() - 1):
        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x["quota"])

        def draw(acc, x):
            u = F.pmod(F.xxhash64(F.lit(seed), acc["node"], x["at"]), F.lit(2**52)) / float(2**52)
            got = F.when(acc["total"] > 0, hypergeometric(acc["total"], x["quota"], acc["drawn"], u)).otherwise(F.lit(0).cast("long"))
            return let(got, lambda g: F.struct(acc["node"].alias("node"), (acc["total"] - x["quota"]).alias("total"),
                                               (acc["drawn"] - g).alias("drawn"), F.array_append(acc["left"], g).alias("left")))
        begin = F.struct((F.col("node") * 2 + shards * 2).alias("node"), F.col("total"), F.ceil(F.col("total") / 2).cast("long").alias("drawn"),
                         F.array().cast("array<long>").alias("left"))
        level = (level.withColumn("total", total).withColumn("left", F.aggregate("q", begin, draw, lambda acc: acc["left"]))
                 .select(F.explode(F.array(
                     F.struct((F.col("node") * 2).alias("node"), F.zip_with("q", "left", lambda x, l: F.struct(x["at"].alias("at"), l.alias("quota"))).alias("q")),  # noqa: E741
                     F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("q", "left", lambda x, l: F.struct(x["at"].alias("at"), (x["quota"] - l).alias("quota"))).alias("q")),  # noqa: E741
                 )).alias("n")).select("n.node", "n.q"))
    return (level.select(F.col("node").cast("int").alias("shard"), F.explode("q").alias("x"))
            .select("shard", "x.at", "x.quota").where("quota > 0"))


def plan(lean: DataFrame, seed: int = 1, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, **weights):
    """(sources, blocks) for rows (source, size, hash).

    sources: source, words, target, n_blocks. blocks: source, block, passes
    (whole draws), part (drawn once more, up to the row hash ``cut`` if that is
    not null), shards (of each draw).
    """
    sums = stored(lean.groupBy("source").agg(F.sum("size").alias("words")), "mix-sizes")
    total = sums.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    size = max(block_words, -(-total // MAX_BLOCKS))
    at = Window.orderBy(F.col("source").asc_nulls_last())
    sources = stored(
        targets(sums, **weights)
        .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("words") / size)).cast("long"))
        .withColumn("at", F.row_number().over(at))
        .withColumn("passes", F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("int"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("words")), "mix-sources")
    placed = with_block(lean, sources)
    in_source = Window.partitionBy("at").orderBy("block")
    blocks = (placed.groupBy("at", "block").agg(F.sum("size").alias("size"))
              .join(sources.select("at", "passes", "rest"), "at")
              .withColumn("end", F.sum("size").over(in_source)).withColumn("begin", F.col("end") - F.col("size"))
              .withColumn("part", (F.col("begin") < F.col("rest"))).withColumn("goal", F.col("rest") - F.col("begin"))
              .withColumn("split", F.col("part") & (F.col("end") > F.col("rest"))))
    blocks = stored(blocks.select("at", "block", "passes", "part", "split", "goal"), "mix-blocks")
    # the row in each source's split block that comes nearest to the target
    inside = (placed.join(blocks.where("split").select("at", "block", "goal"), ["at", "block"])
              .groupBy("at", "block", "goal", "hash").agg(F.sum("size").alias("size"))
              .withColumn("end", F.sum("size").over(Window.partitionBy("at", "block").orderBy("hash")))
              .where(F.col("end") - F.col("size") / 2 <= F.col("goal")))
    cuts = inside.groupBy("at", "block").agg(F.max("hash").alias("cut"))
    blocks = (blocks.join(cuts, ["at", "block"], "left")
              .withColumn("part", F.col("part") & (~F.col("split") | F.col("cut").isNotNull())))
    blocks = stored(blocks.select("at", "block", "passes", "part", "cut"), "mix-blocks")
    draws = (blocks.withColumn("n", F.col("passes") + F.col("part").cast("int")).where("n > 0")
             .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select("at", "block", "copy"))
    quotas = stored(draws.groupBy("at").agg(F.count(F.lit(1)).alias("quota")), "mix-quotas")
    wanted = sources.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    shards = 1 << max(0, int(-(-wanted // shard_words)) - 1).bit_length()
    dealt = split_tree(quotas, shards, seed)
    begins = dealt.withColumn("pos", F.sum("quota").over(Window.partitionBy("at").orderBy("shard")) - F.col("quota"))
    in_draws = Window.partitionBy("at").orderBy("copy", F.xxhash64(F.lit(seed), "at", "copy", "block"), "block")
    numbered = draws.withColumn("pos", (F.row_number().over(in_draws) - 1).cast("long"))
    ranges = Window.partitionBy("at").orderBy("pos", F.col("block").asc_nulls_first())
    sharded = (begins.select("at", "pos", "shard", F.lit(None).cast("long").alias("block"), F.lit(None).cast("int").alias("copy"))
               .unionByName(numbered.withColumn("shard", F.lit(None).cast("int")))
               .withColumn("shard", F.last("shard", True).over(ranges)).where("block is not null")
               .groupBy("at", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("shards")))
    blocks = stored(blocks.join(sharded, ["at", "block"], "left"), "mix-blocks")
    return sources, blocks


def with_block(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows (source, hash, ...) with their source's number and their block."""
    own = sources.select(F.col("source").alias("_s"), "at", "n_blocks")
    return (rows.join(own, rows.source.eqNullSafe(own["_s"])).withColumn("block", F.pmod("hash", "n_blocks"))
            .drop("_s", "n_blocks"))


def draws_of(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows with at, block and hash -> with ``shards``, one entry for each time the row is drawn."""
    b = blocks.select("at", "block", "passes", "part", "cut", "shards")
    n = F.col("passes") + (F.col("part") & F.coalesce(F.col("hash") <= F.col("cut"), F.lit(True))).cast("int")
    return (rows.join(b, ["at", "block"]).withColumn("shards", F.when(n > 0, F.slice("shards", 1, n)).otherwise(F.array().cast("array<int>")))
            .drop("at", "block", "passes", "part", "cut"))


def lean_rows(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), n_words(F.col("text")).alias("size"),
                       row_hash(F.col("doc_id"), F.col("text"), seed).alias("hash"))


def assign(docs: DataFrame, seed: int = 1, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) of every row of (doc_id, text, source)."""
    lean = stored(lean_rows(docs, seed), "mix-rows")
    sources, blocks = plan(lean, seed, **options)
    drawn = draws_of(with_block(lean, sources), blocks)
    own = sources.select(F.col("source").alias("_s"), F.col("words").alias("source_size"), "target")
    return drawn.join(own, drawn.source.eqNullSafe(own["_s"])).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")


def mix(docs: DataFrame, seed: int = 1, **options) -> DataFrame:
    """The mixed rows: ``docs`` once for each draw, with mix_shard, mix_copy and mix_order.

    Rows without words take no words; they are kept out like undrawn rows.
    """
    if set(OWN) & set(docs.columns):
        raise ValueError(f"columns {OWN} are made here")
    sources, blocks = plan(stored(lean_rows(docs, seed), "mix-rows"), seed, **options)
    keyed = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(keyed.alias("row"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"),
                       row_hash(F.col("doc_id"), F.col("text"), seed).alias("hash")).where("size > 0")
    drawn = draws_of(with_block(rows, sources), blocks)
    each = drawn.select("row", "hash", F.posexplode("shards").alias("mix_copy", "mix_shard"))
    return each.select("row.*", "mix_shard", "mix_copy", F.xxhash64(F.lit(seed + 1), "hash", "mix_copy").alias("mix_order"))


def shuffled(mixed: DataFrame) -> DataFrame:
    """Shards side by side, the rows of each in random order."""
    return mixed.repartitionByRange("mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order")
