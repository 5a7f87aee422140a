"""Temperature mixing of sources, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Words in a block, and the most blocks of one source, which one window puts in order: blocks grow beyond that.
BLOCK_TOKENS, MOST_BLOCKS = 200_000, 4096
#: Halvings of the exponent's interval.
HALVINGS = 50
#: The block at a source's cut is filled in 2 ** RANGE_BITS parts.
RANGE_BITS = 10
#: Most rows of a table that is broadcast (some 50 bytes each); larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def weights(sources: DataFrame, repetition: float | None = 2.0, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """(source, tokens, weight, exponent, budget) from (source, tokens).

    weight = share ** exponent / sum of these. The exponent is bisected in [0, 1]: with entropy (a share of the largest
    possible) it is the largest at which the weights still have that entropy, else the smallest at which no source is
    repeated more than `repetition` times. Without a token budget the budget is what lets every source appear whole
    at least once. The only array is one entry per different size of a source, of which there are at most sqrt(2 * tokens).
    """
    sizes = sources.groupBy("tokens").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum(F.col("tokens") * F.col("n")).alias("all"), F.sort_array(F.collect_list(F.struct(F.col("tokens").cast("double").alias("t"), F.col("n").cast("double").alias("n")))).alias("sizes"))
    counted = F.transform("sizes", lambda s: F.struct((s["t"] / F.col("all")).alias("p"), s["n"].alias("n")))

    def over(f) -> Column:
        """The sum of f(share) over all sources."""
        return F.aggregate("counted", F.lit(0.0), lambda a, s: a + s["n"] * f(s["p"]))

    def meets(x: Column) -> Column:
        """Whether the exponent can be lower (repetition) or higher (entropy)."""
        norm = over(lambda p: F.pow(p, x))
        if entropy is not None:
            h = -over(lambda p: F.pow(p, x) / norm * F.log(F.pow(p, x) / norm))
            return h < F.log(over(lambda p: F.lit(1.0))) * entropy
        # A source is repeated weight * budget / tokens times.
        most = F.array_max(F.transform("shares", lambda p: F.pow(p, x - 1)))
        least = F.array_min(F.transform("shares", lambda p: F.pow(p, x - 1)))
        return (most / least if budget is None else most / norm * F.lit(float(budget)) / F.col("all")) <= F.lit(float(repetition or 1e300))

    state = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        mid = (acc["lo"] + acc["hi"]) / 2
        lower = meets(mid)
        return F.struct(F.when(lower, acc["lo"]).otherwise(mid).alias("lo"), F.when(lower, mid).otherwise(acc["hi"]).alias("hi"))

    bisected = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), state, halve)
    exponent = bisected["lo"] if entropy is not None else bisected["hi"]
    found = total.select("all", counted.alias("counted")).withColumn("shares", F.transform("counted", lambda s: s["p"]))
    found = found.withColumn("exponent", exponent)
    found = found.withColumn("norm", over(lambda p: F.pow(p, F.col("exponent"))))
    whole = F.ceil(F.array_max(F.transform("shares", lambda p: p * F.col("all") / (F.pow(p, F.col("exponent")) / F.col("norm"))))).cast("long") if budget is None else F.lit(budget).cast("long")
    found = found.withColumn("whole", whole).drop("counted", "shares")
    return sources.join(F.broadcast(found)).select("source", "tokens", (F.pow(F.col("tokens") / F.col("all"), F.col("exponent")) / F.col("norm")).alias("weight"), "exponent", F.col("whole").alias("budget"))


def free_name(columns: list[str], name: str = "mix") -> str:
    """name, with as many underscores before it as make it unlike all columns, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def mix(docs: DataFrame, repetition: float | None = 2.0, entropy: float | None = None, budget: int | None = None, seed: int = 0, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", info: str | None = "mix") -> DataFrame:
    """docs' rows as often as their source's weight asks for, with a struct column `info` (epoch, block, slot, n_tokens, weight, exponent).

    Tokens are words between white space, one at least. A source's budget is its weight times the budget. Whole epochs
    are taken first; the rest is a permutation of the source's blocks, cut where it is used up: inside the block at the
    cut, documents follow in a hashed order while they fit. Rows that are alike in id and text are taken together, so a
    source is short of its budget by less than one document with its repeats. Budgets are whole words, rounded up where no row may be lost, so a source
    may be repeated up to one word beyond its limit. slot orders the result: rows with slot up to x hold a
    share x of each source's budget, block by block. A null source is a source; a null text is an empty one, and texts are read
    whole. Nothing is dropped when no budget is given. An empty table gives no rows. docs' columns may have any names; a column of
    docs that is named as `info` takes its place, and with info = None there is no such column.
    """
    columns = docs.columns
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("null")).alias("source"),
        F.greatest(F.lit(1), F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(r"\S+")), F.lit(0))).cast("long").alias("n_tokens"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("key"),
    )
    slim = materialise(rows.select("source", "n_tokens", "key"), "mix_keys")
    sources = materialise(slim.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mix_sources")
    planned = weights(sources, repetition, entropy, budget)
    own = F.floor(F.col("weight") * F.col("budget") + 1e-6).cast("long")
    blocks = F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int")
    # The largest source's budget may fall below its size by rounding alone.
    near = F.when((own < F.col("tokens")) & (own >= F.col("tokens") - 1), F.col("tokens")).otherwise(own)
    planned = materialise(planned.withColumn("own", near).withColumn("epochs", F.floor(F.col("own") / F.col("tokens")).cast("int")).withColumn("blocks", blocks), "mix_plan")
    plan = _small(planned)
    block = F.pmod(F.xxhash64(F.lit(seed), "key"), F.col("blocks")).cast("int")
    totals = materialise(slim.join(plan, "source").withColumn("block", block).groupBy("source", "block").agg(F.sum("n_tokens").alias("size")), "mix_blocks")
    epoch = F.explode(F.sequence(F.lit(0), F.col("epochs")))
    order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", "source", "block"), "block")
    laid = totals.join(plan.select("source", "epochs", "tokens", "own"), "source").withColumn("epoch", epoch)
    laid = materialise(laid.withColumn("end", F.sum("size").over(order) + F.col("epoch") * F.col("tokens")).select("source", "block", "epoch", "size", "end", "own"), "mix_order")
    at_cut = laid.where((F.col("end") > F.col("own")) & (F.col("end") - F.col("size") < F.col("own")))
    inside = slim.join(plan, "source").withColumn("block", block).select("source", "block", "key", "n_tokens").groupBy("source", "block", "key").agg(F.sum("n_tokens").alias("n"))
    # The hashed order of the cut block is cut again, into RANGES of hashes: no window holds the block, however large it is.
    cut = inside.join(_small(at_cut), ["source", "block"]).withColumn("hash", F.xxhash64(F.lit(seed + 1), "key"))
    cut = cut.withColumn("range", F.shiftright("hash", 64 - RANGE_BITS))
    ranges = cut.groupBy("source", "range").agg(F.sum("n").alias("own_n"))
    before = ranges.withColumn("before", F.sum("own_n").over(Window.partitionBy("source").orderBy("range")) - F.col("own_n")).drop("own_n")
    fill = Window.partitionBy("source", "range").orderBy("hash", "key")
    cut = cut.join(_small(materialise(before, "mix_ranges")), ["source", "range"]).withColumn("used", F.col("end") - F.col("size") + F.col("before") + F.sum("n").over(fill))
    chosen = materialise(cut.where("used <= own").select("source", "key", F.col("epoch").alias("cut_epoch")), "mix_cut")
    placed = rows.join(plan, "source").withColumn("block", block).withColumn("epoch", epoch).join(_small(laid.drop("own")), ["source", "block", "epoch"])
    taken = placed.join(_small(chosen.withColumn("chosen", F.lit(True))), ["source", "key"], "left")
    keep = (F.col("end") <= F.col("own")) | (F.coalesce("chosen", F.lit(False)) & (F.col("epoch") == F.col("cut_epoch")) & (F.col("end") - F.col("size") < F.col("own")))
    slot = (F.col("end") - F.col("size")) / F.col("own")
    own_columns = [F.col("row")[c].alias(c) for c in columns]
    told = [] if info is None or info in columns else [F.struct("epoch", "block", slot.alias("slot"), "n_tokens", "weight", "exponent").alias(info)]
    return taken.where(keep).select(*own_columns, *told)
