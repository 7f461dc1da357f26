"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Among all document rates that give every source its target number of words, the rates of least
relative entropy to "each document once" are exponentially tilted: exp(lambda * size / mean size),
held at the largest number of copies. The tilt of each source is the root of the derivative of the
convex dual; Newton steps find it for all sources together, each step being one aggregate over the
histogram of (source, size). Rates are then rounded into whole copies: per source from the largest
size down, with the words left over carried to the next size, so that the sum stays at the target.
"""

from pyspark.sql import DataFrame, Window, functions as F

from .shelf import Shelf

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one source and size that one task ranks; larger strata are ranked in parts.
STRATUM_ROWS = 20_000
MOST_STEPS = 120


def word_count(text):
    """Number of maximal runs of other characters than space and 0x09-0x0D; null: 0."""
    words = F.split(text, r"[\x20\x09-\x0D]+", -1)
    empty = F.when(F.element_at(words, 1) == "", 1).otherwise(0) + F.when(
        (F.size(words) > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)
    return F.when(text.isNull(), 0).otherwise(F.size(words) - empty).cast("long")


def source_key(source):
    """A key that is never null and keeps null apart from every name."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(sizes: DataFrame, weights=(1, 2, 3), cap: int = 3) -> DataFrame:
    """key, source_size, documents, target: the share of each source in the sum of all sizes.

    Sources are numbered by code point, null last, and weigh `weights` in turn. A target stops at
    `cap` times its source's size; what is left over goes to the others by weight until none is
    above. One row per source: the windows run over sources, not over documents.
    """
    named = sizes.groupBy("key", "source").agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("documents"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(number, F.lit(len(weights))).cast("int") + 1)
    level = Window.orderBy("full_at", "key")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    every = level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (
        named.withColumn("weight", weight)
        # The level (words per weight) from which on a source is full.
        .withColumn("full_at", cap * F.col("source_size") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(every) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("reached", F.col("left") / F.col("open"))
        # Sources fill up in this order; the first one that does not stop sets the level.
        .withColumn("final", F.min(F.when(F.col("reached") <= F.col("full_at"), F.struct("full_at", "key", "reached"))).over(every)))
    full = F.col("final").isNull() | (F.struct("full_at", "key") < F.struct("final.full_at", "final.key"))
    target = F.when(full, (cap * F.col("source_size")).cast("double")).otherwise(F.col("weight") * F.col("final.reached"))
    return rows.select("key", "source_size", "documents", F.least(target, (cap * F.col("source_size")).cast("double")).alias("target"))


def balance(histogram: DataFrame, targets: DataFrame, shelf: Shelf, cap: int = 3, tolerance: float = 1e-9) -> DataFrame:
    """key, tilt: the dual solution of each source. A full source has no tilt (null): its rate is `cap`."""
    state = targets.select(
        "key", "target", (F.col("source_size") / F.col("documents")).alias("mean"),
        F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        F.lit(False).alias("done")).filter(
            (F.col("source_size") > 0) & (F.col("target") < cap * F.col("source_size") * (1 - 1e-12)))
    state = shelf.keep(state, "tilt-0")
    for step in range(1, MOST_STEPS + 1):
        x = F.col("size") / F.col("mean")
        free = F.exp(F.least(F.col("tilt") * x, F.lit(700.0)))
        words = F.col("n") * F.col("size")
        sums = histogram.join(state.filter("NOT done"), "key").groupBy("key").agg(
            F.sum(words * F.least(free, F.lit(float(cap)))).alias("got"),
            F.sum(F.when(free < cap, words * x * free).otherwise(0.0)).alias("slope"))
        miss = F.col("got") - F.col("target")
        low = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss >= 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - miss / F.when(F.col("slope") > 0, F.col("slope"))
        inside = (F.col("low2").isNull() | (newton > F.col("low2"))) & (F.col("high2").isNull() | (newton < F.col("high2")))
        far = F.greatest(F.abs(newton - F.col("tilt")), F.lit(0.0)) > 4 * (1 + F.abs("tilt"))
        halved = F.when(F.col("low2").isNotNull() & F.col("high2").isNotNull(), (F.col("low2") + F.col("high2")) / 2).otherwise(
            F.when(miss < 0, 2 * F.abs("tilt") + 1).otherwise(-2 * F.abs("tilt") - 1))
        # Met, or as near as the tilt can come: the bracket has no number inside.
        shut = F.col("high2") - F.col("low2") <= 1e-15 * F.greatest(F.abs("low2"), F.abs("high2"))
        done = F.col("done") | (F.abs(miss) <= tolerance * F.col("target")) | F.coalesce(shut, F.lit(False))
        moved = state.join(sums, "key", "left").withColumns({"low2": low, "high2": high}).withColumn("over", done).select(
            "key", "target", "mean",
            F.when(F.col("over"), F.col("tilt")).when(newton.isNotNull() & inside & ~far, newton).otherwise(halved).alias("tilt"),
            F.col("low2").alias("low"), F.col("high2").alias("high"), F.col("over").alias("done"))
        state = shelf.keep(moved, f"tilt-{step}")
        shelf.drop(f"tilt-{step - 1}")
        if state.filter("NOT done").isEmpty():
            break
    else:
        if not state.isEmpty():
            raise RuntimeError(f"targets of the mix are not met after {MOST_STEPS} steps")
    return state.select("key", "mean", "tilt")


def whole_copies(strata: DataFrame, cap: int = 3) -> DataFrame:
    """key, size, n, copies: copies of all n documents of a size together, from (key, size, n, rate).

    One fold per source over its distinct sizes, largest first: as many entries as there are
    different sizes, however many documents have them.
    """
    entry = F.struct((-F.col("size")).alias("order"), "size", "n", "rate")
    rows = strata.groupBy("key").agg(F.sort_array(F.collect_list(entry)).alias("sizes"))
    zero = F.struct(F.lit(0.0).alias("carry"), F.lit("").alias("said"))

    def step(state, e):
        want = e["n"] * e["rate"] * e["size"] + state["carry"]
        copies = F.greatest(F.lit(0).cast("long"), F.least(F.round(want / e["size"]).cast("long"), cap * e["n"]))
        return F.struct((want - copies * e["size"]).alias("carry"), F.concat(state["said"], copies.cast("string"), F.lit(",")).alias("said"))

    said = F.aggregate("sizes", zero, step)["said"]
    return rows.select("key", "sizes", F.split(said, ",").alias("copies")).select(
        "key", F.posexplode("sizes").alias("at", "e"), "copies").select(
        "key", "e.size", "e.n", F.col("copies")[F.col("at")].cast("long").alias("copies"))


def mix(docs: DataFrame, weights=(1, 2, 3), cap: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of `docs`.

    size is the number of words of the whole text (null: 0), copies the whole number of times the
    mix takes the document (0 to cap), taken = copies * size. The words taken from a source differ
    from its target by less than one document. Which documents of equal source and size get the
    last copies follows a hash of their ids, so that reruns agree. Null ids and repeated rows are
    documents like others; documents without words take nothing. Other columns are ignored.
    """
    decided, targets = _decided(docs, weights, cap)
    return decided.join(targets.select("key", "source_size", "target"), "key").select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _decided(docs: DataFrame, weights, cap: int, *carried) -> tuple[DataFrame, DataFrame]:
    """doc_id, source, key, size, the columns `carried` and copies of every row; and the targets."""
    shelf = Shelf(docs.sparkSession, "mixing")
    # Tells rows of one id apart; maps have no hash.
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    columns = [
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        source_key(F.col("source").cast("string")).alias("key"), word_count(F.col("text")).alias("size"), tie.alias("tie")]
    sizes = shelf.keep(docs.select(*columns), "sizes")
    targets = shelf.keep(source_targets(sizes, weights, cap), "targets")
    histogram = shelf.keep(sizes.filter("size > 0").groupBy("key", "size").agg(F.count("*").alias("n")), "histogram")
    tilts = balance(histogram, targets, shelf, cap)
    tilted = F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(700.0)))
    strata = shelf.keep(whole_copies(
        histogram.join(tilts, "key", "left").withColumn("rate", F.least(F.coalesce(tilted, F.lit(float(cap))), F.lit(float(cap)))),
        cap), "strata")
    shelf.drop("histogram")
    # The first `copies mod n` documents of a stratum, by hash, take one copy more than the others.
    def placed(rows):
        return rows.join(strata, ["key", "size"], "left").withColumn("part", F.pmod(
            F.xxhash64(F.coalesce("doc_id", "tie")), F.greatest(F.lit(1).cast("long"), F.floor(F.col("n") / STRATUM_ROWS))))

    known = shelf.keep(placed(sizes), "known")
    parts = known.filter(F.col("n") > STRATUM_ROWS).groupBy("key", "size", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("key", "size", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("key", "size", "part").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id", "tie")
    # Texts are not written again: carried columns are read with the documents.
    known = placed(docs.select(*columns, *carried)) if carried else known
    rows = known.filter("size > 0")
    ranked = rows.withColumn("rank", F.row_number().over(inside)).join(offsets, ["key", "size", "part"], "left").withColumn(
        "rank", F.col("rank") + F.coalesce("offset", F.lit(0)))
    copies = F.floor(F.col("copies") / F.col("n")) + (F.col("rank") <= F.col("copies") % F.col("n")).cast("long")
    kept = [c for c in known.columns if c not in ("tie", "n", "copies", "part")]
    return ranked.select(*kept, copies.cast("long").alias("copies")).union(
        known.filter("size = 0").select(*kept, F.lit(0).cast("long"))), targets


def mixed_documents(docs: DataFrame, weights=(1, 2, 3), cap: int = 3) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it; the columns stay.

    Documents without words, which no mix of words can weigh, stay once. Every row has its own
    copies, also when it shares a doc_id or has none.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    decided, _ = _decided(docs, weights, cap, row)
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).cast("int")
    return decided.select("row", times.alias("times")).filter("times > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("times")))).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
