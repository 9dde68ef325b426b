"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

A document's rate (how many copies of it the mix takes, on average) starts at 1. Among all rates that give each
source its target of words, and none above ``cap``, entropy balancing takes those that diverge least from 1
(Kullback-Leibler). By duality these are exponentially tilted: rate = min(cap, exp(a * size)) with one multiplier a
per source, which solves a convex problem in that one unknown per source.

1. Spark counts the words of every whole text, and the texts per (source, size); all that follows but the last
   step works on these counts, which are few and the same whatever the order of rows.
2. Targets: sources share all words by weight; a target stops at ``cap`` times its source, and the excess is shared
   again by weight. The level at which no source is above comes from sources sorted by cap per weight.
3. Newton iterations on the dual, all sources at once: each is one aggregate of the words taken (gradient) and of
   their derivative (curvature), joined to the multipliers. A step that leaves the bracket known to hold
   the solution, or a source without curvature, halves the bracket. A source is done when its words are
   within ``tolerance`` of its target.
4. Rounding: rates in whole millionths are summed up over a source's sizes from large to small, and a group of equal
   texts gets the copies by which the sum, rounded, grows. What a source then lacks or has too much (half its
   longest text at most) is evened out by single copies of a few sizes per power of two.
5. The copies of a group are dealt to its documents by a hash of the id; a group of more than ``rows_per_task``
   documents is dealt in parts of its own, so that no task holds a hot source, size or group of copies.

Defined results: a null or blank text has size 0 and takes 0 words; a null source is one of its own, after all
others; documents of one source and size without id, or with the same id, are told apart by their texts, and are
interchangeable if these are equal too; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentyield.llm.tables import durable, stored

#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
CAP = 3
TOLERANCE = 1e-9
ROWS_PER_TASK = 1_000_000
#: Most groups of documents that may be dealt in parts; the table of them is broadcast.
MAX_HOT = 100_000
MAX_STEPS = 200
_UNIT = 1_000_000
_BIG = "decimal(38,0)"


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(id, src, size, h): words of each text, the source as a sortable text (null last), a hash to tell texts apart."""
    words = F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    # byte order of UTF-8 is the order of code points
    src = F.when(F.col(source).isNull(), F.lit("z")).otherwise(F.concat(F.lit("v"), F.col(source).cast("string")))
    return docs.select(F.col(key).cast("long").alias("id"), src.alias("src"), words.alias("size"),
                       F.xxhash64(F.col(key).cast("long"), F.col(text).cast("string")).alias("h"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(src, total) → with ``target``: shares by weight of all words, none above ``cap`` times its source.

    Works on one row per source. Sorted by cap per weight, the sources that are capped come first: source k is if
    its cap is at most its share of what the earlier ones leave.
    """
    nth = (F.row_number().over(Window.orderBy("src")) - 1) % len(weights)
    rows = sources.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), nth + 1).cast(_BIG))
    rows = rows.withColumn("most", (F.lit(cap) * F.col("total")).cast(_BIG))
    order = Window.orderBy((F.col("most") / F.col("w")).cast("double"), "src")
    earlier, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    rows = rows.withColumns({
        "left": F.sum(F.col("total").cast(_BIG)).over(everything) - F.coalesce(F.sum("most").over(earlier), F.lit(0).cast(_BIG)),
        "weight_left": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(earlier), F.lit(0).cast(_BIG))})
    capped = (F.col("most").cast("double") * F.col("weight_left").cast("double")) <= (F.col("w").cast("double") * F.col("left").cast("double"))
    rows = rows.withColumn("capped", capped)
    # the level is what the last source before the first free one leaves, per weight
    level = F.min_by(F.when(~F.col("capped"), F.col("left").cast("double") / F.col("weight_left").cast("double")),
                     F.when(~F.col("capped"), F.col("most").cast("double") / F.col("w").cast("double"))).over(everything)
    return rows.select("src", "total", F.when(F.col("capped"), F.col("most").cast("double"))
                       .otherwise(F.col("w").cast("double") * level).alias("target"))


def _rate(multiplier: Column, size: Column, cap: int) -> Column:
    return F.exp(F.least(multiplier * size, F.log(F.lit(float(cap)))))


def multipliers(counts: DataFrame, goals: DataFrame, cap: int = CAP, tolerance: float = TOLERANCE,
                max_steps: int = MAX_STEPS) -> DataFrame:
    """(src, a): the dual solution per source, by Newton iterations on (src, size, n) and (src, total, target).

    A source whose target is its ``cap`` has no finite solution: its rates are ``cap`` (a is null); likewise
    without words. Sizes are measured in the source's mean size, so that a is of the order of 1.
    """
    texts = counts.filter(F.col("size") > 0)
    unit = texts.groupBy("src").agg((F.sum(F.col("n") * F.col("size")).cast("double") / F.sum("n")).alias("unit"), F.max("size").alias("top"),
                                    F.min("size").alias("low"))
    state = goals.join(unit, "src").filter((F.col("target") > 0) & (F.col("target") < cap * F.col("total") * (1 - 1e-12)))
    # where a solution can be: all rates at the cap on one side, none of a word left on the other
    high = F.log(F.lit(float(cap))) * F.col("unit") / F.col("low")
    low = F.log(F.least(F.col("target") / F.col("total"), F.lit(1.0))) * F.col("unit") / F.col("low")
    state = durable(state.select("src", "target", "unit", F.lit(0.0).alias("a"), (low - 1).alias("lo"), (high + 1).alias("hi"),
                                 F.lit(False).alias("done")))
    texts = durable(texts.select("src", "size", "n"))
    for _ in range(max_steps):
        if state.filter(~F.col("done")).isEmpty():
            return state.select("src", (F.col("a") / F.col("unit")).alias("a"))
        x = F.col("size") / F.col("unit")
        r = _rate(F.col("a"), x, cap)
        taken = F.col("n") * F.col("size") * r
        open_ = state.filter(~F.col("done"))
        sums = (texts.join(open_.select("src", "a", "unit"), "src").groupBy("src")
                .agg(F.sum(taken).alias("words"), F.sum(F.when(F.col("a") * x < F.log(F.lit(float(cap))), taken * x).otherwise(0.0)).alias("slope")))
        step = open_.join(sums, "src")
        gap = F.col("words") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("a")).otherwise(F.col("lo")), F.when(gap > 0, F.col("a")).otherwise(F.col("hi"))
        step = step.withColumns({"lo": lo, "hi": hi, "newton": F.when(F.col("slope") > 0, F.col("a") - gap / F.col("slope"))})
        inside = F.coalesce((F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi")), F.lit(False))
        middle = (F.col("lo") + F.col("hi")) / 2
        near = (F.abs(gap) <= tolerance * F.col("target")) | (middle <= F.col("lo")) | (middle >= F.col("hi"))
        step = step.select("src", "target", "unit", F.when(near, F.col("a")).when(inside, F.col("newton")).otherwise(middle).alias("a"),
                           "lo", "hi", near.alias("done"))
        state = durable(step.unionByName(state.filter("done")))
    raise RuntimeError(f"no solution within {max_steps} steps")


def group_copies(counts: DataFrame, goals: DataFrame, solved: DataFrame, cap: int = CAP) -> DataFrame:
    """(src, size, n) → with ``target``, ``total`` and the whole ``copies`` of the group's documents together."""
    rows = counts.join(goals, "src").join(solved, "src", "left")
    rate = (F.when(F.col("size") == 0, F.lit(0.0)).when(F.col("target") <= 0, F.lit(0.0))
            .when(F.col("a").isNull(), F.lit(float(cap))).otherwise(_rate(F.col("a"), F.col("size"), cap)))
    rows = rows.withColumn("parts", (F.round(rate * _UNIT).cast("long") * F.col("n")).cast(_BIG))
    upto = F.sum("parts").over(Window.partitionBy("src").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0))
    rounded = lambda c: F.expr(f"CAST(({c} + {_UNIT // 2}) div {_UNIT} AS DECIMAL(38,0))")       # noqa: E731
    rows = rows.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("parts"))
    rows = durable(rows.withColumn("copies", (rounded("upto") - rounded("before")).cast("long"))
                   .select("src", "size", "n", "total", "target", "copies"))
    return rows.join(_corrections(rows, cap).withColumnsRenamed({"src": "_src", "size": "_size"}),
                     (F.col("src") == F.col("_src")) & (F.col("size") == F.col("_size")), "left") \
        .withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0).cast("long"))).drop("_src", "_size", "more")


def _corrections(rows: DataFrame, cap: int, per_class: int = 4) -> DataFrame:
    """(src, size, more): copies that bring a source's words to its target.

    ``per_class`` sizes of each power of two at most take part: some 80 a source, whatever the number of
    documents. They first take up what is lacking (or give up what is too much), large ones first; then one copy more of
    one size and one less of another, whichever two (or one) come nearest to the target.
    """
    lack = rows.groupBy("src").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("lack"))
    some = rows.filter(F.col("size") > 0).withColumn("class", F.floor(F.log2(F.col("size").cast("double"))))
    some = some.withColumn("_i", F.row_number().over(Window.partitionBy("src", "class").orderBy(F.desc("size")))).filter(F.col("_i") <= per_class)
    each = some.groupBy("src").agg(F.sort_array(F.collect_list(F.struct("size", "n", "copies")), asc=False).alias("e")).join(lack, "src")
    move = (f"CASE WHEN acc.lack > 0 THEN least(CAST(floor(acc.lack / g.size) AS BIGINT), {cap} * g.n - g.copies) "
            "ELSE -least(CAST(floor(-acc.lack / g.size) AS BIGINT), g.copies) END")
    walk = F.expr(f"""
        aggregate(e, named_struct('lack', lack, 'e', CAST(array() AS ARRAY<STRUCT<size: BIGINT, n: BIGINT, copies: BIGINT, more: BIGINT>>)),
          (acc, g) -> named_struct('lack', acc.lack - g.size * {move},
            'e', array_append(acc.e, named_struct('size', g.size, 'n', g.n, 'copies', g.copies + {move}, 'more', {move}))))""")
    each = each.select("src", walk.alias("w")).select("src", "w.lack", "w.e")
    add = f"concat(array(0L), transform(filter(e, g -> g.copies < {cap} * g.n), g -> g.size))"
    less = "concat(array(0L), transform(filter(e, g -> g.copies > 0), g -> g.size))"
    each = each.withColumns({"_add": F.expr(add), "_less": F.expr(less)})
    best = F.expr("array_min(flatten(transform(_add, a -> transform(_less, b -> named_struct('off', abs(lack - a + b), 'a', a, 'b', b)))))")
    each = each.withColumn("best", best)
    more = F.expr("transform(e, g -> named_struct('size', g.size, 'more', g.more + int(g.size = best.a) - int(g.size = best.b)))")
    return each.select("src", F.explode(more).alias("m")).select("src", "m.size", "m.more").filter("more != 0")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, tolerance: float = TOLERANCE,
          rows_per_task: int = ROWS_PER_TASK, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, size, source_size, target, taken): one row per input row; ``taken`` is copies times size."""
    rows = stored(sized(docs, key, text, source))
    counts = durable(rows.groupBy("src", "size").agg(F.count("*").alias("n")))
    goals = durable(targets(counts.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("total")), weights, cap))
    groups = durable(group_copies(counts, goals, multipliers(counts, goals, cap, tolerance), cap))
    return _dealt(rows, groups, rows_per_task).select(
        F.col("id").alias(key), "size", F.col("total").alias("source_size"), "target", (F.col("each") * F.col("size")).alias("taken"))


def _dealt(rows: DataFrame, groups: DataFrame, rows_per_task: int) -> DataFrame:
    """Copies of a group dealt to its documents: ``copies div n`` each, and one more to the first by hash."""
    # groups too large for a task: at most MAX_HOT, so their table may be broadcast
    limit = max(rows_per_task, -(-(groups.agg(F.sum("n")).first()[0] or 0) // MAX_HOT))
    hot = groups.filter(F.col("n") > limit).select(F.col("src").alias("_s"), F.col("size").alias("_z"), F.ceil(F.col("n") / limit).alias("_k"))
    rows = rows.join(F.broadcast(hot), (F.col("src") == F.col("_s")) & (F.col("size") == F.col("_z")), "left")
    rows = rows.withColumn("part", F.pmod("h", F.coalesce("_k", F.lit(1).cast("long")))).drop("_s", "_z", "_k")
    parts = rows.groupBy("src", "size", "part").agg(F.count("*").alias("m"))
    parts = parts.join(groups.withColumnsRenamed({"src": "_s", "size": "_z"}), (F.col("src") == F.col("_s")) & (F.col("size") == F.col("_z")))
    upto = F.sum("m").over(Window.partitionBy("src", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("upto", upto).withColumn("over", F.expr("copies % n"))
    share = F.expr("CAST((CAST(over AS DECIMAL(19,0)) * upto) div n - (CAST(over AS DECIMAL(19,0)) * (upto - m)) div n AS BIGINT)")
    parts = parts.select("_s", "_z", F.col("part").alias("_p"), "total", "target", F.expr("copies div n").alias("base"), share.alias("extra"))
    nth = F.row_number().over(Window.partitionBy("src", "size", "part").orderBy("h", "id"))
    return (rows.withColumn("nth", nth)
            .join(parts, (F.col("src") == F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("part") == F.col("_p")))
            .withColumn("each", F.col("base") + (F.col("nth") <= F.col("extra")).cast("long")))
