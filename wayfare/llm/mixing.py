"""Mixing sources to target weights by entropy balancing.

Document rates stay as close to 1 as possible in relative entropy while each
source's expected words meet its target. The convex dual has one multiplier
per source; its solution tilts rates exponentially in the document's size,
`rate = min(cap, exp(multiplier * size / mean size))`. Newton iterations on the
dual are Spark aggregations over (source, size) cells, which documents are
counted into once. A bracket around each multiplier catches steps that leave
it, so every source converges.

Rates become whole copies by systematic rounding along the sizes of a source:
the k-th document gets the whole numbers that the running sum of rates passes.
The error is then a difference of neighbouring sizes. Every other size belongs
to a second running sum, and of `PHASES` offsets for either sum the pair that
comes nearest to the target is taken. Only aggregated cells are
summed along a source; documents of one cell are numbered in groups of
`2^GROUP_BITS` consecutive ids.

Sums over cells are decimal, so reruns agree whatever the order of addition.

A null source is one source, last in order. Null and empty texts have size 0
and count no words. Repeated rows are separate documents. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import PLAIN_WORD, one_of_each
from wayfare.session import new_run_dir, store

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
PHASES = 32
TOLERANCE = 1e-7
GROUP_BITS = 16
ROUNDS = 200

_BEFORE = (Window.unboundedPreceding, -1)


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(PLAIN_WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A source as text that is never null and sorts by code point, null last."""
    name = source.cast("string")
    return F.concat(F.when(name.isNull(), F.lit("1")).otherwise(F.lit("0")), F.coalesce(name, F.lit("")))


def _exact(x: Column) -> Column:
    return F.sum(x.cast("decimal(38,6)")).cast("double")


def targets(cells: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """`cells(key, size, n)` -> `(key, source_size, mean, target)`, one row per source.

    Every source gets its share of all words by weight, at most `cap` times its
    own; what is cut off is shared by weight among the others. The sources that
    end at the cap are those with the least cap * size / weight: filled in that
    order, a source is capped while the words left per weight left reach that
    ratio.
    """
    per_source = cells.groupBy("key").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(F.lit(0))).alias("with_words"),
    )
    place = F.row_number().over(Window.orderBy("key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    weighed = per_source.withColumn("weight", weight).withColumn(
        "ratio", F.lit(float(cap)) * F.col("source_size") / F.col("weight")
    )
    earlier = Window.orderBy("ratio", "key").rowsBetween(*_BEFORE)
    everything = Window.partitionBy()
    words_left = F.sum("source_size").over(everything) - F.lit(float(cap)) * F.coalesce(
        F.sum("source_size").over(earlier), F.lit(0)
    )
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    filled = weighed.withColumn("level", words_left / weight_left).withColumn(
        "capped", F.col("level") >= F.col("ratio")
    )
    open_level = F.min(F.when(~F.col("capped"), F.struct("ratio", "key", "level"))).over(everything)
    return filled.select(
        "key",
        "source_size",
        F.greatest(F.col("source_size") / F.greatest("with_words", F.lit(1)), F.lit(1.0)).alias("mean"),
        F.when(F.col("capped"), F.lit(float(cap)) * F.col("source_size"))
        .otherwise(F.col("weight") * open_level["level"])
        .alias("target"),
    )


def _tilt(cap: float) -> Column:
    tilted = F.exp(F.least(F.lit(50.0), F.col("multiplier") * F.col("size") / F.col("mean")))
    return F.least(F.lit(float(cap)), tilted)


def solve(
    cells: DataFrame, goals: DataFrame, cap: float = CAP, tolerance: float = TOLERANCE, rounds: int = ROUNDS
) -> DataFrame:
    """Newton iterations on the dual: `goals` with each source's multiplier.

    Each round is one aggregation over the cells, written to the shared folder.
    A source is settled when its words are within `tolerance` of the target, or
    its bracket cannot be halved any further; one that is not settled after
    `rounds` is an error.
    """
    run = new_run_dir(cells.sparkSession, "newton")
    # All documents at the cap, or no words at all: nothing to solve.
    at_cap = F.col("target") >= F.col("source_size") * F.lit(float(cap)) * (1 - 1e-12)
    state = goals.select(
        "*",
        F.when(at_cap & (F.col("source_size") > 0), F.lit(1e300)).otherwise(F.lit(0.0)).alias("multiplier"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        at_cap.alias("settled"),
    )
    state = store(state, f"{run}/0")
    at, gap = F.col("multiplier"), F.col("reached") - F.col("target")
    low = F.when(gap < 0, at).otherwise(F.col("low"))
    high = F.when(gap > 0, at).otherwise(F.col("high"))
    newton = at - gap / F.col("slope")
    # Outside the bracket: halve it, or double the step where it is open.
    step = F.greatest(F.lit(1.0), F.abs(at))
    middle = F.when(low.isNotNull() & high.isNotNull(), (low + high) / 2).otherwise(
        F.when(gap > 0, at - step).otherwise(at + step)
    )
    inside = (
        (F.col("slope") > 0)
        & (F.abs(newton - at) <= 4 * step)
        & F.coalesce(newton > low, F.lit(True))
        & F.coalesce(newton < high, F.lit(True))
    )
    done = (F.abs(gap) <= tolerance * F.col("target") + 1e-3) | F.coalesce(
        F.abs(high - low) <= 1e-14 * F.abs(at), F.lit(False)
    )
    settled = F.col("settled")
    for k in range(1, rounds + 1):
        rate = _tilt(cap)
        words = F.col("size") * F.col("n") * rate
        sums = (
            cells.join(state.where(~settled), "key")
            .groupBy("key")
            .agg(
                _exact(words).alias("reached"),
                _exact(F.when(rate < cap, words * F.col("size") / F.col("mean")).otherwise(F.lit(0.0))).alias("slope"),
            )
        )
        state = store(
            state.join(sums, "key", "left").select(
                "key", "source_size", "mean", "target",
                F.when(settled | done, at).when(inside, newton).otherwise(middle).alias("multiplier"),
                F.when(settled, F.col("low")).otherwise(low).alias("low"),
                F.when(settled, F.col("high")).otherwise(high).alias("high"),
                (settled | done).alias("settled"),
            ),
            f"{run}/{k}",
        )
        if state.where(~settled).isEmpty():
            break
    else:
        open_sources = state.where(~settled).count()
        raise RuntimeError(f"{open_sources} sources have no multiplier within {tolerance} after {rounds} rounds")
    return state.select("key", "source_size", "mean", "target", "multiplier")


def _plan(cells: DataFrame, solved: DataFrame, cap: float) -> DataFrame:
    """Cells with their rate, the sum of rates before them, and the phase of their half."""
    # Cells, not documents: one row per source and distinct size.
    by_size = Window.partitionBy("key").orderBy("size")
    along = Window.partitionBy("key", "half").orderBy("size").rowsBetween(*_BEFORE)
    rated = (
        cells.join(solved, "key")
        .withColumn("rate", _tilt(cap))
        .withColumn("half", F.pmod(F.row_number().over(by_size) - 1, F.lit(2)))
        .withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(along), F.lit(0.0)))
    )
    offset = (F.col("phase") + 0.5) / PHASES
    given = F.floor(F.col("before") + F.col("n") * F.col("rate") + offset) - F.floor(F.col("before") + offset)
    words = (
        rated.select("*", F.explode(F.sequence(F.lit(0), F.lit(PHASES - 1))).alias("phase"))
        .groupBy("key", "half", "phase")
        .agg(F.sum(F.col("size") * given).alias("words"), F.max("target").alias("target"))
    )
    first = words.where("half = 0").select("key", "target", F.col("words").alias("w0"), offset.alias("offset0"))
    second = words.where("half = 1").select("key", F.col("words").alias("w1"), offset.alias("offset1"))
    # Every pair of phases, so PHASES^2 rows a source.
    miss = F.abs(F.col("w0") + F.coalesce("w1", F.lit(0)) - F.col("target")).alias("miss")
    best = (
        first.join(second, "key", "left")
        .groupBy("key")
        .agg(F.min(F.struct(miss, "offset0", "offset1")).alias("best"))
        .select("key", "best.offset0", "best.offset1")
    )
    chosen = F.when(F.col("half") == 0, F.col("offset0")).otherwise(F.col("offset1"))
    return rated.join(best, "key").select(
        "key", "size", "source_size", "target", "rate", "before", chosen.alias("offset")
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """`docs(doc_id, source, text)` -> a row per row with its copies in the mix.

    Columns: doc_id, source, text_key (a hash of the text), size, source_size,
    target, rate, copies.
    """
    run = new_run_dir(docs.sparkSession, "mix")
    text_key = F.xxhash64("text")
    sized = one_of_each(docs, "doc_id", "source", "text").select(
        "doc_id",
        "source",
        text_key.alias("text_key"),
        source_key(F.col("source")).alias("key"),
        words_in(F.col("text")).alias("size"),
        # Ids of one group are neighbours, so a group has few rows however hot its cell is.
        F.coalesce(F.shiftright(F.col("doc_id").cast("long"), GROUP_BITS), text_key).alias("id_group"),
    )
    sized = store(sized, f"{run}/sized")
    groups = store(sized.groupBy("key", "size", "id_group").agg(F.count("*").alias("n")), f"{run}/groups")
    cells = store(groups.groupBy("key", "size").agg(F.sum("n").alias("n")), f"{run}/cells")
    plan = _plan(cells, solve(cells, targets(cells, weights, cap), cap), cap)
    in_cell = Window.partitionBy("key", "size").orderBy("id_group").rowsBetween(*_BEFORE)
    starts = groups.select(
        "key", "size", "id_group", F.coalesce(F.sum("n").over(in_cell), F.lit(0)).alias("skipped")
    ).join(plan, ["key", "size"])
    in_group = Window.partitionBy("key", "size", "id_group").orderBy("doc_id", "text_key")
    numbered = sized.withColumn("k", F.row_number().over(in_group))

    def passed(k: Column) -> Column:
        return F.floor(F.col("before") + k * F.col("rate") + F.col("offset"))

    place = F.col("skipped") + F.col("k")
    copies = F.least(passed(place) - passed(place - 1), F.lit(int(cap)))
    return numbered.join(starts, ["key", "size", "id_group"]).select(
        "doc_id", "source", "text_key", "size", "source_size", "target", "rate", copies.cast("int").alias("copies")
    )


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The rows of `docs`, all columns, each as often as the mix takes it.

    Rows that agree in id, source and text count as one here, which is taken as
    often as all of them.
    """
    names = docs.columns

    def keyed(df: DataFrame, text_key: Column) -> DataFrame:
        rest = F.xxhash64(text_key, F.col("doc_id").isNull(), source_key(F.col("source")))
        return df.withColumns({"__id": F.coalesce("doc_id", F.lit(0)), "__rest": rest})

    taken = (
        keyed(mix(docs, weights, cap), F.col("text_key"))
        .groupBy("__id", "__rest")
        .agg(F.sum("copies").cast("int").alias("__copies"))
        .where("__copies > 0")
    )
    taken = store(taken, new_run_dir(docs.sparkSession, "taken"))
    return (
        keyed(docs, F.xxhash64("text"))
        .join(taken, ["__id", "__rest"])
        .dropDuplicates(["__id", "__rest"])
        .select(*[F.col(f"`{c}`") for c in names], F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy"))
        .select(*[F.col(f"`{c}`") for c in names])
    )
