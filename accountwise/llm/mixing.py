"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weight's share of the wanted words, at most ``cap`` times its own; what is cut off goes to the
others by weight. Within a source a document is expected in e copies: e falls slowly with the class of its size (powers
of two; 2^(-class / 16)), so that long documents are repeated less, is at most ``cap``, and the expected words are the
target. The whole part of e is certain. The fractions p are inclusion probabilities: documents are ranked by
the random odds u / (1 - u) divided by p / (1 - p), and the least are taken while their words fit in what the
certain copies leave of the target; a few more steps fill the gap before a long document with the next shorter ones.
u is a hash of id and text, so reruns agree.

Ranks are not sorted as a whole: words are summed by source and 65,536 ranges of the rank, and only the range that
crosses the target is put in order. A null text has no words; documents without words are never taken. A
null source is a source of its own, ordered last. Rows equal in id and text share their fate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwise.llm.texts import n_words, set_apart, stored, text_of, uniform

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
RANGES = 65_536
STEPS = 3
_TINY = 1e-9


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 42) -> DataFrame:
    """The documents with _source, _doc, _size and _u."""
    return docs.withColumns({
        "_source": F.col(source).cast("string"), "_doc": F.col(id).cast("long"), "_size": n_words(text),
        "_u": uniform(F.lit(seed), F.col(id).cast("long"), text_of(text)),
    })


def _class() -> Column:
    """The power of two below the size; 0 for a document without words."""
    return F.when(F.col("_size") > 0, F.floor(F.log2(F.col("_size").cast("double")) + _TINY)).otherwise(0).cast("int")


def targets(m: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(_source, source_size, target): one row for each source."""
    sizes = m.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    ranked = sizes.withColumn("k", F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("k") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", w).withColumn("most", F.col("source_size") * F.lit(cap))
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("most") / F.col("w"), "k")
    level = (
        F.sum("source_size").over(everything) * F.lit(share)
        - F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    leveled = ranked.withColumn("level", level)
    fits = F.when(F.col("most") >= F.col("level") * F.col("w") - _TINY, F.struct("most", "level"))
    # the first source, by words for its weight, that isn't full sets the level for all
    first = F.min(F.when(fits.isNotNull(), F.struct(F.col("most") / F.col("w"), F.col("k"), F.col("level")))).over(everything)
    return leveled.withColumn("level", first["level"]).select(
        "_source", "source_size",
        F.least("most", F.coalesce(F.col("level") * F.col("w"), F.col("most"))).alias("target"),
    )


def rates(m: DataFrame, goal: DataFrame, cap: float = CAP) -> DataFrame:
    """(_source, _class, whole, p, quota, ...): copies that are certain, and the odds of one more, by size class."""
    cells = m.where("_size > 0").groupBy("_source", _class().alias("_class")).agg(F.sum("_size").alias("words"))
    cells = cells.join(goal.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")))
    h = F.pow(F.lit(2.0), -F.col("_class") / F.lit(16.0))
    source = Window.partitionBy("_source")
    order = source.orderBy("_class")
    cells = cells.withColumn("h", h).withColumn(
        "c",
        (F.col("target") - cap * F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        / F.sum(F.col("h") * F.col("words")).over(order.rowsBetween(0, Window.unboundedFollowing)),
    )
    first = F.min(F.when(F.col("c") * F.col("h") <= cap + _TINY, F.struct("_class", "c"))).over(source)
    e = F.least(F.lit(cap), F.coalesce(first["c"] * F.col("h"), F.lit(cap)))
    cells = cells.withColumn("e", e).withColumn("whole", F.floor(F.col("e") + _TINY))
    cells = cells.withColumn("p", F.greatest(F.col("e") - F.col("whole"), F.lit(0.0)))
    cells = cells.withColumn("p", F.when(F.col("p") > _TINY, F.col("p")))
    quota = F.col("target") - F.sum(F.col("whole") * F.col("words")).over(source)
    return cells.withColumn("quota", quota).select(
        F.col("_source").alias("_s"), F.col("_class").alias("_c"), "whole", "p", "quota"
    )


def _ranked(m: DataFrame, rate: DataFrame) -> DataFrame:
    odds = (F.col("_u") / (1 - F.col("_u"))) * ((1 - F.col("p")) / F.col("p"))
    return (
        m.withColumn("_class", _class())
        .join(rate, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c")), "left")
        .withColumn("_rank", odds)
        .withColumn("_range", F.floor(F.col("_rank") / (1 + F.col("_rank")) * RANGES).cast("int"))
        .drop("_s", "_c")
    )


def _chosen(k: int) -> Column:
    """Whether one of the first k steps takes the document once more."""
    own = F.struct(F.col("_rank").alias("rank"), F.col("_doc").alias("doc"))
    chosen = F.lit(False)
    for i in range(k):
        below = F.col(f"edge{i}").isNull() | (F.col("_range") < F.col(f"edge{i}"))
        at = (F.col("_range") == F.col(f"edge{i}")) & F.coalesce(own <= F.col(f"last{i}"), F.lit(False))
        chosen = chosen | F.coalesce((F.col("_size") <= F.col(f"most{i}")) & (below | at), F.lit(False))
    return F.col("p").isNotNull() & (F.col("_size") > 0) & chosen


def limits(m: DataFrame, rate: DataFrame, steps: int = STEPS) -> DataFrame:
    """(_l, most0, edge0, last0, most1, ...): what each source takes once more.

    Step k takes, in the order of ranks, documents of at most ``most`` words that earlier steps left: all in ranges before
    ``edge`` and, in that range, up to the rank and id in ``last``. ``most`` is what is missing to the quota, so later
    steps fill the gap before a long document with shorter ones.
    """
    ranked = _ranked(m, rate).where("p is not null and _size > 0")
    found = rate.select(F.col("_s").alias("_l")).distinct()
    same = F.col("_source").eqNullSafe(F.col("_l"))
    own = F.struct(F.col("_rank").alias("rank"), F.col("_doc").alias("doc"))
    for k in range(steps):
        state = ranked.join(found, same).withColumn("_in", _chosen(k))
        rest = state.groupBy("_source", "quota").agg(F.sum(F.when(F.col("_in"), F.col("_size"))).alias("has")).select(
            F.col("_source").alias("_s"), (F.col("quota") - F.coalesce("has", F.lit(0))).alias("most")
        )
        rest = stored(rest.where("most > 0"), "rest")
        left = state.where("not _in").join(rest, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_size") <= F.col("most")))
        sums = left.groupBy("_source", "_range", "most").agg(F.sum("_size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("_source").orderBy("_range"))
        crossing = sums.withColumn("before", upto - F.col("words")).where("before <= most and before + words > most").select(
            F.col("_source").alias("_t"), F.col("_range").alias("_r"), (F.col("most") - F.col("before")).alias("space")
        )
        edge = left.join(crossing, F.col("_source").eqNullSafe(F.col("_t")) & (F.col("_range") == F.col("_r")))
        upto = F.sum("_size").over(Window.partitionBy("_t").orderBy("_rank", "_doc", "_size"))
        last = edge.withColumn("upto", upto).where("upto <= space").groupBy("_t").agg(F.max(own).alias("last"))
        step = rest.join(crossing, F.col("_s").eqNullSafe(F.col("_t")), "left").join(
            last.withColumnRenamed("_t", "_u"), F.col("_s").eqNullSafe(F.col("_u")), "left"
        ).select("_s", F.col("most").alias(f"most{k}"), F.col("_r").alias(f"edge{k}"), F.col("last").alias(f"last{k}"))
        found = stored(found.join(step, F.col("_l").eqNullSafe(F.col("_s")), "left").drop("_s"), "limits")
    return found


def mixture(m: DataFrame, goal: DataFrame, rate: DataFrame, limit: DataFrame, steps: int = STEPS) -> DataFrame:
    """The measured documents with source_size, target, copies and taken."""
    joined = _ranked(m, rate).join(limit, F.col("_source").eqNullSafe(F.col("_l")), "left").join(
        goal.withColumnRenamed("_source", "_g"), F.col("_source").eqNullSafe(F.col("_g"))
    )
    copies = F.coalesce(F.col("whole"), F.lit(0)) + F.when(_chosen(steps), 1).otherwise(0)
    copies = F.when(F.col("_size") > 0, copies).otherwise(0).cast("long")
    return joined.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("_size"))


def mixed(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 42,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row."""
    m = stored(measured(docs, id, text, source, seed).select("_source", "_doc", "_size", "_u"), "sizes")
    goal = stored(targets(m, weights, share, cap), "targets")
    rate = stored(rates(m, goal, cap), "rates")
    return mixture(m, goal, rate, limits(m, rate)).select(
        F.col("_doc").alias("doc_id"), F.col("_source").alias("source"), F.col("_size").alias("size"), "source_size",
        "target", "copies", "taken",
    )


def drawn(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 42,
) -> DataFrame:
    """The documents that the mix takes, columns as given, and how often: ``mix_copies``, ``mix_target``."""
    names = docs.columns
    m = measured(set_apart(docs), f"in_{id}", f"in_{text}", f"in_{source}", seed)
    slim = stored(m.select("_source", "_doc", "_size", "_u"), "sizes")
    goal = stored(targets(slim, weights, share, cap), "targets")
    rate = stored(rates(slim, goal, cap), "rates")
    out = mixture(m, goal, rate, limits(slim, rate))
    return out.where("copies > 0").select(
        *(F.col(f"`in_{c}`").alias(c) for c in names), F.col("copies").alias("mix_copies"), F.col("target").alias("mix_target"),
    )
