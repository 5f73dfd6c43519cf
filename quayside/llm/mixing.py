"""Mixing of sources to target weights by weighted sampling without replacement (Efraimidis and Spirakis).

Each source gets a target of words. As many complete epochs as fit come first: every document of the source, that many times. The rest
is selected: each document draws an exponential key, scaled by its quality weight, and documents are taken in the order of their
keys until the prefix sum of their sizes reaches the rest; the document at the edge gives as many words as are missing. Keys come from
a digest of the document's id, so a rerun takes the same words. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import first_of_ranges, ordered, ranked, written

WEIGHTS = (5, 2, 1)
# A source is taken this many times at most.
MOST_EPOCHS = 3
SEED = "mix"
# Digits of a digest that make a draw: 52 bits, exact as a double.
_HEX = 13


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")).cast("long"), F.lit(0).cast("long"))


def exponential_key(id_text: Column, weight: Column, seed: str = SEED) -> Column:
    """``-ln(u) / weight`` with u in (0, 1) from a digest of the id; a document of twice the weight comes first twice as often."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), id_text).cast("binary")), 1, _HEX), 16, 10).cast("double")
    return -F.log((drawn + 0.5) / float(1 << 4 * _HEX)) / weight


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``sources`` (source_key, source_size; stored) with weight and target: the sum of all sizes shared by weight.

    The weights go round over the sources in the order of source_key, null last. A target above ``most`` times its source's size stops
    there, and the excess is shared again by weight until none is above. One short row per source; the loop asks for two sums a round
    and caps at least one source in each, usually many.
    """
    flagged = sources.select(F.lit("").alias("all"), F.col("source_key").isNull().alias("last"), "source_key", "source_size")
    numbered = ranked(ordered(flagged, ["all", "last", "source_key"], "mix-sources"), "all")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighed = written(numbered.select("source_key", "source_size", weight.alias("weight")), "mix-weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    cap = F.lit(most) * F.col("source_size")
    level = 0.0
    while True:
        # Level: words per unit of weight among the sources that are not capped. It only grows, so what is capped stays capped.
        capped = cap <= F.lit(level) * F.col("weight")
        row = weighed.agg(F.coalesce(F.sum(F.when(capped, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0))).first()
        above = (total - row[0]) / row[1] if row[1] else level
        if above <= level:
            break
        level = above
    target = F.least(cap.cast("double"), F.lit(level) * F.col("weight"))
    return weighed.withColumn("target", target)


def mix(
    df: DataFrame, size: Column, weight: Column | None = None, source_col: str = "source", id_col: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = SEED,
) -> DataFrame:
    """(id, source, size, source_size, target, epochs, taken) of every row of ``df``.

    ``size`` and ``weight`` (1 by default, at least a millionth) are columns of ``df``. ``taken`` is at most ``most`` times the size, and
    the sum over a source is its target, rounded. Null ids draw like the empty text; rows of one id draw alike and go by size then; equal
    rows are told apart at random, which changes no result as a whole. Empty texts have size 0 and are never taken. A null source
    is one of its own. An empty table gives no rows. Other columns are not read, so their names cannot clash. A hot source is
    ordered over as many ranges as it needs, and its prefix sums are carried from range to range.
    """
    key = exponential_key(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.greatest(weight if weight is not None else F.lit(1.0), F.lit(1e-6)), seed)
    named = F.col(f"`{source_col}`").cast("string")
    # A mark before the name tells a null source from the one called so.
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.concat(F.lit("="), named), F.lit("-")).alias("source"), named.alias("source_key"),
        size.cast("long").alias("size"), key.alias("key"),
    )
    stored = written(rows, "mix-rows")
    sizes = written(stored.groupBy("source", "source_key").agg(F.sum("size").alias("source_size")), "mix-sizes")
    budget = targets(sizes.select("source_key", "source_size"), weights, most)
    marked = budget.select(F.coalesce(F.concat(F.lit("="), "source_key"), F.lit("-")).alias("source"), "source_size", "target")
    whole = F.least(F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0), F.lit(most)).cast("long")
    marked = marked.withColumn("epochs", whole).withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    line = ordered(stored.drop("source_key"), ["source", "key", "id", "size"], "mix-order")
    starts = first_of_ranges(line, "source", {"before": F.sum("size")}).drop("_least").join(marked, "source")
    # At most one range of rows to a row of `starts`, whichever the source.
    within = Window.partitionBy("source", "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    placed = line.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, ["source", "_range"])
    selected = F.least(F.greatest(F.col("rest") - F.col("before") - F.col("_within"), F.lit(0)), F.col("size"))
    return placed.select(
        F.col("id").alias(id_col), F.when(F.col("source") != "-", F.substring("source", 2, 1 << 30)).alias(source_col), "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + selected).cast("long").alias("taken"),
    )


def quality_weight(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", good: float = 1.0, bad: float = 0.25) -> DataFrame:
    """(id, weight) per labelled id; repeated labels of an id count as their mean."""
    rated = F.avg(F.col(f"`{label_col}`").cast("double"))
    return labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("rated_id")).agg((F.lit(bad) + rated * (good - bad)).alias("weight"))


UNRATED = 0.5


def mix_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``mix`` by words, documents weighed by their quality label, ``UNRATED`` where they have none."""
    counted = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    rated = counted.join(quality_weight(labels), F.col("doc_id") == F.col("rated_id"), "left")
    return mix(rated, F.col("size"), F.coalesce("weight", F.lit(UNRATED)))
