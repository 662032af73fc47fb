"""Mixing sources to target weights by capped water-filling.

Every source asks for its share, by weight, of all the words there are. A source may be read
at most a number of epochs: one that would need more is clamped there, and what it can't take
is shared anew among the others by weight, until no target is above its cap. Each source is
then sampled up to its target: whole repetitions of every document first, and the rest by
documents in a seeded order, the last of which is taken in part.

Everything here is DataFrame functions. One row per round comes to the driver: the words and
weight that are left. A round either halves the excess or the weight that is left, so there
are few of them however many sources there are. No task sees a whole source: the seeded order is cut into
ranges by counts, and totals per range place each range in its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.joins import null_safe_join
from parcelpulse.functions.ordered import running_totals
from parcelpulse.llm.common import whole_text
from parcelpulse.session import staged

#: Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"
MOST_EPOCHS = 3.0


def word_count(text: str = "text") -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def cycled_weights(sources: DataFrame, weights: list[float]) -> DataFrame:
    """(source, weight): weights dealt in turn to the sources by code point, the null source last.

    The places come from ranges of sources, so that their number is no limit.
    """
    named = sources.select("source").distinct().select("source", F.col("source").isNull().alias("__last"), F.lit(1).alias("one"))
    placed = running_totals(named, [], ["__last", "source"], ["one"], descending=False)
    each = F.array(*[F.lit(float(w)) for w in weights])
    return placed.select("source", F.get(each, ((F.col("cum_one") - 1) % len(weights)).cast("int")).alias("weight"))


def fill(sizes: DataFrame, most_epochs: float = MOST_EPOCHS) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight), by capped water-filling.

    The targets add up to the sum of all sizes, or to that of the caps if these are lower. Null,
    negative and missing weights count as 0, and so does the target then. A source without a word
    has the target 0. Equal sources of equal weight have equal targets. No sources: no rows.
    """
    weight = F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(0.0))
    cap = F.col("source_size") * F.lit(float(most_epochs))
    known = sizes.withColumn("weight", weight).withColumn("__cap", cap)
    level, clamped = 0.0, -1
    while True:
        full = F.col("__cap") <= F.col("weight") * F.lit(level)
        left = known.agg(
            F.sum("source_size").alias("words"), F.sum(F.when(full, F.col("__cap"))).alias("taken"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"), F.count_if(full).alias("clamped"),
        ).first()
        if left.clamped == clamped or not left.weight:
            break
        level, clamped = max(level, (left.words - (left.taken or 0.0)) / left.weight), left.clamped
    target = F.least(F.col("__cap"), F.col("weight") * F.lit(level))
    if not left.weight:  # every source that has a weight is at its cap
        target = F.when(F.col("weight") > 0, F.col("__cap")).otherwise(F.lit(0.0))
    return known.withColumn("target", target).drop("__cap")


def mix(
    docs: DataFrame, weights: DataFrame | list[float], most_epochs: float = MOST_EPOCHS, seed: int = 42,
    text: str = "text", source: str = "source", id_column: str = "doc_id", carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, repeats, part_words) of every row of ``docs``.

    ``weights`` is a table (source, weight), in which a source it lacks has weight 0, or a list
    dealt to the sources in order (``cycled_weights``). ``size`` is the number of words of the
    whole text, ``taken`` the words that the mix takes of the row: ``repeats`` times all of them
    and then its first ``part_words``. The taken words of a source add up to its target, rounded
    to whole words. The order in which documents get the last, fractional repetition is that of
    a digest of seed, id and text, so reruns agree; repeated rows stand side by side in it
    and each counts. A null text has no words, a null source is a source of its own, null ids are
    allowed, and an empty table has no rows. Other columns are left out but for those in
    ``carry``, which come back as ``carried``, a struct that can't clash.
    """
    at = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_column).cast("string"), F.lit("")), whole_text(text)))
    carried = [F.struct(*carry).alias("carried")] if carry else []
    sized = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), at.alias("at"), *carried
    )
    sized = staged(sized, "mix-sizes")
    sizes = staged(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    if isinstance(weights, list):
        weights = cycled_weights(sizes, weights)
    wanted = null_safe_join(sizes, weights.select("source", F.col("weight").cast("double")), ["source"], "left")
    wanted = staged(fill(staged(wanted, "mix-weights"), most_epochs), "mix-targets")
    quota = F.round("target").cast("long")
    rest = F.when(F.col("source_size") > 0, quota % F.col("source_size")).otherwise(F.lit(0))
    wanted = wanted.withColumns({"quota": quota, "rest": rest})
    repeats = F.coalesce(F.try_divide(F.col("quota") - F.col("rest"), F.col("source_size")), F.lit(0.0))
    wanted = wanted.select("source", "source_size", "target", repeats.cast("long").alias("repeats"), "rest")
    placed = running_totals(sized, ["source"], ["at", "doc_id", "size"], ["size"], descending=False)
    placed = null_safe_join(placed.drop("tot_size"), wanted, ["source"])
    part = F.greatest(F.least(F.col("rest") - F.col("cum_size") + F.col("size"), F.col("size")), F.lit(0))
    kept = ["doc_id", "source", "size", "source_size", "target"]
    return placed.withColumn("part_words", part.cast("long")).select(
        *kept, (F.col("repeats") * F.col("size") + F.col("part_words")).alias("taken"), "repeats", "part_words",
        *(["carried"] if carry else []),
    )


def repetitions(mixed: DataFrame, text: Column) -> DataFrame:
    """One row per repetition that the mix takes: (doc_id, source, repetition, text), whole texts
    first and then the first ``part_words`` words of the text, if any, with what stands before and
    between them. Rows of which nothing is taken, empty texts included, leave no row."""
    times = F.col("repeats") + F.when(F.col("part_words") > 0, 1).otherwise(0)
    each = mixed.where((times > 0) & (F.col("size") > 0)).withColumn("__text", text)
    each = each.select("*", F.explode(F.sequence(F.lit(1), times.cast("int"))).alias("repetition"))
    words = F.regexp_extract_all("__text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("part_words").cast("int")), "")
    whole = F.col("repetition") <= F.col("repeats")
    return each.select("doc_id", "source", "repetition", F.when(whole, F.col("__text")).otherwise(cut).alias("text"))
