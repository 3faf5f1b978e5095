"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findlark.config import materialise
from findlark.llm.common import running_sums, word_count
from findlark.operators.ordering import ranked

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2


def source_targets(
    sized: DataFrame, weights: Sequence[int], share: float, epochs: int
) -> tuple[DataFrame, int]:
    """Per source: size, rank by code point (null last), start offset and target; and the budget.

    Targets are ``min(epochs * size, level * weight)`` with the one level at which they add up
    to ``share`` of all sizes: what sharing the excess of full sources anew by weight ends in.
    Sources are summed before they are ordered, and ordered by range, not in one task.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = ranked(totals, [F.col("source").asc_nulls_last()], "source_rank")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    numbered = numbered.withColumn(
        "weight", F.get(cycle, (F.col("source_rank") % len(weights)).cast("int")).cast("long")
    )
    numbered = running_sums(numbered, [F.col("source_rank")], ["source_size"], "sources")
    numbered = numbered.withColumn("cap", epochs * F.col("source_size"))
    numbered = numbered.withColumn("ratio", F.col("cap") / F.col("weight"))
    filled = running_sums(numbered, [F.col("ratio"), F.col("source_rank")], ["cap", "weight"], "caps")
    sums = numbered.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total = sums["size"] or 0
    share_of_all = share * total
    level = (F.lit(share_of_all) - F.col("before_cap")) / (F.lit(sums["weight"]) - F.col("before_weight"))
    # the first source, by ratio, that the level leaves below its cap
    least = (
        filled.withColumn("level", level)
        .where(F.col("level") <= F.col("ratio"))
        .agg(F.min_by("level", F.struct("ratio", "source_rank")).alias("level"))
        .first()["level"]
    )
    cap = F.col("cap").cast("double")
    target = cap if least is None else F.least(cap, F.lit(float(least)) * F.col("weight"))
    targets = numbered.select(
        "source", "source_rank", "source_size", F.col("before_source_size").alias("source_start"),
        target.alias("target"),
    )
    return targets, int(min(share_of_all, epochs * total))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """How many words a mix takes from each document.

    Sources in code point order (null last) weigh ``weights`` in turn. Documents of a source
    queue in the order of a hash of their id, ``epochs`` times over; the virtual finish time of
    each is the words of its source up to and with it, divided by the source's target. All
    queues are merged by finish time and cut where the budget is used up; the document at the
    cut is taken in part.

    The order of a source and the merged order are range-partitioned sorts with prefix sums, so
    a source with a third of all rows spreads over many tasks. Only narrow columns are sorted.

    Returns per row ``doc_id, size, source_size, target, taken``, ``source`` and the columns
    named in ``keys``. Null text counts 0 words, a null source is a source, a null id hashes as
    an empty one, rows repeated in full are separate documents, no rows give no rows; other
    columns of ``docs`` are left out.
    """
    from_id = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10)
    sized = materialise(
        docs.select(
            "doc_id", "source", *keys, word_count(F.col("text")).alias("size"), from_id.cast("long").alias("_turn")
        ),
        "sized",
    )
    targets, budget = source_targets(sized, weights, share, epochs)
    order = [F.col("source").asc_nulls_last(), F.col("_turn"), F.col("doc_id"), F.col("size")]
    queued = running_sums(sized, order, ["size"], "queues")
    targets = targets.withColumnRenamed("source", "_source")
    queued = queued.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    queued = queued.withColumn("_upto", F.col("before_size") - F.col("source_start") + F.col("size"))
    copies = queued.where("size > 0").select(
        "size", "source_rank", "_upto", "source_size", "target",
        F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"),
    )
    finish = (F.col("epoch") * F.col("source_size") + F.col("_upto")) / F.col("target")
    copies = copies.select(finish.alias("finish"), "source_rank", "size")
    merged = running_sums(copies, [F.col("finish"), F.col("source_rank")], ["size"], "merged")
    # one row: the copy the budget ends in
    cut = merged.where((F.col("before_size") < budget) & (F.col("before_size") + F.col("size") >= budget)).first()
    taken = F.lit(0).cast("long")
    if cut is not None:
        for epoch in range(epochs):
            own = (F.lit(epoch) * F.col("source_size") + F.col("_upto")) / F.col("target")
            at = F.struct(own.alias("a"), F.col("source_rank").alias("b"))
            end = F.struct(F.lit(cut["finish"]).alias("a"), F.lit(cut["source_rank"]).cast("long").alias("b"))
            part = F.when(at < end, F.col("size")).when(at == end, F.lit(budget - cut["before_size"]))
            taken = taken + F.when(F.col("size") > 0, F.coalesce(part, F.lit(0))).otherwise(0)
    return queued.select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", *keys
    )


SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS turn
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
  FROM sized GROUP BY source),
w AS (SELECT *, [3, 1, 2][1 + rk % 3]::BIGINT AS weight FROM src),
whole AS (SELECT 1.5 * sum(source_size)::DOUBLE AS b, sum(weight) AS sw FROM w),
lv AS (
  SELECT (b - coalesce(sum(2 * source_size) OVER o, 0)) / (sw - coalesce(sum(weight) OVER o, 0))::DOUBLE AS level,
         2 * source_size / weight::DOUBLE AS ratio, rk
  FROM w, whole
  WINDOW o AS (ORDER BY 2 * source_size / weight::DOUBLE, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(level, (ratio, rk)) AS level FROM lv WHERE level <= ratio),
t AS (
  SELECT source, rk, source_size,
         least(2.0::DOUBLE * source_size, coalesce(level.level, 1e300) * weight) AS target
  FROM w, level),
q AS (
  SELECT s.doc_id, s.size, t.rk, t.source_size, t.target, s.turn,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY turn, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS upto,
         row_number() OVER () AS row
  FROM sized s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT row, size, rk, (epoch * source_size + upto)::DOUBLE / target AS finish
  FROM q, (VALUES (0), (1)) e(epoch) WHERE size > 0),
merged AS (
  SELECT row, size, sum(size) OVER (ORDER BY finish, rk ROWS UNBOUNDED PRECEDING) - size AS before FROM copies),
got AS (
  SELECT row, sum(greatest(0, least(size, floor(b) - before)))::BIGINT AS taken FROM merged, whole GROUP BY row)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM q LEFT JOIN got USING (row)
"""
