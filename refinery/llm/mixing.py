"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / size of the source`` times. The whole part of that is fixed;
the fractions are rounded against each other: of two documents with a fraction, words move from one to the other, in
a random direction that leaves both expectations as they are, until one of them is at 0 or 1. It is settled; the
other one meets the next document. So the words taken from a source stay the same throughout, and at its end at most
one document has a fraction left, which is drawn.

The pairs form a reduction tree: a block of about ``BLOCK`` documents of a source is one fold over a sorted array,
what each block leaves over is dealt into blocks of the next level. Levels are stored, so each is worked out once, and
a source of any size takes log_BLOCK(documents) of them. Draws are hashes of the documents, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.tables import key_of, stored, whole_row

# Words, weights by place of the source, and how often a document may be taken at most.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3

BLOCK = 256
SEED = 17

# One fold step: of the unit in hand (a) and the next one (e), one is settled (at 0 or 1) and the other stays in hand.
# w is the words of all copies of a unit, f its fraction; "rise" moves words from e to a.
_FOLD = """
    aggregate(
        slice(units, 2, greatest(size(units) - 1, 0)),
        named_struct('hand', units[0], 'settled', cast(array() AS array<struct<key: struct<k1: bigint, k2: bigint>, up: boolean>>)),
        (done, e) -> transform(transform(transform(
            array(named_struct('a', done.hand, 'settled', done.settled)),
            s -> named_struct('a', s.a, 'settled', s.settled,
                'rise', least((1 - s.a.f) * s.a.w, e.f * e.w),
                'fall', least(s.a.f * s.a.w, (1 - e.f) * e.w),
                'draw', pmod(xxhash64(s.a.key, e.key, level, {seed}), 1048576) / 1048576D)),
            s -> named_struct('a', s.a, 'settled', s.settled, 'up', s.draw * (s.rise + s.fall) < s.fall,
                'a_full', (1 - s.a.f) * s.a.w <= e.f * e.w, 'a_empty', s.a.f * s.a.w <= (1 - e.f) * e.w)),
            s -> CASE
                WHEN s.up AND s.a_full THEN named_struct(
                    'hand', named_struct('key', e.key, 'w', e.w, 'f', greatest(0D, e.f - (1 - s.a.f) * s.a.w / e.w)),
                    'settled', concat(s.settled, array(named_struct('key', s.a.key, 'up', true))))
                WHEN s.up THEN named_struct(
                    'hand', named_struct('key', s.a.key, 'w', s.a.w, 'f', least(1D, s.a.f + e.f * e.w / s.a.w)),
                    'settled', concat(s.settled, array(named_struct('key', e.key, 'up', false))))
                WHEN s.a_empty THEN named_struct(
                    'hand', named_struct('key', e.key, 'w', e.w, 'f', least(1D, e.f + s.a.f * s.a.w / e.w)),
                    'settled', concat(s.settled, array(named_struct('key', s.a.key, 'up', false))))
                ELSE named_struct(
                    'hand', named_struct('key', s.a.key, 'w', s.a.w, 'f', greatest(0D, s.a.f - (1 - e.f) * e.w / s.a.w)),
                    'settled', concat(s.settled, array(named_struct('key', e.key, 'up', true))))
            END)[0])
"""


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from ``source`` and ``size``.

    The first sources to reach ``most`` times their size are those with the least size per weight: with the sources
    in that order, the share per weight after each one is known from running sums, and holds for all sources beyond
    the first one it suffices for. One row per source goes through these windows, whatever the number of documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    exact = "decimal(38,0)"
    rows = by_source.withColumn("weight", weight.cast(exact)).withColumn("cap", F.col("source_size").cast(exact) * most)
    rows = rows.withColumns({"ratio": F.col("cap").cast("double") / F.col("weight").cast("double")})
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "left_size": F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before).cast("double"), F.lit(0.0)),
        "left_weight": (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double"),
    }).withColumn("share", F.col("left_size") / F.col("left_weight"))
    enough = F.min(F.when(F.col("ratio") >= F.col("share"), F.struct("ratio", "share"))).over(everything)["share"]
    target = F.least(F.col("cap").cast("double"), F.col("weight").cast("double") * F.coalesce(enough, F.lit(0.0)))
    return rows.select("source", "source_size", target.alias("target"))


def _level(rows: DataFrame, level: int, expected: Column) -> DataFrame:
    """What each block of a level settles, and what it has left in hand. ``expected``: units of the source on this level."""
    blocks = F.greatest(F.lit(1), F.ceil(expected / BLOCK)).cast("bigint")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit(level), F.lit(SEED)), blocks))
    units = F.array_sort(F.collect_list(F.struct("key", "w", "f")))
    grouped = dealt.groupBy("source", "units_of_source", "block").agg(units.alias("units"))
    folded = grouped.withColumn("level", F.lit(level)).withColumn("folded", F.expr(_FOLD.format(seed=SEED)))
    return folded.select("source", "units_of_source", "folded.*")


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` of each row of ``docs``.

    ``taken`` is ``size`` times the row's copies in the mix, 0 to ``most``. Rows with equal ``doc_id``, source and size
    (NULLs are equal) get as many copies as each other. Rows without a word are taken 0 times. Other columns are
    ignored; an empty table gives an empty result.
    """
    units = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), words_in(F.col("text")).alias("size"))
    units = units.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    units = stored(units.withColumn("key", key_of(F.col("doc_id"), F.col("source"), F.col("size"))), "sizes")
    by_source = targets(units.select("source", (F.col("size") * F.col("copies")).alias("size")), weights, most)
    counts = units.groupBy("source").agg(F.count(F.lit(1)).alias("units_of_source"))
    by_source = by_source.join(counts.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    by_source = stored(by_source.withColumn("rate", F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0))), "targets")
    per_source = by_source.withColumnRenamed("source", "of_source")
    units = units.join(per_source, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    whole = F.least(F.floor("rate"), F.lit(most)).cast("bigint")
    units = units.withColumns({"base": whole, "f": F.col("rate") - whole})

    left = units.filter((F.col("f") > 0) & (F.col("size") > 0)).select(
        "source", "units_of_source", "key", (F.col("size") * F.col("copies")).cast("double").alias("w"), "f"
    )
    most_units = by_source.agg(F.max("units_of_source")).first()[0] or 0
    expected, settled, level = F.col("units_of_source"), [], 0
    while True:
        folded = stored(_level(left, level, expected), "level")
        settled.append(folded.select(F.explode("settled").alias("one")).select("one.*"))
        left = folded.select("source", "units_of_source", "hand.*")
        most_units = -(-most_units // BLOCK)
        if most_units <= 1:
            break
        expected, level = F.ceil(expected / BLOCK), level + 1
    last = left.select("key", (F.pmod(F.xxhash64("key", F.lit(SEED), F.lit("last")), F.lit(1 << 20)) / float(1 << 20) < F.col("f")).alias("up"))
    for one in settled:
        last = last.unionByName(one)
    up = last.filter("up").select(F.col("key").alias("up_key"))
    chosen = units.join(up, F.col("key") == F.col("up_key"), "left")
    taken = F.col("size") * (F.col("base") + F.when(F.col("up_key").isNotNull(), 1).otherwise(0))
    return chosen.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")
    ).drop("copy")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as it is taken."""
    taken = mixed(docs, weights, most).filter("taken > 0").select(
        F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.expr("taken div size").alias("_copies")
    ).distinct()
    doc, source = F.col("doc_id").cast("bigint"), F.col("source").cast("string")
    sized = docs.select(whole_row(docs).alias("row"), doc.alias("doc"), source.alias("of"), words_in(F.col("text")).alias("words"))
    same = F.col("doc").eqNullSafe(F.col("_doc")) & F.col("of").eqNullSafe(F.col("_source")) & (F.col("words") == F.col("_size"))
    repeated = sized.join(taken, same).select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")))
    return repeated.select("row.*")
