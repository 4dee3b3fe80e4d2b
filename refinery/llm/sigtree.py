"""Near duplicates by an exact Jaccard join of word shingles, pruned by signature trees.

1. Every text becomes its set of shingles; equal sets are one class, so copies are one row from here on.
2. Two sets as alike as asked for share one of their first few shingles in any one order that all sets follow (prefix
   filter). Those first shingles deal the classes into buckets. The order puts shingles known to be frequent last, so
   passages that many documents share are in nobody's prefix unless most of a document consists of them.
3. Each class of a bucket is compared with the bucket's first class. That links copies with few changes, however many
   there are, by one comparison each.
4. Buckets that still hold several components go through a signature tree: leaves are the bucket's classes, with a
   bitmap of hashed shingles, a size, and how many shingles are left in the order from the bucket's on; a node has the
   OR and the AND of its children's bitmaps and the ranges of their numbers. A pair of nodes is dropped if no two sets
   below it can overlap enough, or if all are linked already. What two leaves leave over is compared exactly.

Two alike sets meet in the bucket of the first shingle they share, where all that they share is still left. So steps 3
and 4 together compare every pair of alike sets that is not in one component anyway, and no link between different
components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.components import components
from refinery.llm.tables import key_of, stored, whole_row
from refinery.llm.words import Words, in_parts, mix

PERCENT = 80
SHINGLE = 5
BITS = 2048
FANOUT = 8
BUCKET_ROWS = 2048  # classes of a bucket that one task compares; more are dealt into pairs of parts
# The order of shingles, not the result, rests on these: documents sampled for frequent shingles, and how many are kept.
SAMPLED_DOCUMENTS, FREQUENT_IN, MOST_FREQUENT = 20_000, 2, 1 << 18
BROADCAST_ROWS = 1_000_000  # of up to four numbers each, some 80 MB in memory
_PAIRS_AT_ONCE = 1 << 16
_ROWS_AT_ONCE = 512


def _needed(size: np.ndarray | int, other: np.ndarray | int, percent: int):
    """Least overlap of two sets of these sizes whose Jaccard similarity is ``percent`` or more."""
    return -(-percent * (size + other) // (100 + percent))


def _shingle_rows(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    for _, part in in_parts(texts):
        hashes, begin = Words(part, lower=True).shingles(size)
        for a, b in zip(begin.tolist(), begin[1:].tolist()):  # noqa: B905
            yield hashes[a:b]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, so that what a step makes of one stays small."""
    for batch in batches:
        for at in range(0, len(batch), _ROWS_AT_ONCE):
            yield batch.slice(at, _ROWS_AT_ONCE)
            pa.default_memory_pool().release_unused()


def _frequent(docs: DataFrame, size: int) -> np.ndarray:
    """Shingles of many documents, ascending, from a sample of documents with different texts."""
    total = docs.count()
    share = min(1.0, SAMPLED_DOCUMENTS / max(1, total))
    some = docs.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text").distinct()

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(found):
            rows = list(_shingle_rows(batch.column("text").to_pylist(), size))
            if rows:
                shingles, counts = np.unique(np.concatenate(rows), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shingles.view(np.int64)), pa.array(counts)], names=["shingle", "n"])

    counts = some.mapInArrow(batches, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    most = counts.filter(F.col("n") >= FREQUENT_IN).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).select("shingle")
    return np.sort(most.toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))


def _bitmap(shingles: np.ndarray) -> bytes:
    bits = np.zeros(BITS, np.uint8)
    bits[(shingles >> np.uint64(40)) % np.uint64(BITS)] = 1
    return np.packbits(bits).tobytes()


def _features(docs: DataFrame, percent: int, size: int, frequent: np.ndarray) -> DataFrame:
    """Per row: ``doc_id``, ``row_key``, set size ``n``, a 128-bit fingerprint of the set, its prefix and its bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def prefix(shingles: np.ndarray) -> np.ndarray:
        kept = len(shingles) - -(-percent * len(shingles) // 100) + 1
        last = shared.value
        if len(last):
            place = np.searchsorted(last, shingles)
            is_last = last[np.minimum(place, len(last) - 1)] == shingles
            shingles = np.concatenate([shingles[~is_last], shingles[is_last]])
        return shingles[:kept]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(found):
            sizes, first, second, prefixes, maps = [], [], [], [], []
            for shingles in _shingle_rows(some.column("text").to_pylist(), size):
                spread = mix(shingles)
                sizes.append(len(shingles))
                first.append(int(np.sum(spread, dtype=np.uint64).view(np.int64)))
                second.append(int(np.sum(mix(spread ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64).view(np.int64)))
                prefixes.append(prefix(shingles) if len(shingles) else shingles)
                maps.append(_bitmap(shingles))
            ends = pa.array(np.cumsum([0, *map(len, prefixes)]), pa.int32())
            flat = np.concatenate([*prefixes, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    some.column("doc_id"), some.column("row_key"), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(flat)), pa.array(maps, pa.binary()),
                ],
                names=["doc_id", "row_key", "n", "first", "second", "prefix", "bitmap"],
            )

    schema = "doc_id bigint, row_key struct<k1: bigint, k2: bigint>, n bigint, first bigint, second bigint, prefix array<bigint>, bitmap binary"
    return docs.mapInArrow(batches, schema)


def _buckets(prefixes: DataFrame) -> DataFrame:
    """``shingle``, ``class``, ``n``, ``rest`` and ``leader`` of every shingle that two or more classes have in their prefix.

    ``rest`` counts the shingles of the class from this one on.

    Rows pass in the order of their shingles and are not held, so a bucket may be of any size.
    """
    rows = prefixes.select(F.posexplode("prefix").alias("at", "shingle"), "class", F.col("n").cast("int"))
    rows = rows.select("shingle", "class", "n", (F.col("n") - F.col("at")).alias("rest"))
    spread = int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(spread, "shingle").sortWithinPartitions("shingle", "class")

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), np.int64)  # the last row, which may begin a bucket
        shingle = leader = None  # of the bucket that the last row given out is in
        for batch in found:
            rows = np.concatenate([held, np.column_stack([batch.column(i).to_numpy() for i in range(4)])])
            held = rows[-1:]
            if len(rows) < 2:
                continue
            new = np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]])
            leaders = rows[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0)), 1]
            if shingle is not None and rows[0, 0] == shingle:
                leaders[rows[:, 0] == shingle] = leader
            alone = new.copy()
            alone[:-1] &= new[1:]
            if shingle is not None and rows[0, 0] == shingle:
                alone[0] = False
            # The last row is given out with the next batch, or below.
            out, lead = rows[:-1][~alone[:-1]], leaders[:-1][~alone[:-1]]
            in_bucket = len(rows) > 1 and rows[-2, 0] == rows[-1, 0]
            shingle, leader = (rows[-1, 0], leaders[-1]) if in_bucket else (None, None)
            if len(out):
                yield _bucket_rows(out, lead)
        if shingle is not None and len(held):
            yield _bucket_rows(held, np.array([leader]))

    return ordered.mapInArrow(batches, "shingle bigint, class bigint, n bigint, rest bigint, leader bigint")


def _bucket_rows(rows: np.ndarray, leaders: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(4)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(leaders)], names=["shingle", "class", "n", "rest", "leader"])


def _popcount(bitmaps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bitmaps).sum(axis=-1, dtype=np.int64)


class SignatureForest:
    """A signature tree for each of some buckets, level by level in shared arrays.

    Level 0 are the rows, the rows of a bucket together. A node of the next level stands for up to ``FANOUT`` nodes of
    one bucket: OR and AND of their bitmaps, range of their sizes, the largest rest, and their component if it is the
    only one. The last level has one node per bucket.
    """

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray, rests: np.ndarray, parts: np.ndarray, begin: np.ndarray, percent: int):
        """``begin``: first row of each bucket."""
        self.percent = percent
        self.levels = [(bitmaps, bitmaps, sizes, sizes, rests, parts)]
        self.below: list[tuple[np.ndarray, np.ndarray]] = []  # of each node: its first node on the level below, and the end
        end = np.append(begin[1:], len(sizes))
        while len(begin) and (end - begin).max() > 1:
            any_bits, all_bits, least, most, rest, part = self.levels[-1]
            nodes = -(-(end - begin) // FANOUT)
            place = np.arange(nodes.sum()) - np.repeat(np.cumsum(nodes) - nodes, nodes)
            first = np.repeat(begin, nodes) + place * FANOUT
            self.below.append((first, np.minimum(first + FANOUT, np.repeat(end, nodes))))
            low, high = np.minimum.reduceat(part, first), np.maximum.reduceat(part, first)
            self.levels.append((
                np.bitwise_or.reduceat(any_bits, first, axis=0), np.bitwise_and.reduceat(all_bits, first, axis=0),
                np.minimum.reduceat(least, first), np.maximum.reduceat(most, first), np.maximum.reduceat(rest, first), np.where((low == high) & (low >= 0), low, -1),
            ))
            end = np.cumsum(nodes)
            begin = end - nodes

    def possible(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the pairs of nodes below which two sets can be alike enough and are not known to be linked."""
        any_bits, all_bits, least, most, rest, part = self.levels[level]
        kept = (part[a] != part[b]) | (part[a] < 0)
        kept &= (most[a] * 100 >= least[b] * self.percent) & (most[b] * 100 >= least[a] * self.percent)
        kept &= np.minimum(rest[a], rest[b]) >= _needed(least[a], least[b], self.percent)
        found = np.flatnonzero(kept)
        a, b = a[found], b[found]
        needed = _needed(least[a], least[b], self.percent)
        # Bits that all sets of a have and none of b has stand for shingles outside the overlap.
        fits = most[a] - _popcount(all_bits[a] & ~any_bits[b]) >= needed
        fits &= most[b] - _popcount(all_bits[b] & ~any_bits[a]) >= needed
        return found[fits]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows (smaller place first) that the dual traversal leaves over."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][2]))
        waiting = [(top, roots, roots)]
        while waiting:
            level, a, b = waiting.pop()
            if len(a) > _PAIRS_AT_ONCE:
                waiting += [(level, a[i : i + _PAIRS_AT_ONCE], b[i : i + _PAIRS_AT_ONCE]) for i in range(0, len(a), _PAIRS_AT_ONCE)]
                continue
            kept = self.possible(level, a, b)
            a, b = a[kept], b[kept]
            if not level:
                apart = a < b
                if apart.any():
                    yield a[apart], b[apart]
            elif len(a):
                step = max(1, _PAIRS_AT_ONCE // (FANOUT * FANOUT))
                for i in range(0, len(a), step):
                    waiting.append((level - 1, *self._children(level, a[i : i + step], b[i : i + step])))

    def _children(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, end = self.below[level - 1]
        places = np.arange(FANOUT)
        left = np.repeat(first[a][:, None] + places, FANOUT, axis=1)
        right = np.tile(first[b][:, None] + places, (1, FANOUT))
        kept = (left < end[a][:, None]) & (right < end[b][:, None]) & (left <= right)
        return left[kept], right[kept]


def _forest_pairs(dealt: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of one bucket that may be alike and are of different components; buckets pass in order."""
    spread = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = ["shingle", "low", "high"]
    ordered = dealt.select(*bucket, "n", "rest", "class", "component", "bitmap").repartition(spread, *bucket).sortWithinPartitions(*bucket, "n", "class")

    def searched(rows: pa.Table) -> pa.RecordBatch:
        columns = {name: rows.column(name).to_numpy() for name in [*bucket, "n", "rest", "class", "component"]}
        bitmaps = np.frombuffer(b"".join(rows.column("bitmap").to_pylist()), np.uint64).reshape(-1, BITS // 64)
        new = np.ones(len(bitmaps), bool)
        new[1:] = np.any([columns[name][1:] != columns[name][:-1] for name in bucket], axis=0)
        parts = np.unique(columns["component"], return_inverse=True)[1]
        forest = SignatureForest(bitmaps, columns["n"], columns["rest"], parts, np.flatnonzero(new), percent)
        found = [np.zeros((2, 0), np.int64), *(columns["class"][np.stack(pair)] for pair in forest.pairs())]
        pairs = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the last bucket, which the next batch may go on with
        for batch in found:
            if not len(batch):
                continue
            last = [batch.column(name)[len(batch) - 1].as_py() for name in bucket]
            same = np.all([batch.column(name).to_numpy() == value for name, value in zip(bucket, last, strict=True)], axis=0)
            begin = int(np.flatnonzero(same)[0])
            if begin:
                yield searched(pa.Table.from_batches([*held, batch.slice(0, begin)]))
                held = []
            elif held and [held[0].column(name)[0].as_py() for name in bucket] != last:
                yield searched(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(begin))
        if held:
            yield searched(pa.Table.from_batches(held))

    return ordered.mapInArrow(batches, "a bigint, b bigint")


def _beside(rows: DataFrame, key: str, other: DataFrame, other_key: str, names: dict[str, str]) -> DataFrame:
    chosen = other.select(F.col(other_key).alias("_key"), *[F.col(a).alias(b) for a, b in names.items()])
    return rows.join(chosen, F.col(key) == F.col("_key")).drop("_key")


def _small(rows: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if it is small enough and joined by a shuffle if not."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _may_be_alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) whose sizes and bitmaps do not rule the similarity out."""
    both = _beside(pairs, "a", classes, "class", {"n": "n_a", "bitmap": "bitmap_a"})
    both = _beside(both, "b", classes, "class", {"n": "n_b", "bitmap": "bitmap_b"})
    both = both.filter((F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            maps = [
                np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint64).reshape(-1, BITS // 64) for name in ("bitmap_a", "bitmap_b")
            ]
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            needed = _needed(n_a, n_b, percent)
            fits = (n_a - _popcount(maps[0] & ~maps[1]) >= needed) & (n_b - _popcount(maps[1] & ~maps[0]) >= needed)
            yield pa.RecordBatch.from_arrays([batch.column(name) for name in ("a", "b")], names=["a", "b"]).filter(pa.array(fits))

    return both.mapInArrow(batches, "a bigint, b bigint")


def _alike(pairs: DataFrame, classes: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs whose sets are alike. Sets are built anew from the texts of the classes that are in a pair."""
    asked = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    keys = _small(stored(_beside(asked, "class", classes, "class", {"row_key": "class_key"}), "asked"))
    chosen = texts.join(keys, F.col("row_key") == F.col("class_key")).select("class", "text")

    def sets(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(found):
            rows = [row.tobytes() for row in _shingle_rows(batch.column("text").to_pylist(), size)]
            yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(rows, pa.binary())], names=["class", "shingles"])

    # Rows that share a key have the same id and text, so any one of them will do.
    built = stored(chosen.mapInArrow(sets, "class bigint, shingles binary"), "sets").dropDuplicates(["class"])
    both = _beside(pairs, "a", built, "class", {"shingles": "set_a"})
    both = _beside(both, "b", built, "class", {"shingles": "set_b"})

    def compare(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            fits = []
            for one, other in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
                together = np.sort(np.concatenate([x, y]))
                common = int((together[1:] == together[:-1]).sum())
                fits.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(fits, pa.bool_()))

    return both.mapInArrow(compare, "a bigint, b bigint")


def _dealt(rows: DataFrame) -> DataFrame:
    """Deals the rows of each bucket into groups of bounded size such that any two rows of a bucket meet in one."""
    sizes = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows")).withColumnRenamed("shingle", "of")
    sizes = stored(sizes.withColumn("parts", F.ceil(F.col("rows") / (BUCKET_ROWS // 2))), "bucket_sizes")
    rows = rows.join(sizes, F.col("shingle") == F.col("of")).drop("of")
    own = F.pmod(F.xxhash64("class"), F.col("parts"))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    # With several parts, the group of two parts holds both; that of a part and itself is in each of them.
    rows = rows.filter((F.col("own") != F.col("other")) | (F.col("parts") == 1))
    return rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})


def classified(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``row_key``, ``n_shingles``, ``component_id``, ``component_key``.

    A set is the distinct shingles of ``size`` words of the lower-cased text, or the whole sequence of fewer words.
    Rows link if 100 * overlap >= ``percent`` * union; a component is all rows reachable by links, its id the smallest
    ``doc_id`` among them, NULL if none has one. A text without words, or NULL, is linked with nothing: its component
    is its own. ``row_key`` is a 128-bit hash of id and text, equal for repeated rows; ``component_key`` is the key of one row
    of the component with the smallest id. Other columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    texts = texts.withColumn("row_key", key_of(F.col("doc_id"), F.col("text")))
    features = stored(_features(texts, percent, size, _frequent(texts, size)), "features")
    some = features.filter(F.col("n") > 0)
    same = ["first", "second", "n"]
    # NULL ids are larger than any; ids of a class are compared together with their keys.
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")
    classes = some.groupBy(*same).agg(F.min(named).alias("best"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    of_class = _small(classes.select("class", F.col("best.row_key").alias("class_key"), F.col("n").alias("n_class"), F.col("first").alias("first_class")))
    # One row per class carries its prefix and bitmap on; equal rows have equal ones.
    chosen = some.join(
        of_class, (F.col("row_key") == F.col("class_key")) & (F.col("n") == F.col("n_class")) & (F.col("first") == F.col("first_class"))
    ).select("class", "row_key", "n", "prefix", "bitmap")
    sketches = chosen.select("class", "row_key", "n", "bitmap").dropDuplicates(["class"])
    sketches = stored(sketches, "sketches")
    # Rows that share a key give the same prefix again; a bucket of one class that is there twice says nothing.
    buckets = stored(_buckets(chosen.select("prefix", "class", "n")), "buckets")
    stars = buckets.filter("leader != class").select(F.col("leader").alias("a"), F.col("class").alias("b")).distinct()
    first = stored(_may_be_alike(stars, sketches, percent), "pairs")
    links = stored(_alike(first, sketches, texts, percent, size), "links")
    known = components(links)

    rows = buckets.select("shingle", "class", "n", "rest").join(known, F.col("class") == F.col("node"), "left")
    rows = stored(rows.select("shingle", "class", "n", "rest", F.coalesce("component", "class").alias("component")), "members")
    mixed = rows.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    mixed = stored(mixed.select(F.col("shingle").alias("of")), "mixed")
    open_rows = stored(rows.join(mixed, F.col("shingle") == F.col("of"), "left_semi"), "open")
    dealt = _beside(_dealt(open_rows), "class", sketches, "class", {"bitmap": "bitmap"})
    done = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = _forest_pairs(dealt, percent).distinct().join(done, ["a", "b"], "left_anti")
    more = stored(_alike(stored(pairs, "pairs"), sketches, texts, percent, size), "links")
    known = components(links.unionByName(more))

    of = classes.join(known, F.col("class") == F.col("node"), "left").withColumn("component", F.coalesce("component", "class"))
    of = stored(of.select("component", "best", *[F.col(name).alias(f"of_{name}") for name in same]), "of")
    best = stored(of.groupBy("component").agg(F.min("best").alias("best_of")).withColumnRenamed("component", "of_component"), "best")
    of = stored(of.join(best, F.col("component") == F.col("of_component")).select("best_of", *[f"of_{name}" for name in same]), "named")
    equal: Column = (F.col("first") == F.col("of_first")) & (F.col("second") == F.col("of_second")) & (F.col("n") == F.col("of_n"))
    narrow = features.select("doc_id", "row_key", *same)
    return narrow.join(of, equal, "left").select(
        "doc_id", "row_key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("best_of.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("best_of.row_key")).otherwise(F.col("row_key")).alias("component_key"),
    )


def keep_one(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row of each component of ``docs``, all columns: one with the smallest ``doc_id``. Rows without words all stay."""
    keyed = docs.select(whole_row(docs).alias("row"), key_of(F.col("doc_id").cast("bigint"), F.col("text")).alias("_row"))
    found = stored(classified(docs, percent, size), "classified")
    alone = found.filter("n_shingles = 0").select(F.col("row_key").alias("_kept")).distinct()
    kept = found.filter("n_shingles > 0 AND row_key = component_key").select(F.col("row_key").alias("_kept")).distinct()
    rows = keyed.join(kept, F.col("_row") == F.col("_kept"), "left_semi").dropDuplicates(["_row"])
    empty = keyed.join(alone, F.col("_row") == F.col("_kept"), "left_semi")
    return rows.unionByName(empty).select("row.*")
