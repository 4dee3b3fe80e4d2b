"""Scores by prediction by partial matching (PPM) over bytes, learnt from a training part of the corpus.

The model is a trie of byte contexts up to ``ORDER`` long, each with the counts of the bytes that followed it. A byte is
predicted from the longest known context; a byte not seen there costs an escape (method C: as many chances as the
context has different bytes) and is predicted from the next shorter context with the bytes of the longer one excluded,
down to one chance in 255 for a byte never seen. A text is preceded by a mark that no text holds (0xFF) and ends with
another one (0xFE), which is predicted like a byte.

A trie of a large corpus fits no task, and no task needs all of it. Documents lie in blocks of some 8 MB (as stored); a block's
windows of ORDER + 1 bytes and words are counted once, counts of all blocks are added up per window, every window's
probability is worked out once on the trie's tables, and each block gets back the windows and words that it holds. So
what a task holds is bounded by its block, and what is gathered from the corpus grows with it.

Because every occurrence counts for all shorter contexts too, the bytes seen after a context are a subset of those seen
after its suffix. What exclusion takes away is then a number per context: the suffix's counts of the context's bytes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.tables import stored

ORDER = 4
START, END = 0xFF, 0xFE
SYMBOLS = 255
BLOCK_BYTES = 8 << 20
_PART_BYTES = 1 << 18
BLOCKS_PER_ROW = 4096  # that a window's row lists at most
_ROWS_AT_ONCE = 256
_WAITING = 1 << 18  # windows of a block that are not added up yet
_HELD_WORDS, _HELD_WINDOWS = 400_000, 3_000_000  # that a task holds before it passes counts of a block on
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows (context and byte as one number) of some texts, one per byte and end, and where each text's begin."""
    start = bytes([START]) * ORDER
    joined = b"".join(start + text + bytes([END]) for text in texts)
    found = np.frombuffer(joined, np.uint8).astype(np.int64)
    keys = np.zeros(max(0, len(found) - ORDER), np.int64)
    for place in range(ORDER + 1):
        keys <<= 8
        keys |= found[place : len(found) - ORDER + place]
    keys = keys[found[ORDER:] != START]
    return keys, np.concatenate([[0], np.cumsum([len(text) + 1 for text in texts])]).astype(np.int64)


def _parts(texts: list[str]) -> Iterator[tuple[int, list[bytes]]]:
    first, size, part = 0, 0, []
    for place, text in enumerate(texts):
        raw = text.encode()
        if part and size + len(raw) > _PART_BYTES:
            yield first, part
            first, size, part = place, 0, []
        part.append(raw)
        size += len(raw)
    if part:
        yield first, part


class Lookup:
    """Numbers by 64-bit keys in an open hash table of arrays; every key asked for has to be there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(max(1, len(keys)) - 1).bit_length() + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.keys[slot] == -1)
            self.keys[slot[free]] = keys[left[free]]  # of several, the last one stays
            lost = self.keys[slot] != keys[left]
            self.values[slot[~lost]] = values[left[~lost]]
            left, slot = left[lost], (slot[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        left = np.flatnonzero(self.keys[slot] != keys)
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            left = left[self.keys[slot[left]] != keys[left]]
        return self.values[slot]


def _partition_bytes(spark) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    return int(number) * _UNITS[unit]


def _in_blocks(docs: DataFrame, is_training: Column) -> DataFrame:
    """``block``, ``doc_id``, ``training`` and ``text`` (never NULL, A-Z lower-cased), stored so that blocks stay as they are.

    A block is a part of a scan's partition, chosen by a hash of the row, so forming it moves nothing.
    """
    split = max(1, math.ceil(_partition_bytes(docs.sparkSession) / BLOCK_BYTES))
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _LOWER)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(split))
    block = F.spark_partition_id().cast("bigint") * split + part
    return stored(docs.select(block.alias("block"), F.col("doc_id").cast("bigint"), is_training.alias("training"), text.alias("text")), "blocks")


def _added(keys: np.ndarray, counts: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts by ascending windows, with more windows added: each with a bit below it that says whether it counts."""
    if not len(marked):
        return keys, counts
    marked = np.sort(marked)
    every = marked >> 1
    begin = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    more, sums = every[begin], np.add.reduceat(marked & 1, begin)
    place = np.searchsorted(keys, more)
    there = place < len(keys)
    there[there] = keys[place[there]] == more[there]
    total = counts.copy()
    total[place[there]] += sums[there]
    return np.insert(keys, place[~there], more[~there]), np.insert(total, place[~there], sums[~there])


class _Counts:
    """Words and windows of a block's texts with their training counts.

    New windows wait until there are many, so that they are sorted and added to the known ones seldom.
    """

    def __init__(self):
        self.words: Counter = Counter()
        self.keys = self.counts = np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []

    def add(self, texts: list[str], training: np.ndarray) -> None:
        for text, learns in zip(texts, training.tolist(), strict=True):
            tokens = _WORD.findall(text)
            self.words.update(tokens if learns else dict.fromkeys(tokens, 0))
        for first, part in _parts(texts):
            every, begin = windows(part)
            self.waiting.append(every << 1 | np.repeat(training[first : first + len(part)], np.diff(begin)))
            if sum(map(len, self.waiting)) > _WAITING:
                self.settle()

    def settle(self) -> None:
        self.keys, self.counts = _added(self.keys, self.counts, np.concatenate([np.zeros(0, np.int64), *self.waiting]))
        self.waiting = []


def _counted(blocks: DataFrame) -> DataFrame:
    """``block``, ``window`` or ``word`` (-1, '' for the other) and ``n``, occurrences in the block's training texts.

    A task that holds many passes those of its largest block on, so a window or word of a block may have several rows.
    """

    def rows(block: int, held: _Counts) -> pa.RecordBatch:
        held.settle()
        n_windows, words = len(held.keys), held.words
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n_windows + len(words), block)),
                pa.array(np.concatenate([held.keys, np.full(len(words), -1)])),
                pa.concat_arrays([pa.repeat("", n_windows), pa.array(list(words), pa.string())]),
                pa.array(np.concatenate([held.counts, np.array(list(words.values()), np.int64)])),
            ],
            names=["block", "window", "word", "n"],
        )

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Counts] = {}
        for batch in found:
            for at in range(0, len(batch), _ROWS_AT_ONCE):
                some = batch.slice(at, _ROWS_AT_ONCE)
                of = some.column("block").to_numpy()
                for block in np.unique(of).tolist():
                    mine = some.filter(pa.array(of == block))
                    training = mine.column("training").to_numpy(zero_copy_only=False).astype(bool)
                    held.setdefault(block, _Counts()).add(mine.column("text").to_pylist(), training)
                    if sum(len(one.words) for one in held.values()) > _HELD_WORDS or sum(len(one.keys) for one in held.values()) > _HELD_WINDOWS:
                        largest = max(held, key=lambda block: len(held[block].keys) + len(held[block].words))
                        yield rows(largest, held.pop(largest))
        for block, counts in held.items():
            yield rows(block, counts)

    return stored(blocks.select("block", "training", "text").mapInArrow(batches, "block bigint, window bigint, word string, n bigint"), "counts")


def _suffix(window: Column, order: int) -> Column:
    """A window cut to its last ``order`` + 1 bytes: the edge of the trie below a context of that order."""
    return window.bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))


def _context(edge: Column) -> Column:
    return F.shiftright(edge, 8)


def window_scores(totals: DataFrame, order: int = ORDER) -> DataFrame:
    """``window`` and ``score`` (log10 of the chance of its last byte) from ``window`` and ``n``, its training count.

    Per order: edges (a context and a byte, with a count) and contexts (all counts, different bytes, and the counts
    that these bytes have after the context's suffix). Windows that training has are scored from their own context;
    the others, which are few, step down through the orders.
    """
    edges = {order: stored(totals.filter("n > 0").select(F.col("window").alias("edge"), "n"), "edges")}
    for k in range(order - 1, -1, -1):
        shorter = edges[k + 1].groupBy(_suffix(F.col("edge"), k).alias("edge")).agg(F.sum("n").alias("n"))
        edges[k] = stored(shorter, "edges")
    contexts = {}
    for k in range(order + 1):
        rows = edges[k].withColumn("context", _context(F.col("edge")))
        if k:
            below = edges[k - 1].select(F.col("edge").alias("_edge"), F.col("n").alias("_n"))
            rows = rows.join(below, _suffix(F.col("edge"), k - 1) == F.col("_edge"))
        excluded = F.sum("_n") if k else F.lit(0).cast("bigint")
        contexts[k] = stored(
            rows.groupBy("context").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"), excluded.alias("excluded")), "contexts"
        )

    def beside(rows: DataFrame, k: int) -> DataFrame:
        known = contexts[k].select(F.col("context").alias("_context"), F.col("all").alias("_all"), F.col("kinds").alias("_kinds"), F.col("excluded").alias("_excluded"))
        return rows.join(known, _context(_suffix(F.col("window"), k)) == F.col("_context"), "left").drop("_context")

    seen = beside(totals.filter("n > 0"), order).select("window", F.log10(F.col("n") / (F.col("_all") + F.col("_kinds"))).alias("score"))
    nothing = F.lit(0).cast("bigint")
    left = beside(totals.filter("n = 0").select("window"), order)
    known = F.col("_all").isNotNull()
    left = left.select(
        "window",
        F.when(known, F.log10(F.col("_kinds") / (F.col("_all") + F.col("_kinds")))).otherwise(0.0).alias("score"),
        F.coalesce("_excluded", nothing).alias("out_n"), F.coalesce("_kinds", nothing).alias("out_kinds"), F.lit(False).alias("done"),
    )
    for k in range(order - 1, -1, -1):
        edge = edges[k].select(F.col("edge").alias("_edge"), F.col("n").alias("_n"))
        rows = beside(left, k).join(edge, _suffix(F.col("window"), k) == F.col("_edge"), "left")
        kinds = F.coalesce("_kinds", nothing) - F.col("out_kinds")
        chances = F.coalesce("_all", nothing) - F.col("out_n") + kinds
        found = F.col("_n").isNotNull()
        step = F.when(F.col("done") | (chances <= 0), 0.0).when(found, F.log10(F.col("_n") / chances)).otherwise(
            F.when(kinds > 0, F.log10(kinds / chances)).otherwise(0.0)
        )
        rows = rows.select(
            "window", (F.col("score") + step).alias("score"), (F.col("done") | found).alias("done"),
            F.coalesce("_excluded", nothing).alias("out_n"), F.coalesce("_kinds", nothing).alias("out_kinds"),
        )
        left = stored(rows, "unseen")
    # Contexts of order 0 are one, so out_kinds now is the number of different bytes in training.
    never = F.when(F.col("done"), 0.0).otherwise(-F.log10(F.greatest(F.lit(SYMBOLS) - F.col("out_kinds"), F.lit(1)).cast("double")))
    return stored(seen.unionByName(left.select("window", (F.col("score") + never).alias("score"))), "scores")


def _per_block(counted: DataFrame, training: DataFrame) -> tuple[DataFrame, dict]:
    """What each block has to know of its windows (``score``) and words (``n``), and the totals N and V of the base."""
    # A window of all blocks has a row for every BLOCKS_PER_ROW of them, so no row grows with the corpus.
    texts, last = training.agg(F.count_if("training"), F.coalesce(F.max("block"), F.lit(0))).first()
    one_row = last < BLOCKS_PER_ROW
    of = [F.sum("n").alias("n"), F.collect_set("block").alias("blocks")]
    part = F.floor(F.col("block") / BLOCKS_PER_ROW).alias("part")
    grams = stored(counted.filter("window >= 0").groupBy("window", *([] if one_row else [part])).agg(*of), "windows")
    words = stored(counted.filter("window < 0").groupBy("word", *([] if one_row else [part])).agg(*of), "words")

    def totals(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(name, "n") if one_row else stored(rows.groupBy(name).agg(F.sum("n").alias("n")), "totals")

    of_words = totals(words, "word")
    n, v = of_words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    scores = window_scores(totals(grams, "window")).withColumnRenamed("window", "_window")
    scored = grams.join(scores, F.col("window") == F.col("_window")).select(F.explode("blocks").alias("block"), "window", F.lit("").alias("word"), "score")
    if not one_row:
        words = words.drop("n").join(of_words, "word")
    known = words.filter("n > 0").select(F.explode("blocks").alias("block"), F.lit(-1).cast("bigint").alias("window"), "word", F.col("n").cast("double").alias("score"))
    return scored.unionByName(known), {"texts": texts, "N": n + texts, "V": v + (texts > 0)}


def scored(docs: DataFrame, is_training: Column) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``training``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``score`` is the model's log10 probability of the lower-cased text with its end; ``base_score`` that of its words and
    end under add-one word counts. NULL and empty texts are an end alone. Rows with equal id and text score alike.
    Without a training row every byte has one chance in 255. Other columns are ignored; an empty table gives an empty
    result. ``is_training`` must not be NULL.
    """
    blocks = _in_blocks(docs, is_training)
    counted = _counted(blocks)
    known, totals = _per_block(counted, blocks)
    n, v, ends = totals["N"], totals["V"], totals["texts"]
    missing = math.log10(n + v + 1)
    schema = "doc_id bigint, training boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def score(texts: pa.Table, facts: pa.Table) -> pa.Table:
        of = facts.column("window").to_numpy()
        values = facts.column("score").to_numpy()
        lookup = Lookup(of[of >= 0], values[of >= 0])
        vocabulary = dict(zip(facts.column("word").filter(pa.array(of < 0)).to_pylist(), values[of < 0].tolist(), strict=True))
        tokens, familiar, base, total = [], [], [], []
        for at in range(0, len(texts), _ROWS_AT_ONCE):
            strings = texts.column("text").slice(at, _ROWS_AT_ONCE).to_pylist()
            for text in strings:
                found = _WORD.findall(text)
                counts = np.fromiter(map(vocabulary.get, found, repeat(0.0)), np.float64, len(found))
                tokens.append(len(found) + 1)
                familiar.append(int((counts > 0).sum()) + (ends > 0))
                base.append(float(np.log10(counts + 1).sum()) + math.log10(ends + 1) - missing * (len(found) + 1))
            for _, part in _parts(strings):
                keys, begin = windows(part)
                total.append(np.add.reduceat(lookup[keys], begin[:-1]))
        return pa.table({
            "doc_id": texts.column("doc_id"), "training": texts.column("training"), "n_tokens": pa.array(tokens, pa.int64()),
            "n_known": pa.array(familiar, pa.int64()), "train_tokens": pa.array(np.full(len(texts), n)),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(np.concatenate([np.zeros(0), *total])),
        })

    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, schema)
