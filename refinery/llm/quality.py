"""Quality rules by robust multivariate outliers: minimum covariance determinant per language and source.

Each text becomes a vector of transformed statistics. For every language and source, the half (``SUPPORT``) of the
vectors that lies closest together gives a mean and a covariance that the odd rest can't pull away; a text is
rejected if its Mahalanobis distance from there is beyond any that a clean text plausibly has.

The estimates come from concentration steps: from a start, measure all distances, keep the closest ``SUPPORT`` of each
group, estimate anew. There are three fixed starts: medians with median deviations; the covariance of directions seen
from the medians; mean and covariance of all rows. After ``FIRST_STEPS`` steps from each, a group goes on from the one
whose covariance has the least determinant, until no group's closest rows change any more (``MOST_STEPS`` at most). A step
is one aggregation, so a group may hold any share of the rows. Vectors are whole numbers (steps of 1 / ``STEPS``) and
sums of them are exact, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.tables import key_of, stored, whole_row
from refinery.llm.words import Words, in_parts

# The base rule and the characters it counts.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 10, 20, 5

STEPS = 256
SUPPORT = 0.5
FIRST_STEPS, MOST_STEPS = 2, 12
PRIOR_ROWS = 200  # weight of the language's estimate in that of each of its sources
LEAST_DEVIATION = 0.1  # of a statistic; most clean texts have no symbol at all, which must not make one symbol odd
FALSE_REJECTS = 1e-7  # share of normally distributed vectors beyond the cutoff
FEATURES = ["word_length", "symbol_rate", "repeat_rate", "dup_line_rate", "upper_rate", "mark_rate"]

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines"]
_WHITE = " \t\n\x0b\x0c\r"
_IS = {name: np.zeros(256, bool) for name in ("symbol", "upper", "mark", "point")}
_IS["symbol"][list(SYMBOLS)] = True
_IS["upper"][ord("A") : ord("Z") + 1] = True
_IS["mark"][list(b"!\"'()+,-./:;=?@[\\]^_`{}~")] = True
_IS["point"][:] = True
_IS["point"][0x80:0xC0] = False  # bytes that continue a code point


def _per_text(words: Words, flags: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[words.text_begin[1:]] - sums[words.text_begin[:-1]]


def _repeated_words(words: Words) -> np.ndarray:
    """Words of each text that are in a window of ``WINDOW`` words found twice or more in it."""
    hashes, at = words.windows(WINDOW)
    owner = np.searchsorted(words.begin, at, "right") - 1
    order = np.lexsort((hashes, owner))
    same = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(change)[:-1] > 0)])
    return covered[words.begin[1:]] - covered[words.begin[:-1]]


def _lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those of them that are equal to an earlier one."""
    lines = [line for line in (text or "").split("\n") if line.strip(_WHITE)]
    return len(lines), len(lines) - len(set(lines))


def _statistics(texts: list[str | None]) -> np.ndarray:
    rows = []
    for first, part in in_parts(texts):
        words = Words(part, lower=False)
        white = np.isin(words.bytes, np.frombuffer(_WHITE.encode(), np.uint8))
        lines = np.array([_lines(text) for text in texts[first : first + len(part)]], np.int64)
        flags = {name: _per_text(words, table[words.bytes] & ~white) for name, table in _IS.items()}
        rows.append(np.column_stack([
            words.counts(), flags["point"], flags["symbol"], lines[:, 1], _repeated_words(words), flags["upper"], flags["mark"], lines[:, 0],
        ]))
    return np.concatenate(rows) if rows else np.zeros((0, len(_COUNTS)), np.int64)


def statistics(docs: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, the whole numbers ``also`` and the counts of each text; a NULL text has no words and no lines."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            counts = _statistics(batch.column("text").to_pylist())
            columns = [batch.column(name) for name in ("doc_id", "lang", "source", *also)]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(np.ascontiguousarray(counts[:, i])) for i in range(len(_COUNTS)))],
                names=["doc_id", "lang", "source", *also, *_COUNTS],
            )

    schema = "doc_id bigint, lang string, source string, " + ", ".join(f"{name} bigint" for name in [*also, *_COUNTS])
    named = docs.select(F.col("doc_id").cast("bigint"), F.col("lang").cast("string"), F.col("source").cast("string"), *also, "text")
    return named.mapInArrow(batches, schema)


def base_failed() -> Column:
    """The fixed rule: too few words, or too large a share of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)


def vector() -> list[Column]:
    """The transformed statistics, in whole steps. Rates take some words of a usual text along, so that short texts don't scatter."""
    usual_words, usual_length = 30, 5.0
    n = F.col("n_words") + usual_words
    chars = F.col("word_chars") + usual_words * usual_length
    values = [
        F.ln(chars / n) * 4,
        F.asinh(F.col("n_symbols") / chars * 100),
        F.asinh(F.col("n_repeat_words") / n * 2),
        F.asinh(F.col("n_dup_lines") / (F.col("n_lines") + 5) * 2),
        F.asinh(F.col("n_upper") / chars * 10),
        F.asinh(F.col("n_marks") / chars * 10),
    ]
    return [F.round(value * STEPS).cast("bigint").alias(name) for value, name in zip(values, FEATURES, strict=True)]


def _chi2_below(x: float, degrees: int) -> float:
    """Chance of a chi-square below x, for an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**k / math.factorial(k) for k in range(degrees // 2))


def _chi2_quantile(chance_above: float, degrees: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if 1 - _chi2_below(middle, degrees) > chance_above else (low, middle)
    return high


CUTOFF = _chi2_quantile(FALSE_REJECTS, len(FEATURES))
#: The closest SUPPORT of normal vectors spreads less than all of them, by this factor.
CONSISTENCY = SUPPORT / _chi2_below(_chi2_quantile(1 - SUPPORT, len(FEATURES)), len(FEATURES) + 2)

_GROUP = ["lang", "source"]
_DIRECTIONS = 1024  # steps in which directions are whole numbers
_PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
_NUMBERS = [f"m{i}" for i in range(len(FEATURES))] + [f"w{i}_{j}" for i, j in _PAIRS]
_PARAMETERS = "lang string, source string, start int, determinant double, " + ", ".join(f"{name} double" for name in _NUMBERS)


def _with(rows: DataFrame, per_group: DataFrame, group: Sequence[str] = _GROUP) -> DataFrame:
    """Rows beside what is known of their group, of which there may be no language or source."""
    other = per_group.withColumnsRenamed({name: f"of_{name}" for name in group})
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in group])
    return rows.join(other, same, "left").drop(*(f"of_{name}" for name in group))


def _distance() -> Column:
    """Squared Mahalanobis distance in steps of a hundredth of its logarithm, as a whole number."""
    apart = [F.col(name) / F.lit(float(STEPS)) - F.col(f"m{i}") for i, name in enumerate(FEATURES)]
    terms = [apart[i] * apart[j] * F.col(f"w{i}_{j}") for i, j in _PAIRS]
    return F.round(F.log1p(F.greatest(reduce(Column.__add__, terms), F.lit(0.0))) * 100).cast("bigint")


def _medians(rows: DataFrame) -> DataFrame:
    """Medians ``m`` and deviations ``s`` of the statistics one by one. A group's values are few whole numbers, so exact medians stay small."""
    medians = rows.groupBy(*_GROUP).agg(*[F.percentile(name, 0.5).alias(f"m{i}") for i, name in enumerate(FEATURES)])
    apart = _with(rows, stored(medians, "medians"))
    spreads = apart.groupBy(*_GROUP).agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(len(FEATURES))],
        *[F.percentile(F.abs(F.col(name) - F.col(f"m{i}")).cast("bigint"), 0.5).alias(f"s{i}") for i, name in enumerate(FEATURES)],
    )
    # 1.4826 makes a median deviation comparable with a standard deviation.
    deviation = [F.greatest(F.col(f"s{i}") * 1.4826 / STEPS, F.lit(LEAST_DEVIATION)).alias(f"s{i}") for i in range(len(FEATURES))]
    return stored(spreads.select(*_GROUP, *[(F.col(f"m{i}") / STEPS).alias(f"m{i}") for i in range(len(FEATURES))], *deviation), "spreads")


def _sums(values: Sequence[Column]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(value).alias(f"t{i}") for i, value in enumerate(values)],
        *[F.sum(values[i] * values[j]).alias(f"t{i}_{j}") for i, j in _PAIRS],
    ]


def _symmetric(row: pd.Series, prefix: str) -> np.ndarray:
    size = len(FEATURES)
    second = np.zeros((size, size))
    for i, j in _PAIRS:
        second[i, j] = second[j, i] = float(row[f"{prefix}t{i}_{j}"])
    return second


def _weights(covariance: np.ndarray) -> list[float]:
    """What products of two deviations count for in a distance."""
    inverse = np.linalg.inv(covariance)
    return [inverse[i, j] * (1 if i == j else 2) for i, j in _PAIRS]


def _of_directions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Medians, and the covariance of the directions in which the rows lie from there."""
    size = len(FEATURES)
    for batch in batches:
        found = []
        for _, row in batch.iterrows():
            deviation = np.array([float(row[f"s{i}"]) for i in range(size)])
            signs = _symmetric(row, "") / max(1.0, float(row["n"])) / _DIRECTIONS**2 + np.eye(size) * LEAST_DEVIATION**2
            found.append([row["lang"], row["source"], 1, 0.0, *(float(row[f"m{i}"]) for i in range(size)), *_weights(signs * np.outer(deviation, deviation))])
        yield pd.DataFrame(found, columns=["lang", "source", "start", "determinant", *_NUMBERS])


def _estimates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Mean and inverse covariance of each group and start, drawn to those of its language by ``PRIOR_ROWS`` rows."""
    size = len(FEATURES)

    def moments(row: pd.Series, prefix: str) -> tuple[float, np.ndarray, np.ndarray]:
        n = max(1.0, float(row[f"{prefix}n"]))
        mean = np.array([float(row[f"{prefix}t{i}"]) for i in range(size)]) / n / STEPS
        return n, mean, _symmetric(row, prefix) / n / STEPS / STEPS - np.outer(mean, mean)

    for batch in batches:
        found = []
        for _, row in batch.iterrows():
            n, mean, covariance = moments(row, "")
            _, of_lang, covariance_of_lang = moments(row, "l_")
            share = n / (n + PRIOR_ROWS)
            centre = share * mean + (1 - share) * of_lang
            pooled = (share * covariance + (1 - share) * covariance_of_lang) * CONSISTENCY + np.eye(size) * LEAST_DEVIATION**2
            found.append([row["lang"], row["source"], row["start"], round(np.linalg.slogdet(pooled)[1], 9), *centre, *_weights(pooled)])
        yield pd.DataFrame(found, columns=["lang", "source", "start", "determinant", *_NUMBERS])


def _estimated(rows: DataFrame) -> DataFrame:
    """Parameters per group and start of all of the rows, with the logarithm of the covariance's determinant."""
    sums = rows.groupBy(*_GROUP, "start").agg(*_sums([F.col(name) for name in FEATURES]))
    of_lang = Window.partitionBy("lang", "start")
    both = sums.select("*", *[F.sum(name).over(of_lang).alias(f"l_{name}") for name in sums.columns if name not in (*_GROUP, "start")])
    return stored(both.mapInPandas(_estimates, _PARAMETERS), "parameters")


def _starts(rows: DataFrame) -> DataFrame:
    """Parameters of each group from which the steps begin, one row for each of the starts."""
    medians = _medians(rows)
    none = F.lit(0.0)
    by_medians = medians.select(
        *_GROUP, F.lit(0).alias("start"), none.alias("determinant"), *[f"m{i}" for i in range(len(FEATURES))],
        *[(1 / (F.col(f"s{i}") * F.col(f"s{i}")) if i == j else none).alias(f"w{i}_{j}") for i, j in _PAIRS],
    )
    apart = [(F.col(name) / STEPS - F.col(f"m{i}")) / F.col(f"s{i}") for i, name in enumerate(FEATURES)]
    seen = _with(rows, medians).select(*_GROUP, *[value.alias(f"z{i}") for i, value in enumerate(apart)])
    length = F.sqrt(reduce(Column.__add__, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(FEATURES))]))
    direction = [F.when(length > 0, F.round(F.col(f"z{i}") / length * _DIRECTIONS)).otherwise(none).cast("bigint") for i in range(len(FEATURES))]
    whole = seen.select(*_GROUP, *[value.alias(f"u{i}") for i, value in enumerate(direction)])
    sums = whole.groupBy(*_GROUP).agg(*_sums([F.col(f"u{i}") for i in range(len(FEATURES))]))
    by_directions = _with(medians, sums).mapInPandas(_of_directions, _PARAMETERS)
    by_all = _estimated(rows.withColumn("start", F.lit(2)))
    return stored(by_medians.unionByName(by_directions).unionByName(by_all), "starts")


def _concentrate(rows: DataFrame, parameters: DataFrame) -> DataFrame:
    """One step: the closest ``SUPPORT`` of each group under the parameters of its starts gives new ones."""
    measured = _with(rows, parameters).select(*_GROUP, "start", *FEATURES, _distance().alias("distance"))
    borders = measured.groupBy(*_GROUP, "start").agg(F.percentile("distance", SUPPORT).alias("border"))
    closest = _with(measured, stored(borders, "borders"), [*_GROUP, "start"]).filter(F.col("distance") <= F.col("border"))
    return _estimated(closest)


def estimated(rows: DataFrame) -> DataFrame:
    """Parameters of each group of ``rows`` (``lang``, ``source`` and the vectors): one row, of its best start."""
    parameters = _starts(rows)
    for _ in range(FIRST_STEPS):
        parameters = _concentrate(rows, parameters)
    order = F.struct("determinant", "start")
    parameters = stored(parameters.groupBy(*_GROUP).agg(*[F.min_by(name, order).alias(name) for name in ("start", "determinant", *_NUMBERS)]), "best")
    # From here on a language is that of its sources' best, whichever start these came from.
    parameters = parameters.withColumn("start", F.lit(0))
    for _ in range(MOST_STEPS - FIRST_STEPS):
        before, parameters = parameters, _concentrate(rows, parameters)
        if parameters.subtract(before).isEmpty():
            break
    return parameters


def judged(docs: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The counts of each row of ``docs`` (``doc_id``, ``text``, ``lang``, ``source``), ``base_failed`` and ``kept``.

    ``also`` names columns of whole numbers that come along. NULL languages and sources are groups of their own. Rows the base rule fails are never kept and take no part in
    the estimates. Other columns are ignored, repeated rows judged alike, and an empty table gives an empty result.
    """
    counts = statistics(docs, also).withColumn("base_failed", base_failed())
    rows = stored(counts.select("*", *vector()), "statistics")
    sound = rows.filter(~F.col("base_failed"))
    parameters = estimated(sound.select(*_GROUP, *FEATURES))
    limit = round(math.log1p(CUTOFF) * 100)
    fits = F.coalesce(_distance() <= limit, F.lit(False))
    return _with(rows, parameters).select(
        "doc_id", *also, *_COUNTS, "base_failed", (~F.col("base_failed") & fits).alias("kept"), _distance().alias("distance")
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept, all columns; the verdict depends on text, language and source alone.

    Whatever other columns are called, they come back as they were; repeated rows are judged alike.
    """
    # The verdict goes back to the rows by a key of what it was made from, not by an id that rows may share.
    key = key_of(F.coalesce(F.col("text"), F.lit("")), F.col("lang").cast("string"), F.col("source").cast("string"))
    keyed = docs.select(whole_row(docs).alias("row"), key.alias("key"))
    asked = docs.select(key["k1"].alias("doc_id"), key["k2"].alias("second"), "text", "lang", "source")
    good = judged(asked, ["second"]).filter("kept").select("doc_id", "second").distinct()
    same = (F.col("key")["k1"] == F.col("doc_id")) & (F.col("key")["k2"] == F.col("second"))
    return keyed.join(good, same, "left_semi").select("row.*")
