"""Fill-in-middle texts: a document's middle is moved behind its suffix, with marks at the seams.

Displacement scatter: the cuts of a batch are found by scanning its bytes for beginnings of code points. Each byte moves by
one number for its segment; a difference array holds the change of that number where a segment begins, its cumulative sum
is the displacement of every byte, and one scatter writes the outputs. The way back finds the marks in an output, builds the
same kind of array from them and gathers the bytes.

Texts hold none of the marks (those that do stay plain), and marks begin with ``<``, which no other place of a mark holds, so
each mark is found once in an output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARK = 3
_BYTES_AT_ONCE = 1 << 22


def transformed(docs: DataFrame, seed: int = 1, changed_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """``doc_id``, ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of each document.

    Draws are the first groups of eight hex digits of sha256 of ``seed``, a colon and the decimal ``doc_id`` (NULL: nothing after
    the colon), so equal ids draw alike. The prefix ends after the smaller of two draws from 0 to n code points, the middle
    after the larger. ``form`` is plain for an empty or NULL text, one that holds a mark, and for all but ``changed_percent``
    of the draws; of the others ``spm_percent`` are spm (suffix, prefix, middle), the rest psm (prefix, suffix, middle). Plain
    outputs are the text, with NULL sizes. Repeated rows give repeated rows; columns other than ``doc_id`` and ``text`` are left out.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    named = docs.select("doc_id", text.alias("text"), marked.alias("marked"), F.array(*draws).alias("h"))
    named = named.withColumn("n", F.char_length("text").cast("bigint"))
    h = F.col("h")
    plain = (F.col("n") == 0) | F.col("marked") | (h[2] % 100 >= changed_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    cuts = [h[i] % (F.col("n") + 1) for i in range(2)]
    placed = named.select("doc_id", "text", "n", form.alias("form"), F.least(*cuts).alias("first"), F.greatest(*cuts).alias("second"))
    changed = F.col("form") != "plain"
    return placed.select(
        "doc_id", "n", "form", F.when(changed, F.col("first")).alias("prefix_chars"),
        F.when(changed, F.col("second") - F.col("first")).alias("middle_chars"),
        _outputs("text", "form", "first", "second").alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text of each output, from it and its form alone. An output without exactly one of each mark is an error."""
    return _texts(output, form)


@F.arrow_udf(StringType())
def _outputs(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, forms, first, second in batches:
        kinds, cuts = _kinds(forms), np.stack([first.to_numpy(zero_copy_only=False), second.to_numpy(zero_copy_only=False)])
        parts = [scatter(*_bytes(texts, a, b), kinds[a:b], *cuts[:, a:b]) for a, b in _runs(texts)]
        yield _strings(parts)


@F.arrow_udf(StringType())
def _texts(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for outputs, forms in batches:
        kinds = _kinds(forms)
        yield _strings([gather(*_bytes(outputs, a, b), kinds[a:b]) for a, b in _runs(outputs)])


def _kinds(forms: pa.Array) -> np.ndarray:
    """0 plain, 1 psm, 2 spm."""
    return pc.index_in(forms, value_set=pa.array(["plain", "psm", "spm"], forms.type)).to_numpy(zero_copy_only=False).astype(np.int64)


def _offsets(texts: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], width, len(texts) + 1, texts.offset * np.dtype(width).itemsize).astype(np.int64)


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows in runs of about ``_BYTES_AT_ONCE``, a longer text alone; one empty run for no rows."""
    offsets = _offsets(texts) if len(texts) else np.zeros(1, np.int64)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _BYTES_AT_ONCE, "right")) - 1)
        yield at, end
        at = end


def _bytes(texts: pa.Array, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some rows and where each begins among them, with their end."""
    offsets = _offsets(texts)[a : b + 1]
    found = texts.buffers()[2]
    data = np.frombuffer(found, np.uint8)[offsets[0] : offsets[-1]] if found is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _strings(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    arrays = [
        pa.Array.from_buffers(pa.large_string(), len(begin) - 1, [None, pa.py_buffer(begin), pa.py_buffer(data)]).cast(pa.string())
        for data, begin in parts
    ]
    return pa.concat_arrays(arrays) if arrays else pa.array([], pa.string())


def _displacement(starts: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """The shift of every byte, where segment k begins at ``starts[k]`` (ascending) and moves by ``shifts[k]``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, np.diff(shifts, prepend=0))
    return np.cumsum(change[:size])


def _segments(begin, kinds, prefix, middle, suffix):
    """Begin of each output, and the place in it of prefix, suffix and middle; marks stand right before these."""
    marks = np.where(kinds > 0, _MARK, 0)
    out = np.concatenate([[0], np.cumsum(np.diff(begin) + 3 * marks)])
    spm = kinds == 2
    at_prefix = out[:-1] + marks + np.where(spm, marks + suffix, 0)
    at_suffix = out[:-1] + marks + np.where(spm, 0, marks + prefix)
    return out, at_prefix, at_suffix, out[:-1] + 3 * marks + prefix + suffix


def scatter(data: np.ndarray, begin: np.ndarray, kinds: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of some texts, one after the other, and where each begins; ``first`` and ``second`` are cuts in code points."""
    points = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    of_text = np.searchsorted(points, begin[:-1])
    changed = kinds > 0
    one = np.where(changed, points[of_text + np.where(changed, first, 0)], begin[1:])
    two = np.where(changed, points[of_text + np.where(changed, second, 0)], begin[1:])
    out, at_prefix, at_suffix, at_middle = _segments(begin, kinds, one - begin[:-1], two - one, begin[1:] - two)
    starts = np.stack([begin[:-1], one, two], 1)
    places = np.stack([at_prefix, at_middle, at_suffix], 1)
    shift = _displacement(starts.ravel(), (places - starts).ravel(), len(data))
    result = np.empty(out[-1], np.uint8)
    result[np.arange(len(data)) + shift] = data
    for mark, place in ((PREFIX, at_prefix), (SUFFIX, at_suffix), (MIDDLE, at_middle)):
        for i, byte in enumerate(mark.encode()):
            result[place[changed] - _MARK + i] = byte
    return result, out


def gather(data: np.ndarray, begin: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of some outputs, one after the other, and where each begins."""
    changed = np.flatnonzero(kinds > 0)
    places = {mark: np.array(begin[1:]) for mark in (PREFIX, SUFFIX, MIDDLE)}
    for mark, found in places.items():
        same = [data[i : len(data) - 2 + i] == byte for i, byte in enumerate(mark.encode())] if len(data) >= _MARK else [np.zeros(0, bool)]
        at = np.flatnonzero(np.logical_and.reduce(same))
        at = at[np.isin(np.searchsorted(begin, at, "right") - 1, changed)]
        if not np.array_equal(np.searchsorted(begin, at, "right") - 1, changed):
            raise ValueError("an output that isn't plain holds each mark once")
        found[changed] = at
    prefix, suffix, middle = (places[mark] + np.where(kinds > 0, _MARK, 0) for mark in (PREFIX, SUFFIX, MIDDLE))
    spm = kinds == 2
    plain = kinds == 0
    prefix = np.where(plain, begin[:-1], prefix)
    prefix_size = np.where(plain, np.diff(begin), np.where(spm, places[MIDDLE], places[SUFFIX]) - prefix)
    suffix_size = np.where(plain, 0, np.where(spm, places[PREFIX], places[MIDDLE]) - suffix)
    middle_size = begin[1:] - middle
    out = np.concatenate([[0], np.cumsum(prefix_size + middle_size + suffix_size)])
    starts = np.stack([out[:-1], out[:-1] + prefix_size, out[:-1] + prefix_size + middle_size], 1)
    sources = np.stack([prefix, middle, suffix], 1)
    shift = _displacement(starts.ravel(), (sources - starts).ravel(), int(out[-1]))
    return data[np.arange(out[-1]) + shift], out
