"""Targets against repeated sharing, and the rounding's promises."""

import re
from collections import defaultdict
from fractions import Fraction

import pytest
from support import ODD, documents, given_documents, prose, sf_dir  # noqa: F401

from refinery.llm import mixing, queries


def shared(sizes):
    """Targets by sharing, capping and sharing the excess again until no source is above its cap."""
    names = sorted(sizes, key=lambda name: (name is None, name))
    weight = {name: (1, 2, 3)[i % 3] for i, name in enumerate(names)}
    target, capped, total = {}, set(), Fraction(sum(sizes.values()))
    while True:
        open_weight = sum(weight[name] for name in names if name not in capped)
        rest = total - sum(3 * sizes[name] for name in capped)
        target = {name: Fraction(3 * sizes[name]) if name in capped else rest * weight[name] / open_weight for name in names}
        above = {name for name in names if name not in capped and target[name] > 3 * sizes[name]}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 1, "c": 1}, {"a": 1, "b": 2, "c": 300, None: 5, "Z": 40}, {"a": 7}, {"a": 0, "b": 10}, {"b": 0}, {None: 3, "ä": 900, "z": 2, "é": 1},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    found = {row.source: row.target for row in mixing.targets(rows).collect()}
    assert found == pytest.approx({name: float(value) for name, value in shared(sizes).items()})


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(docs, found):
    sizes = defaultdict(int)
    for row in docs:
        sizes[row.source] += size(row.text)
    target = shared(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    source = {}
    for row in docs:
        source[row.doc_id, size(row.text), sizes[row.source]] = row.source
        largest[row.source] = max(largest[row.source], size(row.text))
    assert sorted((repr(row.doc_id), size(row.text)) for row in docs) == sorted((repr(row.doc_id), row["size"]) for row in found)
    for row in found:
        name = source[row.doc_id, row["size"], row.source_size]
        assert row.target == pytest.approx(float(target[name]))
        assert 0 <= row.taken <= 3 * row["size"] and (row["size"] == 0 or row.taken % row["size"] == 0)
        taken[name] += row.taken
    for name in sizes:
        # Copies are rounded as one, so they count as one document.
        assert abs(taken[name] - target[name]) <= 2 * largest[name]


def test_odd_texts(spark):
    docs = documents(spark, [*ODD, *[(100 + i, prose(i, 1 + i % 40), "en", "c") for i in range(700)]])
    found = mixing.mixed(docs).collect()
    check(docs.collect(), found)
    assert sorted(map(repr, found)) == sorted(map(repr, mixing.mixed(docs.repartition(7)).collect()))


def test_several_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    docs = documents(spark, [(i, prose(i, 1 + i % 23), "en", f"s{i % 4}" if i % 3 else "hot") for i in range(600)])
    check(docs.collect(), mixing.mixed(docs).collect())


def test_the_mix_repeats_whole_rows(spark):
    docs = documents(spark, [*ODD, *[(100 + i, prose(i, 1 + i % 40), "en", f"s{i % 5}") for i in range(200)]])
    taken = {(row.doc_id, row["size"]): row.taken for row in mixing.mixed(docs).collect()}
    rows = mixing.mix(docs)
    assert rows.columns == docs.columns
    copies = defaultdict(int)
    for row in rows.collect():
        copies[row.doc_id, size(row.text)] += size(row.text)
    rows_of = defaultdict(int)
    for row in docs.collect():
        rows_of[row.doc_id, size(row.text)] += 1
    assert dict(copies) == {key: value * rows_of[key] for key, value in taken.items() if value}


def test_no_documents(spark):
    assert mixing.mixed(documents(spark, [])).collect() == [] == mixing.mix(documents(spark, [])).collect()


def test_the_query(spark, sf_dir, given_documents):
    check(given_documents.collect(), queries.op4_pivotal_mix(spark, sf_dir).collect())
