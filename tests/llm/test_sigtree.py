"""Components of near duplicates against all pairs of sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from support import ODD, documents, given_documents, prose, sf_dir  # noqa: F401

from refinery.llm import queries, sigtree
from refinery.llm.components import components
from refinery.llm.words import Words


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def classes(rows):
    """(doc_id, set size, component id) of each row, by comparing all pairs that share a shingle."""
    sets = [shingles(text) for _, text in rows]
    having, root = defaultdict(list), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, found in enumerate(sets):
        for shingle in found:
            having[shingle].append(i)
    pairs = {(i, j) for found in having.values() for i in found for j in found if i < j}
    for i, j in pairs:
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    least = {i: min((d for d in found if d is not None), default=None) for i, found in members.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))]


def changed(text, draw, share):
    return " ".join(f"x{draw.randrange(10**6)}" if draw.random() < share else word for word in text.split())


def groups(seed, n=60, passage=True):
    """Originals, chains of edited copies, exact copies, and passages that many texts share."""
    draw = random.Random(seed)
    shared = prose(seed, 60)
    rows = []
    for i in range(n):
        text = prose(1000 * seed + i, draw.randint(1, 150)) + (" " + shared if passage and i % 3 == 0 else "")
        rows.append(text)
        for _ in range(draw.choice([0, 0, 1, 4])):
            text = changed(text, draw, draw.choice([0, 0.005, 0.01, 0.02, 0.05]))
            rows.append(text.upper() if draw.random() < 0.2 else text)
    draw.shuffle(rows)
    return [(i, text) for i, text in enumerate(rows)]


def check(spark, rows):
    docs = documents(spark, [(i, text, "en", "s") for i, text in rows])
    found = sigtree.classified(docs).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, classes(rows)))


def test_copies_and_passages(spark):
    check(spark, groups(1))


def test_a_large_group_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(sigtree, "BUCKET_ROWS", 8)
    monkeypatch.setattr(sigtree, "FREQUENT_IN", 10**9)
    draw = random.Random(3)
    base = prose(7, 120)
    rows = [changed(base, draw, 0.015) for _ in range(60)] + [text for _, text in groups(4, 30)]
    check(spark, list(enumerate(rows)))


def test_odd_texts(spark):
    check(spark, [(i, text) for i, text, *_ in ODD] + [(None, "one"), (None, "ONE"), (50, None)])


def test_no_documents(spark):
    assert sigtree.classified(documents(spark, [])).collect() == [] == sigtree.keep_one(documents(spark, [])).collect()


def test_one_row_of_each_group_stays(spark):
    rows = [(100 + i, text) for i, text in groups(5, 30)] + [(i, text) for i, text, *_ in ODD]
    docs = documents(spark, [(i, text, "en", "s") for i, text in rows])
    kept = sigtree.keep_one(docs)
    assert kept.columns == docs.columns
    expected = classes(rows)
    stay = sorted(repr(i) for i, n, component in expected if not n)
    stay += sorted({repr(component) for _, n, component in expected if n})
    assert sorted(repr(row.doc_id) for row in kept.collect()) == sorted(stay)


def test_the_forest_leaves_every_pair_that_is_alike():
    draw = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        base = draw.integers(0, 1 << 62, draw.integers(1, 300), dtype=np.uint64)
        sets += [np.unique(base[draw.random(len(base)) > 0.05]) for _ in range(4)]
    sets = [found for found in sets if len(found)]
    begin = np.array([0, 1, 50])
    order = np.concatenate([np.array(sorted(range(a, b), key=lambda i: len(sets[i]))) for a, b in [(0, 1), (1, 50), (50, len(sets))]])
    sets = [sets[i] for i in order]
    bitmaps = np.frombuffer(b"".join(map(sigtree._bitmap, sets)), np.uint64).reshape(len(sets), -1)
    sizes, parts = np.array(list(map(len, sets))), np.arange(len(sets))
    forest = sigtree.SignatureForest(bitmaps, sizes, sizes, parts, begin, 80)
    found = {pair for a, b in forest.pairs() for pair in zip(a.tolist(), b.tolist(), strict=True)}
    bucket = np.searchsorted(begin, np.arange(len(sets)), "right")
    alike = set()
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            common = len(np.intersect1d(sets[i], sets[j]))
            if bucket[i] == bucket[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                alike.add((i, j))
    assert alike <= found and len(found) < len(sets) ** 2 / 20


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)] + [(90, 80), (80, 70), (70, 90)]])
def test_components(spark, links):
    found = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    root = {x: x for link in links for x in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {x: least for x, least in root.items() if x != least}


def test_words_do_not_depend_on_their_place():
    one, two = Words([b"the cat", b"", b" sat\ton"], lower=True), Words([b"Sat on THE cat"], lower=True)
    assert one.hashes.tolist() == two.hashes[[2, 3, 0, 1]].tolist() and one.counts().tolist() == [2, 0, 2]


def test_the_query(spark, sf_dir, given_documents):
    rows = [(row.doc_id, row.text) for row in given_documents.collect()]
    assert sorted(map(tuple, queries.op8_signature_trees(spark, sf_dir).collect())) == sorted(classes(rows))
