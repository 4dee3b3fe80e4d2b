"""PPM against a trie that is walked byte by byte, with exclusion by sets."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import ODD, documents, given_documents, prose, sf_dir  # noqa: F401

from refinery.llm import ppm, queries


class Trie:
    def __init__(self, texts):
        self.after = defaultdict(Counter)
        for text in texts:
            for context, symbol in self.steps(text):
                for k in range(ppm.ORDER + 1):
                    self.after[context[ppm.ORDER - k :]][symbol] += 1

    @staticmethod
    def steps(text):
        data = b"\xff" * ppm.ORDER + text + b"\xfe"
        return [(data[i - ppm.ORDER : i], data[i]) for i in range(ppm.ORDER, len(data))]

    def chance(self, context, symbol):
        out, chance = set(), 1.0
        for k in range(ppm.ORDER, -1, -1):
            seen = self.after.get(context[ppm.ORDER - k :])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in out}
            chances = sum(left.values()) + len(left)
            if symbol in left:
                return chance * left[symbol] / chances
            if left:
                chance *= len(left) / chances
            out |= seen.keys()
        return chance / (255 - len(out))

    def score(self, text):
        return sum(math.log10(self.chance(*step)) for step in self.steps(text))


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered(text)), None]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def expected(rows):
    training = [text for doc_id, text in rows if not held_out(doc_id)]
    counts = Counter(word for text in training for word in words(text))
    n, v = sum(counts.values()), len(counts)
    trie = Trie([lowered(text).encode() for text in training])
    found = []
    for doc_id, text in rows:
        tokens = words(text)
        base = sum(math.log10((counts[word] + 1) / (n + v + 1)) for word in tokens)
        found.append((doc_id, held_out(doc_id), len(tokens), sum(counts[word] > 0 for word in tokens), n, base, trie.score(lowered(text).encode())))
    return found


def check(found, rows):
    found = sorted(map(tuple, found), key=repr)
    wanted = sorted(expected(rows), key=repr)
    assert [row[:5] for row in found] == [row[:5] for row in wanted]
    for one, other in zip(found, wanted, strict=True):
        assert one[5:] == pytest.approx(other[5:], rel=1e-9)


def scores(docs):
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = ppm.scored(docs, F.crc32(name.cast("binary")) % 7 != 2)
    return found.select("doc_id", ~F.col("training"), "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()


def test_scores_of_odd_texts(spark):
    rows = [(i, text) for i, text, *_ in ODD] + [(100 + i, prose(i, 1 + i).title() + " ñ\x00ß"[: i % 4]) for i in range(60)]
    check(scores(documents(spark, [(i, text, "en", "s") for i, text in rows]).repartition(3)), rows)


def test_few_blocks_per_row(spark, monkeypatch):
    """Windows and words of many blocks, listed in several rows each."""
    monkeypatch.setattr(ppm, "BLOCKS_PER_ROW", 2)
    rows = [*ODD, *[(i, prose(i, 40), "en", "s") for i in range(100, 130)]]
    docs = documents(spark, rows)
    assert ppm._in_blocks(docs, F.lit(True)).agg(F.max("block")).first()[0] >= 2
    check(scores(docs), [row[:2] for row in rows])


def test_windows_wait_and_are_added_up(monkeypatch):
    """However many windows wait, the counts are those of a plain count, windows of texts that don't learn with none."""
    some = [prose(seed, 30, 20) for seed in range(40)] + ["", "é"]
    training = np.arange(len(some)) % 3 != 1
    learnt, every = Counter(), set()
    for text, learns in zip(some, training.tolist(), strict=True):
        keys = ppm.windows([text.encode()])[0].tolist()
        every.update(keys)
        learnt.update(keys if learns else [])
    for waiting in (0, 1 << 18):
        monkeypatch.setattr(ppm, "_WAITING", waiting)
        held = ppm._Counts()
        for at in range(0, len(some), 7):
            held.add(some[at : at + 7], training[at : at + 7])
        held.settle()
        assert held.keys.tolist() == sorted(every)
        assert held.counts.tolist() == [learnt[key] for key in sorted(every)]
    lookup = ppm.Lookup(held.keys, held.counts.astype(float))
    assert (lookup[held.keys[::-1]] == held.counts[::-1]).all()


def test_no_training_and_no_rows(spark):
    docs = documents(spark, [(1, "ab", "en", "s"), (2, None, "en", "s")])
    found = {row.doc_id: row for row in ppm.scored(docs, F.lit(False)).collect()}
    assert found[1].score == pytest.approx(-3 * math.log10(255)) and found[2].score == pytest.approx(-math.log10(255))
    assert (found[1].n_tokens, found[1].n_known, found[1].train_tokens) == (2, 0, 0)
    assert found[1].base_score == pytest.approx(0.0)
    assert ppm.scored(documents(spark, []), F.lit(True)).collect() == []


def test_the_query(spark, sf_dir, given_documents):
    rows = [(row.doc_id, row.text) for row in given_documents.collect()]
    found = queries.op2_ppm_scores(spark, sf_dir).collect()
    check(found, rows)
    # On texts it has not seen, the model is far better than one chance in 255 a byte.
    unseen = [row for row in found if row.held_out]
    size = {i: len((text or "").encode()) + 1 for i, text in rows}
    assert sum(row.score for row in unseen) > -0.5 * math.log10(255) * sum(size[row.doc_id] for row in unseen)
