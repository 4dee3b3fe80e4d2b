"""Text statistics against plain Python, and what the robust distances keep."""

import math
import re

import numpy as np
import pytest
from support import ODD, documents, given_documents, prose, sf_dir  # noqa: F401

from refinery.llm import quality, queries


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    covered = {i + k for i, window in enumerate(windows) if seen[window] > 1 for k in range(5)}
    repeated = len(covered)
    failed = len(words) < 10 or 100 * repeated > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, failed


def test_statistics_of_odd_texts(spark):
    rows = [*ODD, (9, "a b c d e a b c d e f\nsame line\nsame line\n\n\n#*$ %&|<>", "en", "a")]
    docs = documents(spark, rows)
    found = quality.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((row.doc_id, *plain(row.text))) for row in docs.collect())


def test_clean_texts_stay_and_odd_ones_go(spark):
    clean = [(i, prose(i, 30 + i % 300) + ".", "en", f"s{i % 3}") for i in range(300)]
    junk = [(1000 + i, " ".join(f"{word}&&&" for word in prose(i, 60).split()), "en", f"s{i % 3}") for i in range(30)]
    kept = {row.doc_id for row in quality.judged(documents(spark, clean + junk)).filter("kept").collect()}
    assert kept == {row[0] for row in clean}


def test_kept_rows_come_back_whole(spark):
    docs = documents(spark, [*ODD, *[(i, prose(i, 80), "en", "s") for i in range(50, 90)], (50, prose(50, 80), "en", "s")])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(row.doc_id for row in kept.collect()) == [50, *range(50, 90)]


def test_missing_values_in_different_columns_are_told_apart(spark):
    """One text, rejected in a group of clean texts and kept in a group of texts like it."""
    odd = " ".join(f"{word}&&&" for word in prose(7, 60).split())
    clean = [(i, prose(i, 30 + i % 300) + ".", "x", None) for i in range(300)]
    alike = [(1000 + i, " ".join(f"{word}&&&" for word in prose(i, 50 + i % 30).split()), None, "x") for i in range(300)]
    docs = documents(spark, [*clean, *alike, (5000, odd, "x", None), (5001, odd, None, "x")])
    verdicts = {row.doc_id: row.kept for row in quality.judged(docs).collect()}
    assert verdicts[5000] != verdicts[5001]
    assert {row.doc_id for row in quality.keep_good(docs).collect()} == {doc_id for doc_id, kept in verdicts.items() if kept}


def test_no_documents(spark):
    assert quality.judged(documents(spark, [])).collect() == [] == quality.keep_good(documents(spark, [])).collect()


def test_chi_square():
    assert quality._chi2_quantile(0.05, 6) == pytest.approx(12.5916, abs=1e-3)
    assert quality._chi2_quantile(0.01, 8) == pytest.approx(20.0902, abs=1e-3)


def test_the_query(spark, sf_dir, given_documents):
    found = {row.doc_id: row for row in queries.op3_robust_outliers(spark, sf_dir).collect()}
    for row in given_documents.collect():
        assert tuple(found[row.doc_id])[1:7] == plain(row.text)
        assert not (found[row.doc_id].base_failed and found[row.doc_id].kept)
    again = {row.doc_id: row for row in queries.op3_robust_outliers(spark, sf_dir).collect()}
    assert found == again


@pytest.mark.parametrize("percent", [30, 40])
def test_much_junk_in_one_source(spark, percent):
    """Two other sources of the language are clean; the hot one has ``percent`` of one kind of junk."""
    n = 600
    junk = {i for i in range(n) if i % 100 < percent}
    texts = {i: " ".join(f"{word}&&&" for word in prose(i, 60).split()) if i in junk else prose(i, 30 + i % 300) + "." for i in range(n)}
    rows = [(i, text, "en", "hot") for i, text in texts.items()] + [(n + i, prose(i, 30 + i % 200) + ".", "en", f"s{i % 2}") for i in range(100)]
    kept = {row.doc_id for row in quality.judged(documents(spark, rows)).filter("kept").collect()}
    assert kept == {row[0] for row in rows} - junk


def plain_vector(text):
    n_words, word_chars, n_symbols, n_dup_lines, repeated, _ = plain(text)
    n_lines = sum(1 for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line))
    upper, marks = len(re.findall("[A-Z]", text)), len(re.findall(r"[!\"'()+,\-./:;=?@\[\\\]^_`{}~]", text))
    n, chars = n_words + 30, word_chars + 150
    values = [np.log(chars / n) * 4, np.arcsinh(n_symbols / chars * 100), np.arcsinh(repeated / n * 2),
              np.arcsinh(n_dup_lines / (n_lines + 5) * 2), np.arcsinh(upper / chars * 10), np.arcsinh(marks / chars * 10)]
    return np.floor(np.array(values) * 256 + 0.5)


def plain_distance(rows, centre, covariance):
    apart = rows - centre
    return np.floor(np.log1p(np.maximum(0, np.einsum("ni,ij,nj->n", apart, np.linalg.inv(covariance), apart))) * 100 + 0.5)


def plain_estimates(groups):
    """Centre, covariance and log determinant per group of one language, by the same starts and steps on arrays."""
    ridge = np.eye(6) * 0.01

    def drawn(rows, every):
        share = len(rows) / (len(rows) + 200)
        own, of_all = (np.cov(x.T, bias=True) for x in (rows, every))
        covariance = (share * own + (1 - share) * of_all) * quality.CONSISTENCY + ridge
        return share * rows.mean(0) + (1 - share) * every.mean(0), covariance

    def estimates(subsets):
        every = np.concatenate(list(subsets.values()))
        return {name: drawn(rows, every) for name, rows in subsets.items()}

    def step(found):
        closest = {}
        for name, rows in groups.items():
            distances = plain_distance(rows, *found[name])
            closest[name] = rows[distances <= np.percentile(distances, 50)]
        return estimates(closest)

    def first(rows, way):
        middle = np.median(rows, 0)
        spread = np.maximum(0.1, np.median(np.floor(np.abs(rows - middle) * 256), 0) * 1.4826 / 256)
        if way == "medians":
            return middle, np.diag(spread**2)
        z = (rows - middle) / spread
        length = np.linalg.norm(z, axis=1, keepdims=True)
        u = np.floor(np.divide(z, length, out=np.zeros_like(z), where=length > 0) * 1024 + 0.5) / 1024
        return middle, (u.T @ u / len(u) + ridge) * np.outer(spread, spread)

    ways = [{name: first(rows, way) for name, rows in groups.items()} for way in ("medians", "directions")] + [estimates(groups)]
    ended = [step(step(found)) for found in ways]
    found = {name: min((way[name] for way in ended), key=lambda one: round(np.linalg.slogdet(one[1])[1], 9)) for name in groups}
    for _ in range(10):
        before, found = found, step(found)
        if all(np.array_equal(before[name][0], found[name][0]) for name in groups):
            break
    return found


def test_estimates_against_arrays(spark):
    """Two sources of one language with a third of junk, of two kinds; verdicts and distances as on plain arrays."""
    def text(i):
        if i % 3 == 0:
            return " ".join(f"{word}&&&" if i % 2 else f"{word.upper()}!!" for word in prose(i, 40 + i % 90).split())
        return "\n".join(prose(i + 7 * k, 20 + i % 60).capitalize() + ("." if i % 5 else "") for k in range(1 + i % 4))

    texts = {i: text(i) for i in range(500)}
    rows = [(i, one, "en", f"s{i % 5 == 0}") for i, one in texts.items()]
    sound = {source: [i for i, one, _, of in rows if of == source and not plain(one)[5]] for source in ("sTrue", "sFalse")}
    groups = {source: np.array([plain_vector(texts[i]) for i in ids]) / 256 for source, ids in sound.items()}
    found = plain_estimates(groups)
    judged = {row.doc_id: row for row in quality.judged(documents(spark, rows)).collect()}
    limit = round(math.log1p(quality.CUTOFF) * 100)
    for source, ids in sound.items():
        distances = plain_distance(groups[source], *found[source])
        assert max(abs(judged[i].distance - d) for i, d in zip(ids, distances, strict=True)) <= 1
        assert all(judged[i].kept == (d <= limit) for i, d in zip(ids, distances, strict=True) if abs(d - limit) > 1)
    assert 0 < sum(row.kept for row in judged.values()) < len(rows)
