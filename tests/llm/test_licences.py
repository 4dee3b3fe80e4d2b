"""Licence matches against bags of bigrams."""

import random
import re
import time
from collections import Counter

import pytest
from support import ODD, documents, given_documents, prose, sf_dir  # noqa: F401

from refinery.llm import licences

TEXTS = [
    (1, "Some prose.\n  LICENSED under the apache-license version 2.0\nmore"), (2, "Licensed under CC BY-NC 4.0."), (3, "All rights reserved"),
    (4, "Copyright. All rights reserved. All rights reserved."), (5, "Released under\nthe MIT License."), (6, "MIT"), (2, "Licensed under CC BY-NC 4.0."),
    (7, "This work is licenced under the GNU General Public License, version 3, or any later"), (None, "Released under the MIT License."),
    (8, "Released under the MIT License. " * 2), (9, None), (10, prose(3, 400)),
]


def bag(text):
    words = re.findall("[a-z0-9]+", text.lower())
    return Counter(zip(words, words[1:])) if len(words) != 1 else Counter(words)  # noqa: B905


def expected(rows, templates, percent):
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        passages = list(enumerate(lines)) + ([(-1, text)] if len(lines) > 1 else [])
        for at, passage in passages:
            for name, template in templates.items():
                a, b = bag(passage), bag(template)
                common, total = (a & b).total(), a.total() + b.total()
                if a and 200 * common >= percent * total:
                    out.append((doc_id, at, name, common, total))
    return sorted(out, key=repr)


@pytest.mark.parametrize("percent", [100, 80, 50])
def test_matches(spark, percent):
    rows = TEXTS + [(i, text) for i, text, *_ in ODD]
    docs = documents(spark, [(i, text, "en", "s") for i, text in rows])
    templates = licences.TEMPLATES | {"twice": "of all of all of it", "one": "mit"}
    got = licences.found(docs, templates, percent)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows, templates, percent)


def test_no_documents_and_no_templates(spark):
    assert licences.found(documents(spark, [])).collect() == []
    assert licences.found(documents(spark, [(1, "MIT", "en", "s")]), {}).collect() == []


def test_nothing_is_moved_and_no_python_runs(spark, plan, given_documents):
    text = plan(licences.found(given_documents))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def best_runs(text, template, percent):
    """Whether any run of words reaches the percentage, by all of them."""
    words, b = re.findall("[a-z0-9]+", text.lower()), bag(template)
    if 200 * (bag(text) & b).total() < percent * b.total():  # no run has more in common than the text
        return False
    spans = ((i, j) for i in range(len(words)) for j in range(i + 2, len(words) + 1))
    return any(200 * (bag(" ".join(words[i:j])) & b).total() >= percent * (j - i - 1 + b.total()) for i, j in spans)


def runs_of(text, template, percent):
    """(first word, last bigram, common, n + m) of the best runs, from all runs of words, the most alike first."""
    words, b = re.findall("[a-z0-9]+", text.lower()), bag(template)
    found, pairs = [], list(zip(words, words[1:]))  # noqa: B905
    for i in range(len(pairs)):
        best, seen, common = None, Counter(), 0
        for j in range(i, min(len(pairs), i + b.total() * (200 - percent) // percent)):
            seen[pairs[j]] += 1
            common += seen[pairs[j]] <= b[pairs[j]]
            if best is None or common * best[3] > best[2] * (j - i + 1 + b.total()):
                best = (i, j, common, j - i + 1 + b.total())
        if best and pairs[i] in b and 200 * best[2] >= percent * best[3]:
            found.append(best)
    kept = []
    for run in sorted(found, key=lambda run: (-run[2] / run[3], run[0])):
        if not any(run[0] <= k[1] + 1 and k[0] <= run[1] + 1 for k in kept):
            kept.append(run)
    return kept


def embedded_plainly(rows, forms):
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        of_word = [at for at, line in enumerate(lines) for _ in re.findall("[a-z0-9]+", line.lower())]
        for licence, form, percent in forms:
            notice = bag(licences.TEMPLATES.get(licence, ""))

            def is_notice(passage, notice=notice):
                a = bag(passage)
                return notice.total() and a.total() and 200 * (a & notice).total() >= 80 * (a.total() + notice.total())

            if is_notice(text or ""):
                continue
            for first, last, common, total in runs_of(text or "", form, percent):
                if not any(is_notice(lines[at]) for at in set(of_word[first : last + 2])):
                    out.append((doc_id, of_word[first], licence, common, total))
    return sorted(out, key=repr)


def short_forms():
    return [form for form in licences.all_forms() if len(form[1].split()) < 120]


def test_all_columns_of_embedded_matches(spark):
    """Documents with notices over line ends, inside sentences, twice, edited, and under a line that is a notice."""
    draw = random.Random(5)
    short = short_forms()
    rows = []
    for i in range(60):
        parts = [prose(i * 10 + k, draw.randint(0, 30)) for k in range(4)]
        for k in range(draw.randint(0, 3)):
            words = draw.choice(short)[1].split()
            if draw.random() < 0.4:
                words[draw.randrange(len(words))] = draw.choice(["changed", "license", "the"])
            step = draw.choice([3, 7, 100])
            parts.insert(draw.randrange(len(parts)), draw.choice([" ", "\n"]).join([prose(k, draw.randint(0, 3)), *["\n".join(" ".join(words[j : j + step]) for j in range(0, len(words), step))]]))
        rows.append((i, draw.choice(["\n", " ", "\n\n"]).join(parts)))
    rows += TEXTS
    got = licences.embedded(documents(spark, [(i, text, "en", "s") for i, text in rows]), short)
    wanted = embedded_plainly(rows, short)
    assert sorted(map(tuple, got.collect()), key=repr) == wanted and len(wanted) > 60


def test_a_long_text_takes_time_in_proportion(spark):
    def seconds(n):
        text = "\n".join(f"line {i} of some words here" if i % 7 else "Released under the MIT License and more" for i in range(n))
        docs = documents(spark, [(1, text, "en", "s")])
        start = time.perf_counter()
        assert licences.scanned(docs).count() >= n // 7
        return time.perf_counter() - start

    seconds(1_000)
    assert seconds(32_000) < 5 * max(seconds(8_000), 1.0)


def test_runs_of_words(spark):
    """Wrapped, embedded, edited and full-text notices; each form against all runs of words."""
    forms = dict(licences.FORMS)
    short = short_forms()
    texts = [
        "Released under\nthe MIT License.", "This project is released under the MIT License.", "This code is\n  licensed under the Apache\n * License, Version 2.0.",
        "# SPDX-License-Identifier: MIT", "SPDX-License-Identifier: Apache-2.0 only", "MIT License", "x " * 50 + forms["Apache-2.0"][:400],
        "/* Licensed under the Apache License, Version 2.0 (the License); you may not use this file. */", prose(4, 300), "reserved all rights",
        prose(5, 40) + "\nAll rights\nreserved. All rights reserved in full " + prose(6, 40), "", None, "mit",
    ]
    docs = documents(spark, [(i, text, "en", "s") for i, text in enumerate(texts)])
    got = {(row.doc_id, row.licence) for row in licences.found(docs).unionByName(licences.embedded(docs, short)).collect()}
    wanted = {(i, name) for i, text in enumerate(texts) for name, form, percent in short if best_runs(text or "", form, percent)}
    assert got == wanted and {(0, "MIT"), (1, "MIT"), (2, "Apache-2.0"), (3, "MIT"), (5, "MIT"), (10, "all-rights-reserved")} <= got


def test_full_texts(spark):
    """Every form inside prose, re-wrapped and with a few words changed, is found where it begins."""
    forms = [(name, text) for name, text, percent in licences.all_forms() if percent < 100]
    rows = []
    for i, (_, text) in enumerate(forms):
        words = text.split()
        words[20::40] = ["changed"] * len(words[20::40])
        wrapped = "\n".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9))
        rows.append((i, f"{prose(i, 30)}\n{prose(i + 1, 5)} {wrapped} {prose(i, 30)}", "en", "s"))
    got = {(row.doc_id, row.licence): row for row in licences.scanned(documents(spark, rows)).collect()}
    for i, (name, _) in enumerate(forms):
        assert (i, name) in got, name
    assert sum(row.line_no <= 2 for row in got.values()) >= len(forms)


def test_matches_of_lines_are_not_given_twice(spark):
    text = f"{prose(1, 20)}\nReleased under the MIT License.\n{prose(2, 20)}\nand also released under the\nMIT License."
    rows = licences.scanned(documents(spark, [(1, text, "en", "s")])).collect()
    assert sorted((row.line_no, row.common, row.bigrams) for row in rows if row.bigrams > 2) == [(1, 4, 8), (3, 4, 8)]


def test_a_scan_moves_nothing(spark, plan, given_documents):
    for text in (plan(licences.scanned(given_documents)), plan(licences.embedded(given_documents, short_forms()))):
        assert "Exchange" not in text and "Python" not in text and "Arrow" not in text
