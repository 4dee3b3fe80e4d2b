"""Licence scans: normalised passages compared with licence templates by the Dice coefficient over word bigrams.

A passage is a line of a text, or a whole text of several lines. Normalised, it is its lower-case words of a-z and 0-9.
Its bigrams are its pairs of neighbouring words (of a single word, the word); with n and m bigrams and c in common, the
coefficient is 2 c / (n + m), each bigram counting as often as it is there in both. It can reach ``percent`` only if
the smaller of n and m is at least percent / (200 - percent) of the larger, so most passages are out by their number
of words alone, and the others meet only templates of about their size. Templates are few and go along with the
expression: nothing is joined or moved, so no frequent line gathers in a task.

``scanned`` takes every run of two or more words of a text as a passage as well, over line ends, and meets headers, full
texts and tags (``licence_forms``) too. A run that reaches ``percent`` holds at least m * percent / (200 - percent) of a
template's m bigrams. So texts are read no further that lack all words of a set whose bigrams are too many to miss
(``_hinted``), nor where too few bigrams lie close enough together. Best runs begin and end with a bigram of the template,
so one pass over those from each possible start measures all that matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.licence_forms import FORMS, TAGS
from refinery.llm.tables import stored

PERCENT = 80
WHOLE = -1  # the line number of a whole text
# Usual notices, by identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights-reserved": "All rights reserved.",
}


def template_bigrams(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return [" ".join(pair) for pair in zip(words, words[1:])] or words  # noqa: B905


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), "")


def _size(words: str) -> str:
    """Number of bigrams of an array of words."""
    return f"if(size({words}) = 1, 1, size({words}) - 1)"


_BIGRAMS = "if(size(words) = 1, words, transform(sequence(1, size(words) - 1), i -> concat(words[i - 1], ' ', words[i])))"
# For every different bigram of a template, as often as both have it.
_COMMON = """aggregate(array_distinct(template.bigrams), 0, (sum, one) -> sum + least(
    size(filter(template.bigrams, x -> x = one)), size(filter(bigrams, x -> x = one))))"""


def _least_common(m: int, percent: int) -> int:
    """Bigrams that a passage has in common with a template of ``m`` if it reaches ``percent``."""
    return -(-m * percent // (200 - percent))


def _sets(bigrams: list[str], percent: int, liked: Counter) -> list[list[str]]:
    """Sets of words of a template; a passage that reaches ``percent`` has a word of each of them.

    Without any of a set's words more bigrams are missing than may be. Long words and those of other templates come first.
    """
    may_miss = len(bigrams) - _least_common(len(bigrams), percent)
    having: dict[str, set[int]] = {}
    for at, bigram in enumerate(bigrams):
        for word in bigram.split():
            having.setdefault(word, set()).add(at)
    sets, one, covered = [], [], set()
    for word in sorted(having, key=lambda word: (len(word) < 7, len(word) < 5, -liked[word] * len(having[word]), word)):
        one, covered = [*one, word], covered | having[word]
        if len(covered) > may_miss:
            sets, one, covered = [*sets, one], [], set()
    return sets


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with a column that is worked out once per row: Spark would put it into every expression that names it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _hinted(docs: DataFrame, templates: Sequence[tuple[list[str], int]]) -> DataFrame:
    """``doc_id`` and ``text`` of the rows of ``docs`` that have the words without which none of the templates (bigrams, percent) matches."""
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").filter("text IS NOT NULL")
    liked = Counter(word for bigrams, _ in templates for word in {word for bigram in bigrams for word in bigram.split()})
    any_of, all_of = set(), []
    for bigrams, percent in templates:
        if _least_common(len(bigrams), percent) < 1:
            return texts
        sets = _sets(bigrams, percent, liked)
        if len(sets[0]) > 3:
            any_of |= set(sets[0])
        else:
            all_of.append(tuple(tuple(one) for one in sets if len(one) <= 3))
    known = sorted(any_of.union(*[word for sets in all_of for word in sets]))
    rows = _once(texts, "hints", F.array_intersect(_words(F.col("text")), _list(known))).filter("size(hints) > 0")

    def one_of(words: Sequence[str]) -> Column:
        return reduce(Column.__or__, [F.array_contains("hints", word) for word in words])

    some = [F.arrays_overlap("hints", _list(sorted(any_of)))] if any_of else []
    some += [reduce(Column.__and__, [one_of(words) for words in sets]) for sets in dict.fromkeys(all_of)]
    return rows.filter(reduce(Column.__or__, some)).select("doc_id", "text")


def _list(words: Sequence[str]) -> Column:
    """A list of words or bigrams as one text, so that the plan has few literals."""
    return F.split(F.lit(",".join(words)), ",") if words else F.expr("cast(array() AS array<string>)")


def found(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``line_no`` (from 0; -1: the whole text), ``licence``, ``common`` and ``bigrams`` (n + m) of each match.

    A passage matches every template with which it reaches ``percent``. NULL and empty texts and lines without a word match nothing; repeated rows and lines match as often
    as they are there. Other columns are ignored. Templates must have a word.
    """
    known = {name: template_bigrams(text) for name, text in sorted(templates.items())}
    if not known:
        return docs.select("doc_id", F.lit(0).alias("line_no"), F.lit("").alias("licence"), F.lit(0).alias("common"), F.lit(0).alias("bigrams")).limit(0)
    sizes = [len(bigrams) for bigrams in known.values()]
    docs = _hinted(docs, [(bigrams, percent) for bigrams in known.values()])
    lines = F.split("text", "\n")
    several = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(WHOLE).alias("at"), F.col("text").alias("passage"))))
    each = F.transform(lines, lambda line, at: F.struct(at.alias("at"), line.alias("passage")))
    none = F.expr("cast(array() AS array<struct<at: int, passage: string>>)")
    passages = docs.select("doc_id", F.explode(F.concat(F.coalesce(each, none), F.coalesce(several, none))).alias("one"))
    words = passages.select("doc_id", F.col("one.at").alias("line_no"), _words(F.col("one.passage")).alias("words")).filter("size(words) > 0")
    n = words.withColumn("n", F.expr(_size("words")))
    # Whole numbers: min * (200 - percent) >= max * percent.
    fits = f"n * (200 - {percent}) >= {min(sizes)} * {percent} AND {max(sizes)} * (200 - {percent}) >= n * {percent}"
    candidates = n.filter(fits).select("doc_id", "line_no", "n", F.expr(_BIGRAMS).alias("bigrams"))
    table = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(len(bigrams)).alias("m"), F.array(*map(F.lit, bigrams)).alias("bigrams")) for name, bigrams in known.items()
    ])
    sized = candidates.select("doc_id", "line_no", "n", "bigrams", F.explode(table).alias("template")).filter(
        f"least(n, template.m) * (200 - {percent}) >= greatest(n, template.m) * {percent}"
    )
    scored = sized.select("doc_id", "line_no", "n", F.col("template.name").alias("name"), F.col("template.m").alias("m"), F.expr(_COMMON).alias("common"))
    matches = scored.filter(f"200 * common >= {percent} * (n + m)")
    return matches.select("doc_id", "line_no", F.col("name").alias("licence"), "common", (F.col("n") + F.col("m")).alias("bigrams"))


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _runs() -> str:
    """Of the text's ``bigrams`` and ``t``, a template, the best runs that do not overlap: first and last bigram and common ones.

    ``small`` are the bigrams that any template has, ``spots`` their places.
    """
    hits = "filter(spots, i -> array_contains(shared, bigrams[i]))"
    starts = "if(size(hits) < t.need, cast(array() AS array<int>), filter(sequence(0, size(hits) - t.need), j -> hits[j + t.need - 1] - hits[j] < t.most))"
    # A bigram that is in a run more often than in the template counts so often only: not where the one that many before it is in the run.
    ranked = "array_sort(transform(hits, i -> struct(bigrams[i] AS b, i AS i)))"
    counted = "transform(ranked, (r, k) -> struct(r AS r, k - t.counts[array_position(t.bigrams, r.b) - 1] AS before, k + t.counts[array_position(t.bigrams, r.b) - 1] AS after))"
    places = """array_sort(transform(counted, c -> struct(c.r.i AS i, if(c.before >= 0 AND ranked[c.before].b = c.r.b, ranked[c.before].i, -1) AS q,
        c.after >= size(ranked) OR ranked[least(c.after, size(ranked) - 1)].b != c.r.b OR ranked[least(c.after, size(ranked) - 1)].i - c.r.i >= t.most AS counts)))"""
    # A run is better with the bigram before it, where that counts in any run: starts are those without.
    begins = "filter(starts, j -> j = 0 OR hits[j - 1] != hits[j] - 1 OR NOT places[j - 1].counts)"
    longer = """aggregate(slice(places, j + 1, t.most), struct(0 AS c, 0 AS best, hits[j] AS last), (a, p) -> if(p.i - hits[j] >= t.most, a,
        element_at(transform(array(a.c + int(p.q < hits[j])), c -> if(
            bigint(c) * (a.last - hits[j] + 1 + t.m) > bigint(a.best) * (p.i - hits[j] + 1 + t.m),
            struct(c AS c, c AS best, p.i AS last), struct(c AS c, a.best AS best, a.last AS last))), 1)))"""
    good = f"""filter(transform({begins}, j -> {_let("w", longer, "struct(hits[j] AS first, w.last AS last, w.best AS common)")}),
        w -> 200L * w.common >= t.percent * (w.last - w.first + 1 + t.m))"""
    by_share = f"""array_sort({good}, (x, y) -> int(signum(bigint(y.common) * (x.last - x.first + 1 + t.m) - bigint(x.common) * (y.last - y.first + 1 + t.m)))
        * 2 + int(signum(x.first - y.first)))"""
    apart = f"""aggregate({by_share}, cast(array() AS array<struct<first: int, last: int, common: int>>), (kept, w) ->
        if(exists(kept, k -> w.first <= k.last + 1 AND k.first <= w.last + 1), kept, concat(kept, array(w))))"""
    some = _let("ranked", ranked, _let("counted", counted, _let("places", places, apart)))
    none = "cast(array() AS array<struct<first: int, last: int, common: int>>)"
    return _let("shared", "array_intersect(small, t.bigrams)", _let("hits", hits, _let("starts", starts, f"if(size(starts) = 0, {none}, {some})")))


def _template(licence: str, text: str, percent: int, notice: str) -> Column:
    bigrams = template_bigrams(text)
    bag, m = Counter(bigrams), len(bigrams)
    need, rest, least = _least_common(m, percent), sorted(bag.values()), 0
    while sum(rest[len(rest) - least:]) < need:
        least += 1
    values = {"m": m, "percent": percent, "need": need, "fewest": least, "most": m * (200 - percent) // percent}
    counts = F.split(F.lit(",".join(map(str, bag.values()))), ",").cast("array<int>")
    return F.struct(
        F.lit(licence).alias("licence"), _list(list(bag)).alias("bigrams"), counts.alias("counts"),
        _list(template_bigrams(notice) if notice else []).alias("notice"), *[F.lit(value).alias(name) for name, value in values.items()],
    )


def embedded(
    docs: DataFrame, forms: Sequence[tuple[str, str, int]], notices: Mapping[str, str] = TEMPLATES, percent: int = PERCENT
) -> DataFrame:
    """Matches of runs of words with ``forms`` (licence, text, percent above 0), with the columns of ``found``.

    ``line_no`` is the line where the run begins. Of runs that overlap, the most alike (then the first) is given for each
    form. Left out are runs in a line or a whole text that matches the notice of the same licence at ``percent``, which
    ``found`` gives already. Forms have two words or more.
    """
    if not forms:
        return found(docs, {})
    known = [(template_bigrams(text), least) for _, text, least in forms]
    table = F.array(*[_template(licence, text, least, notices.get(licence, "")) for licence, text, least in forms])
    rows = _once(_hinted(docs, known), "lines", F.transform(F.split("text", "\n"), _words)).select("doc_id", "lines")
    rows = _once(rows, "words", F.flatten("lines")).filter("size(words) > 1")
    rows = _once(rows, "bigrams", F.expr(_BIGRAMS)).select("doc_id", "lines", "bigrams")
    # Once per text: its bigrams that any form has at all; everything after works on these few and their places.
    every = sorted(set().union(*[bigrams for bigrams, _ in known]))
    rows = _once(rows, "small", F.array_intersect("bigrams", _list(every)))
    likely = F.filter(table, lambda t: (F.size("small") >= t["fewest"]) & (F.size(F.array_intersect("small", t["bigrams"])) >= t["fewest"]))
    rows = _once(rows.filter("size(small) > 0"), "likely", likely).filter("size(likely) > 0")
    rows = _once(rows, "spots", F.expr("filter(sequence(0, size(bigrams) - 1), i -> array_contains(small, bigrams[i]))"))
    each = rows.select("doc_id", "lines", "bigrams", "small", "spots", F.explode("likely").alias("t"))
    each = _once(each, "runs", F.expr(_runs())).filter("size(runs) > 0").select("doc_id", "lines", "t", "runs")
    # The line of every word; of a run, the first and the last line.
    each = _once(each, "at", F.expr("flatten(transform(lines, (line, l) -> transform(line, word -> l)))"))
    of = _BIGRAMS.replace("words", "p")
    common = """aggregate(array_distinct(t.notice), 0, (sum, one) -> sum + least(
        size(filter(t.notice, x -> x = one)), size(filter(having, x -> x = one))))"""

    def is_notice(words: str) -> str:
        """Whether a line's or the text's words match the notice of the template's licence; the size is looked at first."""
        alike = _let("having", of, f"200 * {common} >= {percent} * (size(having) + size(t.notice))")
        fits = f"""least({_size("p")}, size(t.notice)) * (200 - {percent}) >= greatest({_size("p")}, size(t.notice)) * {percent}"""
        return _let("p", words, f"size(t.notice) > 0 AND size(p) > 0 AND if({fits}, {alike}, false)")

    each = _once(each, "whole", F.expr(is_notice("flatten(lines)"))).filter("NOT whole")
    rest = f"filter(runs, r -> NOT exists(sequence(at[r.first], at[r.last + 1]), l -> {is_notice('lines[l]')}))"
    placed = F.expr(f"""transform({rest}, r -> struct(
        at[r.first] AS line_no, t.licence AS licence, r.common AS common, r.last - r.first + 1 + t.m AS bigrams))""")
    return each.select("doc_id", F.explode(placed).alias("one")).select("doc_id", "one.*")


def all_forms(percent: int = PERCENT) -> list[tuple[str, str, int]]:
    return [(name, text, percent) for name, text in [*TEMPLATES.items(), *FORMS]] + [(name, text, 100) for name, text in TAGS]


def scanned(docs: DataFrame) -> DataFrame:
    """``found``, and ``embedded`` of all notices, headers, full texts and tags. The texts worth a look are stored, so ``docs`` is read once."""
    forms = all_forms()
    likely = stored(_hinted(docs, [(template_bigrams(text), least) for _, text, least in forms]), "likely")
    return found(likely).unionByName(embedded(likely, forms))
