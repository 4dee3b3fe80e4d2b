"""Alignment against both libraries on whole texts and a comparison of every token with every other."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from support import ODD, documents, given_documents, prose, sf_dir  # noqa: F401
from test_tokens import MODEL
from tokenizers import Tokenizer

from refinery.llm import alignment, queries

BYTES = Tokenizer.from_str(MODEL)
BYTES.encode_special_tokens = True
with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
    PIECE_MODEL = file.read()
PIECES = sentencepiece.SentencePieceProcessor(model_proto=PIECE_MODEL)
OF = alignment.byte_of_character()


def spans(tokens):
    found, at = [], 0
    for token in tokens:
        found.append((at, at + len(token)))
        at += len(token)
    return found


def tokens_of(text):
    """Ids and byte strings of both sides; none if they don't give the text."""
    if not text:
        return [], [], [], []
    a = BYTES.encode(" " + text, add_special_tokens=False).ids
    b = PIECES.encode(text)
    names = [PIECES.id_to_piece(i) for i in b]
    bytes_a = [bytes(OF[c] for c in BYTES.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(n[3:-1], 16)]) if PIECES.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names, strict=True)]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return [], [], [], []
    return a, b, spans(bytes_a), spans(bytes_b)


def plain(rows):
    """(doc_id, text) -> all columns of the operator."""
    links, part = [], []
    for doc_id, text in rows:
        a, b, spans_a, spans_b = tokens_of(text)
        j, mine = 0, []
        for i, (start, end) in enumerate(spans_a):
            while j and spans_b[j - 1][1] > start:
                j -= 1
            while j < len(b) and spans_b[j][0] < end:
                if spans_b[j][1] > start:
                    mine.append((a[i], b[j]))
                j += 1
        ends = sorted({end for _, end in spans_a} & {end for _, end in spans_b})
        groups, low = [], 0
        for end in ends:
            sides = [
                ",".join(str(i) for i, (s, e) in zip(ids, where, strict=True) if low <= s and e <= end) for ids, where in ((a, spans_a), (b, spans_b))
            ]
            groups.append("|".join(sides))
            low = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        part.append((doc_id, len(a), len(b), len(ends), len(mine), digest))
        links.append(mine)
    counts = Counter(pair for mine in links for pair in mine)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(*row, sum(counts[p] == most[p[1]] for p in mine), sum(counts[p] for p in mine)) for row, mine in zip(part, links, strict=True)]


ROWS = [
    *[row for row in ODD if row[0] not in (6, 7)], (6, "word " * 300, "en", "b"), (7, "x" * 500, "de", "b"),
    (8, "a <|endoftext|> and <s> or </s><0x41> in the text", "en", "a"), (9, "the ▁ mark", "en", "a"), (10, " ", "en", "a"),
    (11, "\n", "en", "a"), (12, "two  spaces \n and  \n\n ends ", "en", "a"), (13, "\ttab and　wide", "en", "a"),
    *[(100 + i, prose(i % 30, 4 * i) + "é日😀 l'été!" * (i % 3), "en", "c") for i in range(60)],
]


def test_odd_texts(spark):
    docs = documents(spark, ROWS).repartition(3)
    found = alignment.aligned(docs, MODEL, public_tokenizers.PATTERN, PIECE_MODEL, block_bytes=3_000)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, plain([row[:2] for row in ROWS])))
    assert alignment.aligned(docs.limit(0), MODEL, public_tokenizers.PATTERN, PIECE_MODEL).collect() == []


SIDES = alignment._sides(MODEL, public_tokenizers.PATTERN, PIECE_MODEL)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t ▁a'sé1!<日\x00>0x4"), max_size=30), max_size=4))
def test_ids_and_groups_are_those_of_whole_texts(texts):
    block = alignment.Block(texts, *SIDES)
    n_groups, sums = block.groups()
    rows = plain(list(enumerate(texts)))
    wanted = [tokens_of(text)[:2] for text in texts]
    for place, (a, b) in enumerate(wanted):
        assert block.lists[0][place].as_py() == a and block.lists[1][place].as_py() == b
    assert [(n, s) for n, s in zip(n_groups.tolist(), sums, strict=True)] == [(row[3], row[5]) for row in rows]
    assert np.bincount(block.links()[0], minlength=len(texts)).tolist() == [row[4] for row in rows]


def test_the_query(spark, sf_dir, given_documents):
    found = queries.op11_alignment(spark, sf_dir).collect()
    wanted = plain([(row.doc_id, row.text) for row in given_documents.collect()])
    assert sorted(map(tuple, found)) == sorted(wanted)
