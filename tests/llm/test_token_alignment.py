"""Token alignment against a plain walk over public tokenisers."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cohortlens.llm import token_alignment as T
from cohortlens.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain():
    """(ids, end bytes) of both tokenisers, or None, straight from the public libraries."""
    first = Tokenizer.from_file(f"{T.TOKENIZERS}/byte_bpe_50k.json")
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=f"{T.TOKENIZERS}/piece_bpe_32k.model")
    letters = T.byte_letters()

    def encode(text):
        if not text:
            return None
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        names = [second.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names)]
        whole = (" " + text).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return None
        return a, np.cumsum([len(x) for x in bytes_a]).tolist(), b, np.cumsum([len(x) for x in bytes_b]).tolist()

    return encode


def brute(encode, texts):
    rows, links_of, docs = [], [], Counter()
    for text in texts:
        got = encode(text)
        if got is None:
            rows.append([0] * 4 + [""])
            links_of.append([])
            continue
        a, ends_a, b, ends_b = got
        links = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b)
                 if max(ends_a[i - 1] if i else 0, ends_b[j - 1] if j else 0) < min(ends_a[i], ends_b[j])] if len(a) < 400 else None
        if links is None:  # the same by a merge of the ends
            cuts = sorted({*ends_a, *ends_b})
            links = [(a[i], b[j]) for i, j in zip(np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts))]
        groups, i, j = [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            i, j = k, m
        rows.append([len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()])
        links_of.append(links)
        docs.update(set(links))
    top = {}
    for (x, _), n in docs.items():
        top[x] = max(top.get(x, 0), n)
    return [(*r[:4], sum(docs[p] == top[p[0]] for p in links), sum(docs[p] for p in links), r[4]) for r, links in zip(rows, links_of)]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["", " ", "  lead and trail  ", "▁odd mark", "<s> </s> <unk> <|endoftext|> <0x41>", "é\n\t日本 \U0001f600 naïve", "a\x00b", "x" * 70_000, " " * 5000 + "x",
       "you'll we've  two   blanks\n\n\nlines", "１２３ ﬁ ligature", "日本語" * 300, "﻿mark", "tie", "tie"]


@pytest.mark.parametrize("head", [T.HEAD, 2000, 0])
def test_query_is_brute_force(spark, sf, plain, head):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    rows = docs.collect()
    got = QUERIES["op11_token_alignment"](spark, sf) if head == T.HEAD else T.align(docs, head=head)
    want = brute(plain, [r.text for r in rows])
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got.collect()} == {r.doc_id: w for r, w in zip(rows, want)}


def test_odd_texts(spark, plain):
    texts = [*ODD, None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    want = brute(plain, texts)
    assert [tuple(r[c] for c in COLUMNS) for r in T.align(frame).orderBy("doc_id").collect()] == want
    assert want[3][0] == 0  # its mark reads as a space in the second tokeniser


def test_edges(edges, nothing, plain):
    got = T.align(edges)
    assert got.columns == ["doc_id", *COLUMNS]
    rows = got.collect()
    source = edges.collect()
    want = Counter((r.doc_id, *w) for r, w in zip(source, brute(plain, [r.text for r in source])))
    assert Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in rows) == want
    assert T.align(nothing).collect() == []


def test_equal_hashes_are_told_apart(monkeypatch, plain):
    """Windows that fall together by hash are compared id by id."""
    pair = T.tokeniser_pair(T.TOKENIZERS, "byte_bpe_50k.json", "piece_bpe_32k.model")
    monkeypatch.setattr(T, "mix", lambda x: np.zeros_like(x))
    texts = ["one two three two", "three one one uno", "tokenisation two"]
    found = T.Windows(pair).align([pair.encode(t) for t in texts])
    assert [(g, links.size, d) for g, links, d in found] == [(w[2], w[3], w[6]) for w in brute(plain, texts)]


def test_memory_is_given_back(plain):
    pair = T.tokeniser_pair(T.TOKENIZERS, "byte_bpe_50k.json", "piece_bpe_32k.model")
    windows = T.Windows(pair, most=3)
    texts = ["one two three", "four five six seven", "one two three"]
    found = [windows.align([pair.encode(t)])[0] for t in texts]
    assert [(g, d) for g, _, d in found] == [(w[2], w[6]) for w in brute(plain, texts)]
    assert len(windows.known) <= 7
