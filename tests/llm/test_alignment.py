"""Cross-tokenizer alignment against the tokenizers on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cubeshelf.llm import alignment
from cubeshelf.llm.queries import ALIGNED
from tests.llm.helpers import ROWS, docs

FILES = [public_tokenizers.path(x) for x in ALIGNED]


@pytest.fixture(scope="module")
def whole():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=FILES[1])
    size = {i: len(t) for t, i in a.get_vocab().items()}
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def encode(text):
        """(A ids, B ids, groups, links) of a whole text, by sets of end offsets."""
        if not text:
            return [], [], "", []
        x, y, raw = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
        if b"".join(map(piece, y)) != raw or sum(size[i] for i in x) != len(raw):
            return [], [], "", []
        end_x, end_y = np.cumsum([size[i] for i in x]).tolist(), np.cumsum([len(piece(i)) for i in y]).tolist()
        both = sorted({*end_x} & {*end_y})
        links = [(i, j) for i, at in zip(x, end_x) if at in both for j, other in zip(y, end_y) if other == at] if len(x) < 400 else \
            [(x[end_x.index(e)], y[end_y.index(e)]) for e in both]
        groups, lo = [], 0
        for e in both:
            groups.append(",".join(str(i) for i, at in zip(x, end_x) if lo < at <= e) + "|" + ",".join(str(i) for i, at in zip(y, end_y) if lo < at <= e))
            lo = e
        return x, y, ";".join(groups), links

    return encode


def slow(rows, encode):
    found = [(i, *encode(t)) for i, t in rows]
    count = Counter(p for *_, links in found for p in links)
    best = Counter()
    for (a, b), n in count.items():
        best[b] = max(best[b], n)
    for i, x, y, groups, links in found:
        yield (i, len(x), len(y), groups.count(";") + 1 if groups else 0, len(links), sum(count[p] == best[p[1]] for p in links),
               sum(count[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if x else "")


HARD = ["two  spaces", " leading", "trailing ", "tab\tand\nnew\r\nlines \n x", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b is lost", "ﬁne Ångström é",
        "nbsp\xa0x  y　z", "日本語 テキスト", "😀 emoji 👩‍👩‍👧", "\x1c sep\x1c \x85 x", "don't we'll I'm 's", "\x00 nul \x00x", "﻿bom", "x" * 3000, "    ", "\n", " ", ".", "▁"]


def rows_of(got):
    return sorted(map(repr, map(tuple, got.collect())))


@pytest.mark.parametrize("chunk_links,radixes", [(1 << 20, 4), (40, 256)])
def test_alignment(spark, whole, chunk_links, radixes):
    rows = [(i, t) for i, t, _ in ROWS if len(t or "") < 10_000] + [(100 + i, t) for i, t in enumerate(HARD * 2)]
    df = docs(spark, [(i, t, None) for i, t in rows])
    got = alignment.align(df, *FILES, chunk_links=chunk_links, radixes=radixes)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(got) == sorted(map(repr, slow(rows, whole)))
    assert alignment.align(df.limit(0), *FILES).collect() == []


def test_long_text_and_random_strings(spark, whole):
    pick = random.Random(3)
    letters = ["a", "the", " ", "  ", "\n", "\t", "é", "ß", "'s", "1", "23", ".", "▁", "日", "\xa0", "\x1c", " ", "<s>", "T", "ing", "😀", "-", "\x00"]
    rows = [(i, "".join(pick.choices(letters, weights=[9, 9, 20] + [1] * (len(letters) - 3), k=pick.randrange(1, 40)))) for i in range(1500)]
    rows.append((5000, "lorem ipsum dolor sit amet, " * 700))
    got = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), *FILES, chunk_links=500, radixes=16)
    assert rows_of(got) == sorted(map(repr, slow(rows, whole)))


def test_ranks_give_the_ids_of_the_tokenizer(whole):
    aligner = alignment.Aligner(*(open(f, "rb").read() for f in FILES))
    assert aligner.fast is not None
    pick = random.Random(4)
    letters = list("aeinrst  '\n.,1") + ["the", "'ll", " \t", "é", "日", "\x1c", "\x85", "\u2028", "\u0301", "ß", "😀", "²", "\u200b", "<|endoftext|>"]
    texts = ["".join(pick.choices(letters, k=pick.randrange(1, 60))) for _ in range(20_000)] + HARD
    same = [e.ids for e in aligner.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert [aligner._a_ids(" " + t) for t in texts] == same
    long = "x" * 150_000 + " " * 150_000 + "y"
    assert aligner._a_ids(long) == aligner.a.encode(long, add_special_tokens=False).ids
