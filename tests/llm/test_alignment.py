"""Alignment against whole-text encoding and plain loops over byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from riskloom.llm import alignment
from tokenizers import Tokenizer

A, B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
NASTY = [
    "", None, " ", "  two  spaces ", " lead", "trail ", "\n", "a\nb\n\n c\t d \r\n", "tab\t x", "a b   c", "x  y z", "it's I'll we 've ' s",
    "<|endoftext|> and </s> <s> <unk> here", "<0x41> <0x0A>", "has ▁ inside", "▁", "a b ▁ c", "né é ́x", "你好 世界 我们 在 这里", "😀 😀😀 a😀",
    "\x00 zero \x00", "\x1c a \x1c b \x1f", "\x85 next \x85 line", "w" * 3000, " ".join(["same"] * 500), "1234567890 12 345,678.90", "ﬁ ligature Å Å",
    "​ zero width ​ x", "﻿ bom", "word line   par", "a  b   c    d", "...   !!! ??", "᠎ mongolian ᠎",
]


def alphabet():
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, n = {}, 0
    for b in range(256):
        if b in keep:
            out[chr(b)] = b
        else:
            out[chr(256 + n)] = b
            n += 1
    return out


@pytest.fixture(scope="module")
def plain():
    a, b, chars = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), alphabet()
    a.encode_special_tokens = True

    def encode(text):
        """Ids and byte ends of both sides; nothing where the bytes differ."""
        if not text:
            return [], [], [], []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        xb = [bytes(chars[c] for c in a.id_to_token(i)) for i in x]
        yb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not b"".join(xb) == b"".join(yb) == (" " + text).encode():
            return [], [], [], []
        return x, y, np.cumsum([len(z) for z in xb]).tolist(), np.cumsum([len(z) for z in yb]).tolist()

    return encode


def brute(plain, texts):
    links, rows = [], []
    for text in texts:
        x, y, ex, ey = plain(text)
        found, groups, i, j = [], [], 0, 0
        cuts = sorted(set(ex) & set(ey))
        for cut in cuts:
            g = [], []
            while i < len(x) and ex[i] <= cut:
                g[0].append(i)
                i += 1
            while j < len(y) and ey[j] <= cut:
                g[1].append(j)
                j += 1
            groups.append("|".join(",".join(str(ids[k]) for k in side) for ids, side in zip((x, y), g)))
            for p in g[0]:
                for q in g[1]:
                    if max(ex[p - 1] if p else 0, ey[q - 1] if q else 0) < min(ex[p], ey[q]):
                        found.append((x[p], y[q]))
        links.append(found)
        rows.append((len(x), len(y), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    count = Counter(p for found in links for p in found)
    top = defaultdict(int)
    for (_, q), n in count.items():
        top[q] = max(top[q], n)
    out = [(a, b, g, len(f), sum(count[p] == top[p[1]] for p in f), sum(count[p] for p in f), sha) for f, (a, b, g, sha) in zip(links, rows)]
    return out, {(p, q, n, int(n == top[q])) for (p, q), n in count.items()}


def check(docs, plain, texts, block=alignment.BLOCK, partitions=3):
    found, pairs = alignment.align_corpus(docs(list(enumerate(texts)), partitions=partitions), A, B, block=block)
    got = {r[0]: tuple(r)[1:] for r in found.collect()}
    want, counts = brute(plain, texts)
    for i, t in enumerate(texts):
        assert got[i] == want[i], t and t[:80]
    assert len(got) == len(texts) and {tuple(r) for r in pairs.collect()} == counts


def test_awkward_texts(docs, plain):
    check(docs, plain, NASTY)
    assert brute(plain, ["has ▁ inside"])[0] == [(0, 0, 0, 0, 0, 0, "")]


def test_random_texts_in_small_blocks(docs, plain):
    rng = random.Random(1)
    parts = ["the ", "word", " ", "  ", "\n", "é", "ß", " ", "'s", "123", "don't ", "▁", "你", "😀", "\t", ".", ", ", "<s>", "ing ", "A", "\x1c", "́", "x y "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(250)]
    check(docs, plain, texts, block=500, partitions=4)


def test_the_given_documents(spark, docs, plain, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    check(docs, plain, texts, block=50_000)


def test_null_and_repeated_keys_empty_tables_and_other_columns(docs):
    df = docs([(None, "a b", 1), (5, "a b", 2), (5, "a b", 3), (None, None, 4)], "doc_id long, text string, block int").withColumnRenamed("block", "codes")
    found, pairs = alignment.align_corpus(df, A, B)
    assert Counter(r.doc_id for r in found.collect()) == {None: 2, 5: 2}
    assert {r.n_links for r in found.collect()} == {0, 2} and {r["count"] for r in pairs.collect()} == {3}
    found, pairs = alignment.align_corpus(docs([]), A, B)
    assert found.collect() == [] and pairs.collect() == []
    found, _ = alignment.align_corpus(docs([(1, "")]).selectExpr("cast(doc_id as string) as doc_id", "text"), A, B)
    assert [tuple(r) for r in found.collect()] == [("1", 0, 0, 0, 0, 0, 0, "")]


def test_a_very_long_text(docs, plain):
    rng = random.Random(2)
    spaced = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(60_000))
    check(docs, plain, [spaced, "z" * 200_000, "short"], block=1000)


def test_groups_break_where_both_sides_end():
    start_a, end_a = np.array([0, 2, 5]), np.array([2, 5, 9])
    start_b, end_b = np.array([0, 3, 5, 7]), np.array([3, 5, 7, 9])
    a, b = alignment.coalesce(start_a, end_a, start_b, end_b)
    assert a.tolist() == [0, 0, 1] and b.tolist() == [0, 0, 1, 1]
    x, y = alignment.overlaps(start_a, end_a, start_b, end_b)
    assert list(zip(x.tolist(), y.tolist())) == [(0, 0), (1, 0), (1, 1), (2, 2), (2, 3)]


def test_byte_alphabet():
    assert alignment.byte_alphabet() == alphabet()
