"""Cross-tokenizer alignment by interval coalescing, and how often two tokens are linked in a corpus.

The tokens of both tokenizers are intervals of bytes. Sorted by start, with the running maximum of their ends, they fall
into groups: one begins wherever a start reaches that maximum, which is where both tokenizers end a token.
Inside a group the overlaps are expanded.

Neither tokenizer lets a token cross the place before a single space between two words, so a text is cut there into
chunks, and equal chunks of a block of documents are encoded and aligned once. What a block of documents sends on is
one row per different pair; the counts of its pairs come back to it, and each document adds up those of its own chunks.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from riskloom.sources.store import materialise

#: Characters of text in a block, and chunks that are encoded and aligned at once.
BLOCK, SLICE = 8 << 20, 1 << 13
#: A single space between two characters that are no white space, and two such characters in a row.
CUT, PAIR = re.compile(r"(?<=\S) (?=\S)"), re.compile(r"\s\s")


class Tokenizers:
    """Two tokenizers, with the bytes of every id: ``a`` is byte-level, of the file format of `tokenizers`; ``b`` is a sentencepiece model."""

    def __init__(self, a: str, b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        plain = byte_alphabet()
        size = self.a.get_vocab_size(with_added_tokens=True)
        entries = [self.a.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(plain[c] for c in e) if all(c in plain for c in e) else e.encode() for e in entries]
        self.bytes_b = [self._piece(i) for i in range(self.b.vocab_size())]
        # Chunks are right only where no token can cross a cut; with other tokenizers a text is one chunk.
        inner = any(re.search(r"[^ ] ", x.decode("utf-8", "replace")) for x in self.bytes_b)
        self.cuts = self.a.normalizer is None and isinstance(self.a.pre_tokenizer, ByteLevel) and not inner
        ids = range(max(len(self.bytes_a), len(self.bytes_b)))
        self.written = np.array([[f"{i}{mark}" for i in ids] for mark in ("", ";", "|", ",")], dtype=object)
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def chunks(self, text: str) -> list[str]:
        """The chunks of the text; each stands for a space and itself."""
        if not self.cuts:
            return [text]
        # Without white space in a row or at an end, every space is a cut.
        simple = not (text[0].isspace() or text[-1].isspace() or PAIR.search(text))
        return text.split(" ") if simple else CUT.split(text)

    def encode(self, chunks: list[str]) -> tuple[list[int], list[int]] | None:
        """Ids of both tokenizers for chunks with a space before each, None if their bytes are not those of the chunks."""
        text = " ".join(chunks)
        a = self.a.encode_batch_fast([f" {text}"], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        raw = f" {text}".encode("utf-8", "replace")
        same = b"".join([self.bytes_a[i] for i in a]) == raw and b"".join([self.bytes_b[i] for i in b]) == raw
        return (a, b) if same else None


@functools.cache
def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 is itself, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + n): b for n, b in enumerate(other)}


@functools.cache
def tokenizers(a: str, b: str) -> Tokenizers:
    """Loaded once per Python worker."""
    return Tokenizers(a, b)


@dataclass(frozen=True)
class Aligned:
    """Tokens of chunks laid one after the other, and what follows from them, by chunk.

    ``ok``: whether both tokenizers give the chunk's bytes; a chunk that is not has no tokens. ``n_a``, ``n_b``, ``n_groups``, ``n_links``: counts.
    ``codes``: every link as id of A times ``width`` plus id of B, chunk by chunk. ``groups``: the ids of the chunk's groups.
    """

    ok: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    codes: np.ndarray
    groups: list[str]


def coalesce(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and every B token: groups break where a start reaches the running maximum of the ends before it."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((end, start))
    highest = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= highest[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[: len(start_a)], group[len(start_a) :]


def overlaps(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (A, B) of all tokens that share a byte; the tokens of each side are in order and apart."""
    first = np.searchsorted(end_b, start_a, "right")
    count = np.searchsorted(start_b, end_a, "left") - first
    at = np.repeat(np.arange(len(start_a)), count)
    inside = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    return at, first[at] + inside


def _encoded(t: Tokenizers, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of A and B of all chunks in order, and whether each chunk is whole in both; a chunk that is not has no ids."""
    ok = np.ones(len(chunks), bool)
    ids: tuple[list[int], list[int]] = ([], [])
    # Chunks with white space at an end, which are first or last in a text, have other tokens when something is joined to them.
    alone = [i for i, c in enumerate(chunks) if not t.cuts or c[0].isspace() or c[-1].isspace()]
    edges = sorted({0, len(chunks), *alone, *(i + 1 for i in alone)})
    waiting = list(zip(edges, edges[1:]))[::-1]
    while waiting:
        begin, end = waiting.pop()
        found = t.encode(chunks[begin:end])
        if found is not None:
            ids[0].extend(found[0])
            ids[1].extend(found[1])
        elif end - begin == 1:
            ok[begin] = False
        else:  # one of them is not whole: find it by halves
            middle = (begin + end) // 2
            waiting += [(middle, end), (begin, middle)]
    return np.array(ids[0], np.int64), np.array(ids[1], np.int64), ok


def align(t: Tokenizers, chunks: list[str]) -> Aligned:
    """All chunks, slice by slice."""
    parts = [_aligned(t, chunks[i : i + SLICE]) for i in range(0, len(chunks), SLICE)] or [_aligned(t, [])]
    numbers = [np.concatenate([getattr(p, c) for p in parts]) for c in ("ok", "n_a", "n_b", "n_groups", "n_links", "codes")]
    return Aligned(*numbers, [g for p in parts for g in p.groups])


def _aligned(t: Tokenizers, chunks: list[str]) -> Aligned:
    """The bytes of all chunks, each after a space, are one line, on which no group crosses from one chunk to the next."""
    a, b, ok = _encoded(t, chunks)
    size = (np.fromiter(map(len, map(str.encode, chunks, itertools.repeat("utf-8"), itertools.repeat("replace"))), np.int64) + 1) * ok
    stop = np.cumsum(size)
    end_a, end_b = np.cumsum(t.length_a[a]), np.cumsum(t.length_b[b])
    start_a, start_b = end_a - t.length_a[a], end_b - t.length_b[b]
    group_a, group_b = coalesce(start_a, end_a, start_b, end_b)
    x, y = overlaps(start_a, end_a, start_b, end_b)
    of_a, of_b = np.searchsorted(stop, start_a, "right"), np.searchsorted(stop, start_b, "right")
    count = functools.partial(np.bincount, minlength=len(chunks))
    first = np.concatenate([[True], group_a[1:] != group_a[:-1]]) if len(a) else np.zeros(0, bool)
    return Aligned(
        ok, count(of_a), count(of_b), count(of_a[first]), count(of_a[x]), a[x] * len(t.bytes_b) + b[y],
        _written(t.written, a, group_a, of_a, b, group_b, of_b, len(chunks)),
    )


def _written(table: np.ndarray, a: np.ndarray, group_a: np.ndarray, of_a: np.ndarray, b: np.ndarray, group_b: np.ndarray, of_b: np.ndarray, chunks: int) -> list[str]:
    """Per chunk its groups as ``a1,a2|b1;a3|b2,b3``."""
    ids, group, of = np.concatenate([a, b]), np.concatenate([group_a, group_b]), np.concatenate([of_a, of_b])
    side = np.repeat([0, 1], [len(a), len(b)])
    order = np.lexsort((side, group))  # stable: tokens stay in order
    group, side, of = group[order], side[order], of[order]
    new_group, new_side = np.diff(group, append=-1) != 0, np.diff(side, append=-1) != 0
    last = np.diff(of, append=-1) != 0
    mark = np.where(last, 0, np.where(new_group, 1, np.where(new_side, 2, 3)))
    tokens = table[mark, ids[order]].tolist()
    ends = np.searchsorted(of, np.arange(chunks), "right").tolist()
    begins = [0, *ends[:-1]]
    return ["".join(tokens[s:e]) for s, e in zip(begins, ends)]


# Blocks of documents


def _block_rows(t: Tokenizers, name: int, keys: list, texts: list[np.ndarray], chunks: list[str]) -> pd.DataFrame:
    """One row per document of a block, and first one of the block itself: its different pairs, their links, and the pairs of every chunk."""
    got = align(t, chunks)
    whole = [bool(len(w)) and bool(got.ok[w].all()) for w in texts]
    codes, position = np.unique(got.codes, return_inverse=True)
    counted = [w for w, ok in zip(texts, whole) if ok]
    times = np.bincount(np.concatenate(counted) if counted else texts[0][:0], minlength=len(chunks))
    # Sums of whole numbers far below 2**53, exact in doubles.
    links = np.bincount(position, weights=np.repeat(times, got.n_links), minlength=len(codes)).astype(np.int64)
    used = links > 0
    rows = {
        "codes": [codes[used]], "links": [links[used]], "pairs": [position.astype(np.int32).tobytes()], "sizes": [got.n_links.astype(np.int32).tobytes()],
        "used": [np.packbits(used).tobytes()], "words": [None], "key": [None], "groups_sha256": [None],
        **{c: [0] for c in ("n_a", "n_b", "n_groups", "n_links")},
    }
    for key, w, ok in zip(keys, texts, whole):
        w = w if ok else w[:0]
        for c in ("codes", "links", "pairs", "sizes", "used"):
            rows[c].append(None)
        rows["key"].append(key)
        rows["words"].append(w.tobytes())
        rows["groups_sha256"].append(hashlib.sha256(";".join([got.groups[i] for i in w]).encode()).hexdigest() if ok else "")
        for c in ("n_a", "n_b", "n_groups", "n_links"):
            rows[c].append(int(getattr(got, c)[w].sum()))
    return pd.DataFrame(rows).assign(block=name)


def _numbering() -> defaultdict[str, int]:
    """Numbers for what is looked up, 0, 1, 2 and so on in the order of first look-ups."""
    index: defaultdict[str, int] = defaultdict()
    index.default_factory = index.__len__
    return index


def _blocks(a: str, b: str, block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizers(a, b)
        part, at = TaskContext.get().partitionId(), 0
        keys, texts, size, index = [], [], 0, _numbering()
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                texts.append(np.fromiter(map(index.__getitem__, t.chunks(text)), np.int32) if text else np.zeros(0, np.int32))
                keys.append(key)
                size += len(text or "")
                if size >= block:
                    yield _block_rows(t, (part << 24) + at, keys, texts, list(index))
                    index.clear()  # it holds itself by its factory
                    keys, texts, size, index, at = [], [], 0, _numbering(), at + 1
        if keys:
            yield _block_rows(t, (part << 24) + at, keys, texts, list(index))

    return run


def _added_up(schema: StructType):
    """Documents of a block with the sums over their links, from the block's rows and the counts of its pairs."""
    names = schema.fieldNames()

    def run(rows: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        head = rows[rows["pairs"].notna()].iloc[0]
        docs = rows[rows["pairs"].isna()]
        sizes = np.frombuffer(head["sizes"], np.int32)
        position = np.frombuffer(head["pairs"], np.int32)
        used = np.flatnonzero(np.unpackbits(np.frombuffer(head["used"], np.uint8)))
        counts = counts.sort_values("code")
        values = np.zeros((2, int(position.max(initial=-1)) + 1), np.int64)
        values[:, used] = counts["count"].to_numpy(), counts["best"].to_numpy()
        ends = np.cumsum(sizes)
        sums = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(values[:, position], axis=1)], axis=1)
        of_chunk = sums[:, ends] - sums[:, ends - sizes]
        words = [np.frombuffer(w, np.int32) for w in docs["words"]]
        docs = docs.assign(count_sum=[int(of_chunk[0, w].sum()) for w in words], n_best=[int(of_chunk[1, w].sum()) for w in words])
        return docs[names]

    return run


def align_corpus(df: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Per document ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``; and the pairs (a, b, count, best).

    ``a`` is a byte-level tokenizer file and ``b`` a sentencepiece model, on a path that the executors have; special tokens are not added, and
    their strings in a text are plain text. A pair's ``count`` is the number of links that hold it in the corpus; ``best`` is
    1 if no other pair of the same B id has more. ``n_best`` and ``count_sum`` add these up over the links of a document.

    A text is encoded with a space before it. Null and empty texts, and texts whose joined token bytes
    differ from it (as with U+2581), have no tokens: zeros, and an empty digest. Null and repeated keys are documents like others; other
    columns are ignored. Texts of any length are one document of one block. An empty frame gives empty results.
    """
    kind = df.schema[key].dataType
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    fields = ", ".join(f"{c} long" for c in counts)
    out = StructType([StructField("key", kind), *StructType.fromDDL(f"block long, {fields}, groups_sha256 string, words binary, codes array<long>, links array<long>, pairs binary, sizes binary, used binary")])
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    names = out.fieldNames()
    run = _blocks(a, b, block)
    stored = materialise(narrow.mapInPandas(lambda batches: (rows[names] for rows in run(batches)), out), "aligned")

    held = stored.where("codes is not null").select("block", F.inline(F.arrays_zip("codes", "links"))).select("block", F.col("codes").alias("code"), "links")
    total = held.groupBy("code").agg(F.sum("links").alias("count"))
    width = tokenizers(a, b).b.vocab_size()
    total = total.withColumn("b", (F.col("code") % width).cast("int"))
    # At most as many rows as A has ids share one B id.
    most = F.max("count").over(Window.partitionBy("b"))
    pairs = materialise(total.withColumn("best", (F.col("count") == most).cast("int")), "aligned_pairs")
    known = held.select(F.col("block").alias("known"), "code").join(pairs.select("code", "count", "best"), "code")

    done = StructType([StructField("key", kind), *StructType.fromDDL(f"{fields}, n_best long, count_sum long, groups_sha256 string")])
    documents = stored.groupBy("block").cogroup(known.groupBy("known")).applyInPandas(_added_up(done), done)
    table = pairs.select(F.expr(f"cast(code div {width} as int)").alias("a"), "b", "count", "best")
    return documents.withColumnRenamed("key", key), table
