"""Alignment of two tokenizers against brute force, and the cases the docstring defines."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordloom.llm import alignment
from recordloom.llm.queries import BYTES, PIECES, op13_alignment

SMALL = "/root/testdata/sf0.001"
FILES = public_tokenizers.path(BYTES), public_tokenizers.path(PIECES)
TEXTS = [
    "Plain words, and more words.\nA second line",
    "",
    None,
    "  two  spaces \n\n and   three ",
    "tab\tand\r\nreturn\x1c odd space x\x00y",
    "日本語 テキスト 😀😀 naïve café don't we'll I'M",
    "<|endoftext|> </s> under<s>",
    "a ▁ b",
    "▁",
    " ",
    "word " * 500,
    "x" * 3000,
    "1234567 $$$ ### %%% a1b2",
]


class Plain:
    """The contract, text by text."""

    def __init__(self):
        self.a = Tokenizer.from_file(FILES[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
        self.bytes = alignment.byte_values()

    def groups(self, text):
        """Lists of A ids and B ids."""
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        spell_a = [bytes(self.bytes[c] for c in self.a.id_to_token(i)) for i in a]
        spell_b = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
            return []
        ends = [np.cumsum([len(s) for s in spell]).tolist() for spell in (spell_a, spell_b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        out, i, j = [], 0, 0
        for cut in cuts:
            k, m = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            out.append((a[i:k], b[j:m]))
            i, j = k, m
        return out

    def rows(self, docs):
        found = [self.groups(t) for _, t in docs]
        links = [Counter((x, y) for a, b in g for x in a for y in b) for g in found]
        count = Counter(p for one in links for p in one)
        best = {}
        for (x, _), n in count.items():
            best[x] = max(best.get(x, 0), n)
        for (i, _), g, one in zip(docs, found, links, strict=True):
            yield (
                i,
                sum(len(a) for a, _ in g),
                sum(len(b) for _, b in g),
                len(g),
                sum(one.values()),
                sum(n for p, n in one.items() if count[p] == best[p[0]]),
                sum(n * count[p] for p, n in one.items()),
                ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g),
            )


def by_row(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("hot, piece, many", [(1 << 18, 1 << 20, 64), (40, 300, 3), (1, 1, 0)])
def test_documents_equal_plain_python(spark, monkeypatch, hot, piece, many):
    monkeypatch.setattr(alignment, "HOT", hot)
    monkeypatch.setattr(alignment, "SLICE", piece)
    monkeypatch.setattr(alignment, "MANY", many)
    rng = random.Random(hot)
    mixed = ["".join(rng.choice(["a", "Bc", " ", "\n", "'s", "é", "7", "!", "\t", "漢", "ing"]) for _ in range(40)) for _ in range(40)]
    docs = list(enumerate([*TEXTS, *mixed, *TEXTS]))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = alignment.align(frame, *FILES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert by_row(got.collect()) == by_row(Plain().rows(docs))


def test_registered_query(spark):
    import hashlib

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    wanted = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in Plain().rows(docs)]
    assert by_row(op13_alignment(spark, SMALL).collect()) == by_row(wanted)


def test_odd_rows(spark):
    docs = [(None, "same text"), (1, "same text"), (1, "same text"), (1, None), (None, "")]
    frame = spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, N_A int, row string")
    assert by_row(alignment.align(frame, *FILES).collect()) == by_row(Plain().rows(docs))
    assert alignment.align(frame.where("false"), *FILES).collect() == []
    assert [tuple(r)[:5] for r in alignment.align(frame.where("text = ''"), *FILES).collect()] == [(None, 0, 0, 0, 0)]


def test_long_text_without_spaces(spark):
    rng = random.Random(5)
    docs = [(1, "".join(rng.choice("abcdefghijklmnop0123456789+/") for _ in range(60_000))), (2, "ab" * 30_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert by_row(alignment.align(frame, *FILES).collect()) == by_row(Plain().rows(docs))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), st.randoms(use_true_random=False))
def test_groups_by_jumping(sizes, rng):
    end_a = np.cumsum(sizes)
    inner = [e for e in range(1, int(end_a[-1])) if rng.random() < 0.4]
    end_b = np.array([*inner, int(end_a[-1])])
    a, b = alignment.grouped(end_a, end_b)
    cuts = sorted(set(end_a.tolist()) & set(end_b.tolist()))
    assert a.tolist() == np.searchsorted(cuts, end_a).tolist() and b.tolist() == np.searchsorted(cuts, end_b).tolist()


def test_pieces_equal_the_library():
    with open(FILES[1], "rb") as f:
        pieces = alignment.Pieces(f.read())
    assert pieces.apart
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "Bc", " ", "  ", "\n", "é", "7", "!", "\t", "漢", "the"]) for _ in range(60)) for _ in range(300)]
    ids, size = pieces.encode(pa.array([" " + t for t in texts]))
    ends = np.append(0, np.cumsum(size))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == pieces.model.encode(texts)


def test_whole_groups_of_many_links():
    """A group of all tokens: its pairs are counted by distinct ids."""
    a, b = np.arange(2000) % 7, np.arange(1500) % 5
    spell = np.array([3] * 7), np.array([4] * 5)
    aligned = alignment.Aligned(a, b, np.array([2000]), np.array([1500]), *spell)
    got = {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for _, pairs, times in aligned.pairs() for p, n in zip(pairs, times, strict=True)}
    cuts = np.arange(12, 6001, 12)
    wanted = Counter()
    for k in range(len(cuts)):
        wanted.update((int(x), int(y)) for x in a[4 * k : 4 * k + 4] for y in b[3 * k : 3 * k + 3])
    assert got == wanted


def test_clashing_names(spark):
    docs = spark.createDataFrame([("t", 1)], "ROW string, pairs int").select(F.col("ROW").alias("Text"), F.lit(3).alias("doc_id"), "pairs")
    assert [r.n_groups for r in alignment.align(docs, *FILES, text_column="Text").collect()] == [1]
