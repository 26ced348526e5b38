"""Tokens, vectors, pages and addresses against plain Python, and the cases the docstrings define."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordloom.llm import chunks, neighbours, pieces, tag_paths, token_files, url_trust
from recordloom.llm.queries import BYTES, END, PIECES, RULES

TEXTS = [
    "Plain words, and more words.\nA second line",
    "",
    None,
    "  two  spaces \n\n and   three ",
    "tab\tand\r\nreturn\x1c odd\u00a0space\u2003x",
    "日本語 テキスト 😀😀 naïve café don't we'll I'M",
    "<|endoftext|> </s> \u2581 under",
    "a <|endoftext|> b<|endoftext|>\n c <|endoftext|",
    "word<|endoftext|>word",
    "word " * 3000,
    "x" * 5000,
    "1234567 $$$ ### %%% a1b2",
]


# ------------------------------------------------------------------ token files


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(BYTES))


def test_tokens_equal_the_library(tokenizer):
    with open(public_tokenizers.path(BYTES), encoding="utf-8") as f:
        tokens = token_files.Tokens(f.read())
    rng = random.Random(2)
    mixed = ["".join(rng.choice(["a", "Bc", " ", "\n", "'s", "é", "7", "!", "\t", "漢", "\u00a0"]) for _ in range(60)) for _ in range(300)]
    texts = [*TEXTS, *mixed]
    ids, size = tokens.encode(pa.array(texts, pa.string()))
    ends = np.append(0, np.cumsum(size))
    for text, a, b in zip(texts, ends[:-1], ends[1:], strict=True):
        assert ids[a:b].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_cuts_equal_the_library(tokenizer):
    with open(public_tokenizers.path(BYTES), encoding="utf-8") as f:
        tokens = token_files.Tokens(f.read())
    rng = random.Random(3)
    alphabet = ["a", "Bc", "re", " ", " ", "\n", "'", "'s", "é", "ß", "×", "÷", "É", "ÿ", "\u0301", "ª", "12", "²", "!", ",_", "\x00", "漢", "—", "x" * 17]
    for _ in range(40):
        some = rng.sample(alphabet, rng.randint(3, len(alphabet)))
        texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 50))) for _ in range(100)]
        ids, size = tokens.encode(pa.array(texts, pa.string()))
        ends = np.append(0, np.cumsum(size))
        for text, a, b in zip(texts, ends[:-1], ends[1:], strict=True):
            assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_learned_once_whatever_stands_beside_them():
    with open(public_tokenizers.path(BYTES), encoding="utf-8") as f:
        tokens = token_files.Tokens(f.read())
    words = ["cosas", "señalé", "tion", "Größe"]
    beside = ["", ",", ".", "###", "$$$", "7", "\n", "\n\n"]
    tokens.encode(pa.array([" ".join(["", *(w + b for w in words)]) + " end" for b in beside], pa.string()))
    # the words and " end", and what stands beside them
    assert tokens.known.n <= len(words) + 1 + len(beside)


def test_stretches_of_few_bytes_are_told_apart():
    stretches = [b"\0" * n for n in range(1, 40)] + [b"a" * n for n in range(1, 40)] + [b"a" * n + b"\0" for n in range(1, 40)] + [b"\xff" * n for n in range(1, 40)]
    raw = np.frombuffer(b"".join(stretches), np.uint8)
    ends = np.cumsum([len(s) for s in stretches])
    starts = ends - [len(s) for s in stretches]
    seen = []
    known = chunks.Remembered(lambda new: (seen.extend(new), (np.arange(len(new), dtype=np.int32), np.ones(len(new), np.int64)))[1], 1000)
    ids, _ = known.encode(raw, starts, ends)
    assert sorted(seen) == sorted(stretches) and [seen[i] for i in ids] == stretches
    assert known.encode(raw, starts, ends)[0].tolist() == ids.tolist() and len(seen) == len(stretches)


def test_token_files(spark, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 700)
    rows = [(i * 37 % 1009, TEXTS[i % len(TEXTS)]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = str(tmp_path / "files")
    token_files.write_tokens(docs, path, public_tokenizers.path(BYTES), end_id=END)
    blocks = spark.read.parquet(f"{path}/blocks").orderBy("part", "first").collect()
    assert [i for b in blocks for i in b.doc_ids] == sorted(i for i, _ in rows)
    assert all(b.checkpoints[0] == 0 and len(b.checkpoints) == -(-sum(b.lengths) // token_files.EVERY) for b in blocks)
    ids_of = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [END] for i, t in rows}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read_tokens(spark, path).collect()}
    assert got == ids_of
    start, expected = 0, {}
    for i in sorted(ids_of):
        data = np.array(ids_of[i], "<u4").tobytes()
        expected[i] = (start, len(ids_of[i]), zlib.crc32(data))
        start += len(ids_of[i])
    digests = token_files.tokenised(docs, public_tokenizers.path(BYTES), end_id=END, result={"crc": F.crc32("ids")}).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.crc) for r in digests} == expected


def test_code_of_the_counts_of_all_tasks(spark, tokenizer, tmp_path):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    token_files.write_tokens(docs, str(tmp_path), public_tokenizers.path(BYTES), end_id=END)
    counts = np.bincount([i for _, t in rows for i in [*tokenizer.encode(t or "", add_special_tokens=False).ids, END]])
    used = np.flatnonzero(counts)
    code = spark.read.parquet(f"{tmp_path}/code").collect()
    assert sorted((r.symbol, r.bits) for r in code) == list(zip(used.tolist(), token_files.code_lengths(counts)[used].tolist(), strict=True))


def test_token_files_of_odd_rows(spark):
    rows = [(None, "a"), (None, None), (1, "same"), (1, "same"), (1, "other")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, START string")
    got = token_files.tokenised(docs, public_tokenizers.path(BYTES), end_id=END).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 1, 1]
    assert [r.start for r in got] == np.append(0, np.cumsum([r.n_tokens for r in got]))[:-1].tolist()
    assert token_files.tokenised(docs.where("false"), public_tokenizers.path(BYTES), end_id=END).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**40), min_size=1, max_size=60), st.integers(6, 12))
def test_code_lengths(counts, limit):
    counts = np.array(counts)
    lengths = token_files.code_lengths(counts, limit)
    used = counts > 0
    assert (lengths[~used] == 0).all() and (lengths[used] >= 1).all() and lengths.max(initial=0) <= limit
    if used.sum() > 1:
        assert sum(2.0 ** -float(n) for n in lengths[used]) == 1
        assert (counts * lengths).sum() <= (counts * best_lengths(counts)).sum() or best_lengths(counts).max() > limit


def best_lengths(counts):
    """Huffman without a limit."""
    import heapq

    heap = [(int(c), i, (i,)) for i, c in enumerate(counts) if c]
    lengths = np.zeros(len(counts), np.int64)
    heapq.heapify(heap)
    while len(heap) > 1:
        (a, _, x), (b, k, y) = heapq.heappop(heap), heapq.heappop(heap)
        lengths[list(x + y)] += 1
        heapq.heappush(heap, (a + b, k, x + y))
    return lengths


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=2000))
def test_packing(ids):
    ids = np.array(ids)
    code = token_files.Code(token_files.code_lengths(np.bincount(ids) ** 3))
    payload, checkpoints = code.pack(ids)
    assert code.unpack(payload, checkpoints, len(ids)).tolist() == ids.tolist()


# ------------------------------------------------------------------ SentencePiece


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces.load(public_tokenizers.path(PIECES))


def unigram(model):
    """SentencePiece's own unigram encoder over the same pieces and scores."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path(PIECES), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    scores = dict(zip(model.ids.tolist(), model.scores.tolist(), strict=True))
    for i, piece in enumerate(proto.pieces):
        piece.score = scores.get(i, piece.score)
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_segmentation_equals_the_library(model):
    library = unigram(model)
    score = dict(zip(model.ids.tolist(), model.scores.tolist(), strict=True))
    texts = [t for t in TEXTS if t and "\u2581" not in t and len(t) < 4000]
    words = sorted({w for t in texts for w in t.split()} | {"internationalisation", "reeuxqueétre", "ßstxxq", "aaaaaaa"})
    ids, ends = pieces.Encoder(model).encode(pa.array([*texts, *words]))
    for text, a, b in zip([*texts, *words], ends[:-1], ends[1:], strict=True):
        got, want = ids[a:b].tolist(), library.encode(text)
        total = [sum(score.get(i, -20.0) for i in x) for x in (got, want)]  # sums may tie
        assert got == want or (len(got) == len(want) and abs(total[0] - total[1]) < 1e-3 * abs(total[1]))
        assert library.decode(got) == text


def brute(model, word):
    """Best score of a word over all segmentations into pieces."""
    import functools

    table = {}
    for key, s in zip(model.keys.tolist(), model.scores.tolist(), strict=True):
        table[key] = s
    cells = model._matrix([word])

    @functools.cache
    def best(end):
        if end == 0:
            return 0.0
        found = []
        for n in range(1, min(model.longest, end) + 1):
            key = int(model._keys(cells[:, end - n : end], n)[0, 0])
            if key in table or n == 1:
                found.append(best(end - n) + table.get(key, float(model.unknown)))
        return max(found)

    return best(len(word))


def test_segmentation_is_the_best(model):
    score = dict(zip(model.ids.tolist(), model.scores.tolist(), strict=True))
    for word in [" reeuxque", " international", "   spaced", " a", " qqqqxyz"]:
        ids, count = model.search([word])
        assert count.tolist() == [len(ids)] and sum(score[i] for i in ids.tolist()) == pytest.approx(brute(model, word), rel=1e-5)


def test_encoding_and_decoding(spark, model):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, IDS string").repartition(3)
    ids = pieces.encode(docs, model)
    assert ids.columns == ["doc_id", "text", "ids"]
    back = pieces.decode(ids, model).collect()
    assert len(back) == len(TEXTS) and all(r.decoded == r.text for r in back)
    assert {r.doc_id for r in back if r.ids is None} == {2}
    assert pieces.encode(docs.where("false"), model, keep=["doc_id"]).count() == 0
    strange = spark.createDataFrame([([3 + 0xFF, 10**6, None, -5],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in pieces.decode(strange, model).collect()][1:] == [None, ""]


# ------------------------------------------------------------------ neighbours


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "GROUP", 2)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(400, 24)).astype(np.float32)
    vectors[100:130] = vectors[50]  # ties
    vectors[200:220] = vectors[0] + rng.normal(size=(20, 24)).astype(np.float32) * 1e-4  # closer than int8 tells apart
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1050, [0.0] * 24), (1100, [float("nan")] * 24), (1150, [None] * 24), (1200, [1.0, 2.0]), (None, [1.0] * 24), (1250, []), (7, rows[7][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).repartition(3)
    got = neighbours.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    v = vectors.astype(np.float64)
    expected = []
    for q in range(0, 400, 50):
        norms = np.sqrt((v**2).sum(axis=1))
        score = (v * v[q]).sum(axis=1) / (norms * norms[q])
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-round(score[i], 12), i))[:5]
        expected += [(q, k + 1, i, pytest.approx(score[i], abs=1e-12)) for k, i in enumerate(order)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == expected


def test_few_neighbours(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    asked = F.col("vec_id") % 50 == 0
    assert [(r.rank, r.vec_id) for r in neighbours.nearest(frame, asked).collect()] == [(1, 1)]
    assert neighbours.nearest(frame.where("vec_id = 1"), asked).count() == 0
    assert neighbours.nearest(frame.where("false"), asked).count() == 0


# ------------------------------------------------------------------ addresses


def plain_rule(host, path):
    found = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(found, key=lambda r: len(r.name), default=None)


def test_rules(spark):
    urls = [
        "http://a.com/x", "https://EXAMPLE.com/en/1?q#f", "http://www.example.com/en/2", "http://m.www.example.com/en/", "http://b.net/es/a", "http://net/fr/",
        "http://b.net/en/", "http://com", "http://xcom/", "//a.com/", "a", "", None, "x://a.net?/es/", "x://é.NET/es/ü#?", "http://a.com:80/", "http://a://b.com/y",
    ]
    pages = spark.createDataFrame([(i, u, None, "r") for i, u in enumerate(urls)], "page_id long, url string, html string, Rule string")
    rows = url_trust.judge(pages, RULES)
    assert rows.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict"]
    for r in rows.collect():
        rest = (r.url or "").split("://", 1)[1] if "://" in (r.url or "") else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None)
        if rule:
            assert r.verdict == rule.verdict
    assert url_trust.judge(pages.where("false"), RULES).count() == 0


def test_trust_spreads_along_links_and_distrust_against_them(spark):
    def page(host, *links, path="/"):
        return (f"http://{host}{path}", "".join(f'<a class="x" href="http://{x}/y">l</a>' for x in links))

    pages = [
        page("good.com", "friend.org", "neutral.org"),
        page("bad.net", path="/es/"),
        page("spammer.org", "bad.net", "helper.org"),
        page("helper.org", "//spammer.org".strip("/")),
        page("friend.org", "friend2.org"),
        page("friend2.org"),
        page("neutral.org", "good.com"),
        page("alone.org"),
    ]
    frame = spark.createDataFrame(pages, "url string, html string").repartition(3)
    got = {r.host: r.verdict for r in url_trust.judge(frame, RULES).collect()}
    assert got == {
        "good.com": "allow", "bad.net": "block", "spammer.org": "block", "helper.org": "block",
        "friend.org": "allow", "friend2.org": "allow", "neutral.org": "allow", "alone.org": "allow",
    }


def test_page_rank(spark):
    links = [("a", "b", 3), ("a", "c", 1), ("b", "c", 1), ("c", "a", 2)]
    edges = url_trust._shares(spark.createDataFrame(links, "source string, target string, weight long"), "source", "target")
    seeds = spark.createDataFrame([("a", 1.0)], "host string, seed double")
    got = {r.host: r["rank"] for r in url_trust.page_rank(edges, seeds, steps=30, follow=0.85).collect()}
    rank = {"a": 1.0, "b": 0.0, "c": 0.0}
    for _ in range(30):
        rank = {"a": 0.15 + 0.85 * rank["c"], "b": 0.85 * 0.75 * rank["a"], "c": 0.85 * (0.25 * rank["a"] + rank["b"])}
    assert got == pytest.approx(rank)


def test_distrust_reaches_far(spark):
    """A chain of links that ends at a blocked host: all of it is blocked, who is linked from it is not."""
    link = lambda host: f'<a href="https://{host}/x">x</a>'
    rows = [(0, "https://bad.org/", "")] + [(i, f"https://h{i}.org/", link("bad.org" if i == 1 else f"h{i - 1}.org")) for i in range(1, 15)]
    rows += [(20, "https://good.org/", ""), (21, None, link("bad.org"))]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = url_trust.judge(pages, [url_trust.Rule("block", "bad.org"), url_trust.Rule("allow", "good.org")], keep=["page_id"])
    assert {r.page_id: r.verdict for r in got.collect()} == {i: "block" for i in range(15)} | {20: "allow", 21: "allow"}


# ------------------------------------------------------------------ pages

BODY = "<p>First paragraph, with some <b>bold</b> words; and more.</p><p>Second one &mdash; it\n goes  on, and on.</p>"
CLEAN = "First paragraph, with some bold words; and more.\n\nSecond one — it goes on, and on."


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("just &lt;text&gt; &#233;&#x20AC; &Eacute;", "just <text> é€ É"),
        (f"<body><nav><a>Home</a></nav><article><h1>Title</h1>{BODY}</article><footer>&copy; us</footer>", f"Title\n\n{CLEAN}"),
        (f"<div id=menu><li>a<li>b</div><div class='post'><h1>Title</h1>{BODY}</div><div class='comments'><p>Nice, I agree, very much so.</p></div>", f"Title\n\n{CLEAN}"),
        (f"<main>{BODY}<form>Name <input></form><aside>More</aside><div class=cookie-notice>OK?</div></main>", CLEAN),
        (f"<article>{BODY}<script>var t='</p><p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --></article>", CLEAN),
        (f"<article>{BODY}<!-- never closed <p>no</p>", CLEAN),
        (f"<article>{BODY}<script>never closed", CLEAN),
        (f"<article>{BODY}</article><foo", CLEAN),
        ("<article><p>One<br>two<p>three<ul><li>x<li>y</ul></article>", "One two\n\nthree\n\nx\n\ny"),
        ("<nav>only a menu</nav>", ""),
        (f"<body class='with-sidebar'><div class='content sidebar-left'>{BODY}</div><div class=sidebar>a b c</div></body>", CLEAN),
        (f'<article><p title="a > b">A > b.</p>{BODY}</article>', f"A > b.\n\n{CLEAN}"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\n\nb\n\nc"),
        ("<article>x<noscript>no</noscript> y <svg><text>no</text></svg>z</article>", "x y z"),
    ],
)
def test_main_text(html, text):
    assert tag_paths.main_text(html) == text


def test_ratios_choose_content_paths():
    nodes = tag_paths.text_nodes("<div>" + "<span>a</span>" * 12 + "</div><div>" + BODY * 3 + "</div>")
    chosen = tag_paths.content(nodes)
    paragraphs = [c for n, c in zip(nodes, chosen, strict=True) if "p" in n.path.split("/")]
    assert all(paragraphs) and not any(chosen[:9])  # smoothing reaches three nodes far


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", f"<article>{BODY}</article>", "x"), (2, None, None, "x"), (2, None, None, "x")], "page_id long, url string, html string, N_Chars string")
    got = tag_paths.extract(pages, keep=["page_id", "url"])
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id, r.text, r.n_chars) for r in got.collect()) == [(1, CLEAN, len(CLEAN)), (2, "", 0), (2, "", 0)]
    assert tag_paths.extract(pages.where("false")).count() == 0
