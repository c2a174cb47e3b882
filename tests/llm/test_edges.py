"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables for every operator."""

import io

import numpy as np
import pytest

from daymart.llm import (chat, decontaminate, html_extract, minhash_join, packing, ppm, queries, token_counts,
                         toxicity, vector_join, warc)
from tests.llm import brute

LONG = "lorem ipsum " * 20_000
TEXTS = [(0, None), (1, ""), (2, "a"), (3, "one two three four five six seven eight"),
         (4, "one two three four five six seven eight"), (None, "without an id"), (5, LONG), (5, LONG), (6, " \n\t "),
         (7, "One two THREE four five six seven eight nine"), (8, "日本 🙂 \x00 text")]
CLASH = "text as hashes, text as block, 1 as posting, 2 as set_id, 'x' as score, 3 as n, 'y' as component"


@pytest.fixture(scope="module")
def docs(spark):
    queries.settle(spark)
    return spark.createDataFrame(TEXTS, "doc_id long, text string") \
        .selectExpr("doc_id", "text", "'en' as lang", *CLASH.split(", "))


def empty(df):
    return df.where("false")


def test_token_counts(docs):
    model = queries.tokenizer("piece_bpe_32k.model")
    got = token_counts.count_tokens(docs, model).collect()
    assert len(got) == len(TEXTS) and {r.doc_id: r.n_tokens for r in got}[0] == 0
    assert token_counts.count_tokens(empty(docs), model).count() == 0


def test_prefix_counts_equal_the_library():
    import sentencepiece

    path = queries.tokenizer("piece_bpe_32k.model")
    sp, c = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.counter(path)
    for text in ["a  b\nc the  ", " x", "日本 🙂\t<s>▁z", "internationalisation 12.5"]:
        assert c.prefix_counts(text) == [len(sp.encode(text[:i])) for i in range(len(text) + 1)]


def test_packing(docs):
    vocabulary = queries.tokenizer("byte_bpe_50k.json")
    got = packing.pack(docs, vocabulary).collect()
    assert sorted(r.length for r in got if r.doc_id in (0, 1)) == [1, 1]
    assert sum(r.length for r in got if r.doc_id == 5) == 2 * next(r.doc_tokens for r in got if r.doc_id == 5)
    assert packing.pack(empty(docs), vocabulary).count() == 0


def test_hilbert_steps_are_one():
    cells = np.array(np.meshgrid(*[range(8)] * 3, indexing="ij")).reshape(3, -1).T
    at = packing.hilbert_index(cells, 3)
    assert sorted(at) == list(range(512))
    assert set(np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(1)) == {1}


def test_near_duplicates(docs):
    got = {r.doc_id: r for r in minhash_join.near_duplicates(docs, words=2).collect()}
    assert got[4].component_id == 3 == got[3].component_id and got[3].kept and not got[4].kept
    assert got[0].kept and got[0].n_shingles == 0 and got[1].kept and got[2].n_shingles == 1
    assert got[7].component_id == 3  # 7 of 8 shingles
    assert minhash_join.near_duplicates(empty(docs)).count() == 0


def test_chained_near_copies_are_one_component(spark):
    words = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(words[:i] + [f"x{i}"] + words[i + 1:])) for i in range(40)] + [(99, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(df, words=2).collect()}
    assert got == brute.near_duplicates(rows, 2)


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, None), (3, ""), (4, "a"),
                                   (None, "without an id"), (5, "never seen words in any of these texts")],
                                  "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as hash")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(3, 1), (4, 1), (7, 1), (2, 4), (None, None)}
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {0, 1, 5, 6, 8}
    assert decontaminate.contaminated(empty(docs), items).count() == 0
    assert decontaminate.clean(docs, empty(items)).count() == len(TEXTS)


def test_scores(docs):
    got = ppm.score(docs).collect()
    assert len(got) == len(TEXTS) and all(r.score < 0 for r in got)
    assert ppm.score(empty(docs)).count() == 0


def test_trie_sums_to_one():
    raw = np.frombuffer(ppm.stream([b"abra", b"cadabra", b"abra"]), np.uint8)
    gram, n = np.unique(ppm.grams(raw), return_counts=True)
    levels = []
    for order in range(ppm.ORDER, -1, -1):
        key, at = np.unique(gram & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
        levels.append((key >> 8, key & 255, np.bincount(at, weights=n).astype(int)))
    trie = ppm.Trie(levels[::-1])
    assert np.allclose((10.0 ** trie.cost[:, trie.column]).sum(1), 1, atol=1e-4)


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(0, 1)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels) is None
    assert toxicity.score(docs, None).count() == len(TEXTS)
    rows = [(i, f"plain words of row {i} " + ("awful" if i % 2 else "fine"), "en") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = toxicity.train(df, spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int"))
    got = toxicity.score(df, model).collect()
    assert sum((r.toxic_score >= 0.7) == bool(r.doc_id % 2) for r in got) >= 195
    assert toxicity.score(docs, model).count() == len(TEXTS)


def test_vectors(spark):
    rows = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [1.0, 2.0]),
            (6, [2.0, 4.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0, 0.0]), (9, [-1.0, 2.0]), (10, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as rep", "2 as cell")
    got = {r.vec_id: tuple(r[1:]) for r in vector_join.near_vectors(df).collect()}
    assert got == brute.near_vectors(rows)
    assert vector_join.near_vectors(empty(df)).count() == 0


def test_pages(spark):
    rows = [(0, None, None), (1, "u", ""), (2, "u r\nl", "<p>a &amp; b<p>c"), (2, "x", "<p>same id"), (None, "v", "<div"),
            (3, "v", "<div>" * 3000 + "deep"), (4, "v", "<script>x</script>" + "<p>" + "long, text. " * 9000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as digest")
    got = html_extract.extract(df).collect()
    assert len(got) == len(rows) and {r.page_id: r.text for r in got}[3] == "deep"
    assert html_extract.extract(empty(df)).count() == 0
    back = warc.read(warc.write(df)).collect()
    assert sorted((str(r.page_id), str(r.url), r.html) for r in back) == sorted(
        (str(p), str(u), h or "") for p, u, h in rows)
    assert warc.read(warc.write(empty(df))).count() == 0


def test_archive_faults():
    out = io.BytesIO()
    warc.write_archive(out, iter([warc.record(1, "u", b"x" * 2000, "0" * 40, None, 0)]))
    with pytest.raises(warc.BadArchive):
        [warc.parse(raw) for raw in warc.frames(io.BytesIO(out.getvalue()))]  # the digest is wrong
    with pytest.raises(warc.BadArchive):
        list(warc.frames(io.BytesIO(out.getvalue()[:-3])))
    with pytest.raises(warc.BadArchive):
        list(warc.frames(io.BytesIO(b"PK" + out.getvalue())))


def test_chats(spark):
    rows = [(0, 0, "user", "hi\\ <|x"), (0, 1, "assistant", None), (1, 0, "user", "hi\\ <|x"), (1, 1, None, "<|im_end|>"),
            (2, 0, "assistant", LONG), (2, 1, "assistant", "b\\"), (3, None, "a\nb<|im_start|>", ""), (4, 0, "user", "hi\\ <|x"),
            (4, 1, "assistant", None), (5, 0, "user", "twice"), (5, 0, "user", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .selectExpr("*", "1 as path", "2 as node")
    nodes, members = chat.format_chats(df, queries.tokenizer("byte_bpe_50k.json"))
    got = members.join(chat.read_back(nodes, queries.tokenizer("byte_bpe_50k.json")), "path").collect()
    rows = [(c, -1 if t is None else t, r, x) for c, t, r, x in rows]
    want = brute.chats(rows)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    assert nodes.count() == 8  # shared turns once
    assert chat.conversations(empty(df)).count() == 0
