"""Every query of the training-data operators against its plain version on the small tables."""

import os
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def result(spark):
    held = {}

    def get(prefix):
        if prefix not in held:
            name = next(n for n in E.queries() if n.startswith(prefix))
            held[prefix] = E.queries()[name](spark, SF).collect()
        return held[prefix]
    return get


def rows(table, *columns):
    return duckdb.sql(f"SELECT {', '.join(columns)} FROM '{SF}/{table}.parquet'").fetchall()


def test_op1_links_and_components(result):
    want = brute.near_vectors(rows("embeddings", "vec_id", "embedding"))
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in result("op1_")} == want


def test_op2_articles(result):
    want = {i: (u, brute.article(h)) for i, u, h in rows("pages", "page_id", "url", "html")}
    assert {r.page_id: (r.url, r.text) for r in result("op2_")} == want
    assert all(r.n_chars == len(r.text) for r in result("op2_"))


def test_op3_archives(result):
    assert {r.page_id: tuple(r[1:5]) for r in result("op3_")} == brute.warc(rows("pages", "page_id", "html"))


def test_op4_pieces_hold_every_token_once(result):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
           for i, t in rows("documents", "doc_id", "text")}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in result("op4_"):
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces, total in ((sorted(by_doc[i]), len(v)) for i, v in ids.items()):
        assert [s for s, _ in pieces] == list(np.cumsum([0, *(n for _, n in pieces)][:-1]))
        assert sum(n for _, n in pieces) == total
    for pieces in map(sorted, by_sequence.values()):
        size = sum(n for _, n in pieces)
        assert [o for o, _ in pieces] == list(np.cumsum([0, *(n for _, n in pieces)][:-1]))
        assert size <= 1024 and size & size - 1 == 0  # powers of two: nothing is padded


def test_op5_rows_and_fold(result):
    got = {r.doc_id: r for r in result("op5_")}
    assert set(got) == {i for i, in rows("documents", "doc_id")}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_op6_components(result):
    want = brute.near_duplicates(rows("documents", "doc_id", "text"), 2)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in result("op6_")} == want


def test_op7_counts(result):
    import public_tokenizers as P
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    texts = dict(rows("documents", "doc_id", "text"))
    for r in result("op7_"):
        text = texts[r.doc_id] or ""
        n = len(sp.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)
        if r.over_limit:
            assert len(sp.encode(text[:r.limit_chars])) <= 4096 < len(sp.encode(text[:r.limit_chars + 1]))
        else:
            assert r.limit_chars == len(text)


def test_op8_contained_items(result):
    want = brute.contamination(rows("documents", "doc_id", "text"), rows("benchmark", "item_id", "text"))
    got = {(r.doc_id, r.item_id, r.item_shingles, r.common_shingles) for r in result("op8_")}
    assert got == want and want


def test_op9_counts_and_base(result):
    want = brute.unigram(rows("documents", "doc_id", "text"))
    got = {r.doc_id: r for r in result("op9_")}
    assert set(got) == set(want)
    for i, (held, n, known, total, base) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) <= 1e-9 * abs(base)
    assert all(r.score < 0 for r in got.values())


def test_op10_read_back(result):
    said = "<|im_end|><|im_start|>assistant ok"
    want = brute.chats(rows("conversations", "conv_id", "turn", "role", "text")
                       + [(-1, 0, "user", said), (-1, 1, "assistant", said)])
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in result("op10_")} == want
