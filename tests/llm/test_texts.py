"""Conversation repair, spelling variants and line dedup: the queries against plain versions, and edge cases."""

import os
import random

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from daymart.llm import line_dedup, permuterm, queries, turn_repair
from tests.llm import brute_texts as brute

SF = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def rows(table, *columns):
    return duckdb.sql(f"SELECT {', '.join(columns)} FROM '{SF}/{table}.parquet'").fetchall()


@data
def test_op11_equals_all_scripts(spark):
    got = E.queries()["op11_conversation_repair"](spark, SF).collect()
    assert {r.conv_id: tuple(r[1:]) for r in got} == brute.repairs(rows("conversations", "conv_id", "turn", "role", "text"))


@data
def test_op12_equals_all_edits(spark):
    got = E.queries()["op12_spelling_variants"](spark, SF).collect()
    want = brute.variants(rows("documents", "doc_id", "text"))
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == want and len(got) == len(want)


@data
def test_op13_equals_plain_lines(spark):
    got = E.queries()["op13_line_dedup"](spark, SF).collect()
    want = brute.lines(rows("documents", "doc_id", "text"))
    assert sorted(tuple(r) for r in got) == sorted(want) and any(r.n_dropped for r in got)


# ------------------------------------------------------------- conversations --
TALKS = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hi!"), (1, 2, "assistant", "Hi!"),
         (1, 4, "user", None), (1, 9, None, "what"), (2, None, "user", "No turn."), (2, None, "assistant", "None here."),
         (2, 3, "tool", "x = 1"), (3, 0, "", "No role."), (4, 5, "assistant", "cut of"), (None, 0, "user", "A."),
         (None, 0, "assistant", "B."), (None, None, None, None), (5, 0, "user", " \n "), (6, -3, "ua", "two letters.")]


def talks(spark, found):
    return spark.createDataFrame(found, "conv_id long, turn long, role string, text string") \
        .selectExpr("conv_id", "turn", "role", "text", "1 as symbols", "'x' as part", "3 as edit", "4 as total")


def test_repair_edges(spark):
    queries.settle(spark)
    got = turn_repair.report(talks(spark, TALKS)).collect()
    assert {r.conv_id: tuple(r[1:]) for r in got} == brute.repairs(TALKS) and len(got) == 7
    assert turn_repair.report(talks(spark, TALKS).where("false")).count() == 0


def test_a_long_conversation_lies_in_many_chunks(spark, monkeypatch):
    """Chunks of few rows, several partitions, a third of the rows without an id and many equal rows."""
    queries.settle(spark)
    monkeypatch.setattr(turn_repair, "COPIES", 3)
    rnd = random.Random(3)
    found = [(None if k % 3 == 0 else k % 7, rnd.randint(0, 40), rnd.choice(["user", "assistant", "system", "tool"]),
              rnd.choice(["Yes.", "No!", "cut", "", "one more", "Good?"])) for k in range(240)]
    found += [(8, 1, "user", "Again.")] * 50
    rows_ = turn_repair.damage(talks(spark, found))
    edits, totals = turn_repair.repair(rows_.repartition(6))
    chunks = edits.select("part", "chunk").distinct().count()
    plain = spark_free_costs(found)
    assert {r.conv_id: r.cost for r in totals.collect()} == plain and chunks > 8
    got = turn_repair.report(talks(spark, found)).collect()
    again = {r.conv_id: r.audit for r in got}
    assert {c: cost_of(found, c, again[c]) for c in plain} == plain


def spark_free_costs(found):
    """Least costs by a step for each row over the four states."""
    out = {}
    for conv, symbols in symbols_of(found).items():
        after = turn_repair.END
        for s in reversed(symbols):
            after = turn_repair._before(after, s)
        out[conv] = after[0]
    return out


def symbols_of(found):
    import re
    import zlib
    from collections import defaultdict

    own = defaultdict(list)
    for conv, turn, role, text in found:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        own[conv] += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = {}
    for conv, rows_ in own.items():
        seen, out[conv] = set(), []
        for _, role, text in sorted(rows_):
            out[conv].append(turn_repair.symbol_of(role, text, (role, text) not in seen)[0])
            seen.add((role, text))
    return out


def cost_of(found, conv, audit):
    """The cost of a script, which must be legal."""
    symbols, state, cost = iter(symbols_of(found)[conv]), 0, 0
    for letter in audit:
        s = next(symbols) if letter != "I" else None
        cost += {"D": 2, "I": 5, "K": 0, "R": 1}[letter] + (5 * (s & 1) if letter in "KR" else 0)
        if letter == "K":
            assert s != turn_repair.GONE
            state = turn_repair.KEEP[state][s >> 1]
        elif letter != "D":
            assert s != turn_repair.GONE
            state = turn_repair.ADD[state]
    assert state in (0, 3) and next(symbols, None) is None
    return cost


def test_chunks_give_what_the_whole_gives():
    rnd = random.Random(5)
    t = turn_repair.tables()
    for _ in range(300):
        symbols = [rnd.choice([0, 2, 2, 4, 4, 8, 1, 3, 5, 6, 7]) for _ in range(rnd.randint(1, 7))]
        want = brute.cheapest([("sua?"[s >> 1] if s < 8 else "u", s < 8 and s & 1, s == 8) for s in symbols])
        cut = rnd.randint(0, len(symbols))
        pieces = [np.array(p, np.int64) for p in (symbols[:cut], symbols[cut:]) if p]
        vector, cost, behind = 0, 0, []
        for left, costs, _ in map(turn_repair.summary, reversed(pieces)):
            behind.append(vector)
            cost, vector = cost + int(costs[vector]), int(left[vector])
        state, letters = 0, ""
        for k, (piece, v) in enumerate(zip(pieces, reversed(behind))):
            steps, (tail, after) = turn_repair.trace(piece, v, state, k == len(pieces) - 1)
            assert turn_repair.summary(piece)[2][v, state] == after
            letters, state = letters + "".join(x for x, _ in steps) + tail, after
        assert (cost + t.vectors[vector][0], letters) == want


# --------------------------------------------------------------------- words --
def documents(spark, found):
    return spark.createDataFrame(found, "doc_id long, text string") \
        .selectExpr("doc_id", "text", "1 as word", "'x' as n", "2 as key", "3 as version", "4 as drops", "5 as lines")


WORDS = [(1, "Elephant elephant ELEPHANT " * 20), (2, "elephants elephants elephxnt elephxnt eelephant eelephant"),
         (3, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaab aaaaaab"), (4, None), (5, ""), (None, "elephan elephan"),
         (6, "écoutés écoutés écoutês écoutês ×÷×÷×÷× ×÷×÷×÷×"), (6, "écoutés écoutés écoutês écoutês ×÷×÷×÷× ×÷×÷×÷×"),
         (7, "short words go"), (8, "İstanbul ǅabcdefg abcdefg abcdefg"), (9, "wordword " * 30_000)]


def test_variant_edges(spark):
    queries.settle(spark)
    got = permuterm.group_variants(documents(spark, WORDS)).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == brute.variants(WORDS)
    assert permuterm.group_variants(documents(spark, WORDS).where("false")).count() == 0
    assert permuterm.group_variants(documents(spark, WORDS).where("doc_id in (4, 5, 7)")).count() == 0


def test_runs_reach_over_batches(spark):
    import itertools

    words = ["".join(w) + "qqqqq" for w in itertools.product("abc", repeat=4)]
    found = [(k, " ".join(w for j, w in enumerate(words) for _ in range(2 + (j * k) % 50))) for k in range(3)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = permuterm.group_variants(documents(spark, found)).collect()
    finally:
        queries.settle(spark)
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == brute.variants(found)


# --------------------------------------------------------------------- lines --
LICENCE = "This line is held by many documents and long enough."
LINES = [*[(k, f"own line {k}\n {LICENCE}\t\nend") for k in range(6)], (5, f"{LICENCE.upper()}\n{LICENCE}"), (6, None),
         (7, ""), (8, "\n\n"), (9, "short\nshort"), *[(k, "short\n" * 3) for k in range(10, 16)], (16, "x" * 200_000),
         (17, "é" * 39), (18, "é" * 39), (19, "é" * 40), (19, "é" * 40)]


def test_line_edges(spark):
    queries.settle(spark)
    got = line_dedup.dedup_lines(documents(spark, LINES)).selectExpr("doc_id", "n_lines", "n_dropped", "sha2(text, 256)")
    assert sorted(map(tuple, got.collect())) == sorted(brute.lines(LINES))
    assert line_dedup.dedup_lines(documents(spark, LINES).where("false")).count() == 0


def test_documents_without_an_id_come_before_all_others(spark):
    queries.settle(spark)
    found = [(None, f"{LICENCE}\n{k}") for k in range(6)] + [(None, f"{LICENCE}\n0")]
    got = line_dedup.dedup_lines(documents(spark, found)).collect()
    assert sorted({r.n_dropped for r in got}) == [0, 1] and sum(r.n_dropped == 0 for r in got) in (1, 2)
    got = line_dedup.dedup_lines(documents(spark, [*found, (1, LICENCE)])).collect()
    assert [r.doc_id for r in got if not r.n_dropped] == [1]


def test_a_filter_that_is_too_small_loses_nothing(spark):
    queries.settle(spark)
    found = [(k, "\n".join(f"line {j} of the documents that end in {k % 50} and no others" for j in range(30))) for k in range(400)]
    got = line_dedup.dedup_lines(documents(spark, found).repartition(7), filter_bytes=1)
    got = got.selectExpr("doc_id", "n_lines", "n_dropped", "sha2(text, 256)")
    assert sorted(map(tuple, got.collect())) == sorted(brute.lines(found))


def test_filters_hold_what_two_tasks_saw_once():
    keys = line_dedup.key_hashes(f"key {k}" for k in range(5000))
    f = line_dedup.Filter(4)
    f.add(f.places(keys))
    assert f.holds(f.places(keys)).all()
    other = line_dedup.key_hashes(f"other {k}" for k in range(5000))
    assert f.holds(f.places(other)).mean() < 0.05
    for page in f.bits.reshape(4, -1):
        assert (line_dedup.unpacked(line_dedup.packed(page)) == page).all()
