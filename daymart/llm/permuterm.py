"""Spelling variants: words one code point apart, found over sorted rotations, grouped under the common form.

Method. A permuterm index. ``$`` marks the end of a word, and every rotation ``b$a`` of a word ``ab`` is a key:

* Two words that differ by one replaced code point, ``axb`` and ``ayb``, have rotations ``b$ax`` and ``b$ay``: both
  start with ``b$a``, and only the edited code point follows. Words with an additional code point, ``axb`` against
  ``ab``, meet there too, as ``b$a`` is a whole rotation of ``ab``.
* So a word posts its rotations whole, and each of its rotations without the last code point, with that code point
  beside it. Sorted by key, a prefix range is a run of rows with one key: at most one whole word, and at most as many
  others as there are code points to put in the gap (90 here). That bounds every group, whatever the data.
* A run is scanned once. It gives each member its number of neighbours there and the neighbour of largest count: the
  best or, for the best itself, the second best. No pair is written. A pair is met in one run only: of a row of equal
  code points only the first is taken as the inserted one.

Counting combines documents in the task (a bounded table of words), then before the shuffle. Word counts are the only
rows of one word, so a frequent word is one row a task. Roots: forms are followed by doubling; a form's count is at
least ``ratio`` times the word's, so there are few rounds. Each round is a table in the shared folder.

Defined results. Null or empty text: no words. A null id enters the damage rule as an empty string. Rows equal in id and
text count once each. Ties of a form: the smallest word in code-point order. Extra columns, whatever their names, are
not read. An empty table, or one without words, gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.common import materialize

RUN = "A-Za-zÀ-ÿ"
TABLE = 200_000  # words that a task counts before it sends them on
COUNT = pa.schema([("word", pa.string()), ("n", pa.int64())])
MET = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def text_words(doc_id, text: str | None, shortest: int, every: int) -> Counter:
    """The words of one document with counts, after the damage rule: where ``every`` divides the run's checksum, the
    code point that the checksum names is deleted."""
    found: Counter = Counter()
    low = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    name = "" if doc_id is None else doc_id
    for run, n in Counter(re.findall(f"[{RUN}]{{{shortest},}}", low)).items():
        h = zlib.crc32(f"{name}:{run}".encode())
        if every and h % every == 0:
            run = run[:h % len(run)] + run[h % len(run) + 1:]
        if len(run) >= shortest:
            found[run] += n
    return found


def word_counts(docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n) of words of at least ``shortest`` code points with at least ``least`` occurrences."""
    def run(batches):
        held: Counter = Counter()

        def sent():
            words = list(held)
            for at in range(0, len(words), 50_000):
                some = words[at:at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([held[w] for w in some], pa.int64())],
                                                 schema=COUNT)
            held.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(text_words(doc_id, text, shortest, every))
                if len(held) > TABLE:
                    yield from sent()
        yield from sent()

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """(key, gap, n): every rotation of ``word$`` with an empty gap, and every one without its last code point, which
    is then the gap (the terminator is never in a gap)."""
    w, length = F.col("word"), F.length("word")
    whole = F.transform(F.sequence(F.lit(0), length), lambda i: F.struct(
        F.concat(w.substr(i + 1, length), F.lit("$"), w.substr(F.lit(1), i)).alias("key"), F.lit("").alias("gap")))
    open_ = F.transform(F.sequence(F.lit(1), length), lambda i: F.struct(
        F.concat(w.substr(i + 1, length), F.lit("$"), w.substr(F.lit(1), i - 1)).alias("key"),
        w.substr(i, F.lit(1)).alias("gap")))
    return words.select(F.explode(F.concat(whole, open_)).alias("r"), "n").select("r.key", "r.gap", "n")


def _word(key: str, gap: str) -> str:
    tail, head = key.split("$")
    return head + gap + tail


def _better(a, b):
    """Larger count, then smaller word."""
    return a if (-a[0], a[1]) < (-b[0], b[1]) else b


def neighbours_of_run(key: str, gaps: list[str], counts: list[int]):
    """(word, neighbours, count of the best, the best) for each member of a run that has neighbours in it."""
    members = [(n, _word(key, gap)) for gap, n in zip(gaps, counts) if gap]
    whole = [(n, _word(key, gap)) for gap, n in zip(gaps, counts) if not gap]
    head = key.split("$")[1]
    first = [not head or head[-1] != gap for gap in gaps if gap]  # of a row of equal code points
    ranked = sorted(members, key=lambda m: (-m[0], m[1]))[:2]
    for member, one_of in zip(members, first):
        near = len(members) - 1
        best = None if near == 0 else ranked[1] if member is ranked[0] else ranked[0]
        if whole and one_of:
            near, best = near + 1, whole[0] if best is None else _better(best, whole[0])
        if near:
            yield member[1], near, *best
    if whole and any(first):
        own = [m for m, yes in zip(members, first) if yes]
        yield whole[0][1], len(own), *min(own, key=lambda m: (-m[0], m[1]))


def _scan(batches):
    """Rows sorted by key, runs cut at changes of the key; a run can reach over the end of a batch."""
    held = None

    def found(keys, gaps, counts, cuts):
        out = []
        for a, b in cuts:
            out += neighbours_of_run(keys[a].as_py(), gaps.slice(a, b - a).to_pylist(), counts.slice(a, b - a).to_pylist())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), MET)], schema=MET)

    def runs(keys):
        """(start, end) of runs of at least two rows, and the start of the last run."""
        changes = [0, *(pc.indices_nonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))).to_numpy() + 1).tolist()]
        return [(a, b) for a, b in zip(changes, changes[1:]) if b - a > 1], changes[-1]

    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        keys, gaps, counts = (c.combine_chunks() for c in rows.columns)
        cuts, last = runs(keys)
        yield from found(keys, gaps, counts, cuts)
        held = rows.slice(last)
    if held is not None and len(held) > 1:
        keys, gaps, counts = (c.combine_chunks() for c in held.columns)
        yield from found(keys, gaps, counts, [(0, len(held))])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): number of words one code point away and the one of largest count; words without
    such neighbours are left out."""
    met = rotations(words).repartition("key").sortWithinPartitions("key") \
        .mapInArrow(_scan, "word string, n_near long, best_n long, best string")
    # the smallest word among equal counts: code-point order is byte order in UTF-8
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                   F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("best"))).alias("b")) \
        .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last one, by doubling."""
    forms = materialize(forms.select("word", F.col("form").alias("root")), "permuterm-forms")
    while True:
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = materialize(forms.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "permuterm-roots")
        forms = stepped.select("word", "root")
        if not stepped.where("moved").limit(1).count():
            return forms


def group_variants(docs: DataFrame, shortest: int = 7, least: int = 2, ratio: int = 10, every: int = 31,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root), one row per word."""
    words = materialize(word_counts(docs, shortest, least, every, id_col, text_col), "permuterm-words")
    joined = words.join(near_words(words), "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    judged = materialize(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                       F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")),
                         "permuterm-judged")
    last = roots(judged.where("form IS NOT NULL").select("word", "form"))
    return judged.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n",
                                                    F.coalesce("root", "word").alias("root"))
