"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is contained in a document when at least ``percent`` hundredths of its word shingles occur in it. Items
are short and documents are long, so similarity of whole sets says nothing; containment is searched from the item's
side. Items are partitioned by the size class of their shingle sets (powers of two). An item in a class whose
largest size is u may lack floor(u * (100 - percent) / 100) shingles, so its MinHash sketch is one shingle longer
than that: a document that contains the item holds at least one of the item's smallest hashes, whatever it lacks.
Documents are searched for sketch hashes, a class only in documents long enough for it, and every document and item
that meet are verified on the exact shingles of the whole texts.

Only DataFrame functions are used. The sketch is counted first and broadcast up to ``BROADCAST`` rows; beyond that
the same join is shuffled. The text is not shuffled to search it; verification re-reads the documents that met a
sketch.

Words are what lies between white space, lower-cased. An item with fewer words than a shingle is one shingle of its
own length. Null and empty texts and items contain and are contained in nothing. Rows are told apart by id and text,
so an id given twice is searched in each of its texts (the better containment is reported) and repeated rows give one
result; null ids are kept. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymart.llm.common import materialize

BROADCAST = 500_000  # rows of two or three longs: some tens of MB at most


def words(text):
    """Lower-case words of a text column; an empty array without any."""
    bare = F.btrim(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t-\\r]+"))


def shingles(column: str, n: int, make):
    """``make`` of the n columns of each run of n words of an array column."""
    at = F.sequence(F.lit(0), F.size(column) - n)
    return F.when(F.size(column) >= n, F.transform(at, lambda i: make(*[F.get(column, i + k) for k in range(n)])))


def hashed(*w):
    return F.xxhash64(*w)


def spelled(*w):
    return F.concat_ws(" ", *w)


def item_shingles(items: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, width, shingle, hash, size): the distinct shingles of every item."""
    read = items.select(items[id_col].cast("long").alias("item_id"), items[text_col].cast("string").alias("text")) \
        .withColumn("item", F.xxhash64("item_id", "text")).withColumn("words", words(F.col("text")))
    found = None
    for width in range(1, n + 1):
        here = read.where(F.size("words") >= n if width == n else F.size("words") == width)
        pair = shingles("words", width, lambda *w: F.struct(spelled(*w).alias("shingle"), hashed(*w).alias("hash")))
        here = here.select("item", "item_id", F.lit(width).alias("width"), F.explode(F.array_distinct(pair)).alias("s"))
        found = here if found is None else found.union(here)
    return found.distinct().select("item", "item_id", "width", "s.shingle", "s.hash",
                                   F.count(F.lit(1)).over(Window.partitionBy("item")).alias("size"))


def needed(size, percent: int):
    """Shingles of an item of that size that a document must hold."""
    return F.ceil(size * percent / F.lit(100))


def sketches(found: DataFrame, percent: int) -> DataFrame:
    """(item, width, hash, least): the smallest hashes of each item, as many as its size class asks for, and the
    fewest shingles of a document that can contain an item of the class."""
    low = F.pow(F.lit(2.0), F.floor(F.log2("size"))).cast("long")
    spare = F.floor((2 * low - 1) * (100 - percent) / F.lit(100)) + 1
    rank = F.row_number().over(Window.partitionBy("item").orderBy("hash"))
    return found.withColumn("rank", rank).where(F.col("rank") <= spare) \
        .select("item", "width", "hash", needed(low, percent).alias("least"))


def contained(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(doc, doc_id, item_id, item_shingles, common_shingles) of every document and item it contains; ``doc`` tells
    rows apart by id and text."""
    found = materialize(item_shingles(items, n), "decontaminate-items")
    sketch = sketches(found, percent)
    widths = sorted(r["width"] for r in found.select("width").distinct().collect())  # n values at most
    small = sketch.count() <= BROADCAST
    read = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")) \
        .withColumn("doc", F.xxhash64("doc_id", "text"))
    met = None
    for width in widths:
        here = read.select("doc", words(F.col("text")).alias("words")).where(F.size("words") >= width) \
            .select("doc", F.size("words").alias("n_words"), F.explode(shingles("words", width, hashed)).alias("hash"))
        side = sketch.where(F.col("width") == width).select("item", "hash", (F.col("least") + width - 1).alias("least"))
        here = here.join(F.broadcast(side) if small else side, "hash").where("n_words >= least").select("doc", "item")
        met = here if met is None else met.union(here)
    if met is None:
        met = read.select("doc", F.lit(0).cast("long").alias("item")).where("false")
    met = materialize(met.distinct(), "decontaminate-candidates")
    ids = met.select("doc").distinct()
    again = read.join(F.broadcast(ids) if met.count() <= BROADCAST else ids, "doc").dropDuplicates(["doc"])
    exact = None
    for width in widths:
        here = again.select("doc", "doc_id", words(F.col("text")).alias("words")).where(F.size("words") >= width) \
            .select("doc", "doc_id", F.explode(shingles("words", width, spelled)).alias("shingle")).distinct()
        side = found.where(F.col("width") == width).join(met, "item").select("doc", "item", "item_id", "shingle", "size")
        here = side.join(here, ["doc", "shingle"]).groupBy("doc", "doc_id", "item", "item_id", "size") \
            .agg(F.count(F.lit(1)).alias("common"))
        exact = here if exact is None else exact.union(here)
    if exact is None:
        exact = read.select("doc", "doc_id", F.lit(0).cast("long").alias("item"), F.lit(0).cast("long").alias("item_id"),
                            F.lit(1).cast("long").alias("size"), F.lit(0).cast("long").alias("common")).where("false")
    return exact.where(F.col("common") * 100 >= F.col("size") * percent) \
        .select("doc", "doc_id", "item_id", F.col("size").alias("item_shingles"), F.col("common").alias("common_shingles"))


def contaminated(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, item_shingles, common_shingles, containment), one row per document and item."""
    best = contained(docs, items, n, percent).groupBy("doc_id", "item_id").agg(
        F.max(F.struct(F.col("common_shingles") / F.col("item_shingles"), "item_shingles", "common_shingles")).alias("m"))
    return best.select("doc_id", "item_id", "m.item_shingles", "m.common_shingles",
                       (F.col("m.common_shingles") / F.col("m.item_shingles")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, that contain no item."""
    bad = materialize(contained(docs, items, n, percent).select("doc").distinct(), "decontaminate-bad")
    small = bad.count() <= BROADCAST
    whole = docs.select(F.struct("*").alias("row"), F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string")).alias("doc"))
    return whole.join(F.broadcast(bad) if small else bad, "doc", "left_anti").select("row.*")


ORACLE = """
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \\t-\\r]+'), lambda x: x <> '') AS a
           FROM documents),
d AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(list_transform(range(1, len(a) - 3),
        lambda i: concat_ws(' ', a[i], a[i + 1], a[i + 2], a[i + 3], a[i + 4]))) AS s FROM w)),
v AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[ \\t-\\r]+'), lambda x: x <> '') AS a
      FROM benchmark),
i AS (SELECT DISTINCT item_id, s FROM (SELECT item_id, unnest(list_transform(range(1, len(a) - 3),
        lambda i: concat_ws(' ', a[i], a[i + 1], a[i + 2], a[i + 3], a[i + 4]))) AS s FROM v)),
n AS (SELECT item_id, count(*) AS item_shingles FROM i GROUP BY item_id)
SELECT doc_id, item_id, item_shingles, count(*) AS common_shingles, count(*) / item_shingles AS containment
FROM d JOIN i USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, item_shingles
HAVING count(*) * 100 >= item_shingles * 80
"""
