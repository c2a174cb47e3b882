"""The five views kept up to date: exact measures merged with each commit's new facts.

A view's state is a table of mergeable parts: per group and bucket of sale ids, a bitmap of the ids seen, and sums and
counts. Bitmaps make the distinct count exact under merging, also if a sale is delivered twice. A refresh reads only
the fact directories that commits have added since the last one, joins them with the dimensions (whose versions never
change their attributes), aggregates them and merges the result with the state. Facts are never read twice, and a
view's cost follows the day's facts and the number of its groups.

State tables are written once; ``views/_state/<n>.json`` names the current ones with the fact directories they hold, so
a refresh that dies changes nothing and two refreshes cannot both win.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.plans.views import SUM_DEC
from daymart.sinks.hadoop import Files
from daymart.sinks.publish import ConcurrentCommitError, Warehouse

SUMS = {"tickets": "bigint", "revenue": "decimal(38,2)", "paid": "bigint", "commission": "decimal(38,2)"}
# ---- fixed values: group columns of the views --------------------------------
VIEWS = {
    "venue": ["venuename", "venuecity", "venuestate"],
    "seller": ["username", "firstname", "lastname", "city", "state"],
    "top_events": ["eventname", "catname", "venuename", "venuecity"],
    "monthly": ["year", "month_num", "month_name"],
    "category": ["catgroup", "catname"],
}
# ---- end of fixed values -----------------------------------------------------


def grouped(view: str, sales: DataFrame, event: DataFrame, users: DataFrame) -> DataFrame:
    """The sales that count for a view, with its group columns."""
    measures = ["salesid", "qtysold", "pricepaid", "commission"]
    if view == "monthly":
        return sales.filter(F.col("saletime").isNotNull()).select(
            F.year("saletime").cast("short").alias("year"), F.month("saletime").cast("int").alias("month_num"),
            F.date_format("saletime", "MMM").alias("month_name"), *measures)
    if view == "seller":
        who = users.select(F.col("user_key").alias("seller_key"), *VIEWS[view])
        return sales.select("seller_key", *measures).join(who, "seller_key").drop("seller_key")
    what = event.select("event_key", *VIEWS[view])
    return sales.select("event_key", *measures).join(what, "event_key").drop("event_key")


def parts(rows: DataFrame, keys) -> DataFrame:
    """(keys, bucket, ids, sums): the mergeable state of rows."""
    price, fee = (F.col(c).cast("decimal(38,2)") for c in ("pricepaid", "commission"))
    return rows.groupBy(*keys, F.bitmap_bucket_number("salesid").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("salesid")).alias("ids"),
        F.sum(F.col("qtysold").cast("long")).alias("tickets"), F.sum(price).alias("revenue"),
        F.count("pricepaid").alias("paid"), F.sum(fee).alias("commission")) \
        .select(*keys, "bucket", "ids", *[F.col(c).cast(t).alias(c) for c, t in SUMS.items()])


def merged(one: DataFrame, other: DataFrame, keys) -> DataFrame:
    """The state of the rows of both. Sums over no value stay NULL."""
    return one.unionByName(other).groupBy(*keys, "bucket").agg(
        F.bitmap_or_agg("ids").alias("ids"), *[F.sum(c).cast(t).alias(c) for c, t in SUMS.items()])


def result(state: DataFrame, view: str) -> DataFrame:
    """The view from its state: columns and order of ``plans.views``."""
    df = state.groupBy(*VIEWS[view]).agg(
        F.sum(F.bitmap_count("ids")).alias("total_sales"), F.sum("tickets").alias("total_tickets_sold"),
        F.sum("revenue").alias("_revenue"), F.sum("paid").alias("_paid"),
        F.sum("commission").cast(SUM_DEC).alias("total_commission_paid"))
    df = df.withColumn("total_revenue", F.col("_revenue").cast(SUM_DEC))
    if view == "seller":
        name = F.concat("firstname", F.lit(" "), "lastname").alias("seller_name")
        return df.select("username", name, "city", "state", "total_sales", "total_tickets_sold", "total_revenue",
                         "total_commission_paid").orderBy(F.desc("total_revenue"))
    average: Column = F.col("_revenue").cast("double") / F.when(F.col("_paid") > 0, F.col("_paid"))
    order = ["year", "month_num"] if view == "monthly" else [F.desc("total_revenue")]
    return df.withColumn("avg_sale_price", average).select(
        *VIEWS[view], "total_sales", "total_tickets_sold", "total_revenue", "avg_sale_price").orderBy(*order)


class MaintainedViews:
    def __init__(self, wh: Warehouse):
        self.wh, self.spark = wh, wh.spark
        self.files = Files(wh.spark, wh.root)
        self.folder = f"{wh.root}/views"

    def state(self) -> dict:
        found = sorted(int(n[:-5]) for n, _, _ in self.files.listed(f"{self.folder}/_state") if n.endswith(".json") and n[:-5].isdigit())
        if not found:
            return {"n": 0, "version": 0, "facts": [], "tables": {}}
        return self.files.read_json(f"{self.folder}/_state/{found[-1]}.json")

    def refresh(self) -> dict:
        """Take up the facts of all commits since the last refresh; the new state document."""
        held, commit = self.state(), self.wh.latest()
        dirs, known = commit["tables"].get("fact_sales", []), set(held["facts"])
        made_of = {d: set(commit.get("sources", {}).get(d, [])) | {d} for d in dirs}  # a compacted folder holds others
        inner = {d: made_of[d] - {d} for d in dirs}
        if any(d not in known and inner[d] & known and not inner[d] <= known for d in dirs):
            held, known = {**held, "facts": [], "tables": {}}, set()  # it joins facts taken up and others: begin anew
        new = [d for d in dirs if d not in known and not (inner[d] and inner[d] <= known)]
        if not new and held["tables"]:
            return held
        schema = T.StructType.fromJson(json.loads(commit["schemas"]["fact_sales"]))
        sales = self.spark.read.schema(schema).parquet(*new) if new else self.spark.createDataFrame([], schema)
        event, users = self.wh.dimension("dim_event", commit), self.wh.dimension("dim_users", commit)
        from daymart.plans.warehouse import run_concurrently

        def write(view):
            keys = VIEWS[view]
            state = parts(grouped(view, sales, event, users), keys)
            if view in held["tables"]:
                state = merged(self.spark.read.parquet(held["tables"][view]), state, keys)
            path = f"{self.folder}/{view}/v={commit['version']}-{uuid.uuid4().hex[:12]}"
            state.write.mode("errorifexists").parquet(path)
            return path
        tables = run_concurrently({v: (lambda v=v: write(v)) for v in VIEWS})
        doc = {"n": held["n"] + 1, "version": commit["version"], "facts": sorted(known.union(*(made_of[d] for d in new))), "tables": tables}
        if not self.files.create_json(f"{self.folder}/_state/{doc['n']}.json", doc):
            raise ConcurrentCommitError(f"view state {doc['n']} already exists")
        return doc

    def view(self, name: str) -> DataFrame:
        """A view as of the last refresh."""
        return result(self.spark.read.parquet(self.state()["tables"][name]), name)
