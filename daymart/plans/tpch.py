"""Driver plans: the package's operators run over the TPC-H-style tables.

Mapping of the warehouse model onto the given tables (inputs derived by
Spark from whole tables; no id subsets, no row caps):

* users dimension  <- customer (natural key c_custkey; tracked attributes
  c_name, c_nationkey, c_mktsegment). Two daily snapshots differ by value
  rules on c_acctbal: day 1 (1995-01-01) holds customers with a
  non-negative balance; day 2 (1998-01-01) drops balances >= 9000 (absent
  keys stay current), adds the negative ones (new keys), moves balances
  >= 8000 to the next nation and blanks the segment below 500 (NULL
  transitions).
* sales facts       <- orders (buyer = o_custkey, seller = the next
  customer key, sale time = o_orderdate) resolved point-in-time.
* view facts        <- lineitem (event = part, venue = supplier with its
  nation/region, category = part brand/type).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart import contracts
from daymart.operators import audit, calendar, clean, dedup, enrich, facts, ledger, scd2
from daymart.plans import maintained, views
from daymart.sinks import outputs
from daymart.sinks.materialize import materialize
from daymart.sources import files

# ---- fixed values of the driver scenario ----------------------------------
DAY1 = "1995-01-01"
DAY2 = "1998-01-01"
EARLY_LOAD = "1996-06-01"        # an out-of-order load date
FACT_LOAD_DATE = "2000-01-01"    # facts after this day are "future"
EXISTING_FACTS_BEFORE = "1996-01-01"
USER_KEY, USER_NK = "user_key", "c_custkey"
USER_ATTRS = ("c_name", "c_nationkey", "c_mktsegment")
TOP_N = 10
PENDING_N = 10
HOT_KEY_ROWS = 1_000_000         # facts per key above which a role join salts the key
# ---- end of fixed values --------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- inputs --
def snapshot1(spark, d):
    c = table(spark, d, "customer")
    return c.filter(F.col("c_acctbal") >= 0).select(USER_NK, *USER_ATTRS)


def snapshot2(spark, d):
    c = table(spark, d, "customer")
    return c.filter(F.col("c_acctbal") < 9000).select(
        USER_NK, "c_name",
        F.when(F.col("c_acctbal") >= 8000, (F.col("c_nationkey") + 1) % 25)
         .otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_acctbal") < 500, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


def snapshot_all(spark, d):
    """Day-1 snapshot of every customer: reports and fact loads cover all orders."""
    return table(spark, d, "customer").select(USER_NK, *USER_ATTRS)


def history1(spark, d, snap: DataFrame | None = None):
    snap = snap if snap is not None else snapshot1(spark, d)
    return scd2.scd2_apply(scd2.empty_dim(spark, snap, USER_KEY), snap, USER_NK, USER_ATTRS,
                           USER_KEY, DAY1)


def history2(spark, d, written: bool = False, h1: DataFrame | None = None):
    """Day-2 history. ``written``: materialised once (as the warehouse load
    publishes it) for plans that join it several times (role joins)."""
    h = scd2.scd2_apply(h1 if h1 is not None else history1(spark, d), snapshot2(spark, d),
                        USER_NK, USER_ATTRS, USER_KEY, DAY2)
    return materialize(h, "dim_users") if written else h


def full_history2(spark, d):
    return history2(spark, d, written=True, h1=history1(spark, d, snapshot_all(spark, d)))


def histories(spark, d, snap: DataFrame | None = None):
    """(day-1, day-2) histories, each written once like published versions."""
    h1 = materialize(history1(spark, d, snap), "dim_users_d1")
    return h1, history2(spark, d, written=True, h1=h1)


def watermark_of(hist: DataFrame) -> DataFrame:
    return hist.select(F.col("effective_date").alias("load_date")).distinct()


def orders_sales(spark, d):
    o = table(spark, d, "orders")
    n = table(spark, d, "customer").count()  # one scalar: the customer count
    pricepaid = F.col("o_totalprice").cast("decimal(12,2)")
    return o.select(
        F.col("o_orderkey").alias("salesid"),
        F.col("o_custkey").alias("buyerid"),
        ((F.col("o_custkey") + 1) % F.lit(n)).alias("sellerid"),
        F.substring("o_orderpriority", 1, 1).cast("short").alias("qtysold"),
        pricepaid.alias("pricepaid"),
        F.round(pricepaid * F.lit(0.15).cast("decimal(2,2)"), 2).cast("decimal(12,2)").alias("commission"),
        F.col("o_orderdate").alias("saletime"))


def _roles(hist):
    return [facts.Role(hist, USER_NK, "buyerid", USER_KEY, "buyer_key"),
            facts.Role(hist, USER_NK, "sellerid", USER_KEY, "seller_key")]


def line_sales(spark, d):
    li = table(spark, d, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("salesid"),
        F.col("l_partkey").alias("event_key"), F.col("l_suppkey").alias("venue_key"),
        F.col("l_quantity").cast("long").alias("qtysold"),
        price.alias("pricepaid"),
        F.round(price * F.col("l_discount").cast("decimal(4,2)"), 2).cast("decimal(12,2)").alias("commission"),
        F.col("l_shipdate").alias("saletime"), "l_linestatus")


def part_events(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("event_key"), F.col("p_name").alias("eventname"),
        F.col("p_brand").alias("catgroup"), F.col("p_type").alias("catname"))


def venues(spark, d):
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    return s.join(nr, s.s_nationkey == nr.n_nationkey, "left").select(
        F.col("s_suppkey").alias("event_key"), F.col("s_name").alias("venuename"),
        F.col("n_name").alias("venuecity"), F.col("r_name").alias("venuestate"))


# --------------------------------------------------------------- queries --
def q_v_venue(spark, d):
    s = line_sales(spark, d).drop("event_key").withColumnRenamed("venue_key", "event_key")
    return views.venue_performance(s, venues(spark, d))


def q_v_top_events(spark, d):
    return views.top_events(line_sales(spark, d), part_events(spark, d),
                            venue=venues(spark, d).withColumnRenamed("event_key", "venue_key"))


def q_v_category(spark, d):
    return views.category_performance(line_sales(spark, d), part_events(spark, d))


def q_v_monthly(spark, d):
    return views.monthly_sales(line_sales(spark, d))


def resolved_sales(spark, d, hist=None, how="inner"):
    hist = hist if hist is not None else full_history2(spark, d)
    return facts.resolve_roles(orders_sales(spark, d), "saletime", _roles(hist), how=how,
                               hot_threshold=HOT_KEY_ROWS)


def q_v_seller(spark, d):
    hist = full_history2(spark, d)
    return views.seller_performance(resolved_sales(spark, d, hist), hist, username="c_name",
                                    first="c_name", last="c_mktsegment", extra=("c_nationkey",))


def q_top_buyers(spark, d):
    hist = full_history2(spark, d)
    return views.top_buyers(resolved_sales(spark, d, hist), hist, TOP_N,
                            userid=USER_NK, username="c_name")


def q_listed_vs_sold(spark, d):
    ls = line_sales(spark, d)
    listing = ls.select(F.col("salesid").alias("listid"), F.col("event_key").alias("eventid"),
                        F.col("qtysold").alias("numtickets"))
    sold = ls.filter(F.col("l_linestatus") == "F").select(
        "salesid", F.col("event_key").alias("eventid"), "qtysold", "pricepaid")
    return views.listed_vs_sold(listing, sold)


def q_denormalise_star(spark, d):
    li = table(spark, d, "lineitem")
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    sup = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return enrich.denormalise(li, [(part, "l_partkey", ["p_name", "p_brand"]),
                                   (sup, "l_suppkey", ["s_name"])])


def q_dedup_latest(spark, d):
    li = table(spark, d, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in li.columns if c not in keys + ["l_shipdate"]]
    return dedup.dedup_latest(li, keys, "l_shipdate", tiebreak=rest)


def q_dedup_last_position(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return dedup.dedup_last(ev, "user_id", pos="event_id")


def raw_sales(spark, d):
    """Sales-contract rows from lineitem with value-driven gaps."""
    li = table(spark, d, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("salesid"),
        F.col("l_orderkey").cast("long").alias("listid"),
        F.col("l_suppkey").cast("long").alias("sellerid"),
        F.col("l_partkey").cast("long").alias("buyerid"),
        F.col("l_partkey").cast("long").alias("eventid"),
        calendar.date_to_id("l_shipdate").cast("int").alias("dateid"),
        F.when(F.col("l_quantity") > 45, F.lit(None)).otherwise(F.col("l_quantity") - 3)
         .cast("short").alias("qtysold"),
        F.when(F.col("l_discount") == 0, F.lit(None))
         .otherwise(F.round(price * F.lit(0.1).cast("decimal(1,1)"), 2)).cast("decimal(8,2)").alias("pricepaid"),
        F.when(F.col("l_tax") == 0, F.lit(None))
         .otherwise(F.round(price * F.col("l_tax").cast("decimal(4,2)") * F.lit(0.1).cast("decimal(1,1)"), 2))
         .cast("decimal(8,2)").alias("commission"),
        F.col("l_shipdate").alias("saletime"),
        F.struct(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"))
         .alias("_pos"))


def q_clean_sales(spark, d):
    return clean.clean_sales(raw_sales(spark, d), mode="permissive")


def q_time_gate_violations(spark, d):
    ev = table(spark, d, "events")
    t = ev.select("event_id", F.when(F.col("event_type") == "error", F.lit(None))
                  .otherwise(F.col("ts")).alias("ts"))
    return clean.time_gate_violations(t, "ts", "event_id")


def raw_users(spark, d):
    """Bronze-like users text from customer: padded names, mixed-case
    state and e-mail, boolean tokens of every kind, fractional keys."""
    c = table(spark, d, "customer")
    tok = ["T", "no", " yes ", "0", "maybe", "F", "1", "TRUE", "false", ""]
    def token(shift):
        idx = ((F.col("c_nationkey") + shift) % 10).cast("int")
        return F.element_at(F.array(*[F.lit(t) for t in tok]), idx + 1)
    from daymart.contracts import BOOL_COLUMNS
    return c.select(
        F.concat(F.col("c_custkey").cast("string"),
                 F.when(F.col("c_acctbal") < 0, F.lit(".7")).otherwise(F.lit(""))).alias("userid"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("username"),
        F.col("c_mktsegment").alias("firstname"),
        F.col("c_nationkey").cast("string").alias("lastname"),
        F.lit(" Springfield ").alias("city"),
        F.when(F.col("c_acctbal") > 5000, F.lower(F.substring("c_mktsegment", 1, 2)))
         .otherwise(F.col("c_mktsegment")).alias("state"),
        F.concat(F.lit(" "), F.upper(F.col("c_name")), F.lit("@EXAMPLE.COM ")).alias("email"),
        F.lit("555-0100").alias("phone"),
        *[token(i).alias(b) for i, b in enumerate(BOOL_COLUMNS)],
        F.col("c_custkey").alias("_pos"))


def q_clean_users(spark, d):
    return clean.clean_users(raw_users(spark, d))


def raw_venue(spark, d):
    s = table(spark, d, "supplier")
    return s.select(
        F.concat(F.lit(" "), F.col("s_suppkey").cast("string")).alias("venueid"),
        F.concat(F.col("s_name"), F.lit("  ")).alias("venuename"),
        F.lit("Metropolis").alias("venuecity"),
        F.when(F.col("s_acctbal") > 5000, F.lit(" tx ")).when(F.col("s_acctbal") > 0, F.lit("Texas"))
         .otherwise(F.lit(None)).alias("venuestate"),
        F.when(F.col("s_acctbal") < 0, F.lit("abc")).otherwise(F.col("s_acctbal").cast("string")).alias("venueseats"),
        F.col("s_suppkey").alias("_pos"))


def q_clean_venue(spark, d):
    return clean.clean_venue(raw_venue(spark, d))


def raw_event_inputs(spark, d):
    """Bronze-like event, venue and category text: events from part (venue
    = p_size, category = brand number, some start times unparsable, some
    categories missing), venues from supplier delivered twice (the second
    delivery renames high-balance suppliers; the last one wins), categories
    from nation."""
    p = table(spark, d, "part")
    ev = p.select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string")).alias("eventid"),
        F.col("p_size").cast("string").alias("venueid"),
        F.when(F.col("p_retailprice") > 990, F.lit(None)).otherwise(F.substring("p_brand", 7, 3)).alias("catid"),
        (F.col("p_size") + 1827).cast("string").alias("dateid"),
        F.concat(F.lit("  "), F.col("p_name")).alias("eventname"),
        F.when(F.col("p_retailprice") < 905, F.lit("TBD"))
         .otherwise(F.concat(F.date_add(F.lit("2008-01-01").cast("date"), F.col("p_size")).cast("string"),
                             F.lit(" 18:00:00"))).alias("starttime"),
        F.col("p_partkey").alias("_pos"))
    v1 = raw_venue(spark, d)
    s = table(spark, d, "supplier").filter(F.col("s_acctbal") > 9000)
    v2 = raw_venue(spark, d).join(s.select(F.col("s_suppkey").alias("_pos")), "_pos", "left_semi") \
        .withColumn("venuename", F.concat(F.col("venuename"), F.lit(" (renamed)"))) \
        .withColumn("_pos", F.struct(F.lit(1).alias("delivery"), F.col("_pos").alias("row")))
    v1 = v1.withColumn("_pos", F.struct(F.lit(0).alias("delivery"), F.col("_pos").alias("row")))
    n = table(spark, d, "nation")
    cat = n.select(F.col("n_nationkey").cast("string").alias("catid"),
                   F.concat(F.lit(" "), F.lower("n_name")).alias("catgroup"),
                   F.col("n_name").alias("catname"),
                   F.concat(F.lit("Nation "), F.col("n_name")).alias("catdesc"),
                   F.col("n_nationkey").cast("long").alias("_pos"))
    return ev, v1.unionByName(v2), cat


def q_clean_event(spark, d):
    ev, venue, cat = raw_event_inputs(spark, d)
    return clean.clean_event(ev, venue, cat, mode="strict")


def q_receipt_status(spark, d):
    requests = batch_ledger(spark, d, value_floor=1.0).select("batch_id", "input_sha")
    commits = batch_ledger(spark, d).filter(
        F.col("batch_id").startswith("purchase-") | F.col("batch_id").startswith("view-"))
    return ledger.receipt_status(requests, commits).select("batch_id", "status")


def q_stage_key_violations(spark, d):
    return facts.stage_key_violations(raw_sales(spark, d), "salesid")


def q_fact_not_null(spark, d):
    r = resolved_sales(spark, d, history2(spark, d, written=True), how="left")
    return facts.not_null_violations(r, ["salesid", "buyer_key", "seller_key", "saletime"], "fact_sales")


def q_scd2_day1(spark, d):
    return history1(spark, d)


def q_scd2_day2(spark, d):
    return history2(spark, d)


def q_scd2_replay(spark, d):
    h2 = history2(spark, d, written=True)
    snap = snapshot2(spark, d)
    g = scd2.dimension_guards(h2, snap, USER_NK, USER_ATTRS, DAY2, watermark_of(h2), "users")
    if g.limit(1).count():
        raise RuntimeError("replay rejected")
    return scd2.scd2_apply(h2, snap, USER_NK, USER_ATTRS, USER_KEY, DAY2)


def q_scd2_changed_keys(spark, d):
    h1 = history1(spark, d)
    c = scd2.classify(h1, snapshot2(spark, d), USER_NK, USER_ATTRS).filter("_changed")
    return c.select(F.col("_k").alias(USER_NK),
                    *[(~F.col(f"d.{a}").eqNullSafe(F.col(f"s.{a}"))).alias(f"{a}_changed")
                      for a in USER_ATTRS])


def q_scd2_guard_same_day(spark, d):
    h2 = history2(spark, d)
    return scd2.dimension_guards(h2, snapshot1(spark, d), USER_NK, USER_ATTRS, DAY2,
                                 watermark_of(h2), "users")


def q_scd2_guard_out_of_order(spark, d):
    h2 = history2(spark, d)
    return scd2.dimension_guards(h2, snapshot2(spark, d), USER_NK, USER_ATTRS, EARLY_LOAD,
                                 watermark_of(h2), "users")


def corrupted_history(spark, d):
    h = history2(spark, d)
    closed = ~F.col("is_current")
    exp = (F.when(closed & (F.col("c_mktsegment") == "BUILDING"), F.date_sub("expiry_date", 1))
           .when(closed & (F.col("c_mktsegment") == "MACHINERY"), F.date_add("expiry_date", 30))
           .otherwise(F.col("expiry_date")))
    cur = (F.when(F.col("is_current") & (F.col("effective_date") == F.lit(DAY2).cast("date"))
                  & (F.col("c_nationkey") == 3), F.lit(False)).otherwise(F.col("is_current")))
    return h.withColumn("expiry_date", exp).withColumn("is_current", cur)


def q_history_violations(spark, d):
    return scd2.validate_history(corrupted_history(spark, d), USER_NK)


def q_interval_overlaps(spark, d):
    return scd2.interval_overlaps(corrupted_history(spark, d), USER_NK, USER_KEY)


def q_dim_integrity(spark, d):
    return audit.dim_integrity(history2(spark, d), USER_NK)


def q_null_audit(spark, d):
    return audit.null_audit(history2(spark, d), USER_ATTRS)


def q_dup_keys(spark, d):
    return audit.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_stage_counts(spark, d):
    return audit.table_counts({t: table(spark, d, t) for t in TABLES})


def existing_facts(spark, d, h1=None):
    """Facts loaded earlier: orders before 1996 resolved against day-1 history."""
    early = orders_sales(spark, d).filter(F.col("saletime") < F.lit(EXISTING_FACTS_BEFORE).cast("timestamp_ntz"))
    h1 = h1 if h1 is not None else history1(spark, d)
    return facts.resolve_roles(early, "saletime", _roles(h1), how="inner")


def q_fact_resolve(spark, d):
    return resolved_sales(spark, d).select("salesid", "buyer_key", "seller_key", "saletime",
                                           "qtysold", "pricepaid", "commission")


def q_fact_coverage(spark, d):
    h1, h2 = histories(spark, d)
    stage = facts.new_facts(orders_sales(spark, d), existing_facts(spark, d, h1), "salesid")
    r = facts.resolve_roles(stage, "saletime", _roles(h2), how="left")
    return facts.coverage_counts(r, "saletime", FACT_LOAD_DATE, ["buyer_key", "seller_key"])


def q_fact_append_idempotent(spark, d):
    h1, h2 = histories(spark, d, snapshot_all(spark, d))
    existing = existing_facts(spark, d, h1)
    r = resolved_sales(spark, d, hist=h2, how="left").filter(
        F.col("saletime").cast("date") <= F.lit(FACT_LOAD_DATE).cast("date"))
    new = facts.append_new(r, existing, "salesid", ["buyer_key", "seller_key"], with_load_ts=False)
    cols = ["salesid", "buyer_key", "seller_key", "saletime"]
    return existing.select(*cols).unionByName(new.select(*cols))


def q_fact_temporal_audit(spark, d):
    h2 = history2(spark, d, written=True)
    cur = h2.filter("is_current")
    s = orders_sales(spark, d)
    for col_, alias in (("buyerid", "buyer_key"), ("sellerid", "seller_key")):
        s = s.join(cur.select(F.col(USER_NK).alias(col_), F.col(USER_KEY).alias(alias)), col_)
    return facts.temporal_audit(s, "salesid", "saletime",
                                [(h2, USER_KEY, "buyer_key", "buyer"), (h2, USER_KEY, "seller_key", "seller")])


def q_calendar(spark, d):
    return calendar.calendar_for(table(spark, d, "orders"), "o_orderdate")


def q_manifest_rows(spark, d):
    ev = table(spark, d, "events")
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.get_json_object("props", "$.k").cast("long")).alias("declared_rows"))


def q_secret_findings(spark, d):
    return audit.secret_findings(table(spark, d, "documents"), "doc_id", "text")


def q_file_manifest(spark, d):
    m = files.build_manifest(spark, [f"{d}/{t}.parquet" for t in TABLES], fmt="parquet")
    return m.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "bytes", "sha256", "rows")


def batch_ledger(spark, d, value_floor=None):
    ev = table(spark, d, "events")
    if value_floor is not None:
        ev = ev.filter(F.col("value") >= value_floor)
    day = (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).cast("string")
    g = ev.groupBy(F.concat(F.col("event_type"), F.lit("-"), day).alias("batch_id"),
                   F.col("ts").cast("date").alias("load_date"))
    return g.agg(
        F.sha2(F.concat(F.sum("event_id").cast("string"), F.lit(":"), F.count(F.lit(1)).cast("string")), 256)
         .alias("input_sha"),
        F.when(F.min("value") < 0.5, F.lit("FAILED")).otherwise(F.lit("QUEUED")).alias("state"),
        F.count(F.lit(1)).alias("fence_epoch"))


def event_outputs(spark, d, value_floor=None):
    """Output descriptors: a batch a day, a dataset by event id, a file an hour (at most 24 files a dataset)."""
    ev = table(spark, d, "events")
    if value_floor is not None:
        ev = ev.filter(F.col("value") >= value_floor)
    names = F.array(*[F.lit(n) for n in contracts.DATASETS])
    ev = ev.select("event_id", F.date_format("ts", "yyyyMMdd").alias("day"), F.date_format("ts", "HH").alias("hour"),
                   F.element_at(names, (F.col("event_id") % 6 + 1).cast("int")).alias("dataset"))
    g = ev.groupBy(F.concat(F.lit("day-"), F.col("day")).alias("batch_id"), "dataset", "hour").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").cast("long").alias("bytes"))
    path = F.concat(F.lit("/w/batches/batch="), F.col("batch_id"), F.lit("/attempt=1/"), F.col("dataset"),
                    F.lit("/task=t/part-"), F.col("hour"), F.lit(".parquet"))
    return g.select("batch_id", "dataset", F.lit("t").alias("task"), path.alias("path"), "bytes",
                    F.sha2(F.concat_ws(":", "bytes", "rows"), 256).alias("sha256"), "rows")


def q_output_shas(spark, d):
    """Canonical hash, files and rows of every dataset of every batch."""
    return outputs.dataset_shas(event_outputs(spark, d), ("batch_id", "dataset"))


def q_output_row_faults(spark, d):
    """Datasets whose files do not hold the declared rows; declared are the events of value 1 or more."""
    declared = event_outputs(spark, d, value_floor=1.0).groupBy("batch_id", "dataset").agg(F.sum("rows").alias("declared"))
    return outputs.row_faults(event_outputs(spark, d), declared, ("batch_id", "dataset"))


def _merged_view(view, rows):
    """A maintained view's state built from the facts before 1996, merged with that of the others."""
    keys = maintained.VIEWS[view]
    early = F.coalesce(F.col("saletime") < F.lit("1996-01-01").cast("timestamp_ntz"), F.lit(False))
    one, other = (maintained.parts(rows.where(c), keys) for c in (early, ~early))
    return maintained.result(maintained.merged(one, other, keys), view)


def q_v_category_merged(spark, d):
    what = part_events(spark, d).select("event_key", *maintained.VIEWS["category"])
    return _merged_view("category", line_sales(spark, d).join(what, "event_key"))


def q_v_monthly_merged(spark, d):
    s = line_sales(spark, d).filter(F.col("saletime").isNotNull())
    return _merged_view("monthly", s.select("*", F.year("saletime").cast("short").alias("year"),
                                            F.month("saletime").cast("int").alias("month_num"),
                                            F.date_format("saletime", "MMM").alias("month_name")))


def q_pending_batches(spark, d):
    return ledger.pending(batch_ledger(spark, d), PENDING_N).select("batch_id", "load_date", "input_sha")


def q_batch_conflicts(spark, d):
    _, conflicts = ledger.register(batch_ledger(spark, d), batch_ledger(spark, d, value_floor=1.0))
    return conflicts


def q_stale_epochs(spark, d):
    led = batch_ledger(spark, d)
    commits = led.filter(F.col("batch_id").startswith("purchase-"))
    requests = led.filter(~F.col("batch_id").startswith("purchase-"))
    return ledger.stale_requests(requests, commits).select("batch_id", "fence_epoch")





# ------------------------------------------------- full warehouse load --
def _event_rows(spark, d, day2: bool = False):
    """Events from part: venue = p_size, category = brand number, start =
    2008-01-01 + p_size days at 18:00. Day 2 moves the start of parts
    priced above 995 by one hour."""
    p = table(spark, d, "part")
    start = (F.date_add(F.lit("2008-01-01").cast("date"), F.col("p_size")).cast("timestamp_ntz")
             + F.expr("INTERVAL 18 HOURS"))
    if day2:
        start = F.when(F.col("p_retailprice") > 995, start + F.expr("INTERVAL 1 HOURS")).otherwise(start)
    return p.select(F.col("p_partkey").alias("eventid"), F.col("p_size").cast("long").alias("venueid"),
                    F.substring("p_brand", 7, 3).cast("long").alias("catid"),
                    (F.col("p_size") + 1827).alias("dateid"), F.col("p_name").alias("eventname"),
                    start.alias("starttime"), "p_size", "p_retailprice")


def event_snapshot(spark, d, day2: bool = False):
    """Denormalised event snapshot (stage.event contract). Day 1 holds parts
    of size below 50; day 2 holds parts priced from 901 (the cheaper ones
    stay current), renames high-balance suppliers' venues and moves some
    start times."""
    from daymart import contracts
    from daymart.operators.enrich import enrich_event
    ev = _event_rows(spark, d, day2)
    ev = ev.filter(F.col("p_retailprice") >= 901) if day2 else ev.filter(F.col("p_size") < 50)
    s = table(spark, d, "supplier")
    name = F.col("s_name")
    if day2:
        name = F.when(F.col("s_acctbal") > 9000, F.concat(name, F.lit(" (renamed)"))).otherwise(name)
    venue = s.select(F.col("s_suppkey").cast("long").alias("venueid"), name.alias("venuename"),
                     F.col("s_nationkey").cast("string").alias("venuecity"), F.lit("TX").alias("venuestate"),
                     F.greatest(F.col("s_acctbal"), F.lit(0.0)).cast("int").alias("venueseats"))
    n = table(spark, d, "nation")
    cat = n.select(F.col("n_nationkey").cast("long").alias("catid"), F.upper("n_name").alias("catgroup"),
                   F.col("n_name").alias("catname"), F.concat(F.lit("Nation "), F.col("n_name")).alias("catdesc"))
    out = enrich_event(ev.drop("p_size", "p_retailprice"), venue, cat)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                        for f in contracts.stage_schema("event").fields])


def q_scd2_event_dim(spark, d):
    """Two daily loads of the denormalised event dimension (12 attributes)."""
    from daymart import contracts
    s1 = event_snapshot(spark, d)
    h1 = scd2.scd2_apply(scd2.empty_dim(spark, s1, "event_key"), s1, "eventid", contracts.EVENT_ATTRS,
                         "event_key", DAY1)
    return scd2.scd2_apply(h1, event_snapshot(spark, d, day2=True), "eventid", contracts.EVENT_ATTRS,
                           "event_key", DAY2)


def stage_frames(spark, d) -> dict:
    """Six stage frames (stage contracts) derived from the given tables:
    category <- nation, venue <- supplier, users <- customer,
    event <- part (denormalised with venue = p_size, category = brand no.),
    listing <- de-duplicated lineitem, sales <- its fulfilled lines with the
    order's customer as buyer."""
    from daymart import contracts
    from daymart.operators.enrich import enrich_event

    def conform(df, name):
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                           for f in contracts.stage_schema(name).fields])

    n = table(spark, d, "nation")
    category = conform(n.select(F.col("n_nationkey").alias("catid"), F.upper("n_name").alias("catgroup"),
                                F.col("n_name").alias("catname"),
                                F.concat(F.lit("Nation "), F.col("n_name")).alias("catdesc")), "category")
    s = table(spark, d, "supplier")
    venue = conform(s.select(F.col("s_suppkey").alias("venueid"), F.col("s_name").alias("venuename"),
                             F.col("s_nationkey").cast("string").alias("venuecity"),
                             F.lit("TX").alias("venuestate"),
                             F.greatest(F.col("s_acctbal"), F.lit(0.0)).cast("int").alias("venueseats")), "venue")
    from daymart.contracts import BOOL_COLUMNS
    c = table(spark, d, "customer")
    users = conform(c.select(
        F.col("c_custkey").alias("userid"), F.col("c_name").alias("username"),
        F.col("c_mktsegment").alias("firstname"), F.lit("Person").alias("lastname"),
        F.col("c_nationkey").cast("string").alias("city"), F.lit("TX").alias("state"),
        F.lower(F.concat(F.col("c_name"), F.lit("@example.invalid"))).alias("email"),
        F.lit("000-000-0000").alias("phone"),
        *[(F.col("c_acctbal") > F.lit(1000.0 * i)).alias(b) for i, b in enumerate(BOOL_COLUMNS)]), "users")
    event = conform(enrich_event(_event_rows(spark, d), venue, category), "event")
    li = dedup.dedup_latest(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate",
                            tiebreak=["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                      "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    lid = (F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    listing = conform(li.select(
        lid.alias("listid"), F.col("l_suppkey").alias("sellerid"), F.col("l_partkey").alias("eventid"),
        calendar.date_to_id("l_shipdate").alias("dateid"), F.col("l_quantity").alias("numtickets"),
        F.round(price / F.col("l_quantity").cast("decimal(4,0)"), 2).alias("priceperticket"),
        price.alias("totalprice"), F.col("l_shipdate").alias("listtime")), "listing")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    sold = li.filter(F.col("l_linestatus") == "F").join(o, "l_orderkey")
    sales = conform(sold.select(
        lid.alias("salesid"), lid.alias("listid"), F.col("l_suppkey").alias("sellerid"),
        F.col("o_custkey").alias("buyerid"), F.col("l_partkey").alias("eventid"),
        calendar.date_to_id("l_shipdate").alias("dateid"), F.col("l_quantity").alias("qtysold"),
        price.alias("pricepaid"),
        F.round(price * F.lit(0.15).cast("decimal(2,2)"), 2).alias("commission"),
        F.col("l_shipdate").alias("saletime")), "sales")
    return {"category": category, "venue": venue, "users": users, "event": event,
            "listing": listing, "sales": sales}


def daily_loads(spark, d, root: str) -> list:
    """Two daily loads into a fresh warehouse under ``root``: day A brings the
    dimensions (no facts yet), day B the unchanged snapshot plus all facts -
    stage, SCD2 compare, point-in-time resolution of every fact, write, commit."""
    from daymart.plans.warehouse import BatchRequest, load_batch
    from daymart.sinks.publish import Warehouse

    wh = Warehouse(spark, root)
    st = stage_frames(spark, d)
    day_a, day_b = "1994-12-31", "2002-12-31"
    first = dict(st)
    for t, ts in (("listing", "listtime"), ("sales", "saletime")):
        first[t] = st[t].filter(F.col(ts).cast("date") <= F.lit(day_a).cast("date"))
    out = [load_batch(spark, wh, first, BatchRequest("day-a", day_a))]
    out.append(load_batch(spark, wh, st, BatchRequest("day-b", day_b)))
    return out


QUERIES = {name[2:]: fn for name, fn in dict(globals()).items() if name.startswith("q_")}
