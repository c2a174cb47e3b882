"""Analytical views: surrogate-key join -> group -> measures -> order.

Measures (fixed by the data model):
  total_sales = COUNT(DISTINCT salesid), total_tickets_sold = SUM(qtysold),
  total_revenue = SUM(pricepaid), avg_sale_price = AVG(pricepaid),
  total_commission_paid = SUM(commission).

Each view is a function of lazy DataFrames; Catalyst prunes the scans to
the few columns used and AQE picks the join strategy from runtime sizes.
The distinct count is planned as partial aggregate -> (keys, salesid)
shuffle -> final aggregate, so a hot group is still combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUM_DEC = "decimal(18,2)"


def measures(commission: bool = False, avg: bool = True) -> list[Column]:
    out = [F.count_distinct("salesid").alias("total_sales"),
           F.sum(F.col("qtysold").cast("long")).alias("total_tickets_sold"),
           F.sum("pricepaid").cast(SUM_DEC).alias("total_revenue")]
    if avg:
        # exact decimal sum / count, evaluated once in double
        out.append((F.sum("pricepaid").cast("double") / F.count("pricepaid")).alias("avg_sale_price"))
    if commission:
        out.append(F.sum("commission").cast(SUM_DEC).alias("total_commission_paid"))
    return out


def _view(fact: DataFrame, joins, keys, ms, order) -> DataFrame:
    df = fact
    for dim, fk, dk, cols in joins:
        df = df.join(dim.select(F.col(dk).alias(fk), *cols), fk)
    return df.groupBy(*keys).agg(*ms).orderBy(*order)


def venue_performance(sales: DataFrame, event: DataFrame) -> DataFrame:
    return _view(sales, [(event, "event_key", "event_key", ["venuename", "venuecity", "venuestate"])],
                 ["venuename", "venuecity", "venuestate"], measures(), [F.desc("total_revenue")])


def seller_performance(sales: DataFrame, users: DataFrame, username: str = "username",
                       first: str = "firstname", last: str = "lastname",
                       extra=("city", "state")) -> DataFrame:
    """Grouped by the seller's descriptive attributes (not userid): equal
    people merge, versions of one person with different attributes split.
    seller_name = first || ' ' || last (NULL when either part is NULL)."""
    group = list(dict.fromkeys([username, first, last, *extra]))
    u = users.select(F.col("user_key").alias("seller_key"), *group)
    df = sales.join(u, "seller_key")
    name = F.concat(F.col(first), F.lit(" "), F.col(last)).alias("seller_name")
    return (df.groupBy(*group)
            .agg(*measures(commission=True, avg=False))
            .select(F.col(username).alias("username"), name, *extra, "total_sales",
                    "total_tickets_sold", "total_revenue", "total_commission_paid")
            .orderBy(F.desc("total_revenue")))


def top_events(sales: DataFrame, event: DataFrame, venue: DataFrame | None = None) -> DataFrame:
    """By event name, category and venue. With a denormalised event the
    venue columns come from it; otherwise from a separate ``venue`` lookup
    keyed by ``venue_key``."""
    if venue is None:
        joins = [(event, "event_key", "event_key", ["eventname", "catname", "venuename", "venuecity"])]
    else:
        joins = [(event, "event_key", "event_key", ["eventname", "catname"]),
                 (venue, "venue_key", "venue_key", ["venuename", "venuecity"])]
    return _view(sales, joins, ["eventname", "catname", "venuename", "venuecity"], measures(),
                 [F.desc("total_revenue")])


def monthly_sales(sales: DataFrame) -> DataFrame:
    """By transaction month (saletime, not the event date); NULL times excluded."""
    s = sales.filter(F.col("saletime").isNotNull())
    return (s.groupBy(F.year("saletime").cast("short").alias("year"),
                      F.month("saletime").cast("int").alias("month_num"),
                      F.date_format("saletime", "MMM").alias("month_name"))
            .agg(*measures()).orderBy("year", "month_num"))


def category_performance(sales: DataFrame, event: DataFrame) -> DataFrame:
    return _view(sales, [(event, "event_key", "event_key", ["catgroup", "catname"])],
                 ["catgroup", "catname"], measures(), [F.desc("total_revenue")])


def top_buyers(sales: DataFrame, users: DataFrame, n: int, userid: str = "userid",
               username: str = "username") -> DataFrame:
    """High-value buyers: revenue per buyer, top n (ties by user id)."""
    u = users.select(F.col("user_key").alias("buyer_key"), F.col(userid).alias("userid"),
                     F.col(username).alias("username"))
    return (sales.join(u, "buyer_key").groupBy("userid", "username")
            .agg(*measures(avg=False)).orderBy(F.desc("total_revenue"), "userid").limit(n))


def listed_vs_sold(listing: DataFrame, sales: DataFrame) -> DataFrame:
    """Per event: tickets listed vs tickets sold (two pre-aggregates joined
    on the event key - each side is reduced before the join shuffle). Events
    on one side only keep zeros for the other."""
    lst = listing.groupBy("eventid").agg(
        F.count_distinct("listid").alias("listings"),
        F.sum(F.col("numtickets").cast("long")).alias("tickets_listed"))
    sold = sales.groupBy("eventid").agg(
        F.count_distinct("salesid").alias("total_sales"),
        F.sum(F.col("qtysold").cast("long")).alias("tickets_sold"),
        F.sum("pricepaid").cast(SUM_DEC).alias("total_revenue"))
    return (lst.join(sold, "eventid", "full")
            .select("eventid", F.coalesce("listings", F.lit(0)).alias("listings"),
                    F.coalesce("tickets_listed", F.lit(0)).alias("tickets_listed"),
                    F.coalesce("total_sales", F.lit(0)).alias("total_sales"),
                    F.coalesce("tickets_sold", F.lit(0)).alias("tickets_sold"),
                    F.coalesce("total_revenue", F.lit(0).cast(SUM_DEC)).alias("total_revenue")))
