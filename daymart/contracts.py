"""Physical contracts: one StructType per dataset, keys, tracked attributes.

Column names, order and types of the six stage datasets and the warehouse
tables are fixed values of the data model (they must equal the source
system's stage DDL for files to load positionally). Identifiers alone are
wider than there (long instead of 16 or 32 bits), so that no key is lost when
tables grow.
"""

from __future__ import annotations

from pyspark.sql import types as T

DEC = T.DecimalType(8, 2)
TS = T.TimestampNTZType()

# ---- fixed values: stage dataset columns in stage order -------------------
DATASETS = ("category", "venue", "users", "event", "listing", "sales")

BOOL_COLUMNS = (
    "likesports", "liketheatre", "likeconcerts", "likejazz", "likeclassical",
    "likeopera", "likerock", "likevegas", "likebroadway", "likemusicals",
)

_STAGE = {
    "category": [("catid", T.LongType()), ("catgroup", T.StringType()),
                 ("catname", T.StringType()), ("catdesc", T.StringType())],
    "venue": [("venueid", T.LongType()), ("venuename", T.StringType()),
              ("venuecity", T.StringType()), ("venuestate", T.StringType()),
              ("venueseats", T.IntegerType())],
    "users": [("userid", T.LongType()), ("username", T.StringType()),
              ("firstname", T.StringType()), ("lastname", T.StringType()),
              ("city", T.StringType()), ("state", T.StringType()),
              ("email", T.StringType()), ("phone", T.StringType())]
             + [(c, T.BooleanType()) for c in BOOL_COLUMNS],
    "event": [("eventid", T.LongType()), ("venueid", T.LongType()),
              ("catid", T.LongType()), ("dateid", T.IntegerType()),
              ("eventname", T.StringType()), ("starttime", TS),
              ("venuename", T.StringType()), ("venuecity", T.StringType()),
              ("venuestate", T.StringType()), ("venueseats", T.IntegerType()),
              ("catgroup", T.StringType()), ("catname", T.StringType()),
              ("catdesc", T.StringType())],
    "listing": [("listid", T.LongType()), ("sellerid", T.LongType()),
                ("eventid", T.LongType()), ("dateid", T.IntegerType()),
                ("numtickets", T.ShortType()), ("priceperticket", DEC),
                ("totalprice", DEC), ("listtime", TS)],
    "sales": [("salesid", T.LongType()), ("listid", T.LongType()),
              ("sellerid", T.LongType()), ("buyerid", T.LongType()),
              ("eventid", T.LongType()), ("dateid", T.IntegerType()),
              ("qtysold", T.ShortType()), ("pricepaid", DEC),
              ("commission", DEC), ("saletime", TS)],
}

# Bronze event files carry only the first six stage columns; the rest is
# added by denormalisation.
BRONZE_EVENT_COLUMNS = ("eventid", "venueid", "catid", "dateid", "eventname", "starttime")

KEYS = {"category": "catid", "venue": "venueid", "users": "userid",
        "event": "eventid", "listing": "listid", "sales": "salesid"}

# Attributes whose change opens a new dimension version.
USER_ATTRS = ("username", "firstname", "lastname", "city", "state", "email", "phone") + BOOL_COLUMNS
EVENT_ATTRS = ("venueid", "catid", "dateid", "eventname", "starttime", "venuename",
               "venuecity", "venuestate", "venueseats", "catgroup", "catname", "catdesc")

OPEN_END = "9999-12-31"  # expiry of a current version (half-open interval end)
# ---- end of fixed values ----------------------------------------------------


def stage_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, t, True) for c, t in _STAGE[name]])


def stage_columns(name: str) -> list[str]:
    return [c for c, _ in _STAGE[name]]


def raw_schema(name: str, bronze: bool = True) -> T.StructType:
    """All-string schema of a Bronze file (what a lenient CSV scan yields)."""
    cols = BRONZE_EVENT_COLUMNS if (bronze and name == "event") else stage_columns(name)
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def dim_schema(name: str) -> T.StructType:
    """dim.users / dim.event: surrogate + stage columns + interval columns."""
    surrogate = {"users": "user_key", "event": "event_key"}[name]
    fields = [T.StructField(surrogate, T.LongType(), False)]
    for c, t in _STAGE[name]:
        if c == "venueseats":
            t = T.IntegerType()
        fields.append(T.StructField(c, t, c != KEYS[name]))
    fields += [T.StructField("effective_date", T.DateType(), False),
               T.StructField("expiry_date", T.DateType(), False),
               T.StructField("is_current", T.BooleanType(), False)]
    return T.StructType(fields)


FACT_SALES = T.StructType([
    T.StructField("salesid", T.LongType(), False),
    T.StructField("event_key", T.LongType(), False),
    T.StructField("seller_key", T.LongType(), False),
    T.StructField("buyer_key", T.LongType(), False),
    T.StructField("dateid", T.IntegerType(), False),
    T.StructField("eventid", T.LongType(), False),
    T.StructField("listid", T.LongType(), True),
    T.StructField("qtysold", T.ShortType(), True),
    T.StructField("pricepaid", DEC, True),
    T.StructField("commission", DEC, True),
    T.StructField("saletime", TS, True),
    T.StructField("load_ts", T.TimestampType(), True),
])

FACT_LISTING = T.StructType([
    T.StructField("listid", T.LongType(), False),
    T.StructField("event_key", T.LongType(), False),
    T.StructField("seller_key", T.LongType(), False),
    T.StructField("dateid", T.IntegerType(), False),
    T.StructField("eventid", T.LongType(), False),
    T.StructField("numtickets", T.ShortType(), True),
    T.StructField("priceperticket", DEC, True),
    T.StructField("totalprice", DEC, True),
    T.StructField("listtime", TS, True),
    T.StructField("load_ts", T.TimestampType(), True),
])

# Not-null columns checked before publication.
NOT_NULL = {
    "fact_sales": ("salesid", "event_key", "seller_key", "buyer_key", "dateid", "eventid"),
    "fact_listing": ("listid", "event_key", "seller_key", "dateid", "eventid"),
    "dim_users": ("user_key", "userid", "effective_date", "expiry_date", "is_current"),
    "dim_event": ("event_key", "eventid", "effective_date", "expiry_date", "is_current"),
}

DIM_DATE = T.StructType([
    T.StructField("dateid", T.IntegerType(), False),
    T.StructField("caldate", T.DateType(), False),
    T.StructField("day", T.StringType(), False),
    T.StructField("week", T.ShortType(), False),
    T.StructField("month", T.StringType(), False),
    T.StructField("qtr", T.StringType(), False),
    T.StructField("year", T.ShortType(), False),
    T.StructField("holiday", T.BooleanType(), True),
])

BATCH_COMMITS = T.StructType([
    T.StructField("batch_id", T.StringType(), False),
    T.StructField("input_sha", T.StringType(), False),
    T.StructField("output_sha", T.StringType(), False),
    T.StructField("attempt", T.IntegerType(), False),
    T.StructField("fence_epoch", T.LongType(), False),
    T.StructField("load_date", T.DateType(), False),
    T.StructField("committed_at", T.TimestampType(), True),
])
