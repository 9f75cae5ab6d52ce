"""Table names, column names and schemas of the three models."""

from __future__ import annotations

from pyspark.sql import types as T

# The source tables, with the key by whose range each is read over JDBC.
TABLE_KEYS = {
    "lineitem": "l_orderkey",
    "orders": "o_orderkey",
    "customer": "c_custkey",
    "part": "p_partkey",
    "supplier": "s_suppkey",
    "partsupp": "ps_partkey",
    "nation": "n_nationkey",
    "region": "r_regionkey",
}

TABLES = tuple(TABLE_KEYS)
JOINED_TABLES = ("customer", "orders", "lineitem", "nation", "region")

# Source column -> business name.
RENAMES = {
    "customer": {
        "c_custkey": "customer_id",
        "c_name": "name",
        "c_nationkey": "nation_key",
    },
    "orders": {
        "o_orderkey": "order_id",
        "o_custkey": "customer_id",
        "o_orderstatus": "status",
        "o_totalprice": "total_price",
        "o_orderdate": "order_date",
    },
    "lineitem": {
        "l_orderkey": "order_id",
        "l_linenumber": "line_number",
        "l_quantity": "quantity",
        "l_extendedprice": "extended_price",
        "l_discount": "discount",
        "l_tax": "tax",
        "l_returnflag": "return_flag",
        "l_linestatus": "line_status",
        "l_shipdate": "ship_date",
        "l_commitdate": "commit_date",
        "l_receiptdate": "receipt_date",
    },
    "nation": {
        "n_nationkey": "nation_key",
        "n_name": "nation_name",
        "n_regionkey": "region_key",
    },
    "region": {
        "r_regionkey": "region_key",
        "r_name": "region_name",
    },
}

CUSTOMER_FIELDS = ("customer_id", "name", "nation", "region")
ORDER_FIELDS = ("order_id", "status", "total_price", "order_date")
LINE_FIELDS = tuple(RENAMES["lineitem"].values())[1:]

MONEY = T.DecimalType(15, 2)

WIDE_KEY = ("customer_id", "order_id", "line_number")


def wide_schema(id_type: T.DataType) -> T.StructType:
    """The 18 columns of the wide table."""
    return T.StructType([
        T.StructField("customer_id", id_type, False),
        T.StructField("order_id", id_type, False),
        T.StructField("name", T.StringType()),
        T.StructField("nation", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("total_price", MONEY),
        T.StructField("order_date", T.DateType()),
        T.StructField("line_number", T.IntegerType(), False),
        T.StructField("quantity", MONEY),
        T.StructField("extended_price", MONEY),
        T.StructField("discount", MONEY),
        T.StructField("tax", MONEY),
        T.StructField("return_flag", T.StringType()),
        T.StructField("line_status", T.StringType()),
        T.StructField("ship_date", T.DateType()),
        T.StructField("commit_date", T.DateType()),
        T.StructField("receipt_date", T.DateType()),
    ])


def document_schema(amount: T.DataType = MONEY, key: T.DataType = T.LongType()) -> T.StructType:
    """The stored customer document. Amounts and ids keep the type they have in the source."""
    line = T.StructType([
        T.StructField("line_number", T.IntegerType()),
        *[T.StructField(name, amount)
          for name in ("quantity", "extended_price", "discount", "tax")],
        T.StructField("return_flag", T.StringType()),
        T.StructField("line_status", T.StringType()),
        *[T.StructField(name, T.TimestampNTZType())
          for name in ("ship_date", "commit_date", "receipt_date")],
    ])
    order = T.StructType([
        T.StructField("order_id", key),
        T.StructField("status", T.StringType()),
        T.StructField("total_price", amount),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("lineitems", T.ArrayType(line)),
    ])
    return T.StructType([
        T.StructField("customer_id", key),
        T.StructField("name", T.StringType()),
        T.StructField("nation", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("orders", T.ArrayType(order)),
    ])


# Order keys pass 32 bits at a few hundred gigabytes of orders, so ids are kept in 64 bits.
# A store whose table declares 32-bit ids takes STORE_SCHEMA, where an id that does not fit
# is an error.
WIDE_SCHEMA = wide_schema(T.LongType())
STORE_SCHEMA = wide_schema(T.IntegerType())

# Request-log header -> (name here, type, value where the column or cell is
# missing).
LOG_COLUMNS = {
    "timeStamp": ("start_ms", "bigint", None),
    "elapsed": ("elapsed", "bigint", 0),
    "label": ("label", "string", ""),
    "responseCode": ("response_code", "string", None),
    "responseMessage": ("response_message", "string", None),
    "threadName": ("thread_name", "string", None),
    "success": ("success", "string", "true"),
    "bytes": ("bytes", "bigint", None),
    "sentBytes": ("sent_bytes", "bigint", None),
    "grpThreads": ("group_threads", "int", None),
    "allThreads": ("all_threads", "int", None),
    "Latency": ("latency", "bigint", None),
    "IdleTime": ("idle_time", "bigint", None),
    "Connect": ("connect", "bigint", None),
}

# The queries being compared. Labels equal those in the request log.
CATALOGUE_SCHEMA = "query_id string, title string, system string, label string, differs boolean"
CATALOGUE = [
    ("Q1", "Read customer by ID", "Cassandra", "Cassandra Q1 - Read Customer by ID", False),
    ("Q1", "Read customer by ID", "MongoDB", "MongoDB Q1 - Read Customer by ID", False),
    ("Q1", "Read customer by ID", "MySQL", "MySQL Q1 - Read Customer by ID", False),
    ("Q2", "Read customer orders detail", "Cassandra",
     "Cassandra Q2 - Read Customer Orders Detail", False),
    ("Q2", "Read customer orders detail", "MongoDB",
     "MongoDB Q2 - Read Customer Orders Detail", False),
    ("Q2", "Read customer orders detail", "MySQL",
     "MySQL Q2 - Read Customer Orders Detail", False),
    ("Q3", "Aggregation: orders by status", "Cassandra",
     "Cassandra Q3 - Count Customer Orders", True),
    ("Q3", "Aggregation: orders by status", "MongoDB",
     "MongoDB Q3 - Aggregation: Orders by Status", False),
    ("Q3", "Aggregation: orders by status", "MySQL",
     "MySQL Q3 - Aggregation: Orders by Status", False),
    ("Q4", "Range / filter query", "Cassandra", "Cassandra Q4 - Filter by Return Flag", True),
    ("Q4", "Range / filter query", "MongoDB",
     "MongoDB Q4 - Range Query: Customers by Region", False),
    ("Q4", "Range / filter query", "MySQL",
     "MySQL Q4 - Range Query: Customers by Region", False),
    ("Q5", "Revenue aggregation", "Cassandra", "Cassandra Q5 - Revenue Aggregation", False),
    ("Q5", "Revenue aggregation", "MongoDB", "MongoDB Q5 - Revenue Aggregation", False),
    ("Q5", "Revenue aggregation", "MySQL", "MySQL Q5 - Revenue Aggregation", False),
]

# The parameters drawn by the lookups.
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
RETURN_FLAGS = ("R", "A", "N")
