"""Explicit schemas: nothing is inferred from data."""

from pyspark.sql import types as T


def struct(fields: str) -> T.StructType:
    """'name type, ...' with plain types (or arrays of them), without a session.

    `StructType.fromDDL` needs a running session, which Python workers lack.
    """
    out = T.StructType()
    for field in fields.split(","):
        name, kind = field.split()
        kind = {"int": "integer", "array<long>": "array", "array<float>": "array"}.get(kind, kind)
        if kind == "array":
            out.add(name, T.ArrayType(T.LongType() if "long" in field else T.FloatType()))
        else:
            out.add(name, kind)
    return out


# Records of the sample inputs.
SENSOR = struct("id string, ts long, vc int")
SENSOR_DOUBLE = struct("id string, ts long, vc double")
USER_BEHAVIOR = struct("userId long, itemId long, categoryId int, behavior string, timestamp long")
AD_CLICK = struct("userId long, adId long, province string, city string, timestamp long")
ACCESS_LOG = struct("ip string, userId string, ts long, method string, url string")
LOGIN = struct("userId long, ip string, eventType string, eventTime long")
ORDER = struct("orderId long, eventType string, txId string, eventTime long")
RECEIPT = struct("txId string, payChannel string, eventTime long")
MARKETING = struct("userId long, behavior string, channel string, timestamp long")

# Warehouse tables the registered queries read.
TABLES = {
    "region": struct("r_regionkey int, r_name string"),
    "nation": struct("n_nationkey int, n_name string, n_regionkey int"),
    "customer": struct("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "supplier": struct("s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    "part": struct(
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": struct(
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": struct(
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": struct(
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ),
    "documents": struct("doc_id long, text string, lang string, source string, n_chars long"),
    "pages": struct("page_id long, url string, html string"),
    "conversations": struct("conv_id long, turn long, role string, text string"),
    "labels": struct("doc_id long, quality int, toxic int"),
    "benchmark": struct("item_id long, text string"),
    "embeddings": struct("vec_id long, embedding array<float>, label int"),
}
