"""Explicit schemas. Nothing is inferred from data."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PIXELS = _struct(scene_id=T.IntegerType(), r=T.IntegerType(), c=T.IntegerType(), dn=T.IntegerType())

TILES = _struct(
    scene_id=T.IntegerType(),
    tile_r=T.IntegerType(),
    tile_c=T.IntegerType(),
    h=T.IntegerType(),
    w=T.IntegerType(),
    dn=T.ArrayType(T.IntegerType()),
)

EMBEDDINGS = _struct(vec_id=T.LongType(), embedding=T.ArrayType(T.FloatType()), label=T.IntegerType())

EVENTS = _struct(
    event_id=T.LongType(),
    ts=T.TimestampNTZType(),
    user_id=T.LongType(),
    event_type=T.StringType(),
    value=T.DoubleType(),
    props=T.StringType(),
)

LINEITEM = _struct(
    l_orderkey=T.LongType(),
    l_partkey=T.LongType(),
    l_suppkey=T.LongType(),
    l_linenumber=T.IntegerType(),
    l_quantity=T.DoubleType(),
    l_shipdate=T.TimestampNTZType(),
)

CUSTOMER = _struct(c_custkey=T.LongType(), c_acctbal=T.DoubleType())
NATION = _struct(n_nationkey=T.IntegerType(), n_name=T.StringType(), n_regionkey=T.IntegerType())
REGION = _struct(r_regionkey=T.IntegerType(), r_name=T.StringType())
