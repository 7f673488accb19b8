import hashlib
import zlib
from collections import Counter

from pyspark.sql import functions as F

from silvagrid.llm import shards
from silvagrid.llm.queries import QUERIES
from tests.conftest import SF_DIR


def drawn(key, i):
    return int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16)


def test_query(spark, documents):
    rows = QUERIES["op4_rendezvous_shards"](spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"].encode() for r in documents.collect()}
    slots = {}
    for r in rows:
        k, t = r["doc_id"], texts.pop(r["doc_id"])
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t) + 8, zlib.crc32(t), "key")
        assert r["shard"] == max(range(24), key=lambda i: drawn(k, i))
        assert r["grown_shard"] == max(range(25), key=lambda i: drawn(k, i)) and r["grown_shard"] in (r["shard"], 24)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert not texts and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights(spark):
    shard = shards.rendezvous(F.col("id"), [1.0, 0.0, 3.0])
    got = Counter(r["s"] for r in spark.range(4000).select(shard.alias("s")).collect())
    assert set(got) == {0, 2} and abs(got[2] / 4000 - 0.75) < 0.03


def test_odd_rows(odd, none):
    got = shards.assign_shards(odd, [1.0] * 3, [1.0] * 4).collect()
    assert len(got) == odd.count() and len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    for s in range(3):
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))
    assert shards.assign_shards(none, [1.0], [1.0]).count() == 0


def test_no_python_in_the_plan(documents):
    plan = shards.assign_shards(documents, [1.0] * 3, [1.0] * 4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
