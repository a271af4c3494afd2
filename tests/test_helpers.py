import duckdb
import pytest
from raw_events import raw_event
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.plans.oracle import bigint_counts
from playmetrics.plans.sinks import contract_violations
from playmetrics.operators.masking import masked, row_share


def test_bigint_counts_rewrite_keeps_semantics():
    sql = "SELECT count_if(x > 1 AND (y IN (1, 2))) AS a, count_if(count_if_flag) AS b FROM t"
    out = bigint_counts(sql)
    assert "count_if(" not in out.replace("count_if_flag", "")
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES (2, 1, true), (0, 2, false), (5, 3, true)) "
                "v(x, y, count_if_flag)")
    assert con.execute(out).fetchall() == con.execute(sql).fetchall() == [(1, 2)]
    assert [str(t) for t in con.sql(out).types] == ["BIGINT", "BIGINT"]


def test_contract_violations_report_order_and_types():
    want = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    swapped = T.StructType([want["b"], want["a"]])
    assert any("order" in p for p in contract_violations(swapped, want))
    retyped = T.StructType([T.StructField("a", T.IntegerType()), want["b"]])
    assert contract_violations(retyped, want) == ["column a is int, contract says bigint"]
    assert contract_violations(want, want) == []


def test_masking_is_reproducible_and_bounded(spark, make_raw):
    raw = make_raw([raw_event(user=f"u{i}", name=f"e{i}") for i in range(200)])
    full = masked(raw, "platform")
    assert full.where(F.col("platform").isNotNull()).count() == 0
    assert dict(full.dtypes)["platform"] == "string"
    first, again = (masked(raw, "platform", 0.35, seed="s").where("platform is null").count()
                    for _ in range(2))
    assert first == again and 30 < first < 110
    low, high = raw.select(row_share("s").alias("f")).agg(F.min("f"), F.max("f")).first()
    assert 0 <= low and high < 1
    for column, share in (("no_such_column", 0.5), ("device.category", 1.0), ("platform", 5),
                          ("platform", 0)):
        with pytest.raises(ValueError):
            masked(raw, column, share)


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from playmetrics.session import ensure_checkpoint_dir
    none = SimpleNamespace(get=lambda key, default=None: default)
    for master, fine in (("yarn", False), ("spark://host:7077", False),
                         ("local-cluster[2,1,1024]", False), ("local[2]", True)):
        chosen = []
        sc = SimpleNamespace(master=master, getConf=lambda: none,
                             getCheckpointDir=lambda c=chosen: c[0] if c else None,
                             setCheckpointDir=chosen.append)
        session = SimpleNamespace(sparkContext=sc, conf=none)
        if fine:
            assert ensure_checkpoint_dir(session) == chosen[0]
        else:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                ensure_checkpoint_dir(session)
