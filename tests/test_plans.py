"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tidestream import session
from tidestream.plans.catalog import QUERIES
from tidestream.sources import testdata

TRAINED = {
    "score_lr", "score_gbt", "model_metrics", "champion", "feature_importance",
    "scored_sessions", "prediction_export", "scaled_features",
}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINED))
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in plan


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["order_values"](spark, sf_dir))
    assert "l_orderkey" in plan
    assert not any(c in plan for c in ("l_tax", "l_discount", "l_shipdate", "l_returnflag"))


def test_counts_combine_before_the_shuffle(spark, sf_dir):
    assert "partial_count" in plan_of(QUERIES["event_type_counts"](spark, sf_dir))


def test_copies_are_dropped_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["dedup_events"](spark, sf_dir))
    final, partial = plan.split("Exchange hashpartitioning(event_id", 1)
    assert "WindowGroupLimit" in final and "WindowGroupLimit" in partial


def test_top_lists_need_no_full_sort(spark, sf_dir):
    for name in ("top_products", "high_value_sessions", "top_sellers"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, sf_dir))


def test_json_is_parsed_once(spark, sf_dir):
    frame = contract.queries()["decode_events"](spark, sf_dir)
    assert plan_of(frame).count("from_json(") == 1


def test_large_lookup_is_not_broadcast(spark, sf_dir):
    """Without a small enough measured size, the product lookup shuffles and can be split."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1")
    try:
        plan = plan_of(testdata.clickstream(spark, sf_dir))
    finally:
        spark.conf.set(setting, before)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_hot_product_is_split(spark, tmp_path):
    """Half of all events on one product: its partition of the lookup join is split."""
    events = spark.range(60_000).selectExpr(
        "id event_id",
        "timestamp_ntz'2024-01-05 10:00:00' ts",
        "id % 100 user_id",
        "'view' event_type",
        "1D value",
        """concat('{"k": ', if(id % 2 = 0, 7, id % 100), '}') props""",
    )
    events.repartition(8).write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet("/root/testdata/sf0.001/part.parquet").write.parquet(
        f"{tmp_path}/part.parquet"
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        frame = testdata.clickstream(spark, str(tmp_path)).select("product_id", "product_name")
        assert len(frame.collect()) == 60_000 + 1_200
        assert "skew=true" in plan_of(frame)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_shuffle_count_grows_with_the_input(spark, sf_dir, monkeypatch):
    events = testdata.table(spark, sf_dir, "events")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.fit_shuffles(spark, events) == int(before)
        monkeypatch.setattr(session, "SHUFFLE_TARGET_BYTES", 1000)
        wanted = session.fit_shuffles(spark, events)
        assert wanted > int(before)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(wanted)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


class _Session:
    """The two parts of a session that the checkpoint helper looks at."""

    def __init__(self, master, shared=None):
        self.sparkContext = self
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_checkpoint_folder():
    cluster = _Session("spark://host:7077", "hdfs:///shared")
    assert session.ensure_checkpoint_dir(cluster) == "hdfs:///shared" == cluster.folder
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(_Session("spark://host:7077"))
    assert session.ensure_checkpoint_dir(_Session("local[2]"))
