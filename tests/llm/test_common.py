"""Helpers: the shared folder and bounded samples."""

import pytest

from indexloom.llm import common


class Session:
    def __init__(self, **conf):
        self.conf = self
        self.kept = conf

    def get(self, name, default=None):
        return self.kept.get(name, default)

    def set(self, name, value):
        self.kept[name] = value


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        common.shared_dir(Session(**{"spark.master": "spark://host:7077"}))
    with pytest.raises(ValueError):
        common.shared_dir(Session(**{"spark.master": "local-cluster[3,2,1024]"}))
    assert common.shared_dir(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"
    assert common.shared_dir(Session(**{"spark.master": "local[4]"})).startswith("file://")


def test_samples_do_not_shrink_with_copies(spark):
    few = spark.range(200_000).selectExpr("CAST(id % 50 AS STRING) AS t")
    assert common.bounded_sample(few, 40).count() == 40 and common.bounded_sample(few, 400).count() == 50
    one = spark.range(10_000).selectExpr("'same' AS t")
    assert [r.t for r in common.bounded_sample(one, 5).collect()] == ["same"]
    many = spark.range(20_000).selectExpr("id AS t")
    assert {r.t for r in common.bounded_sample(many.repartition(7), 30).collect()} == {r.t for r in common.bounded_sample(many.coalesce(1), 30).collect()}
