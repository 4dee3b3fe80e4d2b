"""Where pinned rows and written tables go."""

import os

from conftest import rows

from refinery.operators.storage import new_folder, pin, shared_folder


class Session:
    """As much of a session as the choice of a folder looks at."""

    def __init__(self, master, named=None, chosen=None):
        self.master, self.named, self.chosen = master, named, chosen
        self.conf = self.sparkContext = self

    def get(self, name, default=None):
        return {"spark.checkpoint.dir": self.named, "spark.sql.warehouse.dir": "hdfs:/tables/"}.get(name, default)

    def getCheckpointDir(self):
        return self.chosen

    def setCheckpointDir(self, path):
        self.chosen = path


def test_the_named_folder_is_used(spark):
    assert shared_folder(Session("yarn", named="hdfs:/shared")) == "hdfs:/shared"
    assert shared_folder(Session("yarn", chosen="hdfs:/set")) == "hdfs:/set"
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_without_a_name_the_folder_is_in_the_warehouse_on_any_master():
    for master in ("local[2]", "spark://master"):
        assert shared_folder(Session(master)) == "hdfs:/tables/_checkpoints"


def test_pinned_rows_are_files(spark):
    df = spark.range(10)
    pinned = pin(df)
    assert rows(pinned) == rows(df)
    assert os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    assert "Range" not in pinned._jdf.queryExecution().executedPlan().toString()
