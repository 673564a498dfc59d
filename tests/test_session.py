from __future__ import annotations

import pytest

from panelkit.session import materialise, shared_folder


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    """Only what ``shared_folder`` asks of a session."""

    def __init__(self, master, folder=None):
        self.sparkContext, self.conf = Context(master), {} if folder is None else {"spark.checkpoint.dir": folder}


def test_the_named_folder_is_used():
    assert shared_folder(Session("spark://host", "hdfs:/shared")) == "hdfs:/shared"


def test_a_local_master_gets_one_folder():
    session = Session("local[2]")
    assert shared_folder(session) == shared_folder(session) == session.sparkContext.folder


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn"))


def test_materialise_cuts_lineage_and_keeps_rows(spark):
    df = materialise(spark.range(100).selectExpr("id", "id * 2 as twice").where("id > 10"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "FileScan parquet" in plan
    assert df.agg({"twice": "sum"}).first()[0] == sum(2 * i for i in range(11, 100))


def test_settings_of_a_real_session(spark):
    folder = shared_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())


def test_scratch_removes_what_was_materialised(spark):
    import os

    from panelkit.session import materialise, scratch

    with scratch(spark) as folder:
        kept = materialise(spark.range(5), "numbers")
        assert kept.count() == 5
        place = folder.removeprefix("file:")
        assert os.listdir(place)
    assert not os.path.exists(place)
    assert materialise(spark.range(3)).count() == 3


def test_map_names_find_codes_by_alias(spark):
    from panelkit.plans.reports import geo_codes

    names = ["Newfoundland", "Yukon Territory", "Quebec", "Québec", "Manitoba", "Elsewhere"]
    got = geo_codes(spark.createDataFrame([(n,) for n in names], "name string"), "name", min_matches=3)
    assert {r.name: r.prov_code for r in got.collect()} == {
        "Newfoundland": "NL", "Yukon Territory": "YT", "Quebec": "QC", "Québec": "QC", "Manitoba": "MB", "Elsewhere": None}
