from types import SimpleNamespace

import pytest

from sparkkit import session


def fake(master, folder=None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)


def test_shared_folder_comes_from_the_session():
    assert session.shared_folder(fake("yarn", "hdfs://shared/")) == "hdfs://shared"
    with pytest.raises(RuntimeError):
        session.shared_folder(fake("yarn"))
    local = fake("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id", "id * 2 as twice").where("id > 3")
    table = session.materialize(df, "t")
    assert table.columns == df.columns and table.count() == 6
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Range" not in plan
    assert session.shared_folder(spark) in table.inputFiles()[0]
