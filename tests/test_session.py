from types import SimpleNamespace

import pytest

from streambed import session


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/made"


def fake(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=Context(master))


def test_the_named_folder_is_used_as_it_is():
    spark = fake("spark://host", **{"spark.checkpoint.dir": "hdfs://nn/shared/"})
    assert session.shared_folder(spark) == "hdfs://nn/shared"


def test_run_folders_are_new_each_time(spark):
    first, second = session.run_folder(spark, "q"), session.run_folder(spark, "q")
    assert first.startswith(f"{session.shared_folder(spark)}/streambed/q-") and first != second


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("yarn"))


def test_a_local_session_without_it_makes_its_own():
    assert session.shared_folder(fake("local[2]")).endswith("/made")


def test_operators_run_in_utc_whatever_the_session_had(spark):
    from streambed.catalog import views
    from tests.conftest import SMALL

    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        views.events(spark, SMALL)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        session.prepare(spark)


def test_a_tasks_bytes_are_bounded_and_smaller_settings_stay(spark):
    before = {key: spark.conf.get(key) for key in session.MOST_BYTES}
    try:
        for set_to, kept in (("128m", f"{16 << 20}b"), ("20k", "20k")):
            for key in before:
                spark.conf.set(key, set_to)
            session.prepare(spark)
            assert {spark.conf.get(key) for key in before} == {kept}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
