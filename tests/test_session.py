from __future__ import annotations

import pytest

from headway import session


class Context:
    def __init__(self, master):
        self.master, self.applicationId = master, f"app-{master}"


class Session:
    """What `shared_folder` asks of a session, without the setting."""

    def __init__(self, master):
        self.sparkContext, self.conf = Context(master), self

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return default


def test_local_mode_falls_back_to_one_folder():
    one, two = (session.shared_folder(Session("local[4]"), name) for name in ("a", "b"))
    assert one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0] and one != two


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://host"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session(master), "a")


def test_the_folder_of_the_setting_is_used(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark, "a").startswith(f"{base}/headway/a-")
