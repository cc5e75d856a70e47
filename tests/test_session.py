"""Settings: what the user gave stays; no local checkpoint folder on a cluster."""
import pytest

from cabflow import session


def test_submitted_settings_win(monkeypatch, tmp_path):
    monkeypatch.delenv("PYSPARK_GATEWAY_PORT", raising=False)
    (tmp_path / "spark-defaults.conf").write_text("# x\nspark.sql.adaptive.enabled false\nspark.a=b c\n")
    monkeypatch.setenv("SPARK_CONF_DIR", str(tmp_path))
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", "--conf spark.sql.adaptive.skewJoin.enabled=false --master local pyspark-shell")
    got = session.submitted()
    assert got["spark.sql.adaptive.skewJoin.enabled"] == "false"
    assert got["spark.sql.adaptive.enabled"] == "false" and got["spark.a"] == "b c"


class _Conf(dict):
    def get(self, k, d=None):
        return dict.get(self, k, d)


class _Session:
    class sparkContext:  # noqa: N801
        @staticmethod
        def getCheckpointDir():
            return None

    def __init__(self, master):
        self.conf = _Conf({"spark.master": master})


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"])
def test_no_local_checkpoint_folder_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session(master))
