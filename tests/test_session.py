from types import SimpleNamespace

import pytest

from tidegauge.session import remove_written, shared_folder, written


def session(master, checkpoint_dir):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: checkpoint_dir),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_intermediate_tables_go_to_the_folder_the_cluster_names():
    first = shared_folder(session("spark://host:7077", "hdfs:///shared/"))
    assert first.startswith("hdfs:///shared/tidegauge-app-1/")
    assert first != shared_folder(session("spark://host:7077", "hdfs:///shared/"))


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("spark://host:7077", "yarn", "k8s://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master, None))


def test_a_local_session_may_use_a_temporary_folder():
    assert "/tidegauge-app-1/" in shared_folder(session("local[2]", None))


def test_written_tables_keep_their_rows_and_can_be_removed(spark):
    table = written(spark.range(5).selectExpr("id", "CAST(id AS DECIMAL(38,0)) AS d"))
    assert table.count() == 5
    [file] = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    assert file.startswith(f"file://{spark.conf.get('spark.checkpoint.dir')}/tidegauge-")
    # Other tests of this session still need theirs, so only a path of another application goes.
    other = session(spark.sparkContext.master, spark.conf.get("spark.checkpoint.dir"))
    other._jvm, other._jsc = spark._jvm, spark._jsc
    table.write.parquet(shared_folder(other))
    folder = shared_folder(other).rsplit("/", 1)[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert system.exists(path)
    remove_written(other)
    assert not system.exists(path)
