from __future__ import annotations

import types

import pytest

from haulage import cli, storage
from haulage.session import (
    catalog_settings,
    object_store_settings,
    scratch_dir,
    session_setting,
    shared_root,
)
from haulage.sources.embedded import working_endpoint


def stand_in(master, root=None):
    """A session as far as the folder lookup needs one."""
    conf = types.SimpleNamespace(get=lambda key, default=None: root if "checkpoint" in key else default)
    context = types.SimpleNamespace(
        master=master,
        applicationId=f"app-{master}",
        getConf=lambda: types.SimpleNamespace(get=lambda key: None),
    )
    return types.SimpleNamespace(conf=conf, sparkContext=context)


def test_scratch_follows_the_session_setting(spark):
    root = shared_root(spark)
    assert root == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    app = spark.sparkContext.applicationId
    assert first != second and first.startswith(f"{root}/haulage/{app}/x-")
    assert storage.exists(spark, f"{root}/haulage/{app}") and not storage.exists(spark, first)


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir is not set"):
        shared_root(stand_in("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir is not set"):
        shared_root(stand_in("local-cluster[2,1,1024]"))
    assert shared_root(stand_in("spark://host:7077", "hdfs:///shared/")) == "hdfs:///shared"


def test_cluster_without_database_is_an_error():
    with pytest.raises(RuntimeError, match="spark.haulage.jdbc.url is not set"):
        working_endpoint(stand_in("yarn"), "x")


def test_object_store_settings(monkeypatch):
    for name in ("S3_ENDPOINT", "S3_ACCESS_KEY", "S3_SECRET_KEY"):
        monkeypatch.delenv(name, raising=False)
    assert "spark.hadoop.fs.s3a.access.key" not in object_store_settings()
    monkeypatch.setenv("S3_ENDPOINT", "http://store:9000")
    monkeypatch.setenv("S3_ACCESS_KEY", "key")
    monkeypatch.setenv("S3_SECRET_KEY", "secret")
    settings = object_store_settings()
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings["spark.hadoop.fs.s3a.secret.key"] == "secret"


def test_catalog_settings():
    assert catalog_settings("lake", "a.B", uri="u", jdbc__user="me") == {
        "spark.sql.catalog.lake": "a.B",
        "spark.sql.catalog.lake.uri": "u",
        "spark.sql.catalog.lake.jdbc.user": "me",
    }


def test_session_setting_is_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(ValueError):
        with session_setting(spark, key, "3"):
            assert spark.conf.get(key) == "3"
            raise ValueError
    assert spark.conf.get(key) == before


@pytest.fixture
def command_line(spark, monkeypatch):
    stops = []
    monkeypatch.setattr(cli, "build_session", lambda *_: spark)
    monkeypatch.setattr(spark, "stop", lambda: stops.append(True))
    return lambda *argv: (cli.main(argv), bool(stops))


def test_command_line(command_line, tmp_path, spark):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n")
    output = scratch_dir(spark, "cli")
    assert command_line("csv-to-parquet", str(tmp_path / "a.csv"), output) == (0, True)
    assert spark.read.parquet(output).count() == 1


def test_command_line_failure_is_exit_code_1(command_line, tmp_path, capsys):
    assert command_line("csv-to-parquet", str(tmp_path / "none.csv"), str(tmp_path / "o")) == (1, True)
    assert "csv-to-parquet failed" in capsys.readouterr().err


def test_command_line_replicate(command_line, spark, monkeypatch, capsys):
    from haulage.sinks import write_table

    source, target = working_endpoint(spark, "cli-from"), working_endpoint(spark, "cli-to")
    write_table(spark.range(4), source, "CLI_T")
    monkeypatch.setenv("SOURCE_JDBC_URL", source.url)
    monkeypatch.setenv("TARGET_JDBC_URL", target.url)
    assert command_line("replicate", "CLI_T", "--schema", "APP") == (0, True)
    assert "CLI_T\tloaded\t4\t4" in capsys.readouterr().out
    assert command_line("replicate", "CLI_T", "ABSENT", "--schema", "APP")[0] == 1


def test_command_line_bad_rows(command_line, spark, tmp_path, capsys):
    (tmp_path / "a.csv").write_text("k,v\n1,x\nno,y\n")
    source, output = str(tmp_path / "a.csv"), scratch_dir(spark, "cli")
    flags = ["--schema", "k int, v string", "--max-bad-share", "0.5", "--required", "v"]
    assert command_line("csv-to-parquet", source, output, *flags) == (0, True)
    assert "1 good rows, 1 bad rows" in capsys.readouterr().out
    assert command_line("csv-to-parquet", source, output, *flags[:3], "0.4")[0] == 1
    assert "1 of 2 rows are bad" in capsys.readouterr().err
    assert command_line("csv-to-parquet", source, output, "--max-bad-share", "1")[0] == 1


def test_command_line_files_with_unlike_headers(command_line, spark, tmp_path):
    (tmp_path / "1.csv").write_text("k,v\n1,x\n")
    (tmp_path / "2.csv").write_text("v,k\ny,2\n")
    table = "cli_by_name.t"
    assert command_line("stage-csv", str(tmp_path), table, "--no-properties")[0] == 1
    assert command_line("stage-csv", str(tmp_path), table, "--no-properties", "--by-name") == (0, True)
    assert sorted((r.k, r.v) for r in spark.table(table).collect()) == [(1, "x"), (2, "y")]
    spark.sql(f"DROP TABLE {table}")


def test_command_line_json_lines(command_line, spark, tmp_path, capsys):
    line = '{"results": [{"image": "http://%s/x.jpg"}]}\n'
    output = scratch_dir(spark, "cli")
    for name, hosts in (("1", "ab"), ("2", "c")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text("".join(line % host for host in hosts).replace("x.jpg", f"{name}.jpg"))
        assert command_line("image-manifest", str(tmp_path / name), output, "--json-lines") == (0, True)
    found = sorted((r.name, r.url) for r in spark.read.parquet(f"{output}/manifest").collect())
    assert found == [("1.jpg", "http://b/1.jpg"), ("2.jpg", "http://c/2.jpg")]
    assert command_line("image-manifest", str(tmp_path / "2"), output, "--json-lines", "--this-run-only")[0] == 0
    assert [r.name for r in spark.read.parquet(f"{output}/manifest").collect()] == ["2.jpg"]
