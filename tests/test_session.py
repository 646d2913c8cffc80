from types import SimpleNamespace

import pytest

from timberline import session
from timberline.operators.spread import spread_join


def _stub(master: str, folder: str | None):
    conf = SimpleNamespace(get=lambda name, default=None: folder if name == "spark.checkpoint.dir" else default)
    context = SimpleNamespace(master=master, applicationId=f"app-{master}-{folder}")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_intermediate_tables_go_to_the_folder_the_cluster_names():
    one, two = (session.shared_folder(_stub("spark://host:1", "hdfs://x/ckpt/"), "lines") for _ in range(2))
    assert one.startswith("hdfs://x/ckpt/lines-") and one != two


def test_a_local_folder_serves_only_on_one_machine():
    assert session.shared_folder(_stub("local[4]", None), "lines").startswith("/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(_stub("spark://host:1", None), "lines")


def test_settled_keeps_rows_and_schema(spark):
    table = spark.createDataFrame([(1, [1.5, None]), (2, None)], "a int, b array<float>")
    back = session.settled(table, "test")
    assert back.schema == table.schema
    assert sorted(back.collect()) == sorted(table.collect())


def test_spread_join_equals_a_plain_join(spark):
    many = spark.range(300).selectExpr("id AS query_id", "IF(id % 3 = 0, 0, id % 17) AS k")
    few = spark.createDataFrame([(k, copy) for k in range(0, 17, 2) for copy in range(3)], "k bigint, copy int")
    plain = many.join(few, "k").select("query_id", "k", "copy")
    spread = spread_join(many, few, ["k"], "query_id", parts=5).select("query_id", "k", "copy")
    assert sorted(spread.collect()) == sorted(plain.collect())
    keys = spread_join(many, few, ["k"], "query_id")
    assert "_join_part" not in keys.columns


def test_one_local_folder_per_application(monkeypatch):
    made = []
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: made.append(prefix) or "/somewhere")
    stub = _stub("local[2]", None)
    stub.sparkContext.applicationId = "another"
    paths = {session.shared_folder(stub, "lines") for _ in range(3)}
    assert len(paths) == 3 and len(made) == 1


def test_folders_named_in_a_scope_are_removed(spark):
    with session.released_folders(spark):
        inside = session.settled(spark.range(5), "inside").inputFiles()
        outside = []
    kept = session.settled(spark.range(5), "outside")
    assert kept.count() == 5 and inside and outside == []
    assert not session.folder_exists(spark, inside[0])


def test_small_texts_are_created_once(spark, tmp_path):
    path = str(tmp_path / "pointer")
    assert session.create_small_text(spark, path, "one")
    assert not session.create_small_text(spark, path, "two")
    assert session.read_small_text(spark, path) == "one"
    assert session.names_in(spark, str(tmp_path / "nowhere")) == []
    assert [name for name in session.names_in(spark, str(tmp_path)) if not name.startswith(".")] == ["pointer"]
