from keelson import session
from keelson.sources.tables import path_exists


def test_a_run_keeps_its_files_in_one_folder_and_removes_them(spark):
    stored = session.materialize(spark.range(5), "numbers")
    assert stored.count() == 5
    folder = session.run_folder(spark)
    assert stored.inputFiles()[0].split("://")[-1].startswith(folder.split("://")[-1])
    assert path_exists(spark, folder)
    assert session.close(spark)
    assert not path_exists(spark, folder)
    assert session.materialize(spark.range(3), "again").count() == 3
