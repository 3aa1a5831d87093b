import os

from tidemark import session


def test_shared_folders_are_removed_on_demand(spark):
    folder = session.shared_folder(spark, "made")
    spark.range(3).write.parquet(folder)
    plain = folder.removeprefix("file:")
    assert os.path.isdir(plain)
    made, session._made[:] = list(session._made), [folder]
    try:
        assert session.remove_shared_folders(spark) == 1 and not os.path.exists(plain)
    finally:
        session._made[:] = made
