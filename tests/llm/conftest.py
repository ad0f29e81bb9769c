import pytest


@pytest.fixture()
def frame(spark):
    """A DataFrame from rows and a schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module", autouse=True)
def own_shared_folder(spark, tmp_path_factory):
    """A shared folder for each module: tables that the tests of another one wrote and left are not in it."""
    key, before = "spark.checkpoint.dir", spark.conf.get("spark.checkpoint.dir", None)
    conf = spark._jsparkSession.sessionState().conf()       # spark.conf refuses to set this key
    conf.setConfString(key, str(tmp_path_factory.mktemp("shared")))
    yield
    if before is None:
        conf.unsetConf(key)
    else:
        conf.setConfString(key, before)
