import pytest
from pyspark.sql import SparkSession

from lakeload.queries import drop_workspaces
from lakeload.workspace import new_workspace


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4,2]")  # a failed task gets a second try
        .appName("lakeload-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared folder")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    drop_workspaces(session)
    session.stop()


@pytest.fixture
def place(spark):
    """A workspace for one test."""
    made = new_workspace(spark)
    yield made
    made.drop(spark)


@pytest.fixture
def zone(spark):
    """Change the session's time zone for one test."""
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture
def csv(tmp_path):
    """Write CSV text to a file, or several to a folder, and give the path."""

    def write(*texts, name="input"):
        folder = tmp_path / name
        folder.mkdir()
        for n, text in enumerate(texts):
            (folder / f"part-{n}.csv").write_text(text)
        return str(folder / "part-0.csv") if len(texts) == 1 else str(folder)

    return write
