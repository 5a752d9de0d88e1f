import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from gaugeline.session import configure  # noqa: E402
from gaugeline.sources import catalog  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("gaugeline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.checkpoint.dir", str(scratch / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def tables(spark, request):
    """A fresh database with all tables."""
    name = f"t_{abs(hash(request.node.nodeid)) % 10**10}"
    found = catalog.Tables(name)
    catalog.ensure_all(spark, found)
    yield found
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def land(tmp_path):
    """Write page responses as a landing folder, of one request if named; returns its path."""
    import json

    def write(name, lines, request=None):
        path = tmp_path / name
        folder = path / f"request={request}" if request else path
        folder.mkdir(parents=True)
        texts = [t if isinstance(t, str) else json.dumps(t, ensure_ascii=False) for t in lines]
        (folder / "pages.json").write_text("\n".join(texts) + "\n", encoding="utf-8")
        return str(path)

    return write
