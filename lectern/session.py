"""Session helpers shared by queries, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def local_session(name: str = "lectern", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("LECTERN_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of any cluster.

    Workers that inherit a PYTHONPATH with the repository need nothing; for all
    others the package goes out once per application as a zip file.
    """
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    archive = Path(tempfile.mkdtemp()) / "lectern.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted((ROOT / "lectern").rglob("*.py")):
            z.write(path, path.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(archive))
