"""Session helpers."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from .files import open_fs
from .scratch import scratch_path

_shipped: set[str] = set()


def local_session(name: str = "ferrywright", cores: int | str = "*", **conf) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the tasks of this application the package, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    target = f"{scratch_path(spark, 'package')}.zip"
    files, name = open_fs(target)
    files.create_dir(name.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(name) as sink:
        sink.write(packed.getvalue())
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
