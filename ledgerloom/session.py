"""What a Spark session needs before the library's Python functions run on its executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
#: Rows of an Arrow batch where the session says nothing else: a row may hold a text of megabytes.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to the executors once per application, so that they can import it.

    It is the programmatic form of ``spark-submit --py-files``. A session with Spark's own
    default for the rows of an Arrow batch gets ``BATCH_ROWS``.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="ledgerloom-ship-")) / "ledgerloom.zip"
        with zipfile.ZipFile(target, "w") as out:
            for path in sorted(package.rglob("*")):
                if path.suffix in (".py", ".json"):
                    out.write(path, path.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)
    return spark
