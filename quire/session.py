"""What every operator needs of the session: the package on the workers, and cut lineage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors of a cluster, once a context; local workers import it from the driver's path."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or getattr(sc, "_quire_shipped", False):
        return
    path = tempfile.mkdtemp(prefix="quire-package-") + "/quire_package.zip"  # the driver's own, which it serves to the executors
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(_ROOT.rglob("*.py")):
            z.write(p, p.relative_to(_ROOT.parent))
    sc.addPyFile(path)
    sc._quire_shipped = True


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that no lineage is left and a lost executor costs nothing.

    The folder is spark.checkpoint.dir of the session; only where that is unset, as in tests, one is made here.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        given = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="quire-checkpoint-"))
    return df.checkpoint(eager)
