"""Session helpers."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
#: Where scratch files go if the session names no shared folder and driver and executors are one process.
LOCAL_SHARED = "file:///tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Without one only a local master can go on."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return LOCAL_SHARED
    raise RuntimeError(f"spark.checkpoint.dir must name a folder that the driver and all executors share (master {master})")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder, which goes when the application ends."""
    sc = spark.sparkContext
    root = f"{shared_dir(spark)}/helixframe/{sc.applicationId}"
    if getattr(sc, "_helixframe_scratch", None) != root:
        p = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        sc._helixframe_scratch = root
    return f"{root}/{name}-{uuid.uuid4().hex}"


def own_session(spark: SparkSession) -> SparkSession:
    """A session of its own in the same application, which begins with the settings, views and functions of `spark`; what is
    set in one does not show in the other."""
    return SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_helixframe_shipped", False):
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(ROOT.rglob("*.py")):
            z.write(p, f"helixframe/{p.relative_to(ROOT)}")
    target = Path(tempfile.mkdtemp(prefix="helixframe-")) / "helixframe_src.zip"
    target.write_bytes(data.getvalue())
    sc.addPyFile(str(target))
    sc._helixframe_shipped = True
