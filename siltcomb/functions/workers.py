"""Python workers and this package."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_shipped: set[str] = set()


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package even when only the driver's sys.path holds it.

    Workers on this machine get its folder; executors elsewhere get the package as a file that Spark hands out.
    """
    sc = spark.sparkContext
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        env = sc.environment
        have = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
        if _ROOT not in have:
            env["PYTHONPATH"] = os.pathsep.join([_ROOT, *have])
    elif sc.applicationId not in _shipped:
        import tempfile
        import zipfile

        path = os.path.join(tempfile.mkdtemp(prefix="siltcomb-package-"), "siltcomb_package.zip")
        package = os.path.join(_ROOT, "siltcomb")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, _ROOT))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)
