"""Bring this package to the Python workers, whatever path the driver found it on."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

import driftline
from driftline.llm.files import written_once
from driftline.session import working_path

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application, add the package as a zip file in the shared folder."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    top = os.path.dirname(os.path.abspath(driftline.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join(os.path.basename(top), os.path.relpath(path, top)))
    place = working_path(spark, "package")
    with written_once(place, "driftline.zip") as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(f"{place}/driftline.zip")
    _shipped.add(application)
