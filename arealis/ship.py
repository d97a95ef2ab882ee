"""Makes this package importable where Python functions run."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_shipped: set[str] = set()


def ship(df: DataFrame) -> DataFrame:
    """``df``, after the package has been sent to the executors once.

    A job submitted with ``--py-files`` or an installed package would not need this; a
    session that somebody else has started does.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        # The driver serves this file to the executors as long as it lives.
        folder = Path(tempfile.mkdtemp()).resolve()
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = folder / f"{root.name}.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, file.relative_to(root.parent))
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)
    return df


def map_arrow(df: DataFrame, function, schema: StructType | str) -> DataFrame:
    return ship(df).mapInArrow(function, schema)
