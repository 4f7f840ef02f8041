import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
for name in (ROOT, str(Path(__file__).resolve().parent)):
    if name not in sys.path:
        sys.path.insert(0, name)
# Python workers import the package from here.
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH", "")) if x)


@pytest.fixture(scope="session")
def checkpoints(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark.sparkContext.getCheckpointDir()
