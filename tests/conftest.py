from __future__ import annotations

import contextlib
import io
import sys
import time
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from mostrador.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def explained():
    def text(df) -> str:
        printed = io.StringIO()
        with contextlib.redirect_stdout(printed):
            df.explain("formatted")
        return printed.getvalue()

    return text


def shuffle_files(spark) -> set[str]:
    """Names of the files of shuffles on this machine's disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_behind(spark, held: set[str], seconds: float = 10) -> set[str]:
    """Files of shuffles beside those held before; deleting is given a few seconds, as nobody waits for it."""
    until = time.monotonic() + seconds
    while (found := shuffle_files(spark) - held) and time.monotonic() < until:
        time.sleep(0.1)
    return found
