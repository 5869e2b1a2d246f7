"""What both jobs share: configuration, logging, sessions of the command line and folders of the registered queries."""

from __future__ import annotations

import json
import logging
import os
import sys
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from helixframe.session import shared_dir

log = logging.getLogger("jobs")


def configured(name: str, path: str | None = None, known: dict | None = None) -> dict:
    """The settings of a job: its own file beside it, or the given one. Unknown names and wrong types are an error."""
    defaults = json.loads((Path(__file__).parent / f"{name}.json").read_text())
    given = known if known is not None else json.loads(Path(path).read_text()) if path else {}
    for key, value in given.items():
        if key not in defaults:
            raise ValueError(f"unknown setting {key!r}; known: {', '.join(defaults)}")
        if type(value) is not type(defaults[key]):
            raise ValueError(f"{key} must be {type(defaults[key]).__name__}, not {value!r}")
    return defaults | given


def started(name: str) -> SparkSession:
    """The session of a command line; logs go to standard error."""
    logging.basicConfig(stream=sys.stderr, level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that no other call has, in the folder that driver and executors share. Its files stay."""
    return f"{shared_dir(spark)}/jobs/{name}-{os.getpid()}-{uuid.uuid4().hex}"
