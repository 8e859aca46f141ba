"""Files that tasks write themselves, in the folder all executors share."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from touchline.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, as a URI that :func:`located` takes on any machine of the cluster."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    system, path = located(folder)
    system.create_dir(path, recursive=True)
    return folder


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI. Hadoop writes local ones with one slash and names the S3 client ``s3a``."""
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def attempt_name(kind: str, number: int, ending: str) -> str:
    """A file name that no other attempt of the same task uses, so that a task redone never meets a half-written file.

    Readers go by the manifest, which holds the names of the attempts that ended well.
    """
    return f"{kind}-{number:06d}-{uuid.uuid4().hex}{ending}"
