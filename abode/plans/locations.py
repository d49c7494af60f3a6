"""Real locations of paths, and the guard of what a run writes.

Two spellings of a path can name one place: a relative or qualified form, a
link, a mount of another file system, the default file system left out. The file
system itself is asked (Hadoop's ``resolvePath``), for the nearest ancestor that
exists, as an output usually doesn't yet.
"""

from __future__ import annotations

import os
import posixpath
import re
from urllib.parse import urlsplit

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def same_path(a: str, b: str) -> bool:
    """Whether two paths are one by their text: ``file:`` and repeated slashes, ``.`` and ``..`` don't matter."""

    def plain(path: str) -> tuple[str, str, str]:
        parts = urlsplit(path)
        scheme = "" if parts.scheme == "file" else parts.scheme
        return scheme, parts.netloc, posixpath.normpath("/" + parts.path) if scheme else os.path.abspath(parts.path)

    return plain(a) == plain(b)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, place = file_system(spark, path)
    return fs.exists(place)


def _fixed_part(path: str) -> str:
    """The folders of a path pattern above its first wildcard; a plain path as it is."""
    wild = re.search(r"[*?\[{]", path)
    return path if wild is None else path[: wild.start()].rpartition("/")[0] or "/"


def real_location(spark: SparkSession, path: str) -> str:
    """``scheme://authority/path`` of where ``path`` really is or will be, links and mounts followed."""
    fs, place = file_system(spark, _fixed_part(path))
    place = fs.makeQualified(place)
    missing: list[str] = []
    while not fs.exists(place) and place.getParent() is not None:
        missing.insert(0, place.getName())
        place = place.getParent()
    if fs.exists(place):
        place = fs.resolvePath(place)
    uri = place.toUri()
    scheme, folder = uri.getScheme() or "file", uri.getPath()
    if scheme == "file":
        folder = os.path.realpath(folder)  # Hadoop's local file system keeps links
    return "/".join([f"{scheme}://{uri.getAuthority() or ''}{folder.rstrip('/')}", *missing])


def overlap(a: str, b: str) -> bool:
    """Whether one real location is the other, or lies inside it."""
    return (a + "/").startswith(b + "/") or (b + "/").startswith(a + "/")


def check_outputs(spark: SparkSession, inputs: dict[str, str | None], outputs: dict[str, str | None]) -> None:
    """Raise ``ValueError`` if an output is, holds or lies in an input or another output.

    Paths are given by what they are; a ``None`` path isn't used. Nothing is
    written before all of them are compared.
    """
    paths = [(name, path) for name, path in [*inputs.items(), *outputs.items()] if path]
    first = len([p for p in inputs.values() if p])
    places: list[str] = []
    for i, (name, path) in enumerate(paths):
        for other, taken in paths[: i if i >= first else 0]:
            if same_path(path, taken):  # needs no file system
                raise ValueError(f"{name} ({path}) is {other}; a run must write new paths, not ones it reads")
        places.append(real_location(spark, path))
        for (other, _), taken in zip(paths[: i if i >= first else 0], places):
            if overlap(places[i], taken):
                raise ValueError(f"{name} ({places[i]}) overlaps {other} ({taken}); a run must write new places")
