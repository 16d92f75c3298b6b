"""Folders of the raw tree ``{root}/{source}/{category}/{yyyy}/{mm}/{dd}``, listed level by level.

A level's folders are listed only below those of the level above that the filter leaves, so a date filter
costs the folders of its days, not the files of the whole tree. Listing goes through Hadoop's file system,
which reaches every store that Spark reads.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import SparkSession

from .. import constants as K


class Tree:
    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = root.rstrip("/")
        #: Folders that were listed so far.
        self.listed: list[str] = []

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def depth(self) -> int:
        """Number of names in the root's path."""
        return len([n for n in self._fs.makeQualified(self._path(self.root)).toUri().getPath().split("/") if n])

    def names(self, path: str) -> list[str]:
        """Names of the folders in ``path``, sorted; none if it doesn't exist."""
        if not self.exists(path):
            return []
        self.listed.append(path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)) if s.isDirectory())

    def categories(self, sources, category: str | None) -> list[tuple[str, str]]:
        """(source, category) of the folders that are there."""
        out = []
        for source in sources or self.names(self.root):
            found = [category] if category else self.names(f"{self.root}/{source}")
            out += [(source, c) for c in found if not category or self.exists(f"{self.root}/{source}/{c}")]
        return out

    def _numbers(self, path: str, keep) -> list[str]:
        return [n for n in self.names(path) if n.isascii() and n.isdigit() and keep(int(n))]

    def days(self, source: str, category: str, start: dt.date | None = None, end: dt.date | None = None) -> Iterator[tuple[dt.date, str]]:
        """(date, folder) of a category's valid dates from ``start`` to ``end``, latest first."""
        start, end = start or dt.date.min, end or dt.date.max
        at = f"{self.root}/{source}/{category}"
        latest = lambda names: sorted(names, key=int, reverse=True)
        for y in latest(self._numbers(at, lambda n: start.year <= n <= end.year)):
            for m in latest(self._numbers(f"{at}/{y}", lambda n: (start.year, start.month) <= (int(y), n) <= (end.year, end.month))):
                for d in latest(self._numbers(f"{at}/{y}/{m}", lambda n: n >= 1)):
                    try:
                        day = dt.date(int(y), int(m), int(d))
                    except ValueError:
                        continue
                    if start <= day <= end:
                        yield day, f"{at}/{y}/{m}/{d}"

    def latest_file(self, source: str, category: str) -> str | None:
        """The raw file of a category's latest valid date that has one."""
        for _, folder in self.days(source, category):
            if self.exists(f"{folder}/{K.RAW_FILE_NAME}"):
                return f"{folder}/{K.RAW_FILE_NAME}"
        return None
