"""One run at a time on a state folder, by exclusive creation of one small file.

A run that goes from version N to N + 1 first creates ``<root>/claims/v=N+1``; the
file system lets one creator win.  The file holds the owner's mark.  It goes when the
run ends, well or not; one whose run was lost with its driver may be taken over when
it is older than ``stale_seconds`` (a run must not last longer).  A run that was taken
over notices before its last write and stops.

The file system must create files exclusively (HDFS and local ones do; object stores
with conditional writes).
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class RunInProgress(RuntimeError):
    """Another run is working on the same version of the state."""


class Claim:
    def __init__(self, spark: SparkSession, root: str, version: int, stale_seconds: float):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/claims/v={version:06d}")
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._clock = jvm.java.lang.System
        self.mark = uuid.uuid4().hex.encode()
        if not self._create() and not self._take_over(stale_seconds):
            raise RunInProgress(f"another run holds {self._path.toString()}")

    def _create(self) -> bool:
        from py4j.protocol import Py4JJavaError

        try:
            out = self._fs.create(self._path, False)
        except Py4JJavaError as e:
            if self._fs.exists(self._path):
                return False
            raise e
        out.write(bytearray(self.mark))
        out.close()
        return True

    def _take_over(self, stale_seconds: float) -> bool:
        if not self._fs.exists(self._path):  # its run has just ended
            return self._create()
        age = self._clock.currentTimeMillis() - self._fs.getFileStatus(self._path).getModificationTime()
        if age < 1000 * stale_seconds:
            return False
        # of several that find the file stale one moves it away; the others' move fails
        aside = self._path.suffix(f".{self.mark.decode()}")
        if not self._fs.rename(self._path, aside):
            return False
        self._fs.delete(aside, False)
        return self._create()

    def held(self) -> bool:
        if not self._fs.exists(self._path):
            return False
        stream = self._fs.open(self._path)
        try:
            return bytes(stream.readNBytes(len(self.mark))) == self.mark
        finally:
            stream.close()

    def check(self) -> None:
        if not self.held():
            raise RunInProgress(f"{self._path.toString()} was taken over by another run")

    def release(self) -> None:
        if self.held():
            self._fs.delete(self._path, False)
