"""One writer at a time: a lock file in a folder that all writers see.

The file is made by an atomic create, which the local file system and HDFS have; object stores do not. Its time tells that
the owner is alive: a thread renews it, and a lock that was not renewed for a whole lease belongs to nobody.
"""

from __future__ import annotations

import threading
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Busy(RuntimeError):
    """Another writer holds the lock."""


class WriterLock:
    """``with WriterLock(spark, folder)`` holds the lock, waiting up to ``wait`` seconds for another owner to end."""

    def __init__(self, spark: SparkSession, folder: str, lease: float = 600.0, wait: float = 0.0, poll: float = 0.5):
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_writer.lock")
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.owner, self.lease, self.wait, self.poll = uuid.uuid4().hex, lease, wait, poll
        self._done = threading.Event()

    def _create(self) -> bool:
        if self.fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then; Java's does both at once
            plain = self.jvm.java.io.File(self.path.toUri().getPath())
            plain.getParentFile().mkdirs()
            if not plain.createNewFile():
                return False
            out = self.jvm.java.io.FileOutputStream(plain)
        else:
            try:
                out = self.fs.create(self.path, False)
            except Py4JJavaError as error:
                if "AlreadyExists" in error.java_exception.getClass().getName() or self.fs.exists(self.path):
                    return False
                raise
        out.write(self.owner.encode())
        out.close()
        return True

    def _owner_of(self, path) -> str | None:
        try:
            stream = self.fs.open(path)
        except Py4JJavaError:
            return None
        found = bytes(stream.readAllBytes()).decode()
        stream.close()
        return found

    def _expired(self) -> bool:
        try:
            changed = self.fs.getFileStatus(self.path).getModificationTime() / 1000
        except Py4JJavaError:  # gone since
            return False
        return time.time() - changed > self.lease

    def _evict(self) -> None:
        """Move an expired lock away; what turns out to be another owner's lock goes back."""
        before = self._owner_of(self.path)
        aside = self.jvm.org.apache.hadoop.fs.Path(f"{self.path.toString()}.{uuid.uuid4().hex}")
        if not self._expired() or not self.fs.rename(self.path, aside):
            return
        if self._owner_of(aside) != before and not self.fs.exists(self.path):
            self.fs.rename(aside, self.path)
        else:
            self.fs.delete(aside, False)

    def check(self) -> None:
        """Raise if the lock is no longer ours, as after a pause longer than the lease."""
        if self._owner_of(self.path) != self.owner:
            raise Busy(f"the lock {self.path.toString()} was lost")

    def _renew(self) -> None:
        while not self._done.wait(self.lease / 4):
            if self._owner_of(self.path) == self.owner:
                self.fs.setTimes(self.path, int(time.time() * 1000), -1)

    def __enter__(self) -> WriterLock:
        until = time.monotonic() + self.wait
        while not self._create():
            if self._expired():
                self._evict()
            elif time.monotonic() >= until:
                raise Busy(f"another writer holds {self.path.toString()}")
            else:
                time.sleep(self.poll)
        threading.Thread(target=self._renew, daemon=True).start()
        return self

    def __exit__(self, *_) -> None:
        self._done.set()
        if self._owner_of(self.path) == self.owner:
            self.fs.delete(self.path, False)
