"""A lease on a folder: who holds it may change what lies there, alone."""

from __future__ import annotations

import threading
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from slotwise.sources.staging import file_system

# A lease that was not renewed for this many seconds belongs to a driver that was lost.
STALE_SECONDS = 600.0
_POLL_SECONDS = 1.0


class LeaseHeld(RuntimeError):
    """Another run holds the lease."""


class LeaseLost(RuntimeError):
    """The lease was taken over by another run."""


class Lease:
    """A file with a name of its holder's own in it, made by a create that fails
    if there is one.

    The holder renews its time in the background. One that was not renewed for
    ``stale`` seconds is moved away before a new one is made, and only one of
    several runs can move it. With ``wait`` the lease of another run is waited for.
    """

    def __init__(self, spark: SparkSession, folder: str, stale: float = STALE_SECONDS, wait: float = 0.0):
        self._spark, self._stale, self._wait = spark, stale, wait
        self._path, self._files = file_system(spark, f"{folder}/_lease")
        if self._files.getScheme() == "file":
            self._files = self._files.getRawFileSystem()  # without a second file of checksums
        self.name = uuid.uuid4().hex
        self._done = threading.Event()

    def __enter__(self) -> Lease:
        until = time.monotonic() + self._wait
        while not self._taken():
            if time.monotonic() >= until:
                raise LeaseHeld(f"{self._path} is held by another run")
            time.sleep(min(_POLL_SECONDS, max(0.0, until - time.monotonic())))
        self._renewer = threading.Thread(target=self._renew, daemon=True)
        self._renewer.start()
        return self

    def __exit__(self, *_) -> None:
        self._done.set()
        self._renewer.join()
        if self._holder() == self.name:
            self._files.delete(self._path, False)
        folder = self._path.getParent()
        try:
            if not len(self._files.listStatus(folder)):
                self._files.delete(folder, False)
        except Py4JJavaError:
            pass  # another run has begun to use it, or removed it

    def check(self) -> None:
        """Raise if another run has taken the lease over; to be called before anything is changed for good."""
        if self._holder() != self.name:
            raise LeaseLost(f"{self._path} was taken over by another run")

    def _taken(self) -> bool:
        try:
            out = self._files.create(self._path, False)
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return self._moved_stale() and self._taken()
        out.write(bytearray(self.name, "ascii"))
        out.close()
        return self._holder() == self.name

    def _moved_stale(self) -> bool:
        try:
            age = time.time() - self._files.getFileStatus(self._path).getModificationTime() / 1000
            if age > self._stale:
                aside, _ = file_system(self._spark, f"{self._path}-{uuid.uuid4().hex}")
                if self._files.rename(self._path, aside):
                    self._files.delete(aside, False)
                    return True
        except Py4JJavaError as error:
            if "FileNotFound" not in error.java_exception.getClass().getName():
                raise
        return False

    def _holder(self) -> str | None:
        try:
            stream = self._files.open(self._path)
            try:
                return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "US-ASCII")
            finally:
                stream.close()
        except Py4JJavaError as error:
            if "FileNotFound" not in error.java_exception.getClass().getName():
                raise
            return None

    def _renew(self) -> None:
        while not self._done.wait(self._stale / 4):
            if self._holder() == self.name:
                self._files.setTimes(self._path, int(time.time() * 1000), -1)
