"""Sessions with the settings this engine's semantics rest on, and a shared place for what it writes."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

#: ANSI: overflow and bad casts raise. UTC: instants have no session zone. TIME: a type of its own.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
#: For sessions built here alone: checkpoints go when nothing refers to them any more.
_BUILT = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
_own: dict[str, str] = {}


def build(master: str | None = None, **more: str) -> SparkSession:
    b = SparkSession.builder.config(map=SETTINGS | _BUILT | more)
    return (b.master(master) if master else b).getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Puts SETTINGS into a session that someone else has built."""
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def fresh_dir(spark: SparkSession, name: str = "work") -> str:
    """A new folder's URI: below spark.checkpoint.dir, which all machines share, or a local one where that is unset."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        app = spark.sparkContext.applicationId
        root = _own.setdefault(app, "file://" + tempfile.mkdtemp(prefix="lakeferry-"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Files:
    """The few file operations of the store, through Spark's own file systems."""

    def __init__(self, spark: SparkSession):
        self.spark, self.jvm, self.conf = spark, spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, uri: str):
        path = self.jvm.org.apache.hadoop.fs.Path(uri)
        return path.getFileSystem(self.conf), path

    def exists(self, uri: str) -> bool:
        fs, p = self._at(uri)
        return fs.exists(p)

    def names(self, uri: str) -> list[str]:
        fs, p = self._at(uri)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def age(self, uri: str) -> float:
        """Seconds since the file or folder was last changed."""
        fs, p = self._at(uri)
        return time.time() - fs.getFileStatus(p).getModificationTime() / 1000

    def make(self, uri: str) -> None:
        fs, p = self._at(uri)
        fs.mkdirs(p)

    def read(self, uri: str) -> str:
        fs, p = self._at(uri)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, uri: str, text: str) -> None:
        """Writes a file that must not exist yet; of two writers one fails, and no reader sees a part of it.

        The text goes to a name of its own first, which is then moved without overwriting: HDFS does that at once, and so does a
        hard link on a local disk. Stores without such a move need a lock around writers.
        """
        fs, p = self._at(uri)
        own = f"{uri}.{uuid.uuid4().hex}.part"
        out = fs.create(self._at(own)[1], False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if fs.getScheme() == "file":
                local = [self._at(x)[1].toUri().getPath() for x in (own, uri)]
                os.link(*local)
            else:
                none = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
                options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
                options[0] = none
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.conf).rename(self._at(own)[1], p, options)
        finally:
            self.delete(own)

    def delete(self, uri: str) -> None:
        fs, p = self._at(uri)
        fs.delete(p, True)

    def rename(self, a: str, b: str) -> None:
        fs, p = self._at(a)
        if not fs.rename(p, self._at(b)[1]):
            raise OSError(f"can't rename {a} to {b}")
