"""Versioned tables of Parquet segments with JSON metadata.

A table is a folder: `meta/NNNNNNNNNN.json`, the highest of which is current, and `data/<segment>/`, immutable folders of Parquet, which
metadata names by their place below the root, so that a renamed table's segments stay where they are. Appending adds a segment; renaming,
dropping, adding and dropping columns change metadata alone (columns keep their physical names; a dropped table has a last version that says
so); updates and deletes rewrite the files that hold touched rows, no others: a version lists the files of a segment that are gone.

A version is published by creating its file, which fails if another writer was first. Versions of several tables become current together:
they name a transaction, and count only once its file is there. `vacuum` deletes what no version that is kept refers to.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import Conflict, Exists, NotFound
from ..session import Files


#: Parquet codecs that stand for a table's data_compression.
CODECS = {"page": "zstd", "row": "snappy", "none": "uncompressed"}


@dataclass(frozen=True)
class Col:
    """A column. phys: its name in the files. identity: (seed, step). default: SQL of a value."""

    name: str
    type: str
    remote: str
    nullable: bool = True
    phys: str = ""
    collation: str | None = None
    length: int | None = None
    default: str | None = None
    identity: list[int] | None = None

    @property
    def field(self) -> T.StructField:
        return T.StructField(self.name, T._parse_datatype_string(self.type), self.nullable, {"remote_type": self.remote} | ({"collation": self.collation} if self.collation else {}))


@dataclass(frozen=True)
class Meta:
    """One version of a table, or of a view (sql)."""

    columns: list[Col]
    key: list[str] = field(default_factory=list)
    segments: list[str] = field(default_factory=list)
    rows: int = 0
    options: dict = field(default_factory=dict)
    next_identity: int | None = None
    sql: str | None = None
    version: int = 0
    gone: dict[str, list[str]] = field(default_factory=dict)
    dropped: bool = False
    txn: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([c.field for c in self.columns])

    def col(self, name: str) -> Col:
        for c in self.columns:
            if c.name.lower() == name.lower():
                return c
        raise NotFound(f"no column {name}")


def _load(text: str) -> Meta:
    d = json.loads(text)
    return Meta(**d | {"columns": [Col(**c) for c in d["columns"]]})


class Store:
    """Tables below a root folder, as schema/table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def path(self, schema: str, table: str) -> str:
        return f"{self.root}/{schema}/{table}"

    def schemas(self) -> list[str]:
        return [x for x in self.files.names(self.root) if not x.startswith((".", "_"))]

    def tables(self, schema: str) -> list[str]:
        return [x for x in self.files.names(f"{self.root}/{schema}") if self.current(schema, x) is not None]

    def _versions(self, schema: str, table: str) -> list[str]:
        return [x for x in self.files.names(f"{self.path(schema, table)}/meta") if x.endswith(".json")]

    def head(self, schema: str, table: str) -> Meta | None:
        """The last version that counts, that of a dropped table too."""
        for name in reversed(self._versions(schema, table)):
            m = _load(self.files.read(f"{self.path(schema, table)}/meta/{name}"))
            if m.txn is None or self.files.exists(f"{self.root}/_txn/{m.txn}"):
                return m
        return None

    def current(self, schema: str, table: str) -> Meta | None:
        m = self.head(schema, table)
        return None if m is None or m.dropped else m

    def publish(self, schema: str, table: str, meta: Meta, after: int) -> Meta:
        """Makes meta the version after `after` (0: the first)."""
        meta = replace(meta, version=after + 1)
        at = f"{self.path(schema, table)}/meta"
        self.files.make(at)
        try:
            self.files.create(f"{at}/{meta.version:010d}.json", json.dumps(asdict(meta)))
        except Exception as e:
            if "exist" in str(e).lower():
                raise (Conflict if after else Exists)(f"{schema}.{table}: another writer was first") from None
            raise
        return meta

    def publish_all(self, staged: dict[tuple[str, str], tuple[Meta, int]]) -> None:
        """Makes the versions of several tables current at once, or none."""
        if len(staged) <= 1:
            for at, (meta, after) in staged.items():
                self.publish(*at, replace(meta, txn=None), after)
            return
        txn, done = uuid.uuid4().hex, []
        try:
            for at, (meta, after) in staged.items():
                done.append((at, self.publish(*at, replace(meta, txn=txn), after).version))
        except Exception:
            for at, version in done:
                self.files.delete(f"{self.path(*at)}/meta/{version:010d}.json")
            raise
        self.files.make(f"{self.root}/_txn")
        self.files.create(f"{self.root}/_txn/{txn}", "")

    def create_schema(self, name: str) -> None:
        self.files.make(f"{self.root}/{name}")

    def drop(self, schema: str, table: str | None = None) -> None:
        self.files.delete(self.path(schema, table) if table else f"{self.root}/{schema}")

    def write(self, schema: str, table: str, columns: list[Col], df: DataFrame, writers: int = 0, flush_rows: int = 0, options: dict | None = None) -> tuple[str, int]:
        """Writes df, which has the columns in order, as a new segment; its name and rows.

        writers: so many tasks (0: df's partitions as they come). options: of the table: order within files, compression.
        """
        options = options or {}
        sort = options.get("clustered_index")
        segment = f"{schema}/{table}/data/{uuid.uuid4().hex}"
        out = df.toDF(*[c.phys for c in columns])
        if writers:
            out = out.repartition(writers)
        if sort:
            out = out.sortWithinPartitions(*[next(c.phys for c in columns if c.name.lower() == s.lower()) for s in sort])
        count = Observation(segment[-32:])
        writer = out.observe(count, F.count(F.lit(1)).alias("n")).write.mode("errorifexists")
        if codec := CODECS.get(options.get("data_compression")):
            writer = writer.option("compression", codec)
        (writer.option("maxRecordsPerFile", flush_rows) if flush_rows else writer).parquet(f"{self.root}/{segment}")
        return segment, int(count.get["n"])

    def drop_segment(self, segment: str) -> None:
        self.files.delete(f"{self.root}/{segment}")

    def data_files(self, segment: str) -> list[str]:
        return [x for x in self.files.names(f"{self.root}/{segment}") if x.endswith(".parquet")]

    def read(self, meta: Meta, segments: list[str] | None = None, tagged: bool = False, only: dict[str, list[str]] | None = None) -> DataFrame:
        """The rows of a version, of some of its segments, or of `only` some files of segments; tagged: with the file in _file."""
        use = only if only is not None else meta.segments if segments is None else segments
        phys = T.StructType([T.StructField(c.phys, T._parse_datatype_string(c.type)) for c in meta.columns])
        paths = []
        for s in use:
            if only is not None:
                paths += [f"{self.root}/{s}/{f}" for f in only[s]]
            elif s in meta.gone:
                paths += [f"{self.root}/{s}/{f}" for f in self.data_files(s) if f not in set(meta.gone[s])]
            else:
                paths.append(f"{self.root}/{s}")
        df = self.spark.read.schema(phys).parquet(*paths) if paths else self.spark.createDataFrame([], phys)
        cols = [F.col(f"`{c.phys}`").alias(c.name, metadata=c.field.metadata) for c in meta.columns]
        if not tagged:
            return df.select(*cols)
        parts = F.split(F.col("_metadata.file_path"), "/") if paths else F.lit(None).cast("array<string>")
        return df.select(*cols, F.struct(F.element_at(parts, -2).alias("segment"), F.element_at(parts, -1).alias("file")).alias("_file"))

    def vacuum(self, keep_versions: int = 1, older_than: float = 3600) -> int:
        """Deletes versions but the last that count, and what none of those kept refers to, if it is older than so many seconds; folders and files deleted."""
        used: dict[str, set[str]] = {}  # segment -> files of it that are gone in every version kept
        old: list[str] = []
        tables = [(s, t) for s in self.schemas() for t in self.files.names(f"{self.root}/{s}")]
        for s, t in tables:
            head = self.head(s, t)
            for name in self._versions(s, t):
                if head is None or int(name[:10]) > head.version:
                    continue  # of a transaction that is under way, or was broken off
                at = f"{self.path(s, t)}/meta/{name}"
                if int(name[:10]) <= head.version - keep_versions:
                    old.append(at)
                    continue
                m = _load(self.files.read(at))
                for x in m.segments:
                    gone = set(m.gone.get(x, ()))
                    used[x] = used[x] & gone if x in used else gone
        n = 0
        for s, t in tables:
            for x in self.files.names(f"{self.path(s, t)}/data"):
                segment = f"{s}/{t}/data/{x}"
                drop = [segment] if segment not in used else [f"{segment}/{f}" for f in used[segment]]
                for d in drop:
                    if self.files.exists(f"{self.root}/{d}") and self.files.age(f"{self.root}/{d}") >= older_than:
                        self.files.delete(f"{self.root}/{d}")
                        n += 1
        for at in old:
            self.files.delete(at)
        return n + len(old)


def columns_of(schema: T.StructType, describe) -> list[Col]:
    """Columns for a new table; describe(field) gives the remote type."""
    out = []
    for f in schema.fields:
        out.append(Col(f.name, f.dataType.simpleString(), describe(f), True, f"c{len(out)}_{uuid.uuid4().hex[:8]}", f.metadata.get("collation"), f.metadata.get("length"), f.metadata.get("default"), f.metadata.get("identity")))
    return out


def all_of(conditions: list) -> object:
    return reduce(lambda a, b: a & b, conditions)
