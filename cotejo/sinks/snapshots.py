"""A history table whose appends are all or nothing.

``root/data/batch=<id>`` holds the rows of one append, by snapshot. ``root/log/<version>.json`` names one of these folders:
an append writes its folder first and then publishes its entry by one rename that fails where the version exists. Readers
see the folders of published entries only, so a job that dies on the way, at whatever task, leaves them on the old
snapshot and nothing but an unread folder behind. Entries remember the id of the batch: a batch that is given again, after a
crash or by a stream that repeats its last step, adds nothing. Two writers that start from one version both want the
next one; the second to publish fails with ``CommitConflict`` and has changed nothing.

With ``buckets`` the rows of an append lie in folders by a hash of their key, and ``root/keys/batch=<id>`` holds bitmaps of the
keys (``operators/membership.py``), written before the entry. An append then asks the bitmaps first and reads only the
buckets that may hold one of its keys: for a batch of new keys next to nothing. Entries say how their rows were
indexed, so appends with and without an index, or with other buckets, live in one table.

Entries also hold the newest snapshot of their rows, counted by the write itself. With ``sums`` every append leaves its amounts
by snapshot, status and day in ``root/sums/batch=<id>``; reports on ``summaries`` read these rows only.

The rename is the file system's own: atomic on HDFS and on object stores with conditional writes. A local disk checks for
the target first, which is enough for tests on one machine.
"""

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from cotejo.operators.history import check_key, latest_snapshot, new_rows, only_between
from cotejo.operators.membership import Shape, bitmaps, parts_that_may_hold
from cotejo.operators.report import partial_sums
from cotejo.operators.setops import union_by_name

LOG = "version bigint, batch_id string, folder string, rows bigint, schema string, index struct<key: array<string>, buckets: int, chunks: bigint>, newest string, sums string"
BATCH, BUCKET = "batch", "key_bucket"  # folders by these, so no column may be called so
MARKED = f"buckets int, chunks bigint, bucket int, chunk bigint, bitmap binary, {BATCH} string"


class CommitConflict(RuntimeError):
    """Another writer published the version this append was made for."""


@dataclass(frozen=True)
class HistoryTable:
    """A history under ``root``, its rows in folders by ``partition`` where they have that column."""

    spark: SparkSession
    root: str
    partition: str = "file_date"
    buckets: int = 0  # folders by key hash in every append and snapshot; none without an index
    sums: Mapping[str, str] | None = None  # arguments of report.partial_sums, {} for its defaults; none without sums

    def commits(self) -> list[dict]:
        """Published entries in the order of their versions, one small row per append."""
        if not self._exists(f"{self.root}/log"):
            return []
        return [r.asDict() for r in self.spark.read.schema(LOG).json(f"{self.root}/log").orderBy("version").collect()]

    def read(self, version: int | None = None) -> DataFrame | None:
        """Rows as of a version (by default the newest), None before the first append."""
        entries = [e for e in self.commits() if version is None or e["version"] <= version]
        return self._rows(entries) if entries else None

    def append(self, batch: DataFrame, key: Sequence[str], batch_id: str, order: Sequence = ("_row_no",), keep: str = "last") -> bool:
        """Publish the batch's rows whose keys the table lacks; False where a batch of this id was published before.

        Order columns that begin with an underscore aren't stored. Columns the batch lacks are NULL; columns that the table
        lacks are an error. Like every insert it reads the keys of the snapshots between the batch's first and last only, and of
        indexed appends only the buckets of ``holding``. A batch with a long plan should be stored first: its keys are read for
        the bounds and for the index, too.
        """
        entries = self.commits()
        if any(e["batch_id"] == batch_id for e in entries):
            return False
        names = check_key(batch, key)
        hidden = [c for c in order if isinstance(c, str) and c.startswith("_")]
        schema = batch.drop(*hidden).schema
        if reserved := {BATCH, BUCKET} & {n.lower() for n in schema.names}:
            raise ValueError(f"names of folders can't be columns: {sorted(reserved)}")
        if entries:
            schema = StructType.fromJson(json.loads(entries[-1]["schema"]))
            unknown = [c for c in batch.columns if c not in hidden and c not in schema.names]
            if unknown:
                raise ValueError(f"columns that the table {self.root} lacks: {unknown}")
            target = self._holding(entries, batch, names)
        else:
            target = self.spark.createDataFrame([], schema)
        rows = new_rows(target, batch, key, order, keep).drop(*hidden)
        rows = rows.select(*[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        folder, seen = f"{BATCH}={uuid.uuid4().hex}", Observation()
        by = [self.partition] if self.partition in schema.names else []
        if self.buckets:
            by.append(BUCKET)
            rows = rows.withColumn(BUCKET, Shape(self.buckets).bucket(sorted(names))).hint("rebalance", *by)
        newest = F.max(self.partition if self.partition in schema.names else F.lit(None)).cast("string")
        rows.observe(seen, F.count(F.lit(1)).alias("rows"), newest.alias("newest")).write.partitionBy(*by).parquet(f"{self.root}/data/{folder}")
        version = entries[-1]["version"] + 1 if entries else 0
        entry = {"version": version, "batch_id": batch_id, "folder": folder, "rows": seen.get["rows"], "schema": schema.json(), "index": None, "newest": seen.get["newest"]}
        if self.buckets:
            shape = Shape.of(self.buckets, entry["rows"])
            entry["index"] = {"key": sorted(names), "buckets": shape.buckets, "chunks": shape.chunks}
            bitmaps(self._rows([entry]), sorted(names), shape).write.parquet(f"{self.root}/keys/{folder}")
        if self.sums is not None:
            entry["sums"] = self._spec()
            self._summed([entry]).write.parquet(f"{self.root}/sums/{folder}")
        self._publish(entry)
        return True

    def latest(self) -> DataFrame | None:
        """Rows of the newest snapshot; the log says which one it is, so no row is read to find it. None before the first append."""
        entries = self.commits()
        if not entries:
            return None
        read = self._rows(entries)
        seen = {e["newest"] for e in entries if e["rows"]}
        if not seen or None in seen:  # no rows, or entries that don't say
            return latest_snapshot(read, self.partition)
        kind = read.schema[self.partition].dataType
        return read.filter(F.col(self.partition) == F.array_max(F.array(*[F.lit(at).cast(kind) for at in sorted(seen)])))

    def summaries(self) -> DataFrame | None:
        """Amounts by snapshot, status and day, in parts that add up; rows are read only of appends that left no such sums."""
        entries = self.commits()
        if not entries:
            return None
        own = [e for e in entries if self.sums is not None and e["sums"] == self._spec()]
        rest = [e for e in entries if e not in own]
        parts = [self._summed(rest)] if rest else []
        if own:
            kept = self._summed([own[-1]]).schema
            parts.append(self.spark.read.schema(kept).parquet(*[f"{self.root}/sums/{e['folder']}" for e in own]))
        return union_by_name(parts)

    def _spec(self) -> str:
        return json.dumps(dict(self.sums or {}), sort_keys=True)

    def _summed(self, entries: list[dict]) -> DataFrame:
        return partial_sums(self._rows(entries), **{"snapshot": self.partition, **(self.sums or {})})

    def holding(self, batch: DataFrame, key: Sequence[str]) -> DataFrame | None:
        """Rows of the snapshots, and among indexed appends of the buckets, that may hold a key of the batch; None before the first append."""
        entries = self.commits()
        return self._holding(entries, batch, check_key(batch, key)) if entries else None

    def unread(self) -> list[str]:
        """Folders that no entry names: of appends that failed, or of one that is still being written."""
        if not self._exists(f"{self.root}/data"):
            return []
        path = self._path(f"{self.root}/data")
        found = [status.getPath().getName() for status in self._system(path).listStatus(path)]
        return sorted(set(found) - {e["folder"] for e in self.commits()})

    def _holding(self, entries: list[dict], batch: DataFrame, names: list[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(entries[-1]["schema"]))
        key = sorted(names)
        indexed = [e for e in entries if e["rows"] and e["index"] and e["index"]["key"] == key]
        places: dict[str, list[int]] = {}
        if indexed:
            folders = [f"{self.root}/keys/{e['folder']}" for e in indexed]
            marked = self.spark.read.schema(MARKED).option("basePath", f"{self.root}/keys").parquet(*folders)
            keys = batch.select(*[F.col(f"`{n}`").cast(schema[n].dataType).alias(n) for n in key])
            shapes = [Shape(e["index"]["buckets"], e["index"]["chunks"]) for e in indexed]
            for row in parts_that_may_hold(keys, key, marked, shapes, BATCH).collect():  # folders, no more than a file listing has
                places.setdefault(f"{BATCH}={row[BATCH]}", []).append(row["bucket"])
        left = [e for e in entries if e not in indexed or e["folder"] in places]
        read = self._rows(left, schema, places)
        return only_between(read, batch, self.partition) if self.partition in names else read

    def _rows(self, entries: list[dict], schema: StructType | None = None, places: dict[str, list[int]] | None = None) -> DataFrame:
        """Rows of these appends; of those that ``places`` names, in these buckets only."""
        schema = schema or StructType.fromJson(json.loads(entries[-1]["schema"]))
        # An append without new rows has written a folder without files. Folders with and without buckets are two reads.
        parts = [[e for e in entries if e["rows"] and bool(e["index"]) == bucketed] for bucketed in (False, True)]
        reads = [self._folders(part, schema, bool(at), places or {}) for at, part in enumerate(parts) if part]
        if not reads:
            return self.spark.createDataFrame([], schema)
        return reads[0] if len(reads) == 1 else reads[0].unionAll(reads[1])

    def _folders(self, entries: list[dict], schema: StructType, bucketed: bool, places: dict[str, list[int]]) -> DataFrame:
        kept = StructType(list(schema.fields)).add(BATCH, StringType())
        if bucketed:
            kept = kept.add(BUCKET, IntegerType())
        read = self.spark.read.schema(kept).option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/data/{e['folder']}" for e in entries])
        asked = {e["folder"].split("=")[1]: places[e["folder"]] for e in entries if e["folder"] in places}
        if asked:
            whole = [e["folder"].split("=")[1] for e in entries if e["folder"] not in places]
            wanted = [(F.col(BATCH) == batch) & F.col(BUCKET).isin(*sorted(buckets)) for batch, buckets in sorted(asked.items())]
            read = read.where(reduce(or_, wanted, F.col(BATCH).isin(*whole)) if whole else reduce(or_, wanted))
        return read.select(*[F.col(f"`{name}`") for name in schema.names])

    def _publish(self, entry: dict) -> None:
        target = self._path(f"{self.root}/log/{entry['version']:020d}.json")
        draft = self._path(f"{self.root}/log/.{uuid.uuid4().hex}")
        out = self._system(draft).create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        gateway, files = self.spark.sparkContext._gateway, self.spark._jvm.org.apache.hadoop.fs
        choices = getattr(files, "Options$Rename")
        context = files.FileContext.getFileContext(target.toUri(), self._settings())
        try:
            context.rename(draft, target, gateway.new_array(choices, 0))
        except Py4JJavaError as error:
            self._system(draft).delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise CommitConflict(f"version {entry['version']} of {self.root} exists") from error
            raise

    def _settings(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self._settings()).makeQualified(found)

    def _system(self, path):
        return path.getFileSystem(self._settings())

    def _exists(self, path: str) -> bool:
        return self._system(self._path(path)).exists(self._path(path))
