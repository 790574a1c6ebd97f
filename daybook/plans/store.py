"""Versioned tables with one small control file per version.

Tables with a voucher's ``guid`` are kept in parts: by the voucher's month, and in the month by a
hash of ``guid``. A change rewrites only the parts that its vouchers lie in; new rows of other parts
lie in a folder beside those that are there, and all other folders of the new version are those of
the old one. A version becomes visible when its control file is in place. Until then readers see the previous version, so a run that dies half-way leaves
nothing behind that anyone reads.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.lookup import input_bytes
from daybook.plans.books import Books
from daybook.plans.months import MONTH, is_dealt, placed
from daybook.plans.sinks import full_refresh, write_all
from daybook.session import compiled

PARTS = 16
#: Files that a table's new rows may be in without being gathered by part, and bytes that a task reads.
FILES, TASK_BYTES = 2000, 128 * 1024 * 1024
_BUCKET, _RUN = "_bucket", "_run"
_WHOLE = "-"
#: Between the name of a part and the run that added rows to it.
_ADDED = "+"


def _part(key: str) -> str:
    """The part that an entry of the control file belongs to."""
    return key.split(_ADDED)[0]


class Superseded(RuntimeError):
    """Another writer has published a version since the tables were read."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    state: dict[str, str] = field(default_factory=dict)
    tables: dict[str, dict] = field(default_factory=dict)  # schema, and folder by part


class Store:
    """``parts`` of a month are fixed by the first version; names with a leading ``_`` are no books.

    A part is named by month and bucket, ``202004-3``. Small books go ``by`` year.
    """

    def __init__(self, spark: SparkSession, folder: str, parts: int = PARTS, by: str = "month"):
        self.spark, self.folder, self.parts, self.by = spark, folder.rstrip("/"), parts, by
        compiled(spark)

    def placed(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        return placed(tables, self.by)

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *names]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *names: str) -> list[str]:
        path = self._path(*names)
        files = self._files()
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def drop(self, name: str) -> None:
        """Removes a folder of the store that no version names."""
        self._files().delete(self._path(name), True)

    def _controls(self) -> list[str]:
        return [n for n in self._names("control") if n.endswith(".json") and not n.startswith(".")]

    def _read(self, name: str) -> Version | None:
        stream = self._files().open(self._path("control", name))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return Version(**json.loads(text))
        except (ValueError, TypeError):  # torn: files come here whole, so nobody is writing it
            return None

    def head(self) -> Version:
        """The latest version; only its own control file is read."""
        for name in reversed(self._controls()):
            found = self._read(name)
            if found is not None:
                return found
        return Version()

    def bucket(self, guid: Column | str = "guid") -> Column:
        return F.pmod(F.xxhash64(guid), F.lit(self.parts)).cast("int")

    def parts_of(self, keys: DataFrame) -> set[str]:
        """The parts of the given guids and months: at most ``parts`` names a month."""
        found = keys.select(F.coalesce(MONTH, F.lit(0)).alias(MONTH), self.bucket().alias("b")).distinct().collect()
        return {f"{r[MONTH]}-{r.b}" for r in found}

    def undated_parts(self, keys: DataFrame) -> set[str]:
        """The parts that rows without a month and with the given guids lie in."""
        return self.parts_of(keys.select("guid", F.lit(0).alias(MONTH)))

    def rows(self, version: Version, name: str, parts: Collection[str] | None = None,
             months: bool = False) -> DataFrame | None:
        """A table, or some parts of it; None if the version does not have it.

        With ``months`` the month is a column, by which Spark skips whole folders.
        """
        if name not in version.tables:
            return None
        table = version.tables[name]
        schema = T.StructType.fromJson(table["schema"])
        paths = [p for k, p in table["parts"].items() if parts is None or k == _WHOLE or _part(k) in parts]
        if _WHOLE in table["parts"]:
            return self.spark.read.schema(schema).parquet(*paths)
        kept = [*schema.names, MONTH] if months else list(schema.names)
        schema = schema.add(MONTH, T.IntegerType()).add(_BUCKET, T.IntegerType()).add(_RUN, T.StringType())
        if not paths:
            # a constant: the optimiser leaves it out of unions, where rows from Python would be a stage of tasks
            return self.spark.range(0).where(F.lit(False)).select(
                *[F.lit(None).cast(schema[c].dataType).alias(c) for c in kept])
        return (self.spark.read.schema(schema).option("basePath", f"{self.folder}/tables/{name}")
                .parquet(*paths).select(*kept))

    def writes_few(self, docs: DataFrame, parts: int) -> bool:
        """Whether tasks that read the stored ``docs`` write few files though each writes all ``parts``."""
        tasks = max(self.spark.sparkContext.defaultParallelism, input_bytes(docs) // TASK_BYTES + 1)
        return tasks * parts <= FILES

    def scattered(self, version: Version, name: str, most: int) -> set[str]:
        """The parts of a table that lie in ``most`` folders or more."""
        held = Counter(map(_part, version.tables[name]["parts"])) if name in version.tables else {}
        return {p for p, n in held.items() if n >= most}

    def columns(self, version: Version, name: str) -> list[str] | None:
        """The columns of a table, from the control file; None if the version does not have it."""
        return [f["name"] for f in version.tables[name]["schema"]["fields"]] if name in version.tables else None

    def books(self, version: Version | None = None, parts: Collection[str] | None = None, months: bool = False) -> Books:
        """The tables of a version, of the latest one unless given."""
        version = version or self.head()

        def reader(name: str):
            return lambda: self.rows(version, name, parts, months)

        return Books(self.spark, {n: reader(n) for n in version.tables if not n.startswith("_")})

    def state(self) -> dict[str, str]:
        """Run state of the latest version."""
        return self.head().state

    def commit(self, tables: Mapping[str, DataFrame], state: Mapping[str, str] | None = None,
               parts: Collection[str] | Mapping[str, Collection[str]] | None = None,
               base: Version | None = None, ungathered: Collection[str] = ()) -> dict[str, int]:
        """Write ``tables`` as the next version; tables not given keep their files.

        With ``parts``, of all tables or by table, they hold the whole rows of these parts, and the
        other parts stay; rows they hold of other parts are added to what is there.
        ``base`` is the version the tables were derived from; if another one has been published
        since, nothing becomes visible. Lines without a month take that of their header in
        ``tables``. Rows of a part are gathered before they are written, except of the tables named in
        ``ungathered``: there each task writes its own rows of every part. Returns the rows written per table.
        """
        base = base or self.head()
        run = f"{base.number + 1:012d}-{uuid.uuid4().hex[:8]}"
        tables = self.placed(tables)
        split = {n for n, df in tables.items() if is_dealt(n, df)}
        dealt = {n: df.withColumn(_BUCKET, self.bucket()) if n in split else df for n, df in tables.items()}
        dealt |= {n: dealt[n].hint("rebalance", MONTH, _BUCKET) for n in split - set(ungathered)}
        rows = write_all(dealt, lambda name, df: full_refresh(
            df, f"{self.folder}/data/{run}/{name}", [MONTH, _BUCKET] if name in split else None))
        entries = dict(base.tables)
        for name, df in tables.items():
            if name in split:
                own = parts.get(name) if isinstance(parts, Mapping) else parts
                kept = entries.get(name, {"parts": {}})["parts"] if own is not None else {}
                found = {k: p for k, p in kept.items() if _part(k) not in own}
                there = {_part(k) for k in found}
                found.update((f"{k}{_ADDED}{run}" if k in there else k, p) for k, p in self._moved(run, name).items())
                schema = T.StructType([f for f in df.schema.fields if f.name != MONTH])
            else:
                found, schema = {_WHOLE: f"{self.folder}/data/{run}/{name}"}, df.schema
            entries[name] = {"schema": json.loads(schema.json()), "parts": found}
        if split == set(tables):
            self._files().delete(self._path("data", run), True)
        self._publish(Version(base.number + 1, {**base.state, **(state or {})}, entries))
        return rows

    def _moved(self, run: str, name: str) -> dict[str, str]:
        """The run's parts of a table, put where readers find them below the table's folder."""
        files, found = self._files(), {}
        for status in files.globStatus(self._path("data", run, name, f"{MONTH}=*", f"{_BUCKET}=*")) or []:
            month, bucket = str(status.getPath()).split("/")[-2:]
            place = ["tables", name, month, bucket]
            files.mkdirs(self._path(*place))
            files.rename(status.getPath(), self._path(*place, f"{_RUN}={run}"))
            found[f"{month.split('=')[1]}-{bucket.split('=')[1]}"] = "/".join([self.folder, *place, f"{_RUN}={run}"])
        return found

    def _publish(self, version: Version) -> None:
        """The control file is written aside and then put in place, never over another one."""
        if self.head().number != version.number - 1:
            raise Superseded(f"version {version.number} is there already")
        name, hadoop = f"{version.number:012d}.json", self.spark._jvm.org.apache.hadoop.fs
        path, aside = self._path("control", name), self._path("control", f".{uuid.uuid4().hex}")
        out = self._files().create(aside, False)
        try:
            out.write(bytearray(json.dumps(
                {"number": version.number, "state": version.state, "tables": version.tables}).encode()))
        finally:
            out.close()
        if name in self._controls() and self._read(name) is None:  # a torn file of an earlier crash
            self._files().rename(path, self._path("control", f".torn-{uuid.uuid4().hex}"))
        kind = getattr(hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        try:
            hadoop.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration()).rename(aside, path, how)
        except Exception as e:
            self._files().delete(aside, False)
            raise Superseded(f"version {version.number} is there already") from e

    def forget(self, keep: int = 2) -> int:
        """Remove all but the last ``keep`` versions and every file none of those needs.

        Not to be called while a run is writing. Returns the folders removed.
        """
        files = self._files()
        names = self._controls()
        versions = [v for v in map(self._read, names[-keep:]) if v is not None]
        used = {p.removeprefix(f"{self.folder}/") for v in versions for t in v.tables.values() for p in t["parts"].values()}
        for name in names[:-keep]:
            files.delete(self._path("control", name), False)
        runs = {"/".join(p.split("/")[:2]) for p in used}
        old = [f"data/{n}" for n in self._names("data") if f"data/{n}" not in runs]
        for status in files.globStatus(self._path("tables", "*", f"{MONTH}=*", f"{_BUCKET}=*", f"{_RUN}=*")) or []:
            place = "/".join(str(status.getPath()).split("/")[-5:])
            if place not in used:
                old.append(place)
        for place in old:
            files.delete(self._path(place), True)
        return len(old)
