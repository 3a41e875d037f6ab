"""A published layer: tables as immutable Parquet writes, and versions that
name them.

```
<layer>/<table>/write=<id>/[partition=…/]part-*.parquet    rows, never changed
<layer>/_files/<table>-<id>/                               the files of one version of a table
<layer>/_keys/<table>-<id>/                                key summaries of one write
<layer>/_versions/<number>.json                            the pointer, written last
```

Readers resolve the highest version and see all its tables as they were
committed together.  A writer stages everything under new names, runs its
checks on the staged tables, and commits by creating the next pointer, which
either appears whole or not at all; whatever an interrupted writer staged is
named by no version and goes with the next ``retire``.  A layer has one writer
at a time: a second one that commits the same number gets an error.

``Change.merge`` and ``Change.replace`` write only the files that may hold a
changed key.  Each write keeps, per file and cell of keys, the smallest and
greatest key and a Bloom bitmap, all built by aggregation over the file's key
columns.  A cell is a coarse function of the key (a game id's season, an
order number's thousands): files are cut along it, and changed keys meet by an
equi-join only the files that hold their cell.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.latest import OrderSpec, latest_per_key
from tierline.session import ensure_checkpoint_dir
from tierline.sinks import storage

#: Bits of one bitmap segment, as Spark's bitmap functions have them.
SEGMENT = 32768
#: Bits per key and positions per key of the Bloom bitmaps.
BITS, POSITIONS = 8, 2
FILES = "path string, write string, n_rows long"


@dataclass(frozen=True)
class TableSpec:
    """How a table is laid out: the key columns changes are found by, the
    partition folders, and the cell of a key as an SQL expression."""

    key: list[str]
    partition_by: list[str] = field(default_factory=list)
    cell: str | None = None
    rows_per_file: int = 1_000_000

    def cell_column(self) -> Column:
        return (F.expr(self.cell) if self.cell else F.lit("")).cast("string")


@dataclass(frozen=True)
class MergeReport:
    files: int
    files_read: int

    @property
    def files_kept(self) -> int:
        return self.files - self.files_read


def _hash(cols: Sequence[str | Column], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def _probes(key: Sequence[str], segments: Column) -> tuple[Column, list[Column]]:
    """Segment of a key and its positions there."""
    return (F.pmod(_hash(key, 0), segments).alias("segment"),
            [F.pmod(_hash(key, i + 1), F.lit(SEGMENT)) for i in range(POSITIONS)])


def _bit(bits: str, position: str) -> Column:
    return F.expr(f"(cast(conv(hex(substring({bits}, cast({position} div 8 as int) + 1, 1)), 16, 10) as int) "
                  f">> cast({position} % 8 as int)) & 1") == 1


def key_summary(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Per (path, cell, segment) of ``rows(path, key…)``: the smallest and
    greatest key of the file in the cell, and the bitmap of its keys.  The
    number of segments grows with the keys of the file in the cell."""
    cell = spec.cell_column().alias("cell")
    ends = F.struct(*spec.key)
    keys = rows.select("path", cell, *spec.key).distinct()
    per = keys.groupBy("path", "cell").agg(F.min(ends).alias("lo"), F.max(ends).alias("hi"), F.count(F.lit(1)).alias("n"))
    # a power of two, so that few different numbers of segments are in use
    per = per.withColumn("segments", F.pow(2, F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n") * BITS / SEGMENT)))).cast("long"))
    p, c = F.col("path"), F.col("cell")
    sized = keys.join(per.select(p.alias("p"), c.alias("c"), "segments"), (p == F.col("p")) & c.eqNullSafe(F.col("c"))).drop("p", "c")
    segment, at = _probes(spec.key, F.col("segments"))
    bits = (sized.select("path", "cell", segment, F.explode(F.array(*at)).alias("at"))
            .groupBy("path", "cell", "segment").agg(F.expr("bitmap_construct_agg(at)").alias("bits")))
    per = per.withColumnsRenamed({"path": "p", "cell": "c"}).drop("n")
    return bits.join(per, (p == F.col("p")) & c.eqNullSafe(F.col("c"))).drop("p", "c")


class Layer:
    """A layer's committed versions."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ versions
    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in storage.names(self.spark, f"{self.path}/_versions") if n.endswith(".json"))

    def pointer(self, version: int | None = None) -> dict:
        """The version's pointer (the newest by default); no tables where
        nothing has been committed."""
        known = self.versions()
        version = version if version is not None else (known[-1] if known else 0)
        if version == 0:
            return {"version": 0, "tables": {}, "notes": {}}
        if version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        return json.loads(storage.read_text(self.spark, f"{self.path}/_versions/{version:020d}.json"))

    def version(self) -> int:
        return max(self.versions(), default=0)

    def tables(self, version: int | None = None) -> list[str]:
        return sorted(self.pointer(version)["tables"])

    def note(self, name: str):
        return self.pointer()["notes"].get(name)

    # ------------------------------------------------------------ reading
    def files(self, table: str, version: int | None = None) -> DataFrame:
        return self._files(self.pointer(version)["tables"][table])

    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self._read(table, self.pointer(version)["tables"][table])

    def _files(self, entry: dict) -> DataFrame:
        return self.spark.read.schema(FILES).parquet(f"{self.path}/{entry['files']}")

    def _schema(self, entry: dict) -> T.StructType:
        return T.StructType.fromJson(entry["schema"])

    def _read(self, table: str, entry: dict, only: DataFrame | None = None) -> DataFrame:
        """Rows of the files ``only`` lists (all of the version's by default).
        A write all of whose files are wanted is named by its folder, so the
        driver holds paths of partly replaced writes only."""
        files = only if only is not None else self._files(entry)
        per = {r["write"]: r.n for r in files.groupBy("write").agg(F.count(F.lit(1)).alias("n")).collect()}
        whole = [w for w, n in per.items() if n == entry["writes"].get(w)]
        paths = [f"{self.path}/{table}/write={w}" for w in whole]
        if len(whole) < len(per):
            paths += [f"{self.path}/{table}/{unquote(r.path)}" for r in files.where(~F.col("write").isin(whole)).select("path").collect()]
        return self._scan(table, self._schema(entry), paths)

    def _scan(self, table: str, schema: T.StructType, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        wide = T.StructType([*schema.fields, T.StructField("write", T.StringType())])
        rows = self.spark.read.schema(wide).option("basePath", f"{self.path}/{table}").parquet(*paths)
        # a scan drops the metadata of partition columns
        return rows.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) if f.metadata else F.col(f.name) for f in schema.fields])

    # ------------------------------------------------------------ writing
    def begin(self) -> Change:
        return Change(self)

    def retire(self, keep: int = 2) -> None:
        """Remove all versions but the newest ``keep``, and every folder that
        none of those names.  A pointer goes before the files it names."""
        known = self.versions()
        for v in known[:-keep]:
            storage.delete(self.spark, f"{self.path}/_versions/{v:020d}.json")
        held = [self.pointer(v) for v in known[-keep:]]
        entries = [(t, e) for p in held for t, e in p["tables"].items()]
        used = {"_files": {e["files"].split("/")[-1] for _, e in entries},
                "_keys": {f"{t}-{w}" for t, e in entries for w in e["writes"]}}
        for kind, keep_names in used.items():
            for n in storage.names(self.spark, f"{self.path}/{kind}"):
                if n not in keep_names:
                    storage.delete(self.spark, f"{self.path}/{kind}/{n}")
        for t in storage.names(self.spark, self.path):
            if t.startswith("_"):
                continue
            live = {f"write={w}" for t2, e in entries if t2 == t for w in e["writes"]}
            for n in storage.names(self.spark, f"{self.path}/{t}"):
                if n not in live:
                    storage.delete(self.spark, f"{self.path}/{t}/{n}")


class Change:
    """The next version of a layer, until ``commit``."""

    def __init__(self, layer: Layer):
        self.layer, self.spark = layer, layer.spark
        ensure_checkpoint_dir(self.spark)
        base = layer.pointer()
        self.base = base["version"]
        self.entries: dict[str, dict] = dict(base["tables"])
        self.notes: dict = dict(base["notes"])
        self.staged: list[str] = []

    def frame(self, table: str) -> DataFrame:
        """The table as it will be after the commit."""
        return self.layer._read(table, self.entries[table])

    def spec(self, table: str) -> TableSpec:
        return TableSpec(**self.entries[table]["spec"])

    def _write(self, table: str, df: DataFrame, spec: TableSpec) -> tuple[str, DataFrame]:
        """Write the rows and their key summaries; the write's id and files."""
        write = uuid.uuid4().hex
        root = f"{self.layer.path}/{table}"
        self.staged += [f"{table}/write={write}", f"_keys/{table}-{write}"]
        order = [*[F.col(c) for c in spec.partition_by], *([spec.cell_column()] if spec.cell else []), *[F.col(c) for c in spec.key]]
        w = (df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", spec.rows_per_file))
        (w.partitionBy(*spec.partition_by) if spec.partition_by else w).parquet(f"{root}/write={write}")
        full = T.StructType([*df.schema.fields, T.StructField("write", T.StringType())])
        written = self.spark.read.schema(full).option("basePath", root).parquet(f"{root}/write={write}")
        file = F.col("_metadata.file_path")

        def path(file: Column) -> Column:
            return F.concat(F.lit(f"write={write}/"), F.substring_index(file, f"/{table}/write={write}/", -1)).alias("path")

        key_summary(written.select(path(file), *spec.key), spec).write.parquet(f"{self.layer.path}/_keys/{table}-{write}")
        files = written.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
        return write, files.select(path(F.col("file")), F.lit(write).alias("write"), "n_rows")

    def _list(self, table: str, files: DataFrame, schema: T.StructType, spec: TableSpec, writes: dict[str, int]) -> None:
        name = f"_files/{table}-{uuid.uuid4().hex}"
        self.staged.append(name)
        files.select("path", "write", "n_rows").write.parquet(f"{self.layer.path}/{name}")
        listed = self.spark.read.schema(FILES).parquet(f"{self.layer.path}/{name}")
        # a row per write still in use
        counts = {r["write"]: r.n for r in listed.groupBy("write").agg(F.count(F.lit(1)).alias("n")).collect()}
        plain = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
        self.entries[table] = {"files": name, "schema": plain.jsonValue(), "spec": spec.__dict__,
                               "writes": {w: writes.get(w, n) for w, n in counts.items()}}

    def put(self, table: str, df: DataFrame, spec: TableSpec) -> None:
        """The whole table anew.  An empty one has no files."""
        _, files = self._write(table, df, spec)
        self._list(table, files, df.schema, spec, {})

    def touched(self, table: str, keys: DataFrame) -> DataFrame:
        """Files of the table that may hold one of the keys."""
        entry, spec = self.entries[table], self.spec(table)
        files = self.layer._files(entry)
        if not entry["writes"]:
            return files
        schema = self.layer._schema(entry)
        wanted = keys.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in spec.key]).distinct()
        wanted = wanted.withColumn("cell", spec.cell_column())
        summary = self.spark.read.parquet(*[f"{self.layer.path}/_keys/{table}-{w}" for w in entry["writes"]])
        # few: powers of two up to the greatest number of keys a file holds in a cell
        sizes = [r.segments for r in summary.select("segments").distinct().collect()]
        segment, at = _probes(spec.key, F.col("segments"))
        probes = (wanted.withColumn("segments", F.explode(F.array(*[F.lit(s) for s in sizes])))
                  .select(F.struct(*spec.key).alias("k"), "cell", "segments", segment, *[a.alias(f"at{i}") for i, a in enumerate(at)]))
        s = summary.withColumnsRenamed({"cell": "c", "segments": "ss", "segment": "sg"})
        hit = probes.join(s, F.col("cell").eqNullSafe(F.col("c")) & (F.col("segments") == F.col("ss")) & (F.col("segment") == F.col("sg")))
        hit = hit.where((F.col("k") >= F.col("lo")) & (F.col("k") <= F.col("hi")))
        for i in range(POSITIONS):
            hit = hit.where(_bit("bits", f"at{i}"))
        return files.join(hit.select("path").distinct(), "path", "left_semi")

    def rows_of(self, table: str, keys: DataFrame, touched: DataFrame | None = None) -> DataFrame:
        """The table's rows with one of the keys, from the files that may hold them."""
        spec = self.spec(table)
        rows = self.layer._read(table, self.entries[table], touched if touched is not None else self.touched(table, keys))
        return _meeting(rows, keys, spec.key, "left_semi")

    def replace(self, table: str, keys: DataFrame, rows: DataFrame, touched: DataFrame | None = None) -> MergeReport:
        """Put ``rows`` in place of all rows that have one of ``keys``."""
        entry, spec = self.entries[table], self.spec(table)
        schema = self.layer._schema(entry)
        hit = (touched if touched is not None else self.touched(table, keys)).checkpoint()
        stay = _meeting(self.layer._read(table, entry, hit), keys, spec.key, "left_anti")
        write, new = self._write(table, stay.unionByName(rows.select(*schema.names)), spec)
        files = self.layer._files(entry)
        report = MergeReport(files.count(), hit.count())
        self._list(table, files.join(hit.select("path"), "path", "left_anti").unionByName(new), schema, spec, entry["writes"])
        return report

    def merge(self, table: str, rows: DataFrame, keys: Sequence[str], order: OrderSpec) -> MergeReport:
        """Latest-wins merge on ``keys``, which begin with the table's key
        columns: equals a refresh over old and new rows together.  ``rows``
        should be materialised; they are read several times."""
        spec = self.spec(table)
        changed = rows.select(*spec.key).distinct().checkpoint()
        touched = self.touched(table, changed).checkpoint()
        old = self.rows_of(table, changed, touched)
        new = latest_per_key(old.unionByName(rows.select(*old.columns)), keys, order)
        return self.replace(table, changed, new, touched)

    def commit(self, **notes) -> int:
        """Make the staged tables the newest version; its number."""
        self.notes |= notes
        version = self.base + 1
        body = {"version": version, "tables": self.entries, "notes": self.notes}
        storage.publish_text(self.spark, f"{self.layer.path}/_versions/{version:020d}.json", json.dumps(body))
        return version

    def abort(self) -> None:
        """Remove what has been staged."""
        for name in self.staged:
            storage.delete(self.spark, f"{self.layer.path}/{name}")


def _meeting(rows: DataFrame, keys: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join where null keys are equal too."""
    k = keys.select(*[F.col(c).cast(rows.schema[c].dataType).alias(f"__k_{c}") for c in on]).distinct()
    cond = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in on]
    return rows.join(k, cond, how)
