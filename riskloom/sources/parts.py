"""Sets of tables kept in parts, changed part by part and committed by one manifest.

A part (a month, a year, a bucket of keys) lies in a folder of the run that wrote it:
`data/table=<name>/run=<run>/part=<part>`. The newest manifest says which run's folder counts
for each part. A run writes the parts it changes into its own folders and nothing else, then adds
one manifest; so readers and later runs see either all its changes or none, a lost run leaves
folders that don't count, and a repeated run overwrites its own. Parts that no kept manifest
names are removed afterwards.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from riskloom.functions import fixed
from riskloom.sources import paths
from riskloom.sources.sinks import balanced

PART = "part"


@dataclass
class Manifest:
    """Folders that count: table -> part -> run; schemas of the tables; notes of the run."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)

    def next(self) -> Manifest:
        """A copy for the next run to change."""
        return Manifest(self.number + 1, {t: dict(p) for t, p in self.tables.items()}, dict(self.schemas), dict(self.notes))

    @property
    def run(self) -> str:
        return _name(self.number)


def _name(number: int) -> str:
    return f"v{number:08d}"


def _folder(root: str, table: str, run: str, part: str | None = None) -> str:
    return f"{root}/data/table={table}/run={run}" + (f"/{PART}={part}" if part is not None else "")


def _known(spark: SparkSession, root: str) -> list[str]:
    return [n for n in paths.child_names(spark, f"{root}/_manifests") if n.startswith("v")]


def current(spark: SparkSession, root: str) -> Manifest:
    """The newest manifest; an empty one before the first run."""
    known = _known(spark, root)
    return _load(spark, root, known[-1]) if known else Manifest()


def _load(spark: SparkSession, root: str, name: str) -> Manifest:
    return Manifest(**json.loads(paths.read_text(spark, f"{root}/_manifests/{name}")))


def read(spark: SparkSession, root: str, manifest: Manifest, table: str, parts: list[str] | None = None) -> DataFrame:
    """A table (or some parts of it) with the column `part`, which prunes when filtered."""
    held = manifest.tables.get(table, {})
    chosen = [_folder(root, table, run, p) for p, run in sorted(held.items()) if parts is None or p in parts]
    schema = StructType.fromJson(json.loads(manifest.schemas[table]))
    if not chosen:
        return spark.createDataFrame([], schema).withColumn(PART, F.lit(None).cast("string"))
    whole = StructType(schema.fields).add("run", "string").add(PART, "string")
    rows = spark.read.schema(whole).option("basePath", f"{root}/data/table={table}").parquet(*chosen)
    return rows.drop("run")


def write(df: DataFrame, root: str, manifest: Manifest, table: str, gone: list[str] | None = None, sort: list[str] = (), files: int | None = None) -> None:
    """Write rows (with their column `part`) as the run's parts of a table and enter them in the
    manifest. `gone`: parts that these rows replace, with or without rows left; None: all parts.
    `files`: write each part in so many tasks' files instead of even ones. A table's parts may be
    written by several calls of a run."""
    spark = df.sparkSession
    folder = _folder(root, table, manifest.run)
    named = df.withColumn(PART, F.col(PART).cast("string"))
    out = named.repartition(files) if files else balanced(named, PART)
    if sort:
        out = out.sortWithinPartitions(PART, *sort)
    # The first call of a run clears what a lost attempt of it may have left.
    again = manifest.run in manifest.tables.get(table, {}).values()
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if again else "static")
    writer.partitionBy(PART).parquet(folder)
    made = [n.removeprefix(f"{PART}=") for n in paths.child_names(spark, folder) if n.startswith(f"{PART}=")]
    kept = {} if gone is None else {p: r for p, r in manifest.tables.get(table, {}).items() if p not in gone}
    manifest.tables[table] = kept | dict.fromkeys(made, manifest.run)
    manifest.schemas[table] = df.drop(PART).schema.json()


def compact(spark: SparkSession, root: str, target_bytes: int = fixed.TARGET_FILE_BYTES) -> list[tuple[str, str]]:
    """Rewrite the parts that consist of several files far below the target, and no others; returns
    (table, part) of each. Rows are counted while they are written and must stay the same."""
    new = current(spark, root).next()
    done = []
    for table, held in list(new.tables.items()):
        small = []
        for part, run in held.items():
            files, size = paths.files_and_bytes(spark, _folder(root, table, run, part))
            if files > max(1, 2 * size // target_bytes):
                small.append(part)
        if small:
            before = read(spark, root, new, table, small)
            want = before.count()
            write(before, root, new, table, small)
            have = read(spark, root, new, table, small).count()
            if have != want:
                raise ValueError(f"{table}: row count changed from {want} to {have}")
            done += [(table, p) for p in small]
    if done:
        commit(spark, root, new)
    return done


def commit(spark: SparkSession, root: str, manifest: Manifest, keep: int = 3) -> None:
    """Make the manifest count. Fails if another run has committed meanwhile. Folders that none of the
    newest `keep` manifests names are removed."""
    text = json.dumps(manifest.__dict__)
    paths.write_once(spark, f"{root}/_manifests/{manifest.run}", text)
    known = _known(spark, root)
    for name in known[:-keep]:
        paths.remove(spark, f"{root}/_manifests/{name}")
    named = {(t, p, r) for n in known[-keep:] for t, held in _load(spark, root, n).tables.items() for p, r in held.items()}
    for table in manifest.tables:
        for run in paths.child_names(spark, f"{root}/data/table={table}"):
            name = run.removeprefix("run=")
            # Folders of later runs may be in the making.
            if name <= manifest.run:
                for part in paths.child_names(spark, f"{root}/data/table={table}/{run}"):
                    if part.startswith(f"{PART}=") and (table, part.removeprefix(f"{PART}="), name) not in named:
                        paths.remove(spark, f"{root}/data/table={table}/{run}/{part}")
