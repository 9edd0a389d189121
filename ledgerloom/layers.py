"""Tables that grow by layers, and versions that say which layers count.

Every append is a folder of its own below `layers/`, complete once Spark has left `_SUCCESS`
in it. Merging folds the layers that count into one and commits a record under `_versions/`
that names it and what it covers; only then readers go over to it. Records are created and
never replaced, so of two writers that commit at once one fails. Whatever a crash leaves
behind is in no record: readers never see it, and the next merge removes it. Covered layers
stay for one more merge, for readers that are at them.

A layer of a stream is named by its batch number, and a batch that is run again replaces its
own layer; a record covers all batches up to a number, so a replay after a merge is not counted
twice.
"""

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.session import shuffles_removed

_RECORDS, _LAYERS = "_versions", "layers"


class CommitConflict(RuntimeError):
    """Another writer has committed the version in the meantime."""


def unique_name(prefix: str) -> str:
    """A name no other writer takes; names of one prefix sort by time."""
    now = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{prefix}-{now}-{uuid.uuid4().hex[:8]}"


def _path(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    files, target = _path(spark, folder)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _path(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    files, target = _path(spark, path)
    files.delete(target, True)


def read_file(spark: SparkSession, path: str) -> str:
    files, target = _path(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark, path, text):
    files, target = _path(spark, path)
    try:
        stream = files.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            raise CommitConflict(path) from error
        raise
    stream.write(bytearray(text.encode()))
    stream.close()


@dataclass(frozen=True)
class Version:
    """A committed record: its number, and what was written with it."""

    number: int = 0
    facts: dict = field(default_factory=dict)


def versions(spark: SparkSession, folder: str) -> list[Version]:
    """The committed versions, oldest first. A record that a crash cut short is none."""
    found = []
    for name in child_names(spark, f"{folder}/{_RECORDS}"):
        if name.endswith(".json"):
            try:
                facts = json.loads(read_file(spark, f"{folder}/{_RECORDS}/{name}"))
            except ValueError:
                continue
            found.append(Version(int(name.split(".")[0]), facts))
    return found


def latest(spark: SparkSession, folder: str) -> Version:
    """The newest committed version; number 0 without facts if there is none."""
    return ([Version()] + versions(spark, folder))[-1]


def commit(spark: SparkSession, folder: str, base: Version, facts: dict) -> Version:
    """Commit the version after `base`; fails if somebody else has gone on from it already."""
    if latest(spark, folder).number != base.number:
        raise CommitConflict(f"{folder} has gone beyond version {base.number}")
    taken = [int(n.split(".")[0]) for n in child_names(spark, f"{folder}/{_RECORDS}") if n.endswith(".json")]
    number = max([base.number, *taken]) + 1
    _create(spark, f"{folder}/{_RECORDS}/{number:08d}.json", json.dumps(facts))
    return Version(number, facts)


def batch_layer(number: int) -> str:
    return f"batch-{number:08d}"


def _batch_number(name):
    return int(name.removeprefix("batch-")) if name.startswith("batch-") else None


def write_layer(
    rows: DataFrame, folder: str, name: str | None = None, partition_by=(), gathered: bool = False
) -> str:
    """Add a layer; one of the same name is replaced. Returns its name.

    Rows of a partitioned layer are brought together by partition, a large one in several files,
    unless they are `gathered` so already.
    """
    name = name or unique_name("append")
    if partition_by and not gathered:
        rows = rows.hint("rebalance", *map(F.col, partition_by))
    writer = rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by)
    with shuffles_removed(rows.sparkSession):
        writer.parquet(f"{folder}/{_LAYERS}/layer={name}")
    return name


def live_layers(spark: SparkSession, folder: str, version: Version | None = None) -> list[str]:
    """The names of the layers that count, by the newest record."""
    facts = (version or latest(spark, folder)).facts
    covered, upto = set(facts.get("covers", ())), facts.get("upto", -1)
    live = [facts["merged"]] if "merged" in facts else []
    for child in child_names(spark, f"{folder}/{_LAYERS}"):
        name = child.removeprefix("layer=")
        number = _batch_number(name)
        if name in covered or name.startswith("merged-") or (number is not None and number <= upto):
            continue
        if exists(spark, f"{folder}/{_LAYERS}/{child}/_SUCCESS"):
            live.append(name)
    return live


def read_layers(spark: SparkSession, folder: str, schema=None, names=None) -> DataFrame | None:
    """The rows of the layers that count, in one scan; None if there is no layer."""
    names = live_layers(spark, folder) if names is None else names
    if not names:
        return None
    root = f"{folder}/{_LAYERS}"
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.option("basePath", root).parquet(*(f"{root}/layer={name}" for name in names))
    return rows.drop("layer")


def merge_layers(
    spark: SparkSession,
    folder: str,
    fold: Callable[[DataFrame], DataFrame],
    partition_by=(),
    least: int = 2,
    gathered: bool = False,
) -> Version:
    """Fold the layers that count into one, if there are at least `least` of them.

    `fold` gives the same table from its own result and further layers as from all layers; its
    rows may be `gathered` by `partition_by` already, which saves a shuffle.
    May be stopped anywhere and started again; appends may go on meanwhile.
    """
    before = latest(spark, folder)
    names = live_layers(spark, folder, before)
    if len(names) < least:
        return before
    merged = unique_name("merged")
    write_layer(fold(read_layers(spark, folder, names=names)), folder, merged, partition_by, gathered)
    batches = [n for n in map(_batch_number, names) if n is not None]
    facts = {
        "merged": merged,
        "upto": max([before.facts.get("upto", -1), *batches]),
        "covers": [n for n in names if n != before.facts.get("merged") and _batch_number(n) is None],
        "replaces": names,
    }
    # Names that an earlier record covers may still lie there.
    still = {c.removeprefix("layer=") for c in child_names(spark, f"{folder}/{_LAYERS}")}
    facts["covers"] += [n for n in before.facts.get("covers", ()) if n in still]
    version = commit(spark, folder, before, facts)
    _clear(spark, folder, before, version)
    return version


def _clear(spark, folder, before, version):
    """Remove what neither the newest version nor the one before it reads.

    A merged layer that is younger than the last version may be one that another writer is at.
    """
    keep = {version.facts["merged"], *version.facts["replaces"]}
    for child in child_names(spark, f"{folder}/{_LAYERS}"):
        name, number = child.removeprefix("layer="), _batch_number(child.removeprefix("layer="))
        gone = name in version.facts["covers"] or (number is not None and number <= version.facts["upto"])
        gone = gone or (name.startswith("merged-") and name < before.facts.get("merged", ""))
        if gone and name not in keep:
            remove(spark, f"{folder}/{_LAYERS}/{child}")
