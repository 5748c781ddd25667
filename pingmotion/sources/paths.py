"""Directory trees whose levels hold partition values by position, not only ``name=value``."""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator, Mapping, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .folders import child_directories, opened, qualified
from .scratch import new_folder

#: fixed value: the directory of a null partition value
NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"


def slices_glob(base: str, levels: Mapping[str, Sequence[str] | None]) -> str:
    """One glob for every combination of the wanted values; None takes any value."""

    def level(wanted: Sequence[str] | None) -> str:
        if wanted is None:
            return "*"
        return wanted[0] if len(wanted) == 1 else "{" + ",".join(wanted) + "}"

    return "/".join([base.rstrip("/"), *map(level, levels.values())])


def _decoded(text):
    """Percent escapes undone; a plus sign is one."""
    return F.url_decode(F.regexp_replace(text, r"\+", "%2B"))


def with_path_values(
    df: DataFrame,
    levels: Sequence[str],
    types: Mapping[str, str],
    named: Collection[str] = (),
    listed: Collection[str] = (),
) -> DataFrame:
    """Add one column per directory level, counted from the file upwards.

    Levels in ``named`` are written as ``name=value`` with the escapes and the null directory
    that Spark gives them; others are the directory's name as it is. A value that is not of
    the type asked for is null, but stops the job for a level in ``listed``, whose values
    were asked for. The columns are computed, so filters on them skip no directory;
    ``read_slices`` takes such filters itself.
    """
    parent_dirs = F.split(F.col("_metadata.file_path"), "/")
    depth = len(levels)

    def value(i: int):
        name = levels[i]
        text = _decoded(F.element_at(parent_dirs, i - depth - 1))  # the path is a URI
        if name in named:
            text = _decoded(F.regexp_replace(text, "^[^=]*=", ""))
            text = F.when(text != NULL_DIRECTORY, text)
        if name not in types:
            return text
        typed = text.try_cast(types[name])
        if name not in listed:
            return typed
        wrong = F.concat(F.lit(f"directory of level {name} is no {types[name]}: "), text)
        return F.when(text.isNotNull() & typed.isNull(), F.raise_error(wrong)).otherwise(typed)

    return df.withColumns({name: value(i) for i, name in enumerate(levels)})


def slice_index(
    spark: SparkSession,
    base: str,
    levels: Mapping[str, Sequence[str] | None],
    types: Mapping[str, str] | None = None,
    named: Collection[str] = (),
) -> DataFrame:
    """One row per directory of the lowest level: its ``path``, the bytes of its files and the typed values
    of all levels. Directories are listed in tasks, level by level, and those of unwanted values are not
    entered. A value that is not of its type is null."""
    names = list(levels)
    wanted = [None if v is None else set(v) for v in levels.values()]
    top = min(2, len(names) - 1)  # levels that one task lists before the others share the work
    root = qualified(spark, base)

    def below(first: int, last: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, start = opened(root)
            for batch in batches:
                for above in batch["under"].to_pylist():
                    here = [above]
                    for level in range(first, last):
                        here = [
                            f"{p}/{c}"
                            for p in here
                            for c in child_directories(fs, start + p)
                            if wanted[level] is None or c in wanted[level]
                        ]
                    sizes = [0] * len(here)
                    if last == len(names):
                        found = [fs.get_file_info(pafs.FileSelector(start + p)) for p in here]
                        sizes = [sum(f.size for f in files if f.is_file) for files in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(here, pa.string()), pa.array(sizes, pa.int64())], ["under", "n_bytes"]
                    )

        return run

    leaves = spark.createDataFrame([("",)], "under string")
    if top:
        leaves = leaves.mapInArrow(below(0, top), "under string, n_bytes long").select("under").repartition("under")
    leaves = leaves.mapInArrow(below(top, len(names)), "under string, n_bytes long")
    parts = F.split("under", "/")
    values = {n: _level_value(F.element_at(parts, i - len(names)), n, types or {}, named) for i, n in enumerate(names)}
    return leaves.select(F.concat(F.lit(root), "under").alias("path"), "n_bytes", *[v.alias(n) for n, v in values.items()])


def _level_value(text: Column, name: str, types: Mapping[str, str], named: Collection[str]) -> Column:
    if name in named:
        text = _decoded(F.regexp_replace(text, "^[^=]*=", ""))
        text = F.when(text != NULL_DIRECTORY, text)
    return text.try_cast(types[name]) if name in types else text


def read_slices(
    spark: SparkSession,
    base: str,
    levels: Mapping[str, Sequence[str] | None],
    schema: T.StructType,
    types: Mapping[str, str] | None = None,
    skip_unreadable: bool = False,
    named: Collection[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """Read many slices as one scan with their path values as columns.

    ``levels`` gives the wanted directories of each level; combinations that have no
    directory fall out when the glob is expanded. ``where`` is any condition on the level columns; it
    is answered from the index of the directories, and the other directories are neither listed for
    files nor read. With ``skip_unreadable`` damaged files are left out; ``skipped_files`` lists them.
    """
    reader = (
        spark.read.schema(schema)
        .option("ignoreCorruptFiles", skip_unreadable)
        .option("ignoreMissingFiles", skip_unreadable)
    )
    if where is None:
        files = reader.orc(slices_glob(base, levels))
    else:
        # a reader is built from the list of its folders
        chosen = slice_index(spark, base, levels, types, named).where(where).select("path")
        paths = [_as_glob(r["path"]) for r in chosen.collect()]
        files = reader.orc(paths) if paths else reader.orc(_nowhere(spark))
    listed = [name for name, wanted in levels.items() if wanted is not None]
    return with_path_values(files, list(levels), types or {}, named, listed)


def _as_glob(path: str) -> str:
    """A path that a reader takes literally."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def _nowhere(spark: SparkSession) -> str:
    """An empty folder."""
    path = new_folder(spark, "nothing")
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def skipped_files(
    spark: SparkSession, base: str, levels: Mapping[str, Sequence[str] | None], schema: T.StructType
) -> DataFrame:
    """``file_path`` of the slices' files that give no row: damaged ones, and empty ones."""
    glob = slices_glob(base, levels)
    there = spark.read.format("binaryFile").load(glob).select(F.col("_metadata.file_path"))
    whole = F.struct(*[F.col(f.name) for f in schema])  # reading the columns shows the damage
    read = (
        spark.read.schema(schema)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
        .orc(glob)
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.max(F.hash(whole)).alias("seen"))
        .select("file_path")
    )
    return there.join(read, "file_path", "left_anti")


def constant_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Attach constant partition values."""
    return df.withColumns({name: F.lit(v) for name, v in values.items()})
