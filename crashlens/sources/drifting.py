"""S1 over a ping table whose files drifted: columns that came later, went, or changed type.

One scan can take one type for a column, so a column that is text in some files and a number in
others stops it, and a given schema cannot tell which files are which. Here the files' footers
are read on executors, one short read each; files whose wanted columns have the same types form
a group; each group is scanned under its own schema, its columns are cast to the given one, and
the groups are united. There are as many scans as layouts, not files, and filters still reach
each of them: partition filters always, others where a group's column needs no cast.

Defined cases: a column that a file lacks, and a value that the given type cannot hold, read as
NULL; extra columns are left out; names are told apart by case; a folder without files gives no
rows; a missing folder raises. Footers are opened by Arrow (local, HDFS, S3, GCS, ABFS paths);
a path of another kind raises, and a file that is no Parquet does too.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crashlens.sources.pings import PING_SCHEMA, select_ping_columns

FILES_PER_TASK = 64


def _open(path: str) -> tuple[FileSystem, str]:
    if path.startswith("file:"):  # as a listing gives it: file:/x, nothing escaped
        return LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return FileSystem.from_uri(path)


def file_layouts(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """path, layout of the Parquet files below ``folder``: the types that the file has the wanted
    columns in, by its footer. Files and folders whose name starts with . or _ are no data."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "[!._]*").option("recursiveFileLookup", "true")
             .load(folder).where("length > 0").select("path"))
    files = files.where(~F.col("path").rlike(r"/[._][^/=]*/"))

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            layouts = []
            for path in batch["path"]:
                fs, where = _open(path)
                with fs.open_input_file(where) as f:
                    schema = pq.read_schema(f)
                layouts.append(";".join(f"{c}:{schema.field(c).type}" for c in columns if c in schema.names))
            yield pd.DataFrame({"path": batch["path"], "layout": layouts})

    tasks = max(1, -(-files.count() // FILES_PER_TASK))
    return files.repartition(tasks).mapInPandas(footers, "path string, layout string")


def read_drifting(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The table below ``folder`` under ``schema``, whatever types its files have."""
    groups: dict[str, list[str]] = {}
    for row in file_layouts(spark, folder, schema.names).orderBy("layout", "path").toLocalIterator():
        groups.setdefault(row["layout"], []).append(row["path"])  # the listing, as a scan holds it too
    parts = []
    for layout, paths in groups.items():
        reader = lambda: spark.read.option("basePath", folder)
        stored = {f.name: f.dataType for f in reader().parquet(paths[0]).schema}  # one footer
        in_file = {column.split(":")[0] for column in layout.split(";")}
        # a column of the path, and one that the files lack, is read under the given type
        asked = StructType()
        for f in schema:
            asked.add(f.name, stored[f.name] if f.name in in_file else f.dataType)
        df = reader().schema(asked).parquet(*paths)
        parts.append(df.select(*[
            F.col(f.name) if asked[f.name].dataType == f.dataType else F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_drifting_pings(spark: SparkSession, folder: str, schema: StructType = PING_SCHEMA) -> DataFrame:
    """S1 + P1: the 13 columns of the report from a ping table in several layouts."""
    return select_ping_columns(read_drifting(spark, folder, schema))
