"""Session helpers: where scratch data goes, and file-system calls that need no data movement.

Everything staged on disk lives under the shared folder that the cluster names in
``spark.checkpoint.dir``.  Only a local master without that setting (tests on a laptop) gets a
temporary folder; on a cluster its absence is an error, as executors would write to disks of
their own.  Tables live below ``spark.bulkflow.table.dir``, or else in the warehouse folder.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="bulkflow-")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def table_root(spark: SparkSession) -> str:
    """Below it lie the folders of tables, side by side."""
    root = spark.conf.get("spark.bulkflow.table.dir", None)
    if not root:
        root = f"{scratch_root(spark)}/tables" if _is_local(spark) else spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/bulkflow"


def fresh_table_dir(spark: SparkSession, label: str) -> str:
    """A new path for rows that a catalog table keeps, apart from scratch data."""
    return f"{table_root(spark)}/{label}-{uuid.uuid4().hex}"


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody else uses; it is not created, the first write does that."""
    return f"{scratch_root(spark)}/bulkflow/{label}-{uuid.uuid4().hex}"


def fresh_name(label: str) -> str:
    """A catalog name nobody else uses."""
    return f"bf_{label}_{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so that lost executors cost no recomputation.

    Spark deletes the files once the result is not referenced any more, if the application sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    scratch_root(df.sparkSession)
    return df.checkpoint()


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def make_dir(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path)
    return path


def delete_dir(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.delete(hadoop_path, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder; the parent of the new path is made if need be."""
    fs, source = _fs(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{old} could not become {new}")


def rename_new(spark: SparkSession, old: str, new: str) -> bool:
    """Move a folder with files in it to a name that nobody has taken; False when somebody has.

    Of several that try the same name one succeeds, on file systems whose rename is atomic.
    """
    fs, source = _fs(spark, old)
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(new)
    if fs.exists(target):
        return False
    fs.mkdirs(target.getParent())
    try:
        if fs.getScheme() == "file":
            # Hadoop's local rename would go on to copy into a folder that came up meanwhile.
            paths = [jvm.java.nio.file.Path.of(fs.makeQualified(p).toUri()) for p in (source, target)]
            jvm.java.nio.file.Files.move(*paths, spark.sparkContext._gateway.new_array(jvm.java.nio.file.CopyOption, 0))
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(source, target, options)
    except Py4JJavaError:
        if fs.exists(target) and fs.exists(source):
            return False
        raise
    return True


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, hadoop_path = _fs(spark, path)
    fs.create(hadoop_path, True).close()


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed, in milliseconds; 0 when it is gone."""
    fs, hadoop_path = _fs(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime() if fs.exists(hadoop_path) else 0


def children(spark: SparkSession, path: str) -> list[str]:
    """Full paths of everything directly below ``path``, sorted; none when it does not exist."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(hadoop_path))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the folders directly below ``path``, sorted by name."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def quoted(name: str) -> str:
    """Back-quote a possibly qualified catalog name part by part."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
