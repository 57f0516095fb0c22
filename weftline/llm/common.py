"""What the corpus operators share: words, shared storage, connected components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the contract of the corpus tables: a word is a maximal run without these.
WORD = r"[^\x20\x09-\x0D]+"
_SEPARATORS = "\t\n\x0b\x0c\r"

#: Bytes of words that a worker remembers. The words of the slice at hand come on top and are bounded by the slice.
REMEMBERED_BYTES = 64 << 20

_written: dict[str, SparkSession] = {}


def fresh(columns: list[str], prefix: str) -> str:
    """The prefix, with underscores before it until no column's name starts with it; names have no case."""
    while any(c.lower().startswith(prefix.lower()) for c in columns):
        prefix = "_" + prefix
    return prefix


def quoted(columns: list[str]) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text) -> "F.Column":
    """Number of words of a text; null counts as none. JVM side, without building an array of words."""
    flat = F.translate(F.coalesce(text, F.lit("")), _SEPARATORS, " " * len(_SEPARATORS))
    return F.regexp_count(flat, F.lit("[^ ]+")).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local session that names none (tests) gets one of its own; on a
    cluster it must be named, as a folder of one machine would be written where nobody else reads."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="weftline-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Stored:
    """A DataFrame written once to the shared folder; ``df`` reads it back with its lineage cut."""

    def __init__(self, df: DataFrame, codec: str = "zstd"):
        spark = df.sparkSession
        self.path = f"{shared_dir(spark)}/weftline-{uuid.uuid4().hex}"
        df.write.option("compression", codec).parquet(self.path)
        _written[self.path] = spark
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        spark = _written.pop(self.path, None)
        if spark is not None:
            _delete(spark, self.path)


@atexit.register
def _drop_all() -> None:
    for path, spark in list(_written.items()):
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone already
            pass


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Component of each node that an edge touches: columns ``node`` and ``component`` (smallest reachable node).

    ``edges`` holds ``a`` and ``b`` of one orderable type. Alternating large-star and small-star rounds: each
    node's edges are hung on its smallest neighbour until the edge set is a forest of stars. A round is a few
    shuffles of at most the edges themselves; long chains shrink by rounds. A hub's edges meet in partial aggregates and in joins on
    its id, where it is adaptive execution that splits them. Each round is written to the shared folder, which keeps the lineage short. Edges with a null
    end, repeated edges and loops add nothing; without edges there are no rows.
    """
    spark = edges.sparkSession
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()  # an edge with a null end goes here
    now = Stored(edges)
    seen = None
    for _ in range(max_rounds):
        grown = Stored(_small_star(_large_star(now.df)))
        mark = grown.df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        now.drop()
        now = grown
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError("components did not settle")
    roots = now.df.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.df.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each neighbour above a node on the smallest of the node and its neighbours."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    hung = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its neighbours below it on the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def written() -> set[str]:
    """Paths of the tables that are stored now."""
    return set(_written)


def drop_but(kept: Stored, before: set[str]) -> None:
    """Drop what has been stored since ``before`` (of :func:`written`), but ``kept``: tables that went into it and no more."""
    for path in set(_written) - before - {kept.path}:
        _delete(_written.pop(path), path)


def give_back() -> None:
    """Hand freed memory back to the system at a task's end: workers are reused, and an idle one keeps its pages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not this C library
        ctypes.CDLL(None).malloc_trim(0)
