"""Shared helpers: intermediate tables in the shared folder, connected components."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters of ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\f\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session's spark.checkpoint.dir names it.

    Where it names none, a folder of the warehouse will do if that is shared, or if all runs on one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        remote = "://" in warehouse and not warehouse.startswith("file:")
        if not remote and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = f"{warehouse}/_shared"
    return base.rstrip("/")


def _store(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


#: A table known to have few narrow rows (ids, hashes, counts) is written by a task for so many, but by LEAST_TASKS at least.
TASK_ROWS, LEAST_TASKS = 50_000, 8


def materialise(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives the optimizer real sizes.  The table goes
    when the application ends, or earlier by :func:`discard`.  ``most`` tells that it has at most so many
    rows, all narrow and cheap to make: then it gets as many files as they need, whatever the number of
    shuffle partitions.  Each file costs an executor three processes in a local file system.
    """
    spark = df.sparkSession
    if most is not None:
        df = df.coalesce(max(LEAST_TASKS, -(-most // TASK_ROWS)))
    folder = f"{shared_dir(spark)}/quirework-{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{name}")
    fs, path = _store(spark, folder)
    fs.deleteOnExit(path)
    out = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    out._folder = folder
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for df in tables:
        fs, path = _store(df.sparkSession, df._folder)
        fs.delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A table of at most so many narrow rows (ids, hashes, counts: under 100 bytes each) may be broadcast.
BROADCAST_ROWS = 50_000
#: A hub's edges are dealt to so many tasks.
SALTS = 8


def small_side(df: DataFrame, name: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """df written as a table, and marked for broadcast if it has at most ``most`` rows.

    Beyond that it is returned unmarked, so the join is a shuffle join that AQE can split.
    """
    df = materialise(df, name)
    return F.broadcast(df) if df.count() <= most else df


#: So many rows of an Arrow batch are Python objects at a time.
SLICE_ROWS = 500


def tidy() -> None:
    """Gives memory that is free back to the machine; workers are used again, and would hold it."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def sliced(batches, rows: int = SLICE_ROWS):
    """Arrow batches as smaller ones, without copies; an empty one stays."""
    for b in batches:
        for at in range(0, max(1, b.num_rows), rows):
            yield b.slice(at, rows)
    tidy()


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever extra columns it came with."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def keep_one(docs: DataFrame, verdicts: DataFrame, key: Column, name: str) -> DataFrame:
    """The rows of docs with a verdict ``kept``, one of those that agree in doc_id and key.

    verdicts has a row for each of docs: doc_id, kept and the key's value as column ``name``.
    Texts move once at most; only rows that are repeated are aggregated.
    """
    at, k = free_name(docs, "_at"), free_name(docs, "_k")
    seen = verdicts.groupBy(F.col("doc_id").alias(at), F.col(name).alias(k)).agg(F.min("kept").alias("kept"), F.count("*").alias("n"))
    told = materialise(seen.where("not kept or n > 1"), "told")
    same = lambda side: docs["doc_id"].eqNullSafe(side[at]) & (key == side[k])
    drop = told.select(at, k)
    out = docs.join(drop, same(drop), "left_anti")
    again = told.where("kept").select(at, k)
    if again.isEmpty():
        return out
    again = small_side(again, "again")
    return out.unionAll(docs.join(again, same(again)).dropDuplicates([at, k]).select(*docs.columns))


def connected_components(edges: DataFrame, name: str = "cc", max_rounds: int = 60, most: int | None = None) -> DataFrame:
    """(u, v) edges of long ids -> (node, comp), comp = the smallest id in the component.

    Alternating large-star and small-star rounds over DataFrames: each round is aggregations
    with map-side combining and equi-joins (a hub's rows are salted), and its result is
    written to the shared folder.  Self edges and nulls are ignored; an empty table gives an
    empty result.  Nodes that are in no edge are not returned.  ``most``: a bound of the edges, if
    they are cheap to make and one is known.
    """
    cur = materialise(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0", most
    )
    state, rows = None, cur.count()
    for i in range(1, max_rounds + 1):
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours of each node go to the node's smallest neighbour; a hub's are dealt out by salt
        salted = both.where("v > u").withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
        every = low.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        large = salted.join(every, ["u", "s"]).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # then every node and its smaller neighbours go to the smallest of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        # an edge gives one edge at most in the first half of a round, and two in the second
        last, cur = cur, materialise(small, f"{name}-{i}", 2 * rows)
        discard(last)
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        rows = now[0]
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(cur.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
