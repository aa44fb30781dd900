"""What the operators share: the shared folder, written stage tables, document keys, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes an Arrow batch holds, about; whole texts are batched, so this bounds a worker's memory whatever their length.
BATCH_BYTES = 1 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by their bytes, the same for all operators; a bound that the caller has set stands."""
    if spark.conf.get(_BYTES, None) is None:
        spark.conf.set(_BYTES, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset and all run on one machine, one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quillmap-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quillmap-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Cut the lineage: write to the shared folder (in a folder for each value of `by`), read back. Survives the loss of any executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, *frames: DataFrame) -> None:
    """Remove stage tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for df in frames:
        for top in {m[0] for f in df.inputFiles() if (m := re.match(r".*/quillmap-[^/]*-[0-9a-f]{32}(?=/)", f))}:
            p = jvm.org.apache.hadoop.fs.Path(top)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow over single batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := f(b)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """With the id, tells rows apart that share an id or have none; equal rows share it and get equal results."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column end to end, and n + 1 offsets; nulls are empty."""
    column = column.fill_null("") if column.null_count else column
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None and len(column) else np.empty(0, np.uint8)
    return raw, off - off[0]


def private(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


#: Nodes whose least neighbour is sent to all executors, at most: those with more than 1 / HUBS of all neighbours.
HUBS = 10_000


def _with_least(rows: DataFrame, size: int) -> DataFrame:
    """(u, v, m): m is the least v of u. The values of hubs are sent, as there are at most HUBS; those of other nodes meet
    their rows in a join, in which no key has many rows. size: at least as many as there are rows."""
    many = max(100, -(-size // HUBS))
    low = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d"))
    hubs = low.where(F.col("d") > many).select(F.col("u").alias("h"), F.col("m").alias("hm"))
    marked = rows.join(F.broadcast(hubs), F.col("u") == F.col("h"), "left")
    others = marked.where("h is null").select("u", "v").join(low.where(F.col("d") <= many).select("u", "m"), "u")
    return marked.where("h is not null").select("u", "v", F.col("hm").alias("m")).unionByName(others.select("u", "v", "m"))


def _forest(edges: DataFrame) -> DataFrame:
    """(u, v): instead of a task's edges (u, v) one from each node to the least that the task's edges connect it with."""
    kinds = dict(edges.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        both = [pa.concat_arrays([b.column(j) for b in held]) for j in (0, 1)]
        nodes = pa.chunked_array(both).unique()
        nodes = nodes.take(pc.sort_indices(nodes))
        a, b = (pc.index_in(x, nodes).to_numpy().astype(np.int64) for x in both)
        low = np.arange(len(nodes))
        while True:
            before = low.copy()
            np.minimum.at(low, a, low[b])
            np.minimum.at(low, b, low[a])
            low = low[low]
            if (low == before).all():
                break
        at = np.flatnonzero(low != np.arange(len(low)))
        for lo in range(0, len(at), 50_000):
            i = at[lo : lo + 50_000]
            yield pa.record_batch([nodes.take(pa.array(i)), nodes.take(pa.array(low[i]))], ["u", "v"])

    return edges.mapInArrow(run, f"u {kinds['u']}, v {kinds['v']}")


#: Edges that one task joins at once.
TASK_EDGES = 1 << 19


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over the edges, for nodes with an edge to another.

    In every round each task first joins what its own edges connect, of which it has TASK_EDGES about. Then a large-star and
    a small-star step follow, until every node points at one that points at none: each an aggregate (with map-side
    combining) and a join that no hub passes through, whatever its degree. Rounds are written to the shared folder; those
    before are removed.
    """
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v"), "edges")
    for _ in range(rounds):
        tasks = -(-now.count() // TASK_EDGES)
        before, now = now, written(_forest(now.coalesce(max(1, tasks))), "edges")
        drop_written(now.sparkSession, before)
        size, settled = (0, True) if tasks <= 1 else _state(now)
        if settled:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, 2 * size).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = _with_least(large, size)
        nxt = small.select("u", F.col("m").alias("v")).union(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        before, now = now, written(nxt, "edges")
        drop_written(now.sparkSession, before)
    raise RuntimeError("components did not settle")


def _state(edges: DataFrame) -> tuple[int, bool]:
    """How many edges there are, and whether every u has one v, which is no u itself."""
    ends = edges.select("u", F.lit(1).alias("out")).union(edges.select("v", F.lit(0)))
    per = ends.groupBy("u").agg(F.sum("out").alias("out"), F.count("*").alias("n"))
    size, bad = per.agg(F.coalesce(F.sum("out"), F.lit(0)), F.count_if(F.expr("out > 1 or out = 1 and n > 1"))).first()
    return size, bad == 0
