"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from climagrid.session import scratch_path
from climagrid.sinks.manifest import file_system

# ASCII white space: space and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"

# A side may be broadcast up to this many bytes and rows; both are measured first.
BROADCAST_BYTES = 64 << 20
BROADCAST_ROWS = 1_000_000

# A batch of texts for Python holds this much at most (or one text): tasks then need the same memory for rows of any length.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2_000


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's bounds of Arrow batches to ours; smaller settings stay."""
    records, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(records)) <= BATCH_ROWS:
        spark.conf.set(records, str(BATCH_ROWS))
    given = spark.conf.get(size).lower()
    if not given.removesuffix("b").isdigit() or int(given.removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(size, f"{BATCH_BYTES}b")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_hash_mod(modulus: int, name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus


def words_by_space(text: Column) -> Column:
    """Array of the words between ASCII white space."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. A text without other letters takes the quick way."""
    plain = F.octet_length(text) == F.length(text)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def free(name: str, *frames: DataFrame) -> str:
    """``name``, or with underscores added what no column of the frames is called."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def first_of_each(rows: DataFrame, *keys: Column) -> DataFrame:
    """One row for each value of ``keys``: the first by all columns, written as JSON. Copies are combined before the shuffle."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    names = [f"key_{i}" for i in range(len(keys))]
    chosen = rows.groupBy(*[k.alias(n) for k, n in zip(keys, names)]).agg(F.min_by(row, F.to_json(row)).alias("row"))
    return chosen.select("row.*")


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the folders that ``stored`` made inside the block, when it ends.

    Frames that were made inside read those folders, so write the result before. Without a scope the folders stay until the shared
    folder is cleared.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes[:] = [s for s in _scopes if s is not made]
        for path in made:
            folder, files = file_system(spark, path.rsplit("/", 1)[0])
            files.delete(folder, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside the block go when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    given = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if given is None else spark.conf.set(name, given)


def stored(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """Write ``df`` below the shared folder and continue from the files.

    Unlike ``checkpoint()`` this computes the frame once. The folder is the one that
    all executors reach, so a lost executor loses nothing. With ``outer`` it stays when the innermost scope ends, and goes with the next one.
    """
    path = scratch_path(df.sparkSession, name)
    if len(_scopes) > outer:
        _scopes[-1 - outer].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_bounded(table: DataFrame, row_bytes: int, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored side for broadcast if it is counted to be small; leave it alone otherwise.

    ``row_bytes`` bounds a row; where it is not known from the types, callers measure it.
    """
    limit = min(rows, BROADCAST_BYTES // max(1, row_bytes))
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.

    A column that is used inside a lambda may be folded into it by the optimizer and then be computed
    for every element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int, spread: Column, share: int = 1000) -> DataFrame:
    """Left join of ``rows`` with ``table`` (unique ``keys``), safe for keys that many rows hold.

    ``weight`` says how many rows hold a key. Keys that hold more than 1/``share`` of all rows, at most
    ``share`` of them, are broadcast; their rows are then spread by ``spread`` and match nothing in the shuffled join.
    """
    values = [c for c in table.columns if c not in keys]
    hot_from = total // share + 1
    hot = table.where(F.col(weight) > hot_from).select(*keys, F.struct(*values).alias("_hot"))
    rest = table.where(F.col(weight) <= hot_from).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*values).alias("_rest")
    )
    first = rows.join(F.broadcast(hot), keys, "left")
    answered = F.col("_hot").isNotNull()
    lone = [F.when(answered, spread if i == 0 else F.lit(None)).otherwise(F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    found = first.select("*", *lone).join(rest, [f"_k{i}" for i in range(len(keys))], "left")
    entry = F.when(answered, F.col("_hot")).otherwise(F.col("_rest"))
    return found.withColumn("_entry", entry).select(*rows.columns, *[F.col(f"_entry.{v}").alias(v) for v in values])


def thinned(edges: DataFrame) -> DataFrame:
    """Distinct (a, b) that connect what ``edges`` connect: a node keeps the edge to its smallest neighbour, and its other
    smaller neighbours get an edge to that one instead of to the node.

    Where many nodes share the same few neighbours, as near copies share their pivots, about one edge per node is left;
    there are never more edges than before.
    """
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.select("a", "b", F.min("b").over(W.partitionBy("a")).alias("m"))
    return least.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) is connected with.

    Every round gives each node the smallest label around it and then the label of that label, so long chains
    shrink by halves. A round is written to the shared folder, which cuts the lineage; nothing comes to the driver.
    """
    few = stored(thinned(edges), f"{name}-few")
    both = stored(few.unionAll(few.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{name}-edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), f"{name}-0"
    )
    turn = 0
    while True:
        turn += 1
        around = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m"))
        nearer = labels.join(around, "node").select("node", F.col("root").alias("_old"), F.least("root", "m").alias("root"))
        nearer = stored(nearer, f"{name}-{turn}-a")
        jump = nearer.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        after = stored(nearer.join(jump, "root", "left").select("node", "_old", F.coalesce("_next", "root").alias("root")), f"{name}-{turn}")
        labels = after.select("node", "root")
        if after.where(F.col("_old") != F.col("root")).isEmpty():
            return labels
