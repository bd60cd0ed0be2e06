"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.session import settle, share_package, work_dir

Query = Callable[[SparkSession, str], DataFrame]

__all__ = ["arrow_rows", "batches_of", "checkpointed", "col", "free_name", "give_back", "maybe_among", "read", "settle", "share_package", "text_rows", "tidy", "told_apart", "work_dir"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def text_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)`` with a NULL text as the empty one; every other column is left behind."""
    return df.select(
        col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text")
    )


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, as the contracts ask; other letters stay."""
    return F.translate(c, UPPER, UPPER.lower())


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(work_dir(df.sparkSession))
    return df.checkpoint()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def told_apart(df: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with a long column ``name`` (a free one) that tells documents apart, also where ids don't.

    It is the id where one text bears it; rows equal in id and text are one document and share it. Where
    different texts bear an id, and where it is NULL, every row (every NULL) or every text (the others) gets a number
    of its own beyond all ids. Those rows are written first, so that their numbers stay.
    """
    own = col(id_col).cast("long")
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    hashes = [F.xxhash64(text), F.xxhash64(F.lit(1), text)]  # with different seeds
    ids = df.select(own.alias("i"), hashes[0].alias("x"), hashes[1].alias("y"))
    facts = ids.groupBy("i").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in "xy"])
    several = settle(facts.where("i is null or min_x <> max_x or min_y <> max_y").select("i"), "shared-ids")
    if several.isEmpty():
        return df.withColumn(name, own)
    mark = free_name(df, "_statloom_shared")
    shared = several.where("i is not null").withColumnRenamed("i", mark)
    alone = df.join(shared, own == F.col(mark), "left_anti").where(own.isNotNull()).withColumn(name, own)
    last = ids.agg(F.max("i")).first()[0] or 0
    # the row's number where the id is NULL, and what a document is known by otherwise
    unnamed = df.where(own.isNull()).withColumn(mark, F.struct(F.monotonically_increasing_id().alias("t"), own.alias("i"), *[h.alias(n) for h, n in zip(hashes, "xy")]))
    named = df.join(shared, own == F.col(mark), "left_semi")
    named = named.withColumn(mark, F.struct(F.lit(-1).cast("long").alias("t"), own.alias("i"), *[h.alias(n) for h, n in zip(hashes, "xy")]))
    rows = settle(unnamed.unionByName(named), "shared-id-rows")
    numbers = rows.select(mark).distinct().withColumn(name, F.lit(last + 1) + F.monotonically_increasing_id())
    numbers = settle(numbers, "row-numbers").withColumnRenamed(mark, "known")
    numbered = rows.join(numbers, F.col(mark).eqNullSafe(F.col("known"))).select(*[col(c) for c in [*df.columns, name]])
    return alone.unionByName(numbered)


BITMAP = 1 << 15  # bits of one of Spark's bitmaps
BITMAPS = 1 << 10  # at most so many, 4 MB
PLACES = 3  # bits that an id sets, all in one bitmap


def maybe_among(df: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean column ``name`` (a free one): whether the long ``key`` may be one of ``ids``.

    False is certain; true is right but for one in a thousand and has to be followed by an exact join,
    which then moves few rows of ``df``. What goes to every task is a Bloom filter cut into bitmaps, 32 bits
    an id and 4 MB at most: with very many ids more rows come out true, none is missed. ``ids`` has one
    column; it is read twice. A NULL key is hashed like any other.
    """
    bitmaps = min(BITMAPS, 1 + 32 * ids.count() // BITMAP)

    def bitmap(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bitmaps))

    def places(c: Column) -> list[Column]:
        spread = F.xxhash64(F.lit(1), c)
        return [F.shiftrightunsigned(spread, 20 * i) % BITMAP if i else F.pmod(spread, F.lit(BITMAP)) for i in range(PLACES)]

    at, bits = free_name(df, "_statloom_bitmap"), free_name(df, "_statloom_bits")
    own = F.col(ids.columns[0])
    held = ids.select(bitmap(own).alias(at), F.explode(F.array(*places(own))).alias("place"))
    held = held.groupBy(at).agg(F.bitmap_construct_agg("place").alias(bits))
    marked = df.withColumn(at, bitmap(col(key))).join(F.broadcast(held), at, "left")
    hit = F.lit(True)
    for place in places(col(key)):
        byte = F.substring(F.col(bits), F.floor(place / 8).cast("int") + 1, F.lit(1))
        hit = hit & (F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1)
    return marked.select(*[col(c) for c in df.columns], F.coalesce(hit, F.lit(False)).alias(name))


KEPT: dict[str, dict] = {}  # tables that operators keep in a Python worker, by operator


def tidy(owner: str = "") -> None:
    """Drop what other operators keep in this worker, and return its freed memory to the system.

    Workers are reused: what the tasks of one stage leave behind would lie beside the next stage's.
    """
    for name, tables in KEPT.items():
        if name != owner:
            tables.clear()
    _trim()


def give_back() -> None:
    """Return freed memory of this process to the system, where its allocators can."""
    import gc

    gc.collect()
    _trim()


def _trim() -> None:
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that ``column`` holds about ``most`` bytes a slice (one row at least).

    Texts differ in length by orders of magnitude, so memory is bounded by bytes, not rows.
    """
    start = total = 0
    sizes = [0 if v is None else v for v in pa.compute.binary_length(batch.column(column)).to_pylist()]
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_of(spark: SparkSession, most: int) -> Iterator[None]:
    """Batches of about ``most`` bytes for what is written inside, where the session names no size.

    Batches are counted in rows (10,000) otherwise, which may be all of a task's texts: ``slices`` bounds
    the work on a batch, but the worker still holds the batch itself.
    """
    own = spark.conf.get(BATCH_KEY, None)
    if own is None:
        spark.conf.set(BATCH_KEY, str(most))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(BATCH_KEY)


def arrow_rows(
    df: DataFrame, schema: str, step: Callable[[pa.RecordBatch], dict[str, list]], column: str, most: int = 4 << 20, owner: str = ""
) -> DataFrame:
    """Map Arrow batches through ``step``; batches are cut by the bytes of ``column`` first.

    What a batch has used goes back to the system, as an executor's workers share its memory; so do
    tables kept for operators other than ``owner``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    share_package(df.sparkSession)
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy(owner)
        for batch in batches:
            for part in slices(batch, column, most):
                out = step(part)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v := out[f.name], pa.Array) else pa.array(v, type=f.type) for f in target], schema=target
                )
                del out, part
            del batch  # before the next one is read
            tidy(owner)

    return df.mapInArrow(run, schema)
