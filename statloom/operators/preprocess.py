"""Repeatable splits and the impute / scale / one-hot preparation of features."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.exprs import SEED, name_col, number
from statloom.functions.prefix import range_count, sequence_numbers
from statloom.functions.quantiles import column_quantiles
from statloom.functions.roles import numeric_columns
from statloom.functions.skew import HOT_SHARE
from statloom.operators.profile import value_counts
from statloom.session import settle

NARROW = 1000  # slots up to which vectors carry an attribute per slot
SMALL = 100_000  # levels of a column that are broadcast
SPREAD = 4096  # places that the rows of hot levels are spread over


def unit_hash(key: list[str], seed: int = SEED) -> Column:
    """A number in [0, 1) that depends only on the row key, not on partitioning."""
    return (F.shiftrightunsigned(F.xxhash64(*[name_col(k) for k in key], F.lit(seed)), 11) / F.lit(float(2**53))).cast(
        "double"
    )


def assign_parts(
    df: DataFrame, shares: list[float], out: str, by: str | None = None, key: list[str] | None = None, seed: int = SEED
) -> DataFrame:
    """Number rows 0..k by cumulative ``shares``, exactly per class of ``by``.

    Rows are numbered along their hash inside each class, range by range, so that every class is cut at
    the rounded share of its rows, whether rows repeat or not. NULL is a class of its own.
    """
    hashed = df.withColumn("_u", unit_hash(key or df.columns, seed))
    # rows that agree in the key are told apart by the rest; rows that agree in all are alike
    hashed = hashed.withColumn("_v", F.xxhash64(*[name_col(c) for c in df.columns], F.lit(seed)))
    hashed = hashed.withColumn("_by", F.struct((name_col(by).cast("string") if by else F.lit("")).alias("class")))
    numbered = sequence_numbers(hashed, ["_by"], "_u", "_seq", tie="_v", size="_size")
    part = sum(((F.col("_seq") > F.floor(F.col("_size") * s + 0.5)).cast("int") for s in shares[1:]),
               (F.col("_seq") > F.floor(F.col("_size") * shares[0] + 0.5)).cast("int"))
    return numbered.withColumn(out, part).drop("_u", "_v", "_by", "_seq", "_size")


def split(
    df: DataFrame, target: str | None = None, test_share: float = 0.2, key: list[str] | None = None, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test), stratified by ``target`` when one is given."""
    parts = assign_parts(df, [test_share], "_part", target, key, seed)
    return parts.filter("_part = 1").drop("_part"), parts.filter("_part = 0").drop("_part")


def with_folds(
    df: DataFrame, folds: int, target: str | None = None, key: list[str] | None = None, seed: int = SEED + 1
) -> DataFrame:
    """Add ``fold`` 0..folds-1, balanced within each class."""
    return assign_parts(df, [i / folds for i in range(1, folds)], "fold", target, key, seed)


def training_sample(
    df: DataFrame, cap: int, target: str | None = None, key: list[str] | None = None, seed: int = SEED
) -> DataFrame:
    """About ``cap`` rows, the same share of every class (optional, off by default)."""
    n = df.count()
    if n <= cap:
        return df
    return assign_parts(df, [cap / n], "_part", target, key, seed).filter("_part = 0").drop("_part")


def class_weights(df: DataFrame, target: str, threshold: float = 1.5) -> tuple[float, dict[str, float]]:
    """(imbalance ratio, balanced weights n / (k n_c)); no weights below the threshold."""
    counts = {
        r["y"]: r["n"]
        for r in df.groupBy(name_col(target).cast("string").alias("y")).agg(F.count("*").alias("n")).collect()
        if r["y"] is not None
    }  # one row per class
    if len(counts) < 2:
        return 1.0, {}
    ratio = round(max(counts.values()) / min(counts.values()), 2)
    if ratio < threshold:
        return ratio, {}
    total = sum(counts.values())
    return ratio, {k: total / (len(counts) * n) for k, n in counts.items()}


def literal_map(entries: dict[str, float], c: Column) -> Column:
    return F.element_at(F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), F.lit(v))]), c)


@dataclass(frozen=True)
class Preparation:
    """Fitted preparation: numbers with their median, mean and deviation, and a table of all levels.

    The levels of text columns are a table, ``levels(column, level, slot, rows)``: its size follows the
    data, so it is joined, never collected. A vector has a slot per number and per level.
    """

    inputs: list[str]
    statistics: dict[str, tuple[float, float, float]]  # numeric: median, mean, deviation
    modes: dict[str, str]  # most frequent level of every text column with values
    sizes: list[int]  # levels of those columns, in order
    levels: DataFrame | None
    rows: int
    out: str

    @property
    def width(self) -> int:
        """Slots of a vector."""
        return len(self.statistics) + sum(self.sizes)

    def slot_table(self) -> DataFrame:
        """``(slot, name, owner)`` of the levels' slots; those of the numbers come before them."""
        names = F.array(*[F.lit(c) for c in self.modes])
        owner = names[F.col("column")]
        return self.levels.select("slot", F.concat(owner, F.lit("_"), "level").alias("name"), owner.alias("owner"))

    @cached_property
    def _named(self) -> list[tuple[str, str]]:
        names = [(n, n) for n in self.statistics]
        if self.levels is not None:
            names += [(r["name"], r["owner"]) for r in self.slot_table().orderBy("slot").collect()]
        return names

    @property
    def slots(self) -> list[str]:
        """The name of every slot, for reports that list them; it collects the levels."""
        return [n for n, _ in self._named]

    @property
    def owners(self) -> list[str]:
        """The source column of every slot; it collects the levels."""
        return [o for _, o in self._named]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the vector column; unknown levels are all zeros."""
        cells = {}
        for i, (n, (median, mean, sd)) in enumerate(self.statistics.items()):
            cells[f"_n_{i}"] = (F.coalesce(number(df, n), F.lit(median)) - F.lit(mean)) / F.lit(sd)
        for i, (c, mode) in enumerate(self.modes.items()):
            cells[f"_c_{i}"] = F.coalesce(name_col(c).cast("string"), F.lit(mode))
        ready = df.select("*", *[c.alias(n) for n, c in cells.items()])
        for i, size in enumerate(self.sizes):
            ready = self._with_slot(ready, i, size)
        numbers = [f"_n_{i}" for i in range(len(self.statistics))]
        texts = range(len(self.sizes))
        if self.width > NARROW:
            vector = self._sparse(numbers)
            return ready.select(*[name_col(c) for c in df.columns], vector.alias(self.out))
        first = len(numbers)
        for i, size in enumerate(self.sizes):  # one more category, for unknown levels, has no slot
            index = F.coalesce(F.col(f"_s_{i}") - first, F.lit(size)).cast("double")
            ready = ready.withColumn(f"_i_{i}", index.alias(f"_i_{i}", metadata={"ml_attr": {"type": "nominal", "num_vals": size + 1}}))
            first += size
        if self.sizes:
            encoder = OneHotEncoder(inputCols=[f"_i_{i}" for i in texts], outputCols=[f"_o_{i}" for i in texts], dropLast=True)
            ready = encoder.fit(ready).transform(ready)  # sizes come with the columns: nothing is read
        assembled = VectorAssembler(inputCols=[*numbers, *[f"_o_{i}" for i in texts]], outputCol=self.out).transform(ready)
        return assembled.select(*[name_col(c) for c in df.columns], self.out)

    def _with_slot(self, ready: DataFrame, i: int, size: int) -> DataFrame:
        """Add ``_s_<i>``, the slot of the level in ``_c_<i>``, NULL for an unknown one."""
        own = self.levels.where(F.col("column") == i)
        slot = F.col("slot").alias(f"_s_{i}")
        if size <= SMALL:
            return ready.join(F.broadcast(own.select(F.col("level").alias(f"_c_{i}"), slot)), f"_c_{i}", "left")
        # at most HOT_SHARE levels can be hot: their slots are broadcast, and their rows go anywhere in the join
        hot = own.where(F.col("rows") * HOT_SHARE > self.rows)
        ready = ready.join(F.broadcast(hot.select(F.col("level").alias(f"_c_{i}"), F.col("slot").alias("_hot"))), f"_c_{i}", "left")
        place = F.struct(
            F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))).alias("k"),
            F.when(F.col("_hot").isNull(), F.col(f"_c_{i}")).alias("level"),
        )
        cold = own.where(F.col("rows") * HOT_SHARE <= self.rows).select(F.struct(F.lit(0).cast("long").alias("k"), "level").alias("_at"), F.col("slot").alias("_cold"))
        found = ready.withColumn("_at", place).join(cold, "_at", "left")
        return found.withColumn(f"_s_{i}", F.coalesce("_hot", "_cold")).drop("_hot", "_cold", "_at")

    def _sparse(self, numbers: list[str]) -> Column:
        """The vector from its slots and values alone, whatever the number of slots."""
        known = F.array_compact(F.array(*[F.col(f"_s_{i}") for i in range(len(self.sizes))]))
        indices = F.concat(F.array(*[F.lit(i) for i in range(len(numbers))]).cast("array<int>"), known.cast("array<int>"))
        ones = F.transform(known, lambda _: F.lit(1.0))
        values = F.concat(F.array(*[F.col(n) for n in numbers]).cast("array<double>"), ones)
        parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(self.width).alias("size"), indices.alias("indices"), values.alias("values"))
        return F.from_json(F.to_json(F.struct(parts.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]


def level_table(train: DataFrame, columns: list[str], first: int) -> tuple[DataFrame | None, dict[str, str], list[int]]:
    """``(column, level, slot, rows)`` of all levels, the modes of the columns with values, and their sizes.

    Slots count up from ``first``, column by column, along the levels' order. Levels are numbered range by
    range; what reaches the driver is a row per column.
    """
    seen = settle(value_counts(train, columns).filter(F.col("value").isNotNull()), "levels")
    facts = seen.groupBy("feature").agg(
        F.count("*").alias("n"), F.min_by("value", F.struct((-F.col("count")).alias("c"), "value")).alias("mode")
    )
    of = {r["feature"]: r for r in facts.collect()}
    columns = [c for c in columns if c in of]  # a column without values carries nothing
    if not columns:
        return None, {}, []
    sizes = [of[c]["n"] for c in columns]
    if first + sum(sizes) >= 2**31:
        raise ValueError("vectors have at most 2^31 - 1 slots")
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature")) - 1
    tagged = seen.select(place.cast("int").alias("column"), F.col("value").alias("level"), F.col("count").alias("rows"))
    before = F.array(*[F.lit(first + sum(sizes[:i])) for i in range(len(sizes))])
    numbered = sequence_numbers(tagged, ["column"], "level", "_seq", ranges=range_count(sum(sizes)))
    slot = (before[F.col("column")] + F.col("_seq") - 1).cast("int")
    table = settle(numbered.select("column", "level", slot.alias("slot"), "rows"), "slots")
    return table, {c: of[c]["mode"] for c in columns}, sizes


def fit_preparation(train: DataFrame, features: list[str], out: str = "features") -> Preparation:
    """Median-impute and standardise numbers, mode-impute and one-hot everything else.

    Moments after imputation follow from the moments
    before it, so numbers need one aggregate besides their medians.
    """
    nums = [f for f in features if f in numeric_columns(train)]
    cats = [f for f in features if f not in nums]
    # one scan for the numbers: sizes, moments, distinct estimates
    facts = train.agg(
        F.count("*").alias("rows"),
        *[
            f(number(train, n)).alias(f"{t}{i}")
            for i, n in enumerate(nums)
            for t, f in (("k", F.count), ("m", F.avg), ("v", F.var_pop))
        ],
        *[F.approx_count_distinct(number(train, n), 0.05).alias(f"d{i}") for i, n in enumerate(nums)],
    ).first()
    total = max(facts["rows"], 1)
    distinct = {n: facts[f"d{i}"] for i, n in enumerate(nums)}
    medians = {n: (q[0] or 0.0) for n, q in column_quantiles(train, nums, [0.5], distinct=distinct).items()}
    stats: dict[str, tuple[float, float, float]] = {}
    for i, n in enumerate(nums):
        k, mean, var = facts[f"k{i}"], facts[f"m{i}"] or 0.0, facts[f"v{i}"] or 0.0
        centre = (k * mean + (total - k) * medians[n]) / total
        spread = (k * (var + (mean - centre) ** 2) + (total - k) * (medians[n] - centre) ** 2) / total
        stats[n] = (float(medians[n]), centre, spread**0.5 or 1.0)
    levels, modes, sizes = level_table(train, cats, len(stats)) if cats else (None, {}, [])
    return Preparation(features, stats, modes, sizes, levels, total, out)
