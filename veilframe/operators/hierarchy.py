"""Generalization hierarchies of categorical quasi-identifiers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.errors import PipelineError

ANY = "*"


@dataclass(frozen=True)
class Hierarchy:
    """``levels[n]`` maps values to their class at level n, others to ``other``; from ``depth`` on all is ``*``."""

    depth: int
    levels: Mapping[int, Mapping[str, str]] = field(default_factory=dict)
    other: str = "Other"

    def at(self, value: str, level: int) -> str:
        if level <= 1:
            return value
        return ANY if level >= self.depth else self.levels[level].get(value, self.other)

    def column(self, c: Column, level: int) -> Column:
        if level <= 1:
            return c
        if level >= self.depth:
            return F.lit(ANY)
        out = F.lit(self.other)
        by_class: dict[str, list[str]] = {}
        for value, name in self.levels[level].items():
            by_class.setdefault(name, []).append(value)
        for name, members in by_class.items():
            out = F.when(c.isin(*members), name).otherwise(out)
        return out


@dataclass(frozen=True)
class HierarchyTable:
    """A hierarchy of any number of values: ``frame(value, l2, l3, ...)`` with a row for each value and its class at each level.

    Values that the frame lacks, and classes that are null, are ``other``; from ``depth``, one above the last column, all is ``*``. Classes nest: two values of one
    class share the class of each level above (``check`` tells). Only joins read it; Spark decides how by its size.
    """

    frame: DataFrame
    other: str = "Other"

    @property
    def depth(self) -> int:
        return len(self.frame.columns) + 1

    def check(self) -> None:
        """Raises if a value stands there twice or classes part again further up."""
        names = [f"l{n}" for n in range(2, self.depth)]
        if self.frame.columns != ["value", *names]:
            raise PipelineError("CONFIG_INVALID", "A hierarchy has the columns value, l2, l3, ...", ", ".join(self.frame.columns))
        for low, high in zip(["value", *names], [None, *names[1:]]):
            found = self.frame.groupBy(low).agg((F.count("*") if high is None else F.count_distinct(F.coalesce(high, F.lit(self.other)))).alias("n")).where("n > 1")
            if low == "value" or high is not None:
                if row := found.head():
                    raise PipelineError("CONFIG_INVALID", "A value stands twice in its hierarchy, or a class has two classes above it", str(row[0]))

    def joined(self, df: DataFrame, key: Column, level: int, name: str) -> DataFrame:
        """``df`` with the class of ``key`` at ``level`` as ``name``; null has no class of its own."""
        if level <= 1 or level >= self.depth:
            return df.withColumn(name, key if level <= 1 else F.lit(ANY))
        own = self.frame.select(F.col("value").alias("__value"), F.col(f"l{level}").alias("__class"))
        out = df.withColumn("__key", key).join(own, F.col("__key") == F.col("__value"), "left")
        return out.withColumn(name, F.coalesce("__class", F.lit(self.other))).drop("__key", "__value", "__class")

    def paths(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with the text in ``column`` replaced by the array of its classes from level 1 up."""
        own = self.frame.select(F.col("value").alias(column), F.array(*[F.coalesce(f"l{n}", F.lit(self.other)) for n in range(2, self.depth)]).cast("array<string>").alias("__up"))
        rest = F.coalesce("__up", F.array_repeat(F.lit(self.other), self.depth - 2))
        return df.join(own, column, "left").withColumn(column, F.concat(F.array(column), rest, F.array(F.lit(ANY)))).drop("__up")


def read_hierarchy(spark: SparkSession, path: str) -> HierarchyTable:
    """Parquet, or CSV with a header."""
    found = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.option("header", True).csv(path)
    table = HierarchyTable(found)
    table.check()
    return table


# The built-in hierarchies.
_FIELDS = {
    "Healthcare": ("Medical Specialists", "Allied Health", "Nursing", "Healthcare Support"),
    "Education": ("K-12 Education Teacher", "Higher Education Teacher", "Supplemental Education Teacher", "University Professor"),
    "Creative": ("Performing Arts", "Visual & Media Arts", "Design", "Mixed Media Artist"),
    "Engineering": ("Traditional Engineering", "Software Engineering", "Data & Analytics", "AI & Machine Learning"),
}
_SECTORS = {"Healthcare": "Service Sector", "Education": "Service Sector", "Creative": "Non-Service", "Engineering": "Non-Service"}
BUILT_IN: dict[str, Hierarchy] = {
    "blood group": Hierarchy(3, {2: {f"{g}{sign}": g for g in ("A", "B", "AB", "O") for sign in "+-"}}),
    "gender": Hierarchy(2),
    "profession": Hierarchy(4, {2: {v: f for f, vs in _FIELDS.items() for v in vs}, 3: {v: _SECTORS[f] for f, vs in _FIELDS.items() for v in vs}}),
}


def base_name(column: str) -> str:
    """The name without the suffixes of derived columns."""
    for suffix in ("_scaled_encoded", "_encoded", "_scaled"):
        if column.endswith(suffix):
            return column[: -len(suffix)]
    return column


def hierarchy_of(column: str, own: Mapping[str, Hierarchy | HierarchyTable] | None = None) -> Hierarchy | HierarchyTable:
    """A hierarchy given for the column, else the built-in one of its name in any case."""
    found = (own or {}).get(column) or BUILT_IN.get(base_name(column).strip().lower())
    if found is None:
        raise PipelineError("CONFIG_INVALID", f"No hierarchy is known for categorical column '{column}'", column)
    return found
