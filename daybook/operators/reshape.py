"""Nested documents to flat rows: path explosion and scoped field access."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Comparison operators a table filter may use.
COMPARISONS = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def _is_list(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)


def raw_text(c: Column, dtype: T.DataType) -> Column:
    """A leaf as the text an export would contain."""
    if isinstance(dtype, T.StructType) and "_VALUE" in dtype.names:
        return raw_text(c["_VALUE"], dtype["_VALUE"].dataType)
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "Yes").when(~c, "No")
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyyMMdd")
    if isinstance(dtype, T.ArrayType) and not isinstance(dtype.elementType, T.StructType):
        return F.when(F.size(c) == 1, F.get(c, F.lit(0)).cast("string"))
    return c.cast("string")


@dataclass
class Rows:
    """One row per innermost list entry, with every enclosing object at hand."""

    df: DataFrame
    levels: list[tuple[str | None, T.StructType]] = field(default_factory=list)

    def _at(self, level: int, name: str) -> tuple[Column, T.DataType] | None:
        prefix, schema = self.levels[level]
        if name not in schema.names:
            return None
        ref = f"`{name}`" if prefix is None else f"`{prefix}`.`{name}`"
        return F.col(ref), schema[name].dataType

    def find(self, name: str) -> list[tuple[Column, T.DataType]]:
        """Where ``name`` occurs, innermost object first; ``..name`` starts one object out."""
        depth = len(self.levels)
        while name.startswith(".."):
            name, depth = name[2:], depth - 1
        found = (self._at(level, name) for level in range(depth - 1, -1, -1))
        return [f for f in found if f is not None]

    def has(self, name: str) -> bool:
        return bool(self.find(name))

    def raw(self, name: str) -> Column:
        """Text of the innermost object that has the field; NULL when none has it."""
        leaves = [raw_text(c, t) for c, t in self.find(name) if not _is_list(t)]
        return F.coalesce(*leaves) if leaves else F.lit(None).cast("string")

    def values(self, name: str) -> Column:
        """A repeated value or a nested list as an array."""
        for c, t in self.find(name):
            return c if isinstance(t, T.ArrayType) else F.array(c)
        return F.lit(None).cast("array<string>")

    def entries_with(self, name: str, member: str) -> Column | None:
        """A nested list whose entries have ``member``, if there is one."""
        for c, t in self.find(name):
            if _is_list(t) and member in t.elementType.names:
                return c
        return None


def explode_path(docs: DataFrame, path: str) -> Rows:
    """``"voucher.entries.bills"``: one row per bill; the collection itself gives one per doc.

    Documents without an entry on the way yield no row. A list the documents do not declare
    is an empty list.
    """
    rows = Rows(docs, [(None, docs.schema)])
    for depth, name in enumerate(path.split(".")[1:], start=1):
        prefix, schema = rows.levels[-1]
        if name not in schema.names or not _is_list(schema[name].dataType):
            return Rows(rows.df.where(F.lit(False)), rows.levels)
        source = f"`{name}`" if prefix is None else f"`{prefix}`.`{name}`"
        alias = f"_level{depth}"
        df = rows.df.select("*", F.explode(source).alias(alias))
        rows = Rows(df, [*rows.levels, (alias, schema[name].dataType.elementType)])
    return rows


def explode_paths(docs: DataFrame, paths: list[str]) -> list[Rows]:
    """One set of rows per path; a path that continues a listed one is covered by it."""
    kept = [p for p in paths if not any(p.startswith(f"{q}.") for q in paths if q != p)]
    return [explode_path(docs, p) for p in kept]


def compare(rows: Rows, name: str, operator: str, value) -> Column:
    """A table filter on a document field."""
    c, dtype = rows.find(name)[-1]
    if isinstance(value, bool):
        return COMPARISONS[operator](raw_text(c, dtype) == "Yes", F.lit(value))
    if isinstance(value, (int, float)):
        return COMPARISONS[operator](raw_text(c, dtype).try_cast("double"), F.lit(value))
    return COMPARISONS[operator](raw_text(c, dtype), F.lit(value))
