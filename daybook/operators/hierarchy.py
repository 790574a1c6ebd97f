"""Traversal of ``(name, parent)`` hierarchies by recursive queries.

A cycle ends in an error at the recursion limit, never in a cut-off result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def ancestors(groups: DataFrame, name: str, levels: int = 100) -> DataFrame:
    """The named node and everything above it, as ``(name, parent)``."""
    return groups.sparkSession.sql(
        f"""WITH RECURSIVE path(name, parent) MAX RECURSION LEVEL {int(levels)} AS (
              SELECT name, parent FROM {{groups}} WHERE name = :name
              UNION ALL
              SELECT above.name, above.parent FROM {{groups}} above JOIN path
                ON above.name = path.parent)
            SELECT name, parent FROM path""",
        args={"name": name}, groups=groups.select("name", "parent"))


def descendants(groups: DataFrame, name: str, levels: int = 100) -> DataFrame:
    """The named node and everything below it, as ``(name, parent)``."""
    return groups.sparkSession.sql(
        f"""WITH RECURSIVE tree(name, parent) MAX RECURSION LEVEL {int(levels)} AS (
              SELECT name, parent FROM {{groups}} WHERE name = :name
              UNION ALL
              SELECT below.name, below.parent FROM {{groups}} below JOIN tree
                ON below.parent = tree.name)
            SELECT name, parent FROM tree""",
        args={"name": name}, groups=groups.select("name", "parent"))


def members(ledgers: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """Ledgers whose group lies in the subtree of the named group."""
    subtree = descendants(groups, name).select("name").toDF("parent").distinct()
    return ledgers.join(subtree, "parent", "left_semi")
