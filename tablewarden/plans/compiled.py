"""Checks of one table, compiled into few reads of it.

A check registers what it needs to know: aggregates over all rows, aggregates over the groups
of a key, or level counts of a column.  All of the first kind become one aggregate, all of the
second one grouping by several key sets, all of the third one unpivot; each is a single scan.  Results
of one row are scalar subqueries that any later expression may read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Gives, by name, an aggregate of a group's rows, NULL in groups of other key sets.
Groups = Callable[[str], Column]


class Checks:
    """Asks over ``df``; after ``compile``, ``value`` reads their results."""

    def __init__(self, df: DataFrame):
        self.df = df
        self._asks: dict[str, Column] = {}
        self._sets: list[tuple[list[Column], dict[str, Callable[[Groups], Column]]]] = []
        self._per_group: dict[str, Column] = {}
        self._levels: dict[str, Column] = {}
        self._row: Column | None = None
        self._grouped: Column | None = None

    def ask(self, name: str, aggregate: Column) -> None:
        """An aggregate over all rows."""
        self._asks[name] = aggregate

    def ask_groups(
        self, key: Sequence[Column], per_group: Mapping[str, Column], totals: Mapping[str, Callable[[Groups], Column]]
    ) -> None:
        """Totals over the groups of ``key``, made from ``per_group``, the aggregates of a group's rows.

        Every total gets a function that reads them; ``null_key`` is true for groups of which a key
        part is NULL.
        """
        self._per_group |= per_group
        self._sets.append((list(key), dict(totals)))

    def ask_levels(self, name: str, value: Column, where: Column | None = None) -> None:
        """Count the levels of ``value`` in rows where ``where`` holds; see ``levels``."""
        one = F.struct(value.alias("value"))
        self._levels[name] = one if where is None else F.when(where, one)

    def compile(self) -> None:
        """Nothing can be asked afterwards."""
        if self._asks:
            self._row = self.df.agg(F.struct(*[c.alias(n) for n, c in self._asks.items()]).alias("w")).scalar()
        if self._sets:
            self._grouped = self._key_sets().scalar()

    def value(self, name: str) -> Column:
        return (self._row if name in self._asks else self._grouped).getField(name)

    def _key_sets(self) -> DataFrame:
        # rows are expanded once per key set and counted per key before the shuffle
        sets = [[f"_k{s}_{i}" for i in range(len(key))] for s, (key, _) in enumerate(self._sets)]
        every = [c for one in sets for c in one]
        parts = [c.alias(n) for one, (key, _) in zip(sets, self._sets) for n, c in zip(one, key)]
        grouping = [[F.col(c) for c in one] for one in sets]
        groups = self.df.select("*", *parts).groupingSets(grouping, *[F.col(c) for c in every]).agg(
            F.grouping_id().alias("_set"), *[c.alias(n) for n, c in self._per_group.items()]
        )
        totals = []
        for one, (_, asked) in zip(sets, self._sets):
            here = F.col("_set") == sum(1 << (len(every) - 1 - j) for j, c in enumerate(every) if c not in one)
            null_key = F.lit(False)
            for c in one:
                null_key = null_key | F.col(c).isNull()
            known = {n: F.col(n) for n in self._per_group} | {"null_key": null_key}
            totals += [total(lambda n: F.when(here, known[n])).alias(name) for name, total in asked.items()]
        return groups.agg(F.struct(*totals).alias("w"))

    def levels(self) -> DataFrame:
        """(name, value, n) of every level asked for, NULL being one; one scan and one shuffle for all."""
        rows = self.df.select(*[c.alias(n) for n, c in self._levels.items()])
        rows = rows.unpivot([], list(self._levels), "name", "_v").filter(F.col("_v").isNotNull())
        return rows.groupBy("name", F.col("_v.value").alias("value")).agg(F.count("*").alias("n"))

    def facts(self, facts: Sequence[Column]) -> DataFrame:
        """Finding rows from facts that read results of one row only; the table is not read for them. A NULL is no fact."""
        known = F.array_compact(F.array(*facts))
        return self.df.sparkSession.range(1).select(F.explode(known).alias("_f")).select("_f.*")
