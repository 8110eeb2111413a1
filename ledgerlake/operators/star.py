"""Star model: facts, dimensions and named relationships between them, and measures
evaluated under slicers on dimension columns, at several levels of totals.

A column of a dimension is written ``Dimension.Column``, or ``Dimension@role.Column`` for a
relationship over another key of the fact (the order date beside the shipment date).  A
slicer reaches every fact that has the relationship, as a semi-join with the filtered
dimension; grouping columns come from a join with the dimension.  A fact without the
relationship stays unfiltered and unsplit: its value repeats.

Each fact is read once: it is joined, summed to the grain of the grouping columns (plus
columns counted distinctly), and that cube is written.  All levels are grouping sets of the
cube; ratios and other derived measures are computed on the sums of each level, so totals are
evaluated again, not added up.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import materialise


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``fact`` have one row of ``dimension``; ``role`` names a second key."""
    fact: str
    key: str
    dimension: str
    dimension_key: str
    role: str = ""


@dataclass(frozen=True)
class Base:
    """A base aggregate: the sum of a column (``kind`` sum) or its number of distinct values (distinct).
    ``ignores`` names columns whose slicers and grouping it does not see (all rows of its context); with ``all_selected``
    it sees the slicers but no grouping, so it is the total of what is selected."""
    fact: str
    column: str
    kind: str = "sum"
    ignores: frozenset = frozenset()
    all_selected: bool = False


@dataclass
class Star:
    facts: dict[str, DataFrame]
    dimensions: dict[str, DataFrame]  # keys are unique; hinted for broadcast by their owner if counted small
    relationships: list[Relationship]
    bases: dict[str, Base] = field(default_factory=dict)

    def __post_init__(self):
        for r in self.relationships:
            if r.key not in self.facts[r.fact].columns or r.dimension_key not in self.dimensions[r.dimension].columns:
                raise ValueError(f"{r}: no such key")
        if len({(r.fact, r.dimension, r.role) for r in self.relationships}) < len(self.relationships):
            raise ValueError("two relationships with one name")

    def relationship(self, fact: str, column: str) -> Relationship | None:
        """The relationship by which ``fact`` sees a dimension's column."""
        dimension, role, name = split_name(column)
        if dimension not in self.dimensions or name not in self.dimensions[dimension].columns:
            raise ValueError(f"no column {column}")
        return next((r for r in self.relationships if (r.fact, r.dimension, r.role) == (fact, dimension, role)), None)

    def seen(self, fact: str, columns) -> list[str]:
        return [c for c in columns if self.relationship(fact, c)]


def split_name(column: str) -> tuple[str, str, str]:
    found = re.fullmatch(r"(\w+)(?:@(\w+))?\.(\w+)", column)
    if not found:
        raise ValueError(f"{column!r} is not Dimension.Column or Dimension@role.Column")
    return found[1], found[2] or "", found[3]


def output_name(column: str) -> str:
    """Name in the result: the column's own, with the role behind it."""
    _, role, name = split_name(column)
    return f"{name}_{role}" if role else name


def values(v) -> list:
    return list(v) if isinstance(v, (list, tuple, set)) else [v]


def joined(star: Star, fact: str, columns: list[str], where: dict) -> DataFrame:
    """The fact under the slicers that reach it, with the grouping columns it sees."""
    df = star.facts[fact]
    by_relationship: dict[Relationship, tuple[list[str], dict]] = {}
    for c in columns:
        by_relationship.setdefault(star.relationship(fact, c), ([], {}))[0].append(c)
    for c, v in where.items():
        if r := star.relationship(fact, c):
            by_relationship.setdefault(r, ([], {}))[1][c] = v
    for r, (wanted, slicers) in by_relationship.items():
        dim = star.dimensions[r.dimension]
        for c, v in slicers.items():
            dim = dim.where(F.col(split_name(c)[2]).isin(values(v)))
        key = f"_key_{r.dimension}_{r.role}"
        dim = dim.select(F.col(r.dimension_key).alias(key), *(F.col(split_name(c)[2]).alias(output_name(c)) for c in wanted))
        # a filtered dimension keeps the fact's rows that it has; an unfiltered one keeps them all
        how = "left_semi" if not wanted else "inner" if slicers else "left"
        df = df.join(dim, df[r.key] == dim[key], how)
        df = df.drop(key)
    return df


def cube(star: Star, fact: str, bases: dict[str, Base], columns: list[str], where: dict) -> DataFrame:
    """The fact summed to the grain of ``columns`` and of what is counted distinctly, written once."""
    distinct = sorted({b.column for b in bases.values() if b.kind == "distinct"})
    sums = sorted({b.column for b in bases.values() if b.kind == "sum"})
    df = joined(star, fact, columns, where)
    names = [output_name(c) for c in columns]
    df = df.groupBy(*names, *(F.col(c).alias(f"_d_{c}") for c in distinct)).agg(F.count(F.lit(1)).alias("_rows"), *(F.sum(c).alias(f"_s_{c}") for c in sums))
    return materialise(df)


def _aggregates(bases: dict[str, Base]) -> list[Column]:
    return [(F.sum(f"_s_{b.column}") if b.kind == "sum" else F.countDistinct(f"_d_{b.column}")).alias(n) for n, b in bases.items()]


def evaluate(star: Star, measures: list[tuple[str, str]], by: list[str], where: dict | None = None, levels: list[list[str]] | None = None) -> DataFrame:
    """Measures (name, SQL over bases and earlier measures) for each level, a subset of ``by`` ([] is the grand
    total; default: ``by`` alone).  Result: ``nivel`` (number of the level in ``levels``), the grouping columns (null where rolled up) and
    the measures.  A level has the rows of the facts that see all its columns; other facts' values are joined to them."""
    where, levels = where or {}, levels if levels is not None else [by]
    names = {c: output_name(c) for c in by}
    if len(set(names.values())) < len(by) or any(set(level) - set(by) for level in levels):
        raise ValueError("grouping columns clash, or a level has others")
    used = set().union(*(re.findall(r"\w+", e) for _, e in measures))
    bases = {n: b for n, b in star.bases.items() if n in used}
    groups: dict[tuple, dict[str, Base]] = {}
    for n, b in bases.items():
        groups.setdefault((b.fact, b.ignores, b.all_selected), {})[n] = b

    whole, partial = [], []
    cubes: dict[tuple, DataFrame] = {}
    for (fact, ignores, all_selected), own in groups.items():
        slicers = {c: v for c, v in where.items() if c not in ignores}
        seen = [] if all_selected else [c for c in star.seen(fact, by) if c not in ignores]
        # what is selected in all is a grouping set of the same cube where the facts' other sums have one
        grain = [c for c in star.seen(fact, by) if c not in ignores]
        key = (fact, ignores)
        if key not in cubes:
            together = {n: b for (f, i, _), g in groups.items() if (f, i) == key for n, b in g.items()}
            cubes[key] = cube(star, fact, together, grain, slicers)
        table = cubes[key]
        for k, level in enumerate(levels):
            mine = [c for c in level if c in seen]
            (whole if mine == list(level) and not all_selected and not ignores else partial).append((k, level, mine, table, own))
    if any(all(k != j for j, *_ in whole) for k in range(len(levels))):
        raise ValueError("a level has a column that no fact sees")

    # whole: one aggregate per cube over the grouping sets of its levels
    stacked = None
    for table in {id(t): t for *_, t, _ in whole}.values():
        mine = [(k, level) for k, level, _, t, _ in whole if t is table]
        own = {n: b for _, _, _, t, g in whole if t is table for n, b in g.items()}
        columns = list(dict.fromkeys(names[c] for _, level in mine for c in level))
        if columns:
            sets = [[F.col(names[c]) for c in level] for level in dict.fromkeys(tuple(level) for _, level in mine)]
            rows = table.groupingSets(sets, *map(F.col, columns)).agg(F.grouping_id().alias("_set"), *_aggregates(own))
            number = F.create_map(*(F.lit(v) for k, level in mine for v in (_set_id(columns, [names[c] for c in level]), k)))
            rows = rows.withColumn("nivel", number[F.col("_set").cast("int")])
        else:
            rows = table.agg(*_aggregates(own)).withColumn("nivel", F.lit(mine[0][0]))
        rows = rows.select("nivel", *(F.col(n) if n in columns else F.lit(None).cast(_type(star, c)).alias(n) for c, n in names.items()), *own)
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    order = [n for _, _, _, _, g in whole for n in g]
    out = stacked.groupBy("nivel", *names.values()).agg(*(F.max(n).alias(n) for n in dict.fromkeys(order)))

    # partial: values that repeat over the columns their fact does not see
    pieces: dict[tuple, list] = {}
    for k, level, mine, table, own in partial:
        pieces.setdefault((id(table), tuple(own)), []).append((k, mine, table, own))
    for n_, parts in enumerate(pieces.values()):
        rows = None
        columns = list(dict.fromkeys(names[c] for _, mine, *_ in parts for c in mine))
        for k, mine, table, own in parts:
            keys = [names[c] for c in mine]
            one = table.groupBy(*keys).agg(*_aggregates(own)) if keys else table.agg(*_aggregates(own))
            one = one.select(F.lit(k).alias("_nivel"), *(F.col(c).alias(f"_k_{c}") if c in keys else F.lit(None).cast(dict(out.dtypes)[c]).alias(f"_k_{c}") for c in columns),
                             *(F.col(n).alias(f"_v_{n}") for n in own))
            rows = one if rows is None else rows.unionByName(one)
        # at most the rows of a level: null keys of a rolled-up column equal null
        match = out["nivel"] == rows["_nivel"]
        for c in columns:
            used_at = F.lit(False)
            for k, mine, *_ in parts:
                if c in [names[x] for x in mine]:
                    used_at = used_at | (out["nivel"] == k)
            match = match & F.when(used_at, out[c]).eqNullSafe(rows[f"_k_{c}"])
        out = out.join(rows, match, "left")
        # a base may be whole at one level and repeat at another
        out = out.withColumns({n: F.coalesce(n, f"_v_{n}") if n in order else F.col(f"_v_{n}") for n in parts[0][3]})
        out = out.drop("_nivel", *(f"_k_{c}" for c in columns), *(f"_v_{n}" for n in parts[0][3]))

    out = out.withColumns({n: F.col(n).cast("double" if b.kind == "sum" else "long") for n, b in bases.items()})
    for n, e in measures:
        out = out.withColumn(n, F.expr(e))
    return out.select("nivel", *names.values(), *(n for n, _ in measures))


def _set_id(columns: list[str], kept: list[str]) -> int:
    """grouping_id of a set: a bit per column, the first highest, set where it is rolled up."""
    return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in kept)


def _type(star: Star, column: str):
    dimension, _, name = split_name(column)
    return star.dimensions[dimension].schema[name].dataType


def evaluate_sql(facts: dict[str, str], dimensions: dict[str, str], relationships: list[Relationship], bases: dict[str, Base], columns: dict[str, set],
                 measures: list[tuple[str, str]], by: list[str], where: dict | None = None, levels: list[list[str]] | None = None) -> str:
    """Oracle: per level and base a plain join of the fact with its dimensions under the slicers.
    ``facts`` and ``dimensions`` name CTEs or tables, ``columns`` the columns of each dimension."""
    where, levels = where or {}, levels if levels is not None else [by]
    used = set().union(*(re.findall(r"\w+", e) for _, e in measures))
    need = {n: b for n, b in bases.items() if n in used}

    def rel(fact, c):
        dimension, role, name = split_name(c)
        return next((r for r in relationships if (r.fact, r.dimension, r.role) == (fact, dimension, role)), None)

    def source(fact, slicers):
        joins, conds = "", []
        for r in relationships:
            if r.fact == fact:
                alias = f"{r.dimension}_{r.role}"
                joins += f" LEFT JOIN {dimensions[r.dimension]} {alias} ON f.{r.key} = {alias}.{r.dimension_key}"
        for c, v in slicers.items():
            if r := rel(fact, c):
                conds.append(f"{r.dimension}_{r.role}.{split_name(c)[2]} IN ({', '.join(repr(x) for x in values(v))})")
        return f"{facts[fact]} f{joins}" + (" WHERE " + " AND ".join(conds) if conds else "")

    def col(fact, c):
        r = rel(fact, c)
        return f"{r.dimension}_{r.role}.{split_name(c)[2]}"

    parts = []
    for k, level in enumerate(levels):
        spines, joins, picked = [], "", []
        for i, (n, b) in enumerate(need.items()):
            slicers = {c: v for c, v in where.items() if c not in b.ignores}
            mine = [] if b.all_selected else [c for c in level if rel(b.fact, c) and c not in b.ignores]
            keys = "".join(f"{col(b.fact, c)} AS {output_name(c)}, " for c in mine)
            agg = f"CAST(sum(f.{b.column}) AS DOUBLE)" if b.kind == "sum" else f"count(DISTINCT f.{b.column})"
            group = f" GROUP BY {', '.join(col(b.fact, c) for c in mine)}" if mine else ""
            table = f"(SELECT {keys}{agg} AS {n} FROM {source(b.fact, slicers)}{group})"
            on = " AND ".join(f"s.{output_name(c)} IS NOT DISTINCT FROM b{i}.{output_name(c)}" for c in mine) or "true"
            joins += f" LEFT JOIN {table} b{i} ON {on}"
            picked.append(f"b{i}.{n}")
            if mine == list(level) and not b.all_selected and not b.ignores:
                spines.append(f"SELECT {', '.join([f'{col(b.fact, c)} AS {output_name(c)}' for c in mine] or ['1 AS uno'])} FROM {source(b.fact, slicers)}" if mine else "SELECT 1 AS uno")
        shown = ", ".join(f"s.{output_name(c)}" if c in level else f"NULL AS {output_name(c)}" for c in by)
        parts.append(f"SELECT {k} AS nivel, {shown}{', ' if shown else ''}{', '.join(picked)} FROM (SELECT DISTINCT * FROM ({' UNION '.join(spines)}) u) s{joins}")
    body = " UNION ALL ".join(parts)
    for i, (n, e) in enumerate(measures):
        body = f"SELECT *, {e} AS {n} FROM ({body}) m{i}"
    return f"SELECT nivel, {', '.join([output_name(c) for c in by] + [n for n, _ in measures])} FROM ({body}) r"
