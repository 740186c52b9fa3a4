"""Whole-table decisions from what is known of each batch, so that landed rows are not read again.

Of every batch a small state is kept: the sums of its profile and, under given column rules, how many
rows hold something, which columns have few values (and these), and which columns are equal. States
merge exactly: sums add up, few values unite, columns are equal if they are in every batch. The
plan of merged states is that of a fit over all rows. Only if more rows change a column's rule are
the earlier batches measured again.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import asdict, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col, normalize_columns
from ..sources.files import FileSystem
from .clean import CleanConfig, CleanPlan, ColumnRule, EmptyTable, _normalized, decided, rules_for
from .columns import Variety, distinct_value, equal_values, is_comparable, proven_distinct, value_class
from .profile import profile_of, profile_sums


def _few_values(df: DataFrame, names: Sequence[str], most: int) -> dict[str, list[str | None]]:
    """Distinct values, as text, of the columns that have fewer than ``most``; read from these columns only."""
    if not names:
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    entries = [F.struct(F.lit(i).alias("c"), distinct_value(col(n), types[n]).cast("string").alias("v")) for i, n in enumerate(names)]
    pairs = df.select(F.explode(F.array(*entries)).alias("e")).select("e.c", "e.v").distinct()
    counted = pairs.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"))
    few = pairs.join(counted.where(F.col("n") < most).select("c"), "c", "left_semi")
    out: dict[str, list] = {names[r.c]: [] for r in counted.where(F.col("n") < most).collect()}
    for r in few.collect():
        out[names[r.c]].append(r.v)
    return out


def _equal_groups(df: DataFrame, groups: list[list[str]]) -> list[list[str]]:
    """Columns with equal fingerprints as groups of columns that are equal in every row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    found: list[list[str]] = []
    while groups:
        checks = [(g[0], other) for g in groups for other in g[1:]]
        row = df.agg(*[F.bool_and(equal_values(col(a), types[a], col(b), types[b])).alias(f"p{i}") for i, (a, b) in enumerate(checks)]).first()
        same = {b for i, (_, b) in enumerate(checks) if row[i]}
        found += [[g[0], *(x for x in g[1:] if x in same)] for g in groups]
        groups = [rest for g in groups if len(rest := [x for x in g[1:] if x not in same]) > 1]
    return [g for g in found if len(g) > 1]


def profiled(df: DataFrame, names: Sequence[str], untyped: bool) -> dict:
    """The sums of one batch's profile."""
    return profile_sums(df.toDF(*names), untyped)


def measured(df: DataFrame, names: Sequence[str], cfg: CleanConfig, rules: tuple[ColumnRule, ...]) -> dict:
    """The variety of one batch's rows as ``rules`` clean them: one read of its columns, and one of those with few values."""
    plan = CleanPlan(names=tuple(names), rules=rules, config=replace(cfg, extra_steps=()))
    out = plan.project(plan.filtered(df.toDF(*names)), plan.cleaned_columns())
    variety = Variety(out, cfg.min_distinct)
    got, words, fields = variety.measured, range(variety.words), out.schema.fields
    doubtful = [f.name for i, f in enumerate(fields) if is_comparable(f.dataType) and proven_distinct(*(got[f"bits_{i}_{w}"] for w in words)) < cfg.min_distinct]
    prints: dict[tuple, list[str]] = defaultdict(list)
    for i, f in enumerate(fields):
        if f"low_{i}" in got:
            prints[value_class(f.dataType), got[f"low_{i}"], got[f"high_{i}"]].append(f.name)
    return {
        "rules": [asdict(r) for r in rules],
        "rows": variety.rows,
        "few": _few_values(out, doubtful, cfg.min_distinct) if variety.rows else {n: [] for n in doubtful},
        "equal": _equal_groups(out, [g for g in prints.values() if len(g) > 1]) if variety.rows else [],
    }


def merged_profile(states: Sequence[dict]) -> dict[str, int]:
    """Sums of all states; nought where there is none."""
    total: dict[str, int] = defaultdict(int)
    for s in states:
        for k, v in s["profile"].items():
            total[k] += v
    return total


class AdditivePlan:
    """The cleaning plan of a growing table, from states kept in ``folder``, one small file for each batch."""

    def __init__(self, spark, folder: str, columns: Sequence[str], config: CleanConfig | None = None, untyped: bool = True):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.names = tuple(normalize_columns(columns))
        cfg = config or CleanConfig()
        self.config = replace(cfg, string_columns=_normalized(cfg.string_columns, columns, self.names))
        self.untyped = untyped

    def _states(self) -> dict[str, dict]:
        files = FileSystem(self.spark)
        found = [n for n in files.names(self.folder) if n.endswith(".json") and not n.startswith(".")]
        return {n.removesuffix(".json"): json.loads(files.read_text(f"{self.folder}/{n}")) for n in found}

    def _keep(self, name: str, state: dict) -> dict:
        FileSystem(self.spark).write_text(f"{self.folder}/{name}.json", json.dumps(state))
        return state

    def plan(self, batches: Sequence[str], read: Callable[[str], DataFrame], schema: T.StructType) -> tuple[CleanPlan, list[str]]:
        """The plan over all ``batches``, and which of them were read for it: new ones, or all if a rule changed."""
        states = {b: s for b, s in self._states().items() if b in set(batches)}
        fields = [T.StructField(n, f.dataType) for n, f in zip(self.names, schema.fields)]
        for b in batches:
            if b not in states:
                states[b] = self._keep(b, {"profile": profiled(read(b), self.names, self.untyped)})
        profile = profile_of(fields, merged_profile([states[b] for b in batches]))
        rules = rules_for(profile, fields, self.config, self.untyped)
        if not profile.rows or not rules:
            raise EmptyTable(f"{profile.rows} rows, {len(rules)} columns left after dropping sparse columns")
        stale = [b for b in batches if states[b].get("rules") != [asdict(r) for r in rules]]
        for b in stale:
            states[b] = self._keep(b, {"profile": states[b]["profile"], **measured(read(b), self.names, self.config, rules)})
        return self._merged([states[b] for b in batches], profile.rows, rules), stale

    def _merged(self, states: list[dict], n: int, rules: tuple[ColumnRule, ...]) -> CleanPlan:
        cfg, rows = self.config, sum(s["rows"] for s in states)
        counting = [s for s in states if s["rows"]]
        low = set()
        for name in [r.name for r in rules] if cfg.min_distinct > 1 else []:
            if all(name in s["few"] for s in counting):
                values = {v for s in counting for v in s["few"][name]}
                if len(values) < cfg.min_distinct and (counting or any(name in s["few"] for s in states)):
                    low.add(name)
        varied = [r.name for r in rules if r.name not in low]
        groups = [{c: i for i, g in enumerate(s["equal"]) for c in g} for s in counting]
        same = lambda a, b: bool(groups) and all(a in g and g[a] == g.get(b) for g in groups)
        copies = {b for k, b in enumerate(varied) if any(same(a, b) for a in varied[:k])}
        plan = CleanPlan(names=self.names, rules=rules, config=replace(cfg, extra_steps=()))
        return decided(plan, cfg, n, rows, varied, copies)

