"""Consistency checks read from a table of rules: over rows, groups, tables and periods.

A rule names a table, a kind and a condition that holds for a fault:

``row``
    ``condition`` over the columns of a row; ``keys`` name the row.
``group``
    ``condition`` over ``value``, the ``measure`` (an SQL aggregate) of each
    group of ``keys``, and ``n``, its rows.
``reference``
    each group of ``keys`` is looked up in ``other_table`` by ``other_keys``;
    ``condition`` over ``found``, ``value`` and ``other`` (``other_measure``
    there); by default ``not found``. Keys with a null refer to nothing and pass.
``period``
    ``condition`` over ``value`` of each group and ``period`` (a whole number),
    ``previous``, the value of the group's last period before (null in its
    first), and ``gap``, the periods between the two.

An unknown condition (null) is no fault. All rules of a table share one pass:
each row contributes to every grouping that some rule needs (to a row rule's
only if it breaks one), and a single aggregation, combined before its shuffle,
serves them all. Its result is staged, so each table is read once whatever the
number of rules, and no join or window sees more than one row per group.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tallyweave.session import stage

ROW, GROUP, REFERENCE, PERIOD = "row", "group", "reference", "period"
RULE_SCHEMA = (
    "rule string, kind string, table_name string, keys string, condition string, measure string, period string, "
    "other_table string, other_keys string, other_measure string"
)
_VIOLATION = ["rule", "kind", "key", "period", "value", "other", "rows"]


@dataclass(frozen=True)
class Rule:
    """One rule; ``keys`` are SQL expressions separated by semicolons."""

    rule: str
    kind: str
    table_name: str
    keys: tuple[str, ...]
    condition: str
    measure: str
    period: str
    other_table: str
    other_keys: tuple[str, ...]
    other_measure: str

    @classmethod
    def of(cls, row: Row) -> Rule:
        given = {k: (v or "").strip() for k, v in row.asDict().items()}
        split = lambda text: tuple(part.strip() for part in text.split(";") if part.strip())
        if given["kind"] == REFERENCE:
            given["condition"] = given["condition"] or "not found"
        given = {name: given.get(name, "") for name in cls.__dataclass_fields__}
        return cls(**given | {"keys": split(given["keys"]), "other_keys": split(given["other_keys"])})

    def problem(self, tables: Mapping[str, DataFrame]) -> str | None:
        """What is wrong with the rule itself, if anything."""
        if self.kind not in (ROW, GROUP, REFERENCE, PERIOD):
            return f"unknown kind {self.kind!r}"
        for name in (self.table_name, *([self.other_table] if self.kind == REFERENCE else [])):
            if name not in tables:
                return f"unknown table {name!r}"
        if not self.keys:
            return "no keys"
        if not self.condition:
            return "no condition"
        if self.kind == PERIOD and not (self.period and self.measure):
            return "a period rule needs a period and a measure"
        if self.kind == REFERENCE and len(self.keys) != len(self.other_keys):
            return "keys and other_keys differ in number"
        return None


@dataclass
class _Pass:
    """What one table has to be aggregated to: groupings, measures and row conditions."""

    sets: dict[tuple[str, tuple[str, ...], str], int] = field(default_factory=dict)
    measures: dict[str, int] = field(default_factory=dict)
    rows: dict[int, list[Rule]] = field(default_factory=dict)

    def grouping(self, kind: str, keys: tuple[str, ...], period: str = "") -> int:
        return self.sets.setdefault((kind, keys, period), len(self.sets) + 1)

    def measure(self, text: str) -> str:
        return f"m{self.measures.setdefault(text, len(self.measures))}" if text else "cast(null as double)"


@dataclass
class Checked:
    """``violations``: one row for each fault; ``report``: rules with what they checked and found."""

    violations: DataFrame
    report: DataFrame


def read_rules(rules: DataFrame, tables: Mapping[str, DataFrame]) -> list[Rule]:
    """The rules of a table, refused as a whole if one cannot be planned."""
    found = [Rule.of(row) for row in rules.orderBy("rule").collect()]
    problems = [f"{r.rule}: {p}" for r in found if (p := r.problem(tables))]
    names = [r.rule for r in found]
    problems += [f"{n}: named twice" for n in sorted({n for n in names if names.count(n) > 1})]
    if problems:
        raise ValueError("; ".join(problems))
    return found


def _aggregated(df: DataFrame, plan: _Pass) -> DataFrame:
    """One row for each grouping and key: rows, measures, and broken row rules."""
    flags = {r.rule: F.coalesce(F.expr(r.condition), F.lit(False)) for own in plan.rows.values() for r in own}
    numbers = {name: i for i, name in enumerate(flags)}
    flagged = df.withColumns({f"_f{numbers[n]}": c for n, c in flags.items()}) if flags else df
    none = F.lit(None).cast("long")
    parts = [F.struct(F.lit(0).alias("set"), F.array().cast("array<string>").alias("keys"), none.alias("period"))]
    for (_, keys, period), number in plan.sets.items():
        texts = F.array(*[F.expr(k).cast("string") for k in keys])
        part = F.struct(F.lit(number).alias("set"), texts.alias("keys"), (F.expr(period).cast("long") if period else none).alias("period"))
        if number in plan.rows:
            broken = F.array_contains(F.array(*[F.col(f"_f{numbers[r.rule]}") for r in plan.rows[number]]), True)
            part = F.when(broken, part)
        parts.append(part)
    spread = flagged.withColumn("_part", F.explode(F.array_compact(F.array(*parts))))
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.count_if(F.col(f"_f{i}")).alias(f"f{i}") for i in numbers.values()]
    sums += [F.expr(text).cast("double").alias(f"m{j}") for text, j in plan.measures.items()]
    grouped = spread.groupBy(F.col("_part.set").alias("set"), F.col("_part.keys").alias("keys"), F.col("_part.period").alias("period"))
    return grouped.agg(*sums)


def _key_text(keys: tuple[str, ...]) -> Column:
    named = [F.concat(F.lit(f"{k}="), F.coalesce(F.get("keys", F.lit(i)), F.lit("null"))) for i, k in enumerate(keys)]
    return F.concat_ws(", ", *named)


def _faults(frame: DataFrame, rules: list[Rule], keys: tuple[str, ...], cells: list[tuple[Column, Column, Column]], rows: list[Column]) -> DataFrame:
    """Explode the rules each row of ``frame`` breaks; ``cells`` hold condition, value and other of each rule, ``rows`` the rows it counts."""
    entries = []
    for rule, (broken, value, other), count in zip(rules, cells, rows, strict=True):
        values = (value.cast("double").alias("value"), other.cast("double").alias("other"), count.alias("rows"))
        entry = F.struct(F.lit(rule.rule).alias("rule"), F.lit(rule.kind).alias("kind"), *values)
        entries.append(F.when(broken, entry))
    hit = frame.select(_key_text(keys).alias("key"), "period", F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return hit.select("e.rule", "e.kind", "key", "period", "e.value", "e.other", "e.rows")


def check_rules(rules: DataFrame, tables: Mapping[str, DataFrame]) -> Checked:
    """Check ``tables`` by a table of rules (columns of ``RULE_SCHEMA``)."""
    found = read_rules(rules, tables)
    if not found:
        empty = rules.sparkSession.createDataFrame
        return Checked(
            empty([], "rule string, kind string, key string, period long, value double, other double, rows long"),
            empty([], "rule string, kind string, checked long, faults long"),
        )
    passes: dict[str, _Pass] = {}
    placed: dict[tuple, list[Rule]] = {}
    for rule in found:
        plan = passes.setdefault(rule.table_name, _Pass())
        kind = ROW if rule.kind == ROW else "keys"
        number = plan.grouping(kind, rule.keys, rule.period if rule.kind == PERIOD else "")
        plan.measure(rule.measure)
        if rule.kind == ROW:
            plan.rows.setdefault(number, []).append(rule)
        other = 0
        if rule.kind == REFERENCE:
            there = passes.setdefault(rule.other_table, _Pass())
            other = there.grouping("keys", rule.other_keys)
            there.measure(rule.other_measure)
        placed.setdefault((rule.table_name, number, rule.kind, rule.other_table, other), []).append(rule)
    groups = {name: stage(_aggregated(tables[name], plan), f"groups-{name}") for name, plan in passes.items()}
    null = F.lit(None).cast("double")
    parts, checked = [], []
    for (name, number, kind, other_table, other), own in placed.items():
        plan, frame = passes[name], groups[name].filter(F.col("set") == number)
        keys = own[0].keys
        total = frame.agg(F.count(F.lit(1)).alias("checked"))
        rows = [F.col("n")] * len(own)
        if kind == ROW:
            flags = {r.rule: i for i, r in enumerate(r for rs in plan.rows.values() for r in rs)}
            rows = [F.col(f"f{flags[r.rule]}") for r in own]
            cells = [(count > 0, null, null) for count in rows]
            total = groups[name].filter("set = 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("checked"))
        elif kind == GROUP:
            cells = [(_holds(r, plan.measure(r.measure), "n"), F.expr(plan.measure(r.measure)), null) for r in own]
        elif kind == REFERENCE:
            there = passes[other_table]
            wanted = sorted({there.measure(r.other_measure) for r in own if r.other_measure})
            parents = groups[other_table].filter(F.col("set") == other)
            parents = parents.select(F.col("keys").alias("_keys"), *[F.col(m).alias(f"o_{m}") for m in wanted])
            frame = frame.filter(F.forall("keys", lambda k: k.isNotNull()))
            total = frame.agg(F.count(F.lit(1)).alias("checked"))
            frame = frame.join(parents, F.col("keys") == F.col("_keys"), "left").withColumn("found", F.col("_keys").isNotNull())
            cells = []
            for r in own:
                far = f"o_{there.measure(r.other_measure)}" if r.other_measure else "cast(null as double)"
                cells.append((_holds(r, plan.measure(r.measure), far), F.expr(plan.measure(r.measure)), F.expr(far)))
        else:
            before = Window.partitionBy("keys").orderBy("period")
            frame = frame.filter("period is not null")
            total = frame.agg(F.count(F.lit(1)).alias("checked"))
            wanted = sorted({plan.measure(r.measure) for r in own})
            frame = frame.withColumns({f"p_{m}": F.lag(m).over(before) for m in wanted} | {"gap": F.col("period") - F.lag("period").over(before)})
            cells = [(_holds(r, plan.measure(r.measure), f"p_{plan.measure(r.measure)}"), F.expr(plan.measure(r.measure)), F.col(f"p_{plan.measure(r.measure)}")) for r in own]
        parts.append(_faults(frame, own, keys, cells, rows))
        checked.append(total.select(F.explode(F.array(*[F.lit(r.rule) for r in own])).alias("rule"), F.lit(kind).alias("kind"), "checked"))
    violations = parts[0]
    for part in parts[1:]:
        violations = violations.unionByName(part)
    violations = stage(violations.select(*_VIOLATION), "violations")
    counts = checked[0]
    for more in checked[1:]:
        counts = counts.unionByName(more)
    faults = violations.groupBy("rule").agg(F.count(F.lit(1)).alias("faults"))
    report = counts.join(faults, "rule", "left").select("rule", "kind", "checked", F.coalesce("faults", F.lit(0)).cast("long").alias("faults"))
    return Checked(violations, report)


#: Names by which conditions of each kind call the measure and what it is held against.
_NAMES = {GROUP: ("value", "n"), REFERENCE: ("value", "other"), PERIOD: ("value", "previous")}


def _holds(rule: Rule, value: str, other: str) -> Column:
    """The condition with its names bound to columns of the aggregated table."""
    first, second = _NAMES[rule.kind]
    inner = f"coalesce({rule.condition}, false)"
    if second != other:
        inner = f"exists(array({other}), {second} -> {inner})"
    return F.expr(f"exists(array({value}), {first} -> {inner})")
