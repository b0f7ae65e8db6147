"""Declared rules as distributed checks.

Rules are data and name their columns, so whether a rule can be checked is a comparison of
column sets. Each family makes one pass over its tables, and key rules share one exchange:

* row rules: the rules of a table are counted side by side over its rows, without a grouping;
* unique keys: counts per (rule, 64-bit hash of the key) are combined before the shuffle. Only hashes that
  occur twice are looked at again, on the typed columns, so hashes that collide by chance do no harm;
* foreign keys of one whole-number column: child and parent keys become bitmaps, one 64-bit word for 64
  neighbouring keys, combined before the shuffle. Child bits without parent bits are the orphan keys. A word costs
  no more than a key, so sparse keys cost no more than a plain list of them. Rows are counted for orphans only;
* other foreign keys: child and parent keys of one combination of types are hashed into one grouping, without a
  sort. A bit for each rule and one for the parent tell the orphans. The rows of a key that is the orphan of one rule
  are counted on the way, only those of keys that are orphans of several rules in a second scan.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType

from caremesa.sources.shared import settled
from caremesa.sources.tables import Tables

c = F.col
#: Words of a predicate that are no columns.
SQL_WORDS = frozenset(
    "and or not in is null between case when then else end true false date interval minute like rlike coalesce trim ltrim rtrim "
    "length try_parse_json as_of if".split()
)


def named_columns(predicate: str | None) -> tuple[str, ...]:
    """The columns that an SQL predicate names, in order."""
    text = re.sub(r"'(?:[^']|'')*'", " ", predicate or "")
    words = re.findall(r"(?<![\w.:])[A-Za-z_]\w*\b(?!\s*\()", text)
    return tuple(dict.fromkeys(word for word in words if word.lower() not in SQL_WORDS))


@dataclass(frozen=True)
class RowRule:
    """A row breaks the rule when ``predicate`` is false; unknown passes. ``:as_of`` stands for a date.

    ``columns`` may state the columns that the predicate reads; else they are found in its text.
    """

    name: str
    table: str
    predicate: str
    columns: tuple[str, ...] = ()

    @property
    def needs(self) -> dict[str, tuple[str, ...]]:
        """The columns that the rule reads, by table."""
        return {self.table: self.columns or named_columns(self.predicate)}


@dataclass(frozen=True)
class KeyRule:
    """``columns`` must be unique among the rows that meet ``condition``; absent parts equal each other."""

    name: str
    table: str
    columns: tuple[str, ...]
    condition: str | None = None

    @property
    def needs(self) -> dict[str, tuple[str, ...]]:
        return {self.table: tuple(dict.fromkeys((*self.columns, *named_columns(self.condition))))}


@dataclass(frozen=True)
class ReferenceRule:
    """Non-NULL child columns must exist in the parent; any NULL part passes."""

    name: str
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]

    @property
    def needs(self) -> dict[str, tuple[str, ...]]:
        if self.table == self.parent:
            return {self.table: tuple(dict.fromkeys((*self.columns, *self.parent_columns)))}
        return {self.table: self.columns, self.parent: self.parent_columns}


Rule = RowRule | KeyRule | ReferenceRule


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def checkable(tables: Tables, rules: Iterable[Rule]) -> tuple[list, list]:
    """The rules whose tables and columns are all there, and the others."""
    there: list = []
    absent: list = []
    for rule in rules:
        whole = all(
            table in tables and {name.lower() for name in columns} <= tables.types(table).keys() for table, columns in rule.needs.items()
        )
        (there if whole else absent).append(rule)
    return there, absent


def _by_table(rules: Iterable[Rule]) -> dict[str, list]:
    found: dict[str, list] = defaultdict(list)
    for rule in rules:
        found[rule.table].append(rule)
    return found


def _read_for(tables: Tables, table: str, mine: Sequence[Rule]) -> DataFrame:
    """One scan of a table with the columns that its rules name."""
    return tables.read(table, *dict.fromkeys(name for rule in mine for name in rule.needs[table]))


def _reported(tables: Tables, rules: Sequence[Rule], counted: DataFrame | None) -> DataFrame:
    """Violations by rule number as a report; rules without any have zero."""
    listed = [(i, rule.name, rule.table) for i, rule in enumerate(rules)]
    report = tables.spark.createDataFrame(listed, "rule int, RuleName string, TableName string")
    if counted is None:
        return report.select("RuleName", "TableName", F.lit(0).cast("bigint").alias("Violations"))
    violations = F.coalesce("v", F.lit(0)).cast("bigint").alias("Violations")
    return report.join(counted.select("rule", "v"), "rule", "left").select("RuleName", "TableName", violations)


def _hash_keys(tables: Tables, rule: KeyRule) -> str:
    """SQL text of the key columns for a hash: texts that are equal under their collation give equal values.

    Texts of a collation without case or trailing blanks are taken without both; under any
    other collation every text gives the same value, and only the comparison tells them apart.
    """
    types, keys = tables.types(rule.table), []
    for name in rule.columns:
        collation = getattr(types[name.lower()], "collation", None) or "UTF8_BINARY"
        if collation == "UTF8_BINARY":
            keys.append(f"`{name}`")
        elif collation.startswith("UTF8_LCASE"):
            keys.append(f"lower(rtrim(collate(`{name}`, 'UTF8_BINARY')))")
        else:
            keys.append(f"`{name}` is null")
    return ", ".join(keys)


def _record(condition: str, number: int, **fields: str) -> str:
    """SQL text of one record of a rule, absent where the condition does not hold."""
    named = ", ".join(f"'{name}', {text}" for name, text in fields.items())
    return f"if({condition}, named_struct('rule', {number}, {named}), null)"


def _exploded(rows: DataFrame, records: Sequence[str]) -> DataFrame:
    """One row for each record that is there."""
    return rows.selectExpr(f"inline(array({', '.join(records)}))").where("rule is not null")


# -- row rules ------------------------------------------------------------------


def check_rows(tables: Tables, rules: Sequence[RowRule], as_of: str) -> DataFrame:
    """All row rules of a table in one scan and one row of counts.

    Rules that cannot be checked are left out. No rules give no rows.
    """
    there, _ = checkable(tables, rules)
    by_table = _by_table(there)
    ordered = [rule for mine in by_table.values() for rule in mine]
    if not ordered:
        return _reported(tables, ordered, None)
    frames, first = [], 0
    for table, mine in by_table.items():
        broken = [rule.predicate.replace(":as_of", f"date'{as_of}'") for rule in mine]
        counts = _read_for(tables, table, mine).agg(*(F.expr(f"count_if(not ({predicate}))").alias(f"f{i}") for i, predicate in enumerate(broken)))
        each = [f"named_struct('rule', {first + i}, 'v', f{i})" for i in range(len(mine))]
        frames.append(counts.selectExpr(f"inline(array({', '.join(each)}))"))
        first += len(mine)
    return _reported(tables, ordered, stack(frames))


# -- unique keys ----------------------------------------------------------------

def check_keys(tables: Tables, rules: Sequence[KeyRule], hashed: str = "xxhash64({keys})") -> DataFrame:
    """Number of key values held by more than one row.

    ``hashed`` is the SQL text of a whole number for key columns; any such text gives the
    same result, a better one fewer rows to look at again.
    """
    there, _ = checkable(tables, rules)
    by_table = _by_table(there)
    ordered = [rule for mine in by_table.values() for rule in mine]
    if not ordered:
        return _reported(tables, ordered, None)
    number = {id(rule): i for i, rule in enumerate(ordered)}
    frames = []
    for table, mine in by_table.items():
        hashes = [hashed.format(keys=_hash_keys(tables, rule)) for rule in mine]
        records = [_record(rule.condition or "true", number[id(rule)], hash=text) for rule, text in zip(mine, hashes)]
        frames.append(_exploded(_read_for(tables, table, mine), records))
    twice = settled(stack(frames).groupBy("rule", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rule", "hash"))
    suspects = sorted(row["rule"] for row in twice.select("rule").distinct().collect())  # at most one a rule
    if not suspects:
        return _reported(tables, ordered, None)
    counted = []
    for i in suspects:
        rule = ordered[i]
        rows = _read_for(tables, rule.table, [rule])
        rows = rows.where(rule.condition) if rule.condition else rows
        again = rows.withColumn("_hash", F.expr(hashed.format(keys=_hash_keys(tables, rule))))
        again = again.join(twice.where(c("rule") == i).select(c("hash").alias("_hash")), "_hash", "left_semi")
        repeated = again.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
        counted.append(repeated.agg(F.count(F.lit(1)).alias("v")).select(F.lit(i).alias("rule"), "v"))
    return _reported(tables, ordered, stack(counted))


# -- foreign keys ---------------------------------------------------------------

WHOLE = (ByteType, ShortType, IntegerType, LongType)


def _word(key: Column) -> Column:
    """The number of the bitmap word that holds a whole number; negative ones included."""
    return F.shiftright(key, 6)


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(F.lit(63)).cast("int"))


def _is_whole(kind: DataType) -> bool:
    return isinstance(kind, WHOLE)


def _common_types(tables: Tables, rule: ReferenceRule) -> tuple[str, ...]:
    """For each column, the type in which child and parent are compared."""
    mine, parent = tables.types(rule.table), tables.types(rule.parent)
    found = []
    for one, two in zip(rule.columns, rule.parent_columns):
        a, b = mine[one.lower()], parent[two.lower()]
        found.append("bigint" if _is_whole(a) and _is_whole(b) else a.simpleString() if a == b else "string")
    return tuple(found)


def check_references(tables: Tables, rules: Sequence[ReferenceRule]) -> DataFrame:
    """Child rows without a parent, by the path that the types of the keys allow."""
    there, _ = checkable(tables, rules)
    by_types: dict[tuple[str, ...], list[ReferenceRule]] = defaultdict(list)
    for rule in there:
        by_types[_common_types(tables, rule)].append(rule)
    frames = [
        _whole_references(tables, mine) if types == ("bigint",) else _typed_references(tables, mine, types) for types, mine in by_types.items()
    ]
    return stack(frames) if frames else _reported(tables, [], None)


def _children(tables: Tables, rules: Sequence[ReferenceRule], number: dict[int, int], types: tuple[str, ...]) -> DataFrame:
    """(rule, k0, k1, ...) for each child row and rule whose key is whole; each child table is scanned once."""
    frames = []
    for table, mine in _by_table(rules).items():
        records = []
        for rule in mine:
            keys = {f"k{i}": f"cast(`{name}` as {kind})" for i, (name, kind) in enumerate(zip(rule.columns, types))}
            whole = " and ".join(f"`{name}` is not null" for name in rule.columns)
            records.append(_record(whole, number[id(rule)], **keys))
        read = tables.read(table, *dict.fromkeys(name for rule in mine for name in rule.columns))
        frames.append(_exploded(read, records))
    return stack(frames)


def _parent_numbers(rules: Sequence[ReferenceRule]) -> dict[tuple[str, tuple[str, ...]], int]:
    return {parent: i for i, parent in enumerate(dict.fromkeys((rule.parent, rule.parent_columns) for rule in rules))}


def _parents(tables: Tables, rules: Sequence[ReferenceRule], types: tuple[str, ...]) -> DataFrame:
    """(parent, k0, k1, ...) of each key that some rule refers to."""
    frames = []
    for (parent, columns), i in _parent_numbers(rules).items():
        keys = [f"cast(`{name}` as {kind}) as k{j}" for j, (name, kind) in enumerate(zip(columns, types))]
        frames.append(tables.read(parent, *columns).selectExpr(f"{i} as parent", *keys))
    return stack(frames)


def _parent_of(rules: Sequence[ReferenceRule]) -> Column:
    """The number of a rule's parent key, from the rule's number."""
    numbers = _parent_numbers(rules)
    listed = ", ".join(str(numbers[rule.parent, rule.parent_columns]) for rule in rules)
    return F.expr(f"array({listed})[rule]")


def _whole_references(tables: Tables, rules: Sequence[ReferenceRule]) -> DataFrame:
    number = {id(rule): i for i, rule in enumerate(rules)}
    used = (
        _children(tables, rules, number, ("bigint",))
        .groupBy("rule", _word(c("k0")).alias("word")).agg(F.bit_or(_bit(c("k0"))).alias("bits"))
        .withColumn("parent", _parent_of(rules))
    )
    known = (
        _parents(tables, rules, ("bigint",)).where("k0 is not null")
        .groupBy("parent", _word(c("k0")).alias("word")).agg(F.bit_or(_bit(c("k0"))).alias("known"))
    )
    lost = c("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0))))
    orphans = settled(used.join(known, ["parent", "word"], "left").select("rule", "word", lost.alias("bits")).where("bits <> 0"))
    failing = sorted(row["rule"] for row in orphans.select("rule").distinct().collect())  # at most one a rule
    if not failing:
        return _reported(tables, rules, None)
    rows = _children(tables, [rules[i] for i in failing], number, ("bigint",))
    rows = rows.select("rule", _word(c("k0")).alias("word"), _bit(c("k0")).alias("bit"))
    met = rows.join(orphans, ["rule", "word"]).where(c("bits").bitwiseAND(c("bit")) != 0)
    return _reported(tables, rules, met.groupBy("rule").agg(F.count(F.lit(1)).alias("v")))


def _typed_references(tables: Tables, rules: Sequence[ReferenceRule], types: tuple[str, ...]) -> DataFrame:
    """The bits of a key's group are its rules, the sign is the parent; hence at most 63 rules at a time."""
    if len(rules) > 63:
        return stack([_typed_references(tables, rules[i : i + 63], types) for i in range(0, len(rules), 63)])
    number = {id(rule): i for i, rule in enumerate(rules)}
    keys = [f"k{i}" for i in range(len(types))]
    parent = _parent_of(rules).alias("parent")
    whole = " and ".join(f"{key} is not null" for key in keys)
    used = _children(tables, rules, number, types).select(parent, *keys, _bit(c("rule").cast("bigint")).alias("bit"), F.lit(1).cast("bigint").alias("n"))
    known = _parents(tables, rules, types).where(whole).selectExpr("parent", *keys, "shiftleft(1L, 63) as bit", "0L as n")
    met = used.unionByName(known).groupBy("parent", *keys).agg(F.bit_or("bit").alias("bits"), F.sum("n").alias("n"))
    orphans = settled(met.where("bits > 0"))
    alone = F.bit_count("bits") == 1
    several = orphans.where(~alone).agg(F.bit_or("bits")).first()[0]  # one row
    single = orphans.where(alone).groupBy("bits").agg(F.sum("n").alias("v")).selectExpr("bit_count(bits - 1) as rule", "v")
    if several is None:
        return _reported(tables, rules, single)
    shared = _children(tables, [rule for i, rule in enumerate(rules) if several >> i & 1], number, types).select("rule", parent, *keys)
    shared = shared.join(orphans.where(~alone).drop("n"), ["parent", *keys]).where(c("bits").bitwiseAND(_bit(c("rule").cast("bigint"))) != 0)
    counted = single.unionByName(shared.groupBy("rule").agg(F.count(F.lit(1)).alias("v")))
    return _reported(tables, rules, counted.groupBy("rule").agg(F.sum("v").alias("v")))


def with_status(report: DataFrame) -> DataFrame:
    return report.withColumn("RuleStatus", F.when(c("Violations") == 0, "PASS").otherwise("FAIL"))
