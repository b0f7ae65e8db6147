"""The rule register (D44): the last result of every declared rule, and whether it still holds.

The register is a parquet dataset that only grows: each run of a family appends one small file with, for every rule,
the version of the rule's tables and the number of violations (none if the rule could not be checked). A file
appears as a whole or not at all, and the last entry of a rule counts, so readers and several writers need no lock.
A result holds as long as the rule's tables have the version it was found on.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremesa.operators import constraints
from caremesa.operators.constraints import KeyRule, ReferenceRule, RowRule, Rule
from caremesa.sources.tables import Tables

c = F.col
ENTRY = "Family string, RuleName string, TableName string, TableVersion string, Violations bigint, IsEnabled boolean, Run bigint"


class RuleRegister:
    """The rules of ``families`` (rules by family) over ``tables``, with the register in ``folder``."""

    def __init__(self, tables: Tables, folder: str, families: Mapping[str, Sequence[Rule]], as_of: str) -> None:
        self.tables, self.folder, self.families, self.as_of = tables, folder, families, as_of
        self.spark: SparkSession = tables.spark
        self._versions: dict[str, str] = {}

    def _version(self, rule: Rule) -> str:
        """Of all tables and columns that the rule reads, and of the rule itself."""
        if not self._versions:
            needed = {table for own in self.families.values() for one in own for table in one.needs}
            present = self.tables.versions(sorted(table for table in needed if table in self.tables))
            self._versions = {table: present.get(table, "absent") for table in needed}
        dated = self.as_of if ":as_of" in repr(rule) else ""
        text = "\n".join([repr(rule), dated, *(self._versions[table] for table in rule.needs)])
        return hashlib.sha256(text.encode()).hexdigest()[:16]

    def entries(self) -> DataFrame:
        """Everything recorded so far; empty without a register."""
        try:
            return self.spark.read.schema(ENTRY).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ENTRY)

    def latest(self) -> DataFrame:
        """The last entry of each rule; one scan."""
        rest = [field.split()[0] for field in ENTRY.split(", ") if not field.startswith(("RuleName", "Run"))]
        last = self.entries().groupBy("RuleName").agg(F.max(F.struct("Run", *rest)).alias("e"))
        return last.select("RuleName", *(f"e.{name}" for name in rest))

    def _append(self, rows: DataFrame) -> None:
        rows.select(*(c(field.split()[0]).cast(field.split()[1]) for field in ENTRY.split(", "))).coalesce(1).write.mode("append").parquet(self.folder)

    def _check(self, rules: Sequence[Rule]) -> DataFrame:
        kinds = (
            (RowRule, lambda some: constraints.check_rows(self.tables, some, self.as_of)),
            (KeyRule, lambda some: constraints.check_keys(self.tables, some)),
            (ReferenceRule, lambda some: constraints.check_references(self.tables, some)),
        )
        reports = [check(some) for kind, check in kinds if (some := [rule for rule in rules if isinstance(rule, kind)])]
        return constraints.stack(reports)

    def run(self, families: Sequence[str] | None = None, rules: Sequence[Rule] | None = None) -> DataFrame:
        """Checks families of rules (all, if none are named) or some of their rules, and records the results.

        Gives RuleName, TableName and Violations of the rules that could be checked, as recorded.
        """
        family = {rule.name: name for name, own in self.families.items() for rule in own}
        wanted = list(rules) if rules is not None else [rule for name in families or self.families for rule in self.families[name]]
        there, absent = constraints.checkable(self.tables, wanted)
        known = [(family[rule.name], rule.name, rule.table, self._version(rule)) for rule in (*there, *absent)]
        number = time.time_ns()
        listed = self.spark.createDataFrame(known, "Family string, RuleName string, TableName string, TableVersion string")
        results = listed.withColumn("Violations", F.lit(None).cast("bigint"))
        if there:
            results = listed.join(self._check(there).select("RuleName", "Violations"), "RuleName", "left")
        self._append(results.withColumns({"IsEnabled": F.lit(True), "Run": F.lit(number)}))
        mine = self.entries().where((c("Run") == number) & c("Violations").isNotNull())
        return mine.select("RuleName", "TableName", "Violations")

    def switch(self, names: Sequence[str], enabled: bool) -> None:
        """Switches rules off or on again; one that is switched on has to be checked anew."""
        rows = [(name, rule.name, rule.table, enabled) for name, own in self.families.items() for rule in own if rule.name in names]
        if unknown := set(names) - {row[1] for row in rows}:
            raise KeyError(f"Unknown rules: {sorted(unknown)}")
        listed = self.spark.createDataFrame(rows, "Family string, RuleName string, TableName string, IsEnabled boolean")
        blank = {"TableVersion": F.lit(None).cast("string"), "Violations": F.lit(None).cast("bigint"), "Run": F.lit(time.time_ns())}
        self._append(listed.withColumns(blank))

    def states(self) -> DataFrame:
        """Every declared rule: Family, RuleName, TableName, Violations and RuleState.

        TRUSTED and FAILING results were found on the present tables; UNTRUSTED ones on other
        versions, or never; NOT CHECKED rules lack a table or column; OFF rules are switched off.
        """
        declared = [(name, rule.name, rule.table, self._version(rule)) for name, own in self.families.items() for rule in own]
        present = self.spark.createDataFrame(declared, "Family string, RuleName string, TableName string, Present string")
        found = self.latest().select("RuleName", "TableVersion", "Violations", "IsEnabled")
        state = (
            F.when(~c("IsEnabled"), "OFF")
            .when(c("TableVersion").isNull() | (c("TableVersion") != c("Present")), "UNTRUSTED")
            .when(c("Violations").isNull(), "NOT CHECKED")
            .when(c("Violations") == 0, "TRUSTED")
            .otherwise("FAILING")
        )
        return present.join(found, "RuleName", "left").select("Family", "RuleName", "TableName", "Violations", state.alias("RuleState"))

    def refresh(self) -> DataFrame:
        """Checks the rules that are untrusted, and gives ``states``; a register that is up to date runs none."""
        stale = {row["RuleName"] for row in self.states().where("RuleState = 'UNTRUSTED'").select("RuleName").collect()}  # at most one a rule
        if stale:
            self.run(rules=[rule for own in self.families.values() for rule in own if rule.name in stale])
        return self.states()

    def open_rules(self) -> DataFrame:
        """The rules that fail or could not be checked, after the untrusted ones have been checked anew."""
        status = F.when(c("RuleState") == "FAILING", "FAIL").otherwise("NOT CHECKED").alias("RuleStatus")
        open_ones = self.refresh().where("RuleState in ('FAILING', 'NOT CHECKED')")
        return open_ones.select("RuleName", "TableName", "Violations", status).orderBy("TableName", "RuleName")
