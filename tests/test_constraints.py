import datetime as dt
import os
import random
import re
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql.types import BooleanType, DateType, DecimalType, StringType, StructField, StructType, TimestampNTZType

from caremesa.operators import constraints
from caremesa.operators.constraints import KeyRule, ReferenceRule, RowRule
from caremesa.operators.register import RuleRegister
from caremesa.plans import rules
from caremesa.sources.derived import derived_tables
from caremesa.sources.tables import frame_tables, parquet_tables
from oracle.operators import RULE_REPORTS

AS_OF = "1999-06-30"
FOLDER = "/root/testdata/sf0.001"


def counts(report):
    return {r.RuleName: r.Violations for r in report.collect()}


def test_the_catalogue_is_whole():
    sizes = {name: len(own) for name, own in rules.FAMILIES.items()}
    assert sizes == {"D45": 197, "D46": 63, "D47": 38, "D48": 57, "D49": 20, "D50": 4, "D51": 1}
    names = [rule.name for own in rules.FAMILIES.values() for rule in own]
    assert len(set(names)) == len(names) == 380


def test_columns_are_found_in_predicates():
    text = "case when A_b = 'no Col' or trim(C1) <> '' then x is not null else D >= date'1999-01-01' - interval '5' minute end and E <= :as_of"
    assert constraints.named_columns(text) == ("A_b", "C1", "x", "D", "E")
    assert constraints.named_columns(None) == () and RowRule("r", "t", "a > 0", ("b",)).needs == {"t": ("b",)}


def test_row_rules_pass_on_unknown(spark):
    tables = frame_tables(spark, {
        "t": spark.createDataFrame([(1, 2), (None, 2), (3, 2)], "a int, b int"),
        "u": spark.createDataFrame([], "a int"),
        "v": spark.createDataFrame([(0,), (-1,)], "a int"),
    })
    listed = [RowRule("t1", "t", "a >= b"), RowRule("t2", "t", "b = 2"), RowRule("u1", "u", "a > 0"), RowRule("v1", "v", "a > 0"),
              RowRule("gone", "t", "z > 0"), RowRule("nowhere", "w", "a > 0"), RowRule("dated", "t", "date'2000-01-01' <= :as_of and b > 0")]
    assert counts(constraints.check_rows(tables, listed, AS_OF)) == {"t1": 1, "t2": 0, "u1": 0, "v1": 2, "dated": 3}
    assert counts(constraints.check_rows(tables, [], AS_OF)) == {}


def test_json_and_digit_rules(spark):
    texts = ['{"a":1}', "[1]", "1", "{x", None, "  {}"]
    codes = ["0123456789", "012345678", "01234x6789", None, "0123456789\n"]
    tables = frame_tables(spark, {
        "ai_prediction": spark.createDataFrame([(t, None) for t in texts], "InputSnapshotJSON string, ExplanationJSON string"),
        "hospital_provider": spark.createDataFrame([(x,) for x in codes], "NPINumber string"),
    })
    found = counts(constraints.check_rows(tables, rules.JSON_RULES, AS_OF))
    assert found == {"CK_Prediction_InputSnapshotJSON": 2, "CK_Prediction_ExplanationJSON": 0}
    assert counts(constraints.check_rows(tables, rules.DIGIT_RULES, AS_OF)) == {"CK_Provider_NPINumber": 3}


def test_key_and_reference_rules(spark):
    child = [(1, 1, 10, "a"), (2, 1, 10, "a"), (3, None, 10, "z"), (4, 9, 10, None), (5, 9, 10, "b"), (6, 2, 99, "z")]
    tables = frame_tables(spark, {
        "child": spark.createDataFrame(child, "id int, p int, h int, code string"),
        "parent": spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (None, None, None)], "p bigint, h int, code string"),
    })
    references = [
        ReferenceRule("single", "child", ("p",), "parent", ("p",)), ReferenceRule("pair", "child", ("p", "h"), "parent", ("p", "h")),
        ReferenceRule("clean", "parent", ("p",), "child", ("p",)), ReferenceRule("text", "child", ("code",), "parent", ("code",)),
        ReferenceRule("mixed", "child", ("p", "code"), "parent", ("p", "code")), ReferenceRule("unlike", "child", ("p",), "parent", ("code",)),
        ReferenceRule("self", "child", ("p",), "child", ("id",)), ReferenceRule("gone", "child", ("p",), "parent", ("other",)),
    ]
    expected = {"single": 2, "pair": 3, "clean": 0, "text": 2, "mixed": 2, "unlike": 5, "self": 2}
    assert counts(constraints.check_references(tables, references)) == expected
    keys = [KeyRule("all", "child", ("p",)), KeyRule("some", "child", ("p",), "id < 5"), KeyRule("text", "child", ("code", "h")),
            KeyRule("clean", "child", ("id",)), KeyRule("gone", "child", ("other",)), KeyRule("no condition", "child", ("p",), "other")]
    assert counts(constraints.check_keys(tables, keys)) == {"all": 2, "some": 1, "text": 1, "clean": 0}
    assert counts(constraints.check_references(tables, [])) == counts(constraints.check_keys(tables, [])) == {}


@pytest.mark.parametrize("hashed", ["xxhash64({keys})", "pmod(xxhash64({keys}), 7)", "0"])
def test_hashes_that_collide_do_no_harm(spark, hashed):
    random.seed(7)
    rows = [(random.choice([None, *range(40)]), random.choice(["a", "b", None]), random.random() < 0.5) for _ in range(120)]
    tables = frame_tables(spark, {"t": spark.createDataFrame(rows, "k int, s string, ok boolean")})
    listed = [KeyRule("k", "t", ("k",)), KeyRule("ks", "t", ("k", "s")), KeyRule("sk", "t", ("s", "k"), "ok"), KeyRule("none", "t", ("k",), "k > 99")]
    repeated = lambda keys: len({key for key in keys if keys.count(key) > 1})
    expected = {
        "k": repeated([k for k, _, _ in rows]), "ks": repeated([(k, s) for k, s, _ in rows]),
        "sk": repeated([(s, k) for k, s, ok in rows if ok]), "none": 0,
    }
    assert counts(constraints.check_keys(tables, listed, hashed)) == expected


def test_bitmaps_of_any_whole_numbers(spark):
    """Dense, sparse, negative and extreme keys; a key that most rows share."""
    random.seed(9)
    edge = [-(2**63), 2**63 - 1, -1, 0, 1, 63, 64, -64, -65, 2**31, -(2**31) - 1]
    child = [None, *edge, *range(-200, 200), *(random.randrange(-(2**62), 2**62) for _ in range(200)), *[77] * 3000]
    parent = [key for key in {*child} if key is not None and (random.random() < 0.6 or key in (-1, 2**63 - 1)) and key != 77]
    tables = frame_tables(spark, {
        "c": spark.createDataFrame([(key,) for key in child], "k bigint"),
        "p": spark.createDataFrame([(key,) for key in parent] + [(None,)], "k bigint"),
        "q": spark.createDataFrame([(1,)], "k smallint"),
    })
    listed = [ReferenceRule("cp", "c", ("k",), "p", ("k",)), ReferenceRule("pc", "p", ("k",), "c", ("k",)), ReferenceRule("cq", "c", ("k",), "q", ("k",))]
    whole = [key for key in child if key is not None]
    assert counts(constraints.check_references(tables, listed)) == {
        "cp": sum(key not in set(parent) for key in whole), "pc": 0, "cq": sum(key != 1 for key in whole)
    }


def test_every_rule_equals_its_plain_sql(spark):
    """Random rows for all tables and columns of the catalogue, against the hand-written conditions."""
    if not os.path.isdir(FOLDER):
        pytest.skip("data folder missing")
    random.seed(4)
    derived = derived_tables(spark, FOLDER)
    words = sorted({word for rule in (*rules.ROW_RULES, *rules.JSON_RULES) for word in re.findall(r"'([^']*)'", rule.predicate)})
    by_column = {}
    for rule in rules.ROW_RULES:
        for column in rule.needs[rule.table]:
            by_column.setdefault((rule.table, column), []).extend(re.findall(r"'([^']*)'", rule.predicate))

    def value(table, column, kind):
        if random.random() < 0.15:
            return None
        if isinstance(kind, StringType):
            return random.choice([*by_column.get((table, column), []), "", "  ", "{}", "{x", "[1]", "7", "1234567890", "12345678x0", random.choice(words)])
        if isinstance(kind, BooleanType):
            return random.random() < 0.5
        if isinstance(kind, DateType):
            return random.choice([dt.date(1899, 1, 1), dt.date(1999, 6, 30), dt.date(1999, 7, 1), dt.date(1995, 1, random.randint(1, 9))])
        if isinstance(kind, TimestampNTZType):
            return dt.datetime(1996, 1, 1, 0, random.randint(0, 12))
        number = random.choice([-181, -91, -90, -1, 0, 1, 2, 3, 5, 90, 91, 181, 301, random.randint(-3, 6)])
        if isinstance(kind, DecimalType):
            limit = 10 ** (kind.precision - kind.scale) - 1
            return Decimal(max(-limit, min(limit, number))) if random.random() < 0.8 else Decimal("0.1")
        return number

    frames = {}
    duck = duckdb.connect()
    for name in derived.names:
        schema = StructType([StructField(field.name, field.dataType) for field in derived.read(name).schema])
        rows = [tuple(value(name, field.name, field.dataType) for field in schema) for _ in range(60)]
        frames[name] = spark.createDataFrame(rows, schema)
        duck.register(name, frames[name].toArrow())
    tables = frame_tables(spark, frames)
    for family, own in rules.FAMILIES.items():
        kind = type(own[0])
        check = {RowRule: lambda t, r: constraints.check_rows(t, r, AS_OF), KeyRule: constraints.check_keys, ReferenceRule: constraints.check_references}[kind]
        got = counts(check(tables, own))
        want = {name: n for name, _, n in duck.execute(RULE_REPORTS[family]).fetchall()}
        assert got == want
        assert sum(n > 0 for n in got.values()) > len(got) / 3


def test_plans_of_rule_families(spark):
    """No text keys, one shuffle for all keys of a family."""
    if not os.path.isdir(FOLDER):
        pytest.skip("data folder missing")
    tables = derived_tables(spark, FOLDER)
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    composite = plan(constraints.check_references(tables, rules.COMPOSITE_REFERENCE_RULES))
    assert "to_json" not in composite.lower() and "as string" not in composite
    number = {id(rule): i for i, rule in enumerate(rules.REFERENCE_RULES)}
    used = constraints._children(tables, rules.REFERENCE_RULES, number, ("bigint",)).groupBy("rule").count()
    assert "cast" not in plan(used).replace("as bigint", "").lower() or "as string" not in plan(used)


def test_orphans_of_several_rules_without_sorts(spark):
    """Repeated child keys, orphans of one rule and of several, more rules than a word has bits; no anti join, no grouping of rows."""
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    tables = frame_tables(spark, {
        "a": spark.createDataFrame([(1, 1), (1, 1), (2, 9), (2, 9), (2, 9), (3, 3), (None, 9), (9, None)], "x int, y bigint"),
        "b": spark.createDataFrame([(2, 9), (3, 3), (3, 3), (7, 7)], "x bigint, y bigint"),
        "p": spark.createDataFrame([(1, 1), (1, 1), (7, 8), (None, None), (2, None)], "x bigint, y bigint"),
    })
    pair = ("x", "y")
    listed = [ReferenceRule(f"{child}{i}", child, pair, "p", pair) for i in range(40) for child in "ab"] + [ReferenceRule("ba", "b", pair, "a", pair)]
    assert counts(constraints.check_references(tables, listed)) == {f"a{i}": 4 for i in range(40)} | {f"b{i}": 4 for i in range(40)} | {"ba": 1}
    apart = [ReferenceRule("ap", "a", pair, "p", pair), ReferenceRule("bp", "b", pair, "p", pair), ReferenceRule("pa", "p", pair, "a", pair)]
    report = constraints.check_references(tables, apart)
    assert counts(report) == {"ap": 4, "bp": 4, "pa": 1} and "LeftAnti" not in plan(report)
    rows = constraints.check_rows(tables, [RowRule("ax", "a", "x < 3"), RowRule("bx", "b", "x < 3"), RowRule("by", "b", "y < 9")], AS_OF)
    assert counts(rows) == {"ax": 2, "bx": 3, "by": 1} and "keys=[first" not in plan(rows)


# -- register -------------------------------------------------------------------


@pytest.fixture
def register(spark, tmp_path):
    for name, rows in {"child": [(1, 1), (2, 1), (3, 9)], "parent": [(1, 5), (2, 6)]}.items():
        spark.createDataFrame(rows, "id int, p int").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    families = {
        "rows": [RowRule("positive", "child", "id > 0"), RowRule("gone", "child", "other > 0"), RowRule("below", "parent", "p < 6")],
        "keys": [KeyRule("one", "child", ("p",))],
        "references": [ReferenceRule("there", "child", ("p",), "parent", ("id",)), ReferenceRule("away", "child", ("p",), "nowhere", ("id",))],
    }

    def opened():
        spark.catalog.clearCache()
        return RuleRegister(parquet_tables(spark, str(tmp_path), ["child", "parent"]), f"file://{tmp_path}/register", families, AS_OF)

    return opened, tmp_path


def states(register):
    return {r.RuleName: (r.RuleState, r.Violations) for r in register.states().collect()}


def test_register_from_untrusted_to_trusted(register):
    opened, _ = register
    new = opened()
    assert states(new) == dict.fromkeys(("positive", "gone", "below", "one", "there", "away"), ("UNTRUSTED", None))
    assert counts(new.run(["rows"])) == {"positive": 0, "below": 1}
    assert states(opened()) == {
        "positive": ("TRUSTED", 0), "gone": ("NOT CHECKED", None), "below": ("FAILING", 1),
        "one": ("UNTRUSTED", None), "there": ("UNTRUSTED", None), "away": ("UNTRUSTED", None),
    }
    found = [tuple(row) for row in opened().open_rules().collect()]
    assert found == [
        ("away", "child", None, "NOT CHECKED"), ("gone", "child", None, "NOT CHECKED"), ("one", "child", 1, "FAIL"),
        ("there", "child", 1, "FAIL"), ("below", "parent", 1, "FAIL"),
    ]
    entries = opened().entries().count()
    assert opened().open_rules().count() == 5 and opened().entries().count() == entries  # nothing was checked again


def test_changed_table_turns_only_its_rules_untrusted(register, spark):
    opened, folder = register
    opened().run()
    spark.createDataFrame([(9, 5)], "id int, p int").coalesce(1).write.mode("append").parquet(f"{folder}/parent.parquet")
    now = states(opened())
    assert {name for name, (state, _) in now.items() if state == "UNTRUSTED"} == {"below", "there"}
    assert {r.RuleName: r.RuleState for r in opened().refresh().collect()}["there"] == "TRUSTED"
    last = max(row["Run"] for row in opened().entries().collect())
    assert {row["RuleName"] for row in opened().entries().where(f"Run = {last}").collect()} == {"below", "there"}


def test_rules_are_switched_off_and_on(register):
    opened, _ = register
    opened().run()
    opened().switch(["one", "there"], enabled=False)
    assert states(opened())["one"] == ("OFF", None)
    assert "one" not in {row["RuleName"] for row in opened().open_rules().collect()}
    opened().switch(["one"], enabled=True)
    assert states(opened())["one"] == ("UNTRUSTED", None)
    assert {r.RuleName: r.RuleState for r in opened().refresh().collect()}["one"] == "FAILING"
    assert states(opened())["there"][0] == "OFF"
    with pytest.raises(KeyError):
        opened().switch(["no such rule"], enabled=False)
