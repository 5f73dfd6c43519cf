"""Ordered wildcard rules: parsing rule strings and finding the first rule that matches a row.

Three dialects share one grammar of ``:``-separated parts:

* ``strict``: institution:type:version:strategy, anything else is an error;
* ``lenient``: type:version:action, malformed rules are ignored;
* ``file``: as lenient, but extra parts are allowed and an unknown action means "do not encrypt".
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.options import ACTIONS, STRATEGIES
from quayside.session import small_side

WILDCARD = "*"
# Above this many rules a CASE chain costs more per row than hash lookups.
CASE_RULES = 64


@dataclass(frozen=True)
class Rule:
    number: int
    patterns: tuple[str, ...]
    outcome: str


def parse(text: str | None, mode: str = "strict") -> list[Rule]:
    """Rules of one configured string, numbered from 1 in order."""
    found: list[Rule] = []
    for raw in (text or "").split(","):
        rule = raw.strip()
        if not rule:
            continue
        parts = [p.strip() for p in rule.rstrip(":").split(":")]
        if mode == "strict":
            if len(parts) != 4:
                raise ValueError(f"a rule needs institution:type:version:strategy, got: {rule}")
            if parts[3].upper() not in STRATEGIES:
                raise ValueError(f"unknown strategy in rule: {rule}")
            outcome, patterns = parts[3].upper(), tuple(parts[:3])
        elif mode == "lenient":
            if len(parts) != 3 or not all(parts) or parts[2].upper() not in ACTIONS:
                continue
            outcome, patterns = parts[2].upper(), tuple(parts[:2])
        else:
            if len(parts) < 3:
                continue
            outcome = "ENCRYPT" if parts[2].upper() == "ENCRYPT" else "SKIP"
            patterns = tuple(parts[:2])
        found.append(Rule(len(found) + 1, patterns, outcome))
    return found


def rule_array(text: Column, mode: str) -> Column:
    """The same parse for a column of rule strings (a policy table).

    ARRAY<STRUCT<rule_no INT, rule STRING, patterns ARRAY<STRING>, outcome STRING, valid BOOLEAN>>; every non-blank
    rule is listed, and ``valid`` tells whether the dialect accepts it. ``rule_no`` counts non-blank rules.
    """
    width = 4 if mode == "strict" else 3
    outcomes = STRATEGIES if mode == "strict" else ACTIONS
    trimmed = F.filter(F.transform(F.split(text, ","), lambda r: F.trim(r)), lambda r: r != "")

    def described(rule: Column, index: Column) -> Column:
        parts = F.transform(F.split(F.regexp_replace(rule, ":+$", ""), ":"), lambda p: F.trim(p))
        word = F.upper(F.try_element_at(parts, F.lit(width)))
        if mode == "strict":
            valid = (F.size(parts) == 4) & F.coalesce(word.isin(*outcomes), F.lit(False))
        elif mode == "lenient":
            valid = (
                (F.size(parts) == 3)
                & F.coalesce(word.isin(*outcomes), F.lit(False))
                & ~F.exists(parts, lambda p: p == "")
            )
        else:
            valid = F.size(parts) >= 3
            word = F.when(valid, F.when(word == "ENCRYPT", F.lit("ENCRYPT")).otherwise(F.lit("SKIP")))
        return F.struct(
            (index + 1).cast("int").alias("rule_no"),
            rule.alias("rule"),
            F.slice(parts, 1, width - 1).alias("patterns"),
            F.when(valid, word).alias("outcome"),
            valid.alias("valid"),
        )

    return F.coalesce(F.transform(trimmed, described), F.expr(
        "cast(array() as array<struct<rule_no:int,rule:string,patterns:array<string>,outcome:string,valid:boolean>>)"
    ))


def _accepts(pattern: str, value: Column) -> Column:
    return F.lit(True) if pattern == WILDCARD else F.coalesce(F.lower(value) == pattern.lower(), F.lit(False))


def first_match(rules: Iterable[Rule], values: Iterable[Column]) -> Column:
    """STRUCT<rule_no, outcome> of the first matching rule, or NULL; compiled to one CASE expression."""
    values = list(values)
    chain = None
    for rule in rules:
        checks = [_accepts(p, v) for p, v in zip(rule.patterns, values) if p != WILDCARD]
        test = reduce(lambda a, b: a & b, checks, F.lit(True)) if checks else F.lit(True)
        hit = F.struct(F.lit(rule.number).alias("rule_no"), F.lit(rule.outcome).alias("outcome"))
        chain = F.when(test, hit) if chain is None else chain.when(test, hit)
    nothing = F.lit(None).cast("struct<rule_no:int,outcome:string>")
    return nothing if chain is None else chain.otherwise(nothing)


def first_match_in(rules: Column, values: Iterable[Column]) -> Column:
    """As :func:`first_match`, for rules held per row in an array made by :func:`rule_array`."""
    values = [F.lower(v) for v in values]

    def accepts(rule: Column) -> Column:
        tests = []
        for index, value in enumerate(values):
            pattern = rule["patterns"][index]
            tests.append((pattern == WILDCARD) | F.coalesce(F.lower(pattern) == value, F.lit(False)))
        return reduce(lambda a, b: a & b, tests, rule["valid"])

    return F.try_element_at(F.filter(rules, accepts), F.lit(1))


def match_rules(df: DataFrame, rules: list[Rule], on: list[str], into: str = "matched") -> DataFrame:
    """Add STRUCT<rule_no, outcome>: a CASE chain for short lists, hash lookups for long ones.

    Long lists are grouped by which parts are wildcards. Within one such shape a row can only meet rules whose
    literal parts equal its own, so each shape is one equi-join on a key that is unique on the rule side; the lowest
    rule number over all shapes wins. No row is paired with rules it does not match, and nothing is shuffled while
    the rule side stays broadcastable.
    """
    if len(rules) <= CASE_RULES:
        return df.withColumn(into, first_match(rules, [F.col(c) for c in on]))
    spark: SparkSession = df.sparkSession
    shapes: dict[tuple[bool, ...], dict[tuple[str, ...], Rule]] = {}
    for rule in rules:
        shape = tuple(p == WILDCARD for p in rule.patterns)
        key = tuple(p.lower() for p in rule.patterns if p != WILDCARD)
        shapes.setdefault(shape, {}).setdefault(key, rule)  # first one wins
    found = []
    for index, (shape, table) in enumerate(shapes.items()):
        literal = [column for column, wild in zip(on, shape) if not wild]
        hit = f"__rule_{index}"
        found.append(hit)
        if not literal:
            rule = table[()]
            df = df.withColumn(hit, F.struct(F.lit(rule.number).alias("rule_no"), F.lit(rule.outcome).alias("outcome")))
            continue
        keys = [f"__key_{index}_{i}" for i in range(len(literal))]
        rows = [(*key, rule.number, rule.outcome) for key, rule in table.items()]
        schema = ", ".join(f"{k} string" for k in keys) + ", rule_no int, outcome string"
        side = spark.createDataFrame(rows, schema).select(*keys, F.struct("rule_no", "outcome").alias(hit))
        test = reduce(lambda a, b: a & b, [F.lower(df[c]) == side[k] for c, k in zip(literal, keys)])
        df = df.join(small_side(side, len(rows)), test, "left").drop(*keys)
    # least() skips NULL and orders structs by their first member, the rule number.
    best = F.least(*[F.col(h) for h in found]) if len(found) > 1 else F.col(found[0])
    return df.withColumn(into, best).drop(*found)


def encrypt_decision(
    enabled: Column, rule_text: Column, rules: Column, event_type: Column, version: Column, level: str
) -> Column:
    """Whether a record (``level='record'``) or file (``level='file'``) is to be encrypted.

    The two levels differ on purpose: a record whose type or version is missing, or that no rule covers, is encrypted,
    while a file that no rule covers is not and wildcards there accept a missing type or version.
    """
    blank = rule_text.isNull() | (F.trim(rule_text) == "")
    outcome = first_match_in(rules, [event_type, version])["outcome"]
    if level == "record":
        by_rules = F.when(event_type.isNull() | version.isNull(), F.lit(True)).otherwise(
            F.coalesce(outcome, F.lit("ENCRYPT")) == "ENCRYPT"
        )
    else:
        by_rules = F.coalesce(outcome, F.lit("SKIP")) == "ENCRYPT"
    return F.when(~F.coalesce(enabled, F.lit(False)), F.lit(False)).when(blank, F.lit(True)).otherwise(by_rules)
