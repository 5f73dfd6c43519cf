"""First-match rules held as a table of any size, for everyone or per tenant.

A rule's pattern is one point: its literal parts lower-cased, ``*`` where anything goes. A row can be met by the patterns that keep some of its
values and have ``*`` for the others, two to the power of the fields in number. So distinct combinations of values are
looked up at those points by one equi-join on a key that is unique on the rule side, and the lowest rule number wins.
What a row costs does not depend on the number of rules, and no row is paired with rules that it does not match.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.rules import WILDCARD, rule_array
from quayside.session import bounded_count, small_side
from quayside.sources.policy import Policy

# Marks before values keep a missing value and the wildcard apart from all texts.
_ANY, _NONE, _VALUE = "*", "-", "="


def _point(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(_VALUE), F.lower(value)), F.lit(_NONE))


def pattern_points(rules: DataFrame, fields: list[str], scope: str | None = None) -> DataFrame:
    """(scope, one column per field, rule_no, outcome): the first rule of each pattern. Rules without a pattern part are left out."""
    keys = [F.when(F.trim(F.col(f)) == WILDCARD, F.lit(_ANY)).otherwise(_point(F.trim(F.col(f)))).alias(f"__p{i}") for i, f in enumerate(fields)]
    owner = (F.col(scope) if scope else F.lit("")).alias("__scope")
    whole = rules.where(" AND ".join(f"`{f}` IS NOT NULL" for f in fields))
    points = whole.select(owner, *keys, F.struct(F.col("rule_no").cast("int").alias("rule_no"), "outcome").alias("__rule"))
    return points.groupBy("__scope", *(f"__p{i}" for i in range(len(fields)))).agg(F.min("__rule").alias("__rule"))


def match_rule_table(
    df: DataFrame, rules: DataFrame, on: list[str], fields: list[str] | None = None, scope: Column | None = None, rule_scope: str | None = None,
    into: str = "matched",
) -> DataFrame:
    """Add STRUCT<rule_no, outcome> of the first rule that matches, NULL where none does.

    ``rules`` has rule_no, outcome and the pattern columns ``fields`` (the names of ``on`` by default); case does not matter, a missing value is
    matched by ``*`` alone. With ``scope`` a row follows the rules whose ``rule_scope`` equals it exactly, numbered by themselves;
    a row without scope follows none. A hot combination costs one lookup, and its rows meet the answer by a broadcast of
    counted size or a shuffle join that AQE may split.
    """
    fields = fields or on
    names = [f"__v{i}" for i in range(len(on))]
    owner = F.lit("") if scope is None else scope
    keyed = df.withColumns({"__owner": owner, **{n: _point(F.col(f"`{c}`")) for n, c in zip(names, on, strict=True)}})
    combinations = keyed.where(F.col("__owner").isNotNull()).select("__owner", *names).distinct()
    shapes = F.array(*(
        F.struct(*((F.lit(_ANY) if any_ else F.col(n)).alias(f"__p{i}") for i, (n, any_) in enumerate(zip(names, shape, strict=True))))
        for shape in product((False, True), repeat=len(on))
    ))
    asked = combinations.withColumn("__shape", F.explode(shapes)).select("__owner", *names, "__shape.*")
    points = pattern_points(rules, fields, rule_scope if scope is not None else None)
    same = (F.col("__owner") == F.col("__scope"))
    right = points.withColumnsRenamed({f"__p{i}": f"__q{i}" for i in range(len(on))})
    for i in range(len(on)):
        same = same & (F.col(f"__p{i}") == F.col(f"__q{i}"))
    found = asked.join(small_side(right, bounded_count(right)), same).groupBy("__owner", *names).agg(F.min("__rule").alias("__best"))
    answer = found.withColumnsRenamed({n: f"{n}_" for n in ("__owner", *names)})
    on_all = F.col("__owner") == F.col("__owner_")
    for n in names:
        on_all = on_all & (F.col(n) == F.col(f"{n}_"))
    joined = keyed.join(small_side(answer, bounded_count(answer)), on_all, "left")
    return joined.withColumn(into, F.col("__best")).select(*df.columns, into)


def policy_rules(policy: Policy, mode: str) -> DataFrame:
    """(bank, rule_no, event_type, event_version, outcome): the valid rules of every tenant's policy as one table."""
    each = policy.table.select("bank", F.explode(rule_array(F.col("enc_rules"), mode)).alias("r")).where("r.valid")
    patterns = F.col("r.patterns")
    return each.select("bank", "r.rule_no", patterns[0].alias("event_type"), patterns[1].alias("event_version"), F.col("r.outcome").alias("outcome"))
