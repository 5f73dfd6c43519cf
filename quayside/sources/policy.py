"""The tenant policy document and the lookups into it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quayside.functions.rules import rule_array
from quayside.options import SOURCE_FIELD, STRATEGIES, TARGET_FIELD
from quayside.session import bounded_count, small_side

# Member names of the policy document.
TENANT = """struct<
    name:string, pan_strategy:string,
    pan_config:struct<source_field:string,target_field:string,private_key_path:string,tokenize:boolean,reason:string>,
    pgp_encryption:struct<enabled:boolean,public_key_path:string,armor:boolean,rules:string,reason:string>,
    s3_config:struct<bucket:string,path_prefix:string,object_key_template:string>>"""
DOCUMENT = f"struct<banks:map<string,{TENANT}>,`default`:{TENANT}>"
# Distinct object key templates that one plan may hold; tenants may share them in any number.
MAX_TEMPLATES = 500
BUILT_IN_DEFAULT = (
    '{"name":"Default Configuration","pan_strategy":"REMOVE",'
    '"pan_config":{"source_field":"encryptedPrimaryAccountNumber"},"pgp_encryption":{"enabled":false}}'
)


def _flat(tenant: Column, bank: Column) -> list[Column]:
    hide, seal, place = tenant["pan_config"], tenant["pgp_encryption"], tenant["s3_config"]
    strategy = F.coalesce(F.upper(F.trim(tenant["pan_strategy"])), F.lit("REMOVE"))  # unset: the safest choice
    tokenized = F.coalesce(hide["tokenize"], F.lit(False))
    return [
        bank.alias("bank"),
        tenant["name"].alias("name"),
        F.when((strategy == "DECRYPT") & tokenized, F.lit("TOKENIZE")).otherwise(strategy).alias("strategy"),
        F.coalesce(hide["source_field"], F.lit(SOURCE_FIELD)).alias("source_field"),
        F.coalesce(hide["target_field"], F.lit(TARGET_FIELD)).alias("target_field"),
        hide["private_key_path"].alias("private_key"),
        F.coalesce(seal["enabled"], F.lit(False)).alias("enc_enabled"),
        seal["public_key_path"].alias("public_key"),
        F.coalesce(seal["armor"], F.lit(False)).alias("armor"),
        seal["rules"].alias("enc_rules"),
        place["bucket"].alias("bucket"),
        place["path_prefix"].alias("path_prefix"),
        place["object_key_template"].alias("template"),
    ]


@dataclass(frozen=True)
class Policy:
    """One row per tenant, plus the row every other tenant falls back to as a whole."""

    table: DataFrame
    fallback: Row
    rows: int
    rule_mode: str | None = None

    def attach(self, df: DataFrame, tenant: Column, into: str = "policy") -> DataFrame:
        """Add the tenant's policy as a struct: exact code or else the entire fallback row.

        A listed tenant with a missing section does not inherit that section from the fallback.
        """
        names = self.table.columns
        side = self.table.select(F.col("bank").alias("__bank"), F.struct(*names).alias("__found"))

        def default(name: str) -> Column:
            if name == "parsed_rules":
                return rule_array(F.lit(self.fallback["enc_rules"]).cast("string"), self.rule_mode)
            return F.lit(self.fallback[name])

        fallback = F.struct(*[default(n).cast(self.table.schema[n].dataType).alias(n) for n in names])
        keyed = df.withColumn("__tenant", tenant)
        joined = keyed.join(small_side(side, self.rows), F.col("__tenant") == F.col("__bank"), "left")
        return joined.withColumn(into, F.coalesce(F.col("__found"), fallback)).drop("__bank", "__found", "__tenant")

    def with_rules(self, mode: str) -> Policy:
        """Parse each tenant's rule string once per tenant instead of once per record."""
        parsed = self.table.withColumn("parsed_rules", rule_array(F.col("enc_rules"), mode))
        return Policy(parsed, self.fallback, self.rows, mode)

    def templates(self) -> list[str]:
        """The distinct layouts in use: few, as each becomes one expression."""
        found = [r[0] for r in self.table.where("template IS NOT NULL").select("template").distinct().limit(MAX_TEMPLATES + 1).collect()]
        if len(found) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} different object key templates")
        return sorted({*found, self.fallback["template"]} - {None})

    def strategies(self) -> set[str]:
        """Strategies in use: a list bounded by the strategy names, not by the tenants."""
        known = self.table.where(F.col("strategy").isin(*STRATEGIES))
        found = {r[0] for r in known.select("strategy").distinct().collect()}
        return (found | {self.fallback["strategy"]}) - {None}


def policy_from_text(spark: SparkSession, text: DataFrame | str) -> Policy:
    """Policy from the JSON document, given as text or as a one-column DataFrame with the whole document."""
    if isinstance(text, str):
        text = spark.createDataFrame([(text,)], "value string")
    document = text.select(F.from_json("value", DOCUMENT).alias("d"))
    if document.where("d is null or (d.banks is null and d.`default` is null)").count():
        raise ValueError("the policy document is not a JSON object with banks or default")
    tenants = document.select(F.explode("d.banks").alias("bank", "tenant"))
    table = tenants.select(*_flat(F.col("tenant"), F.col("bank")))
    built_in = F.from_json(F.lit(BUILT_IN_DEFAULT), TENANT.replace("\n", ""))
    default = document.select(F.coalesce(F.col("d.default"), built_in).alias("tenant"))
    fallback = default.select(*_flat(F.col("tenant"), F.lit("DEFAULT"))).first()
    return Policy(table, fallback, bounded_count(table))


def read_policy(spark: SparkSession, path: str) -> Policy:
    """Policy file from shared storage; a missing file means the built-in default for everyone."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        text = spark.createDataFrame([("{\"banks\":{}}",)], "value string")
    return policy_from_text(spark, text)


def unmapped(df: DataFrame, tenant: Column, known: DataFrame, known_column: str) -> DataFrame:
    """Tenants present in the data but absent from a table, with their record counts.

    The records are counted per tenant first, so the anti-join sees one row per tenant.
    """
    seen = df.groupBy(tenant.alias("tenant")).agg(F.count("*").alias("records"))
    return seen.join(known.select(F.col(known_column).alias("tenant")).distinct(), "tenant", "left_anti")
