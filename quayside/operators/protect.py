"""Protecting the sensitive field of each record by ordered rules or by tenant policy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import masking, tokens
from quayside.functions.headers import header
from quayside.functions.once import once
from quayside.functions.rsa import KeyRing
from quayside.functions.rules import match_rules, parse
from quayside.options import CRYPTO_STRATEGIES, STRATEGIES, ProtectOptions
from quayside.sources.lookups import attach_key
from quayside.sources.messages import first_error, with_error
from quayside.sources.policy import Policy


@dataclass(frozen=True)
class Crypto:
    """What the decrypting strategies need: loaded keys and, for re-encryption, the partner-key table."""

    ring: KeyRing
    partners: DataFrame | None = None
    private_key: str | None = None
    as_of: Column | None = None


def choose_by_rules(df: DataFrame, options: ProtectOptions) -> DataFrame:
    """Add ``strategy``, ``rule_no`` from rules over the columns institution, event_type, event_version."""
    matched = match_rules(df, parse(options.rules, "strict"), ["institution", "event_type", "event_version"])
    return matched.select(
        *df.columns,
        F.coalesce(F.col("matched")["outcome"], F.lit(options.default_strategy)).alias("strategy"),
        F.col("matched")["rule_no"].alias("rule_no"),
    )


def replacement(value: Column, strategy: Column, options: ProtectOptions, clear: Column, rekeyed: Column) -> Column:
    """The value that takes the place of the source field; NULL for REMOVE and NONE."""
    shape = (options.mask_prefix, options.mask_suffix, options.mask_character)
    return (
        F.when(strategy == "MASK", masking.mask(value, *shape))
        .when(strategy == "DECRYPT", clear)
        .when(strategy == "TOKENIZE", masking.tokenize(clear, *shape))
        .when(strategy == "REKEY", rekeyed)
    )


def apply_crypto(
    df: DataFrame, value: Column, strategy: Column, tenant: Column, private_key: Column, crypto: Crypto | None,
    used: set[str],
) -> DataFrame:
    """Add ``__clear`` and ``__rekeyed`` for the rows that need them, and errors where a token cannot be opened.

    Only such rows carry a token into the Arrow batches; a plan without decrypting strategies has no Python step.
    """
    nothing = F.lit(None).cast("string")
    if not used & set(CRYPTO_STRATEGIES):
        return df.withColumn("__clear", nothing).withColumn("__rekeyed", nothing)
    needs = strategy.isin(*CRYPTO_STRATEGIES) & F.col("error").isNull()
    if crypto is None:
        return with_error(df, "protect", needs, "decrypting strategies need a private key").withColumn(
            "__clear", nothing
        ).withColumn("__rekeyed", nothing)
    df = df.withColumn("__needs", needs)
    df = tokens.decrypt_text(df, F.when(F.col("__needs"), value), private_key, crypto.ring, "__clear")
    df = with_error(df, "jwe", F.col("__needs") & F.col("__clear").isNull(), "token could not be decrypted")
    if "REKEY" not in used:
        return df.withColumn("__rekeyed", nothing).drop("__needs")
    again = (strategy == "REKEY") & F.col("__clear").isNotNull()
    if crypto.partners is None:
        df = with_error(df, "key", again, "no usable public key for the institution").withColumn("__rekeyed", nothing)
    else:
        df = attach_key(df, tenant, crypto.partners, "__partner", crypto.as_of, again)
        df = tokens.encrypt_text(df, F.when(again, F.col("__clear")), F.col("__partner"), crypto.ring, "__rekeyed")
        df = with_error(df, "key", again & F.col("__rekeyed").isNull(), "public key is not loaded").drop("__partner")
    return df.drop("__needs")


def protect(
    df: DataFrame, options: ProtectOptions, policy: Policy | None = None, crypto: Crypto | None = None
) -> DataFrame:
    """Protect the source field inside ``record`` (a MAP of variants, or a STRUCT).

    Without ``policy`` the strategy comes from the rules; with it, from the tenant's row, including the field names.
    A dotted source field reaches into a wrapped record.
    """
    box, _, source_name = options.source_field.rpartition(".")
    holder = F.col("record")
    for part in box.split(".") if box else ():
        holder = holder[part]
    holder_type = df.select(holder.alias("h")).schema["h"].dataType
    names, before = options.names, df.columns
    df = df.withColumns({
        "institution": once(header(F.col("headers"), names.institution, "first")),
        "event_type": once(header(F.col("headers"), names.event_type, "first")),
        "event_version": once(header(F.col("headers"), names.version, "first")),
    })
    unknown = []
    if policy is None:
        df = choose_by_rules(df, options)
        used = {r.outcome for r in parse(options.rules, "strict")} | {options.default_strategy}
        source, target = F.lit(source_name), F.lit(options.target_field)
        private_key = F.lit(options.private_key or (crypto.private_key if crypto else None)).cast("string")
    else:
        df = policy.attach(df, F.col("institution"))
        df = df.withColumn("strategy", F.col("policy")["strategy"])
        unlisted = F.col("record").isNotNull() & ~F.col("strategy").isin(*STRATEGIES)
        unknown.append(("policy", unlisted, "unknown strategy"))
        used = policy.strategies()
        source, target = F.col("policy")["source_field"], F.col("policy")["target_field"]
        private_key = F.col("policy")["private_key"]
    strategy = F.col("strategy")

    odd = F.lit(False)
    if isinstance(holder_type, T.MapType):
        found = holder.isNotNull() & F.map_contains_key(holder, source)
        stored = F.try_element_at(holder, source)
        odd = ~F.coalesce(F.schema_of_variant(stored).isin("STRING", "VOID"), F.lit(True))
        value = F.try_variant_get(stored, "$", "string")
    else:
        if policy is not None:
            raise ValueError("policy field names vary per tenant: decode the records as maps")
        if not isinstance(holder_type, T.StructType):
            raise ValueError(f"{options.source_field} does not lead into a map or struct record")
        if source_name not in holder_type.fieldNames():
            return df.select(*before, *[c for c in ("error", "strategy") if c not in before])
        found = holder.isNotNull()
        if not isinstance(holder_type[source_name].dataType, T.StringType):
            odd = holder[source_name].isNotNull()
        value = holder[source_name].cast("string")
    touched = found & (strategy != "NONE")
    # What a strategy lacks is an error whether or not the record has the field.
    lacking = [
        ("protect", holder.isNotNull() & strategy.isin(*CRYPTO_STRATEGIES) & private_key.isNull(),
         "decrypting strategies need a private key"),
        ("key", holder.isNotNull() & (strategy == "REKEY") & F.col("institution").isNull(),
         "re-encryption needs an institution"),
    ] if used & set(CRYPTO_STRATEGIES) else []
    wrong = ("protect", touched & (strategy != "REMOVE") & odd, "the sensitive field is not a string")
    df = df.withColumns({
        "__value": once(F.when(found, value)), "__touched": once(touched), "error": first_error(df, *unknown, *lacking, wrong),
    })
    value, touched = F.col("__value"), F.col("__touched")
    df = apply_crypto(
        df, value, F.when(touched, strategy), F.col("institution"), private_key, crypto, used
    )
    changed = touched & F.col("error").isNull()
    fresh = replacement(value, strategy, options, F.col("__clear"), F.col("__rekeyed"))

    if isinstance(holder_type, T.MapType):
        bare = F.map_filter(holder, lambda k, _: k != source)
        added = F.map_concat(
            F.map_filter(holder, lambda k, _: (k != source) & (k != target)), F.create_map(target, fresh.cast("variant"))
        )
        updated = F.when(~changed | (strategy == "NONE"), holder).when(strategy == "REMOVE", bare).otherwise(added)
    else:
        target_name = options.target_field
        gone = changed & (strategy == "REMOVE")
        updated = holder
        if target_name == source_name:
            kept = F.when(~changed, value).when(~gone, fresh)
            updated = updated.withField(f"`{source_name}`", kept)
        else:
            if used - {"REMOVE", "NONE"}:
                old = holder[target_name].cast("string") if target_name in holder_type.fieldNames() else F.lit(None)
                updated = updated.withField(
                    f"`{target_name}`", F.when(changed & ~gone, fresh).otherwise(old.cast("string"))
                )
            # A field that only some rows lose stays in the schema as NULL; one that no row keeps is dropped.
            if "NONE" in used or used & set(CRYPTO_STRATEGIES):
                updated = updated.withField(f"`{source_name}`", F.when(~changed, value))
            else:
                updated = updated.dropFields(f"`{source_name}`")
        updated = F.when(holder.isNotNull(), updated)
    inside = ".".join(f"`{part}`" for part in box.split("."))
    record = F.col("record").withField(inside, updated) if box else updated
    df = df.withColumn("record", once(F.when(F.col("record").isNotNull(), record)))
    kept = dict.fromkeys([*before, "error", "strategy", "institution", "event_type", "event_version"])
    return df.select(*kept)
