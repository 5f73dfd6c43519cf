"""Compact encrypted tokens (RFC 7516, RSA-OAEP-256 + A256GCM) as DataFrame steps.

These are DataFrame functions, not column functions, because the drawn content key must become a column before it is
used twice. Plaintext only ever sits in the output column the caller names.
"""

from __future__ import annotations

import base64
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.once import once
from quayside.functions.rsa import KeyRing

ALGORITHMS = {"alg": "RSA-OAEP-256", "enc": "A256GCM"}
PLAIN_HEADER = base64.urlsafe_b64encode(json.dumps(ALGORITHMS, separators=(",", ":")).encode()).rstrip(b"=").decode()


def to_base64url(data: Column) -> Column:
    # Spark's base64 breaks lines in old modes and pads; both are stripped here.
    return F.translate(F.base64(data), "+/=\r\n", "-_")


def from_base64url(text: Column) -> Column:
    """Bytes of unpadded base64url text, NULL when it is not valid."""
    width = (F.ceil(F.length(text) / 4) * 4).cast("int")
    return F.try_to_binary(F.rpad(F.translate(text, "-_", "+/"), width, F.lit("=")), F.lit("base64"))


def _work(name: str, part: str) -> str:
    return f"__{name}_{part}"


def encrypt(
    df: DataFrame, content: Column, key_id: Column, ring: KeyRing, into: str, header: Column | None = None
) -> DataFrame:
    """Add STRUCT<header, wrapped, iv, body> under ``into``: ``content`` (binary) under a fresh key per row.

    NULL content or an unknown key id gives NULL. ``header`` is the base64url text bound in as associated data.
    """
    keys, name, text = _work(into, "keys"), _work(into, "header"), _work(into, "content")
    df = df.withColumn(text, once(content)).withColumn(name, F.lit(PLAIN_HEADER) if header is None else once(header))
    df = df.withColumn(keys, ring.draw_keys()(F.when(F.col(text).isNotNull(), key_id)))
    body = F.aes_encrypt(
        F.col(text), F.col(keys)["key"], F.lit("GCM"), F.lit("DEFAULT"), F.col(keys)["iv"],
        F.encode(F.col(name), "US-ASCII"),
    )
    token = F.struct(
        F.col(name).alias("header"), F.col(keys)["wrapped"].alias("wrapped"), F.col(keys)["iv"].alias("iv"),
        body.alias("body"),  # iv, ciphertext, tag
    )
    present = F.col(text).isNotNull() & F.col(keys)["wrapped"].isNotNull()
    return df.withColumn(into, once(F.when(present, token))).drop(keys, name, text)


def compact(token: Column) -> Column:
    """Five-part text of a token struct made by :func:`encrypt`."""
    body = token["body"]
    size = F.length(body)
    return F.concat_ws(
        ".", token["header"], to_base64url(token["wrapped"]), to_base64url(token["iv"]),
        to_base64url(F.substring(body, F.lit(13), size - 28)), to_base64url(F.substring(body, size - 15, F.lit(16))),
    )


def parse_parts(parts: Column) -> Column:
    """STRUCT<header, wrapped, iv, body> of the split five-part text; members are NULL where it is malformed."""
    whole = F.size(parts) == 5

    def part(index: int) -> Column:
        return F.when(whole, parts[index])

    return F.struct(
        part(0).alias("header"), from_base64url(part(1)).alias("wrapped"), from_base64url(part(2)).alias("iv"),
        F.concat(from_base64url(part(2)), from_base64url(part(3)), from_base64url(part(4))).alias("body"),
    )


def decrypt(df: DataFrame, token: Column, key_id: Column, ring: KeyRing, into: str) -> DataFrame:
    """Add the decrypted bytes of a token struct under ``into``; NULL for a wrong key, damage or another algorithm."""
    parts, opened = _work(into, "parts"), _work(into, "opened")
    df = df.withColumn(parts, once(token))
    meta = F.from_json(from_base64url(F.col(parts)["header"]).cast("string"), "alg string, enc string")
    known = (meta["alg"] == ALGORITHMS["alg"]) & (meta["enc"] == ALGORITHMS["enc"])
    df = df.withColumn(opened, ring.open_keys()(F.when(known, F.col(parts)["wrapped"]), key_id))
    plain = F.try_aes_decrypt(
        F.col(parts)["body"], F.col(opened), F.lit("GCM"), F.lit("DEFAULT"),
        F.encode(F.col(parts)["header"], "US-ASCII"),
    )
    return df.withColumn(into, once(plain)).drop(parts, opened)


def encrypt_text(df: DataFrame, text: Column, key_id: Column, ring: KeyRing, into: str) -> DataFrame:
    """Add the compact token of a text; NULL for NULL or blank text and for unknown keys."""
    struct = _work(into, "token")
    content = F.when(F.trim(text) != "", F.encode(text, "UTF-8"))
    df = encrypt(df, content, key_id, ring, struct)
    return df.withColumn(into, F.when(F.col(struct).isNotNull(), compact(F.col(struct)))).drop(struct)


def decrypt_text(df: DataFrame, text: Column, key_id: Column, ring: KeyRing, into: str) -> DataFrame:
    """Add the plaintext of a compact token; NULL when it cannot be opened."""
    pieces = _work(into, "split")
    df = df.withColumn(pieces, once(F.split(text, "[.]")))
    return decrypt(df, parse_parts(F.col(pieces)), key_id, ring, into).withColumn(
        into, F.col(into).cast("string")
    ).drop(pieces)


def rekey_text(
    df: DataFrame, text: Column, old_key: Column, new_key: Column, ring: KeyRing, into: str
) -> DataFrame:
    """Add the token re-encrypted under another key; the plaintext never becomes an output column."""
    clear = _work(into, "clear")
    df = decrypt_text(df, text, old_key, ring, clear)
    return encrypt_text(df, F.col(clear), new_key, ring, into).drop(clear)
