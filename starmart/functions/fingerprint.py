"""Name-based UUID (version 5) of a text, bit for bit, from Spark's sha1."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the DNS name space of RFC 4122, as hex.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def digest_to_uuid_hex(digest: Column) -> Column:
    """Set version 5 and the RFC 4122 variant in the first 32 hex digits of a sha1 digest."""
    variant = F.substring(digest, 17, 1)
    nibble = F.conv(variant, 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))
    return F.concat(
        F.substring(digest, 1, 12),
        F.lit("5"),
        F.substring(digest, 14, 3),
        F.lower(F.hex(nibble)),
        F.substring(digest, 18, 15),
    )


def uuid5_hex(text: Column) -> Column:
    payload = F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(text, "UTF-8"))
    return digest_to_uuid_hex(F.sha1(payload))
