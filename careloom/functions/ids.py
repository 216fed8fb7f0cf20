"""Pseudonyms for identifiers.

``keyed`` is the default: a keyed SHA-256 digest, one-way and joinable.  ``xor``
exists only to stay joinable with data already released under the older,
reversible scheme.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_pseudonym(c: Column, site: str, key: str, salt: str = "") -> Column:
    """SHA-256 of a digest of (key, site, salt) followed by the id.

    The digest has a fixed length, and in it every part is preceded by its own, so no two
    sites, salts or ids can run into each other.  It is made on the driver: the key itself
    is in no plan, event log or user interface.
    """
    parts = b"".join(len(p).to_bytes(8, "big") + p for p in (x.encode() for x in (key, site, salt)))
    return F.sha2(F.concat(F.lit(hashlib.sha256(parts).hexdigest()), c.cast("string")), 256)


def xor_pseudonym(c: Column, site: str, seed: str) -> Column:
    """Base64 of (site, id) XORed byte by byte with the SHA-1 digest of the seed."""
    pad = F.array(*[F.lit(b) for b in hashlib.sha1(seed.encode()).digest()])
    plain = F.concat(F.lit(site), c.cast("string"))
    data = F.hex(F.encode(plain, "UTF-8"))

    def masked(i: Column) -> Column:
        byte = F.conv(F.substr(data, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
        return F.lpad(F.hex(byte.bitwiseXOR(F.get(pad, i % F.size(pad)))), 2, "0")

    places = F.sequence(F.lit(0), F.octet_length(plain) - 1)
    text = F.array_join(F.transform(places, masked), "")
    return F.regexp_replace(F.base64(F.unhex(text)), "[\r\n]", "")


def pseudonym(c: Column, site: str, key: str, mode: str = "keyed", salt: str | None = None) -> Column:
    """``salt`` (a table name) keeps ids of tables that exchange rows apart."""
    if not site:
        raise ValueError("a site code is required")
    if mode == "keyed":
        return keyed_pseudonym(c, site, key, salt or "")
    if mode != "xor":
        raise ValueError(f"no such mode: {mode}")
    return xor_pseudonym(F.concat(c.cast("string"), F.lit(salt)) if salt else c, site, key)
