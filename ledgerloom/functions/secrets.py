"""Encrypted columns.

GCM with a random IV is the default.  ECB is only for reading and writing data
that must match values stored earlier: there the key text is folded by XOR into
16 bytes.  The key is a one-row frame that the query asks for when it runs, so
neither the text of a plan nor an event log holds it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, SparkSession, functions as F

GCM, ECB = "GCM", "ECB"


def folded_key(key: str) -> bytes:
    folded = bytearray(16)
    for i, byte in enumerate(key.encode()):
        folded[i % 16] ^= byte
    return bytes(folded)


def _key(key: str, mode: str) -> Column:
    held = bytearray(folded_key(key) if mode == ECB else hashlib.sha256(key.encode()).digest())
    return SparkSession.active().createDataFrame([(held,)], "SECRET binary").scalar()


def encrypt(col: Column, key: str, mode: str = GCM) -> Column:
    padding = "PKCS" if mode == ECB else "DEFAULT"
    return F.aes_encrypt(col, _key(key, mode), F.lit(mode), F.lit(padding))


def decrypt(col: Column, key: str, mode: str = GCM) -> Column:
    padding = "PKCS" if mode == ECB else "DEFAULT"
    return F.aes_decrypt(col, _key(key, mode), F.lit(mode), F.lit(padding)).cast("string")
