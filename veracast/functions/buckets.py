"""Stable hash buckets of creator ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_bucket(key: Column, buckets: int) -> Column:
    """First 32 bits of the SHA-256 of the key, modulo `buckets`."""
    prefix = F.substring(F.sha2(key, 256), 1, 8)
    return F.conv(prefix, 16, 10).cast("bigint") % F.lit(buckets)


def split_name(platform: Column, creator_id: Column) -> Column:
    """60/20/20 split by creator, so that no creator lands in two splits."""
    key = F.concat_ws(":", F.coalesce(platform, F.lit("")), F.coalesce(creator_id, F.lit("")))
    bucket = hash_bucket(key, 10)
    return F.when(bucket < 6, "train").when(bucket < 8, "eval").otherwise("analysis_profile")


def identity_profile(creator_id: Column) -> Column:
    """Reputation, risk and verified flag assigned from the creator id alone."""
    bucket = hash_bucket(creator_id, 5)
    profiles = {0: (0.42, "risky", "bot_attack", False), 1: (0.58, "watch", "trust_drop", False), 2: (0.72, "trusted", "viral", True)}

    def as_struct(values: tuple) -> Column:
        names = ("reputation_score", "risk_profile", "default_mode", "verified")
        return F.struct(*[F.lit(value).alias(name) for value, name in zip(values, names)])

    chosen = F.when(F.lit(False), as_struct((0.80, "trusted", "normal", True)))
    for number, values in profiles.items():
        chosen = chosen.when(bucket == number, as_struct(values))
    return chosen.otherwise(as_struct((0.80, "trusted", "normal", True)))
