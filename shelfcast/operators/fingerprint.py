"""Order-free fingerprint of a table, in parts that add up."""

from pyspark.sql import functions as F


def fingerprint_parts(frame, *keys):
    """Row count and two sums of 60-bit row hashes per key: parts of a table add up to the whole.

    A row's text is the JSON of its other columns in the order of their names. Sums keep
    duplicates apart, unlike xor, and combine map-side. Give the month among the keys, and only
    months that changed need new parts.
    """
    columns = [c for c in sorted(frame.columns) if c not in keys]
    digest = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)

    def part(start):
        return F.sum(F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)"))

    return frame.groupBy(*keys).agg(F.count("*").alias("rows"), part(1).alias("a"), part(16).alias("b"))


def combined(parts, *keys):
    """rows and data_hash per key from parts of any finer keys."""
    sums = parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("rows", "a", "b")])
    packed = F.concat_ws("|", *[F.col(c).cast("string") for c in ("rows", "a", "b")])
    return sums.select(*keys, "rows", F.substring(F.sha2(packed, 256), 1, 32).alias("data_hash"))


def fingerprint(frame, *keys):
    """32 hex digits that depend on the rows but not on their order."""
    return combined(fingerprint_parts(frame, *keys), *keys)
