"""Fixity audit of replicated WARC segments by Merkle trees.

A leaf hashes one record together with the offset range it takes in its segment; a node hashes the ordered hashes of
up to FANOUT nodes below it, first within a segment and then over segments, up to one root per replica. Two replicas
are compared from the root down: each level looks only at nodes below those that differ, so work follows the damage and
not the archive. Segments in which leaves differ are then compared record by record to name what happened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import stored

#: Children of a node (a power of two, as bits), records of a segment.
FANOUT_BITS, SEGMENT = 3, 512


def warc_record(record_id: Column, url: Column, payload: Column) -> Column:
    """A WARC/1.1 resource record as binary; null url and payload count as empty."""
    url, payload = F.coalesce(url, F.lit("")), F.coalesce(payload, F.lit(""))
    lines = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:md5:"), record_id, F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(lines, payload, F.lit("\r\n\r\n")).cast("binary")


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Pages as records: (key, url, payload, record_id, record). A record's id is the digest of its key and url."""
    record_id = F.md5(F.concat_ws(" ", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.coalesce(F.col(url), F.lit("null"))))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(payload).alias("payload"), record_id.alias("record_id"))
    return rows.withColumn("record", warc_record(F.col("record_id"), F.col("url"), F.col("payload")))


def fingerprint(record: Column) -> list[Column]:
    return [F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest")]


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `at`, the place of each row in the order of all rows, from 0; rows that tie get places in some fixed order.

    Rows are dealt out in ranges and written; what a range begins with is the sum of the sizes before it, one number
    per range. Repeated rows are spread by an added number, so no key makes a range long.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "spread")
    ranged = stored(ranged.sortWithinPartitions(*order, "spread").drop("spread").withColumn("place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("place", 33)
    sizes = {r["part"]: r["n"] for r in ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    begins, total = {}, 0
    for p in sorted(sizes):
        begins[p], total = total, total + sizes[p]
    if not begins:
        return ranged.withColumn("at", F.lit(0).cast("long")).drop("place")
    begin = F.element_at(F.create_map(*(F.lit(x).cast("long") for pair in begins.items() for x in pair)), part)
    return ranged.withColumn("at", begin + F.col("place").bitwiseAND((1 << 33) - 1)).drop("place")


def manifest(records: DataFrame) -> DataFrame:
    """Adds `no` (place in the segment) and `start` (offset) to (segment, at, record_id, length, digest, ...)."""
    window = Window.partitionBy("segment").orderBy("at")
    return records.withColumn("no", (F.row_number().over(window) - 1).cast("long")).withColumn(
        "start", F.sum("length").over(window) - F.col("length"))


def leaves(rows: DataFrame) -> DataFrame:
    """(segment, no, hash) of a manifest."""
    parts = [F.lit("leaf"), *(F.col(c).cast("string") for c in ("segment", "start", "length")), F.col("record_id"), F.col("digest")]
    return rows.select("segment", "no", F.sha2(F.concat_ws(" ", *parts), 256).alias("hash"))


def tree(both: DataFrame) -> list[tuple[str, DataFrame]]:
    """Levels from the leaves to the root, each with the number that is shortened on the way to the next one.

    A level has (side, segment, no, hash) and is written; `both` has the leaves of both sides.
    """
    level = stored(both, "leaves")
    most, levels = level.agg(F.max("no").alias("no"), F.max("segment").alias("segment")).first(), []
    for name, other in (("no", "segment"), ("segment", "no")):
        largest = most[name] or 0
        while largest > 0:
            levels.append((name, level))
            ordered = F.sort_array(F.collect_list(F.struct(name, "hash")))  # at most one node's children
            nodes = level.groupBy("side", other, F.shiftright(name, FANOUT_BITS).alias(name)).agg(ordered.alias("below"))
            children = F.transform("below", lambda x: F.concat_ws(":", x[name].cast("string"), x["hash"]))
            text = F.concat_ws(" ", F.lit("node"), children)
            level = stored(nodes.select("side", "segment", "no", F.sha2(text, 256).alias("hash")), "nodes")
            largest >>= FANOUT_BITS
    return [*levels, ("", level)]


def differing(levels: list[tuple[str, DataFrame]]) -> DataFrame:
    """(segment, no) of the leaves that differ, found by going down from the roots below differing nodes only."""
    found = None
    for name, nodes in reversed(levels):
        if found is not None:
            other = "segment" if name == "no" else "no"
            above = found.select(F.col(name).alias("above"), F.col(other).alias("same"))
            nodes = nodes.join(above, (F.shiftright(name, FANOUT_BITS) == F.col("above")) & (F.col(other) == F.col("same")), "left_semi")
        sides = [F.max(F.when(F.col("side") == s, F.col("hash"))).alias(s) for s in "ab"]
        found = nodes.groupBy("segment", "no").agg(*sides).filter(~F.col("a").eqNullSafe(F.col("b"))).select("segment", "no")
        found = stored(found, "differing")
    return found


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every record of either manifest: segment, record_id, copy, start, length, digest (as in `a`, else in `b`), status.

    Status is intact, altered (other bytes), moved (same bytes elsewhere in the segment), missing (from `b`) or extra
    (only in `b`). Manifests have (segment, at, record_id, length, digest); rows that repeat a record id within a
    segment are matched in order. Empty manifests give no rows.
    """
    copy = F.row_number().over(Window.partitionBy("segment", "record_id").orderBy("at"))
    a, b = (stored(manifest(x).withColumn("copy", copy), "manifest") for x in (a, b))
    both = leaves(a).withColumn("side", F.lit("a")).unionByName(leaves(b).withColumn("side", F.lit("b")))
    suspect = differing(tree(both)).select("segment").distinct()
    keys = ["segment", "record_id", "copy"]
    x = a.join(suspect, "segment", "left_semi").select(*keys, *(F.col(c).alias(f"a_{c}") for c in ("start", "length", "digest")))
    y = b.join(suspect, "segment", "left_semi").select(*keys, *(F.col(c).alias(f"b_{c}") for c in ("start", "length", "digest")))
    status = (
        F.when(F.col("b_digest").isNull(), "missing").when(F.col("a_digest").isNull(), "extra")
        .when(F.col("a_digest") != F.col("b_digest"), "altered").when(F.col("a_start") != F.col("b_start"), "moved").otherwise("intact"))
    named = x.join(y, keys, "full").select(
        *keys, *(F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in ("start", "length", "digest")), status.alias("status"))
    same = a.join(suspect, "segment", "left_anti").select(*keys, "start", "length", "digest", F.lit("intact").alias("status"))
    return same.unionByName(named)
