"""WARC files and a Merkle fixity audit of two replicas (operator 7)."""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.llm.common import ship, written
from garimpo.session import fresh_path

#: Bytes of a file that one leaf of its tree covers, and children of an inner node.
LEAF_BYTES = 1 << 16
FAN_OUT = 16

_END = b"\r\n\r\n"
_START = b"WARC/1.0\r\n"


def warc_record(record_id: Column, url: Column, body: Column) -> Column:
    """One WARC record as text, without the two line ends that follow it; null fields are empty."""
    def clean(c):
        return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[\r\n]", " ")

    payload = F.coalesce(body.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: "), clean(record_id),
        F.lit("\r\nWARC-Target-URI: "), clean(url),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"),
        F.lit("\r\n\r\n"), payload)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> None:
    """Writes gzipped WARC files below ``path``, one per input partition and without a shuffle.

    The text sink puts the record terminator after every record, so the files are plain WARC.
    """
    pages.select(warc_record(F.col(id_col), F.col(url_col), F.col(body_col)).alias("value")).write.option(
        "lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def split_records(data: bytes):
    """(offset, length, record id) of every record; after damage, reading resumes at the next record start."""
    at = 0
    while at < len(data):
        head = data.find(_END, at)
        if head < 0:
            yield at, len(data) - at, None
            return
        header = data[at:head]
        size = re.search(rb"\r\nContent-Length: (\d+)", header)
        name = re.search(rb"\r\nWARC-Record-ID: ([^\r\n]*)", header)
        end = head + 4 + int(size[1]) if size else -1
        if not header.startswith(_START) or end < 0 or data[end:end + 4] != _END:
            again = data.find(_END + _START, at)
            end = again if again >= 0 else max(at, len(data) - 4)
        yield at, end - at, name[1].decode("utf-8", "replace") if name else None
        at = end + 4


def _member(stored: bytes, begin: int) -> tuple[bytes, int] | None:
    """Data and end of the gzip member that begins there, or None. It is fed in blocks, so the rest is not copied."""
    reader, parts, at = zlib.decompressobj(31), [], begin
    try:
        while at < len(stored) and not reader.eof:
            block = stored[at:at + LEAF_BYTES]
            parts.append(reader.decompress(block))
            at += len(block)
    except zlib.error:
        return None
    return (b"".join(parts), at - len(reader.unused_data)) if reader.eof else None


def unzipped(stored: bytes) -> tuple[bytes, list[tuple[int, int]]]:
    """The data of all gzip members of a file, and (offset, length) of what could not be read, kept as stored.

    A member that breaks off or does not pass its checksum, and anything behind a member that is no gzip data,
    is damaged up to the next place from which a whole member can be read. Zeros that pad the end are left out.
    """
    parts, damaged, size, at = [], [], 0, 0
    while at < len(stored) and (stored[at] or stored[at:].strip(b"\0")):
        begin, read = at, _member(stored, at)
        while read is None and begin >= 0:
            begin = stored.find(b"\x1f\x8b\x08", begin + 1)
            read = _member(stored, begin) if begin >= 0 else None
        lost = stored[at:begin] if read else stored[at:]
        if lost:
            damaged.append((size, len(lost)))
            parts.append(lost)
            size += len(lost)
        if read is None:
            break
        parts.append(read[0])
        size += len(read[0])
        at = read[1]
    return b"".join(parts), damaged


def stored_records(stored: bytes):
    """(data, records) of a file as it is stored, gzipped in any number of members or plain."""
    if stored[:2] != b"\x1f\x8b":
        return stored, list(split_records(stored))
    data, damaged = unzipped(stored)
    found, at = [], 0
    for begin, length in [*damaged, (len(data), 0)]:
        found += [(at + o, n, name) for o, n, name in split_records(data[at:begin])]
        if length:
            found.append((begin, length, None))
        at = begin + length
    return data, found


#: What Spark adds to the names of the files of one write.
WRITE_ID = r"(part-\d+)-[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?=[-.])"


def read_records(spark: SparkSession, path: str, one_write: bool = False) -> DataFrame:
    """file, offset, length, record_id and SHA-256 of every record below ``path``, folders below it included.

    A file is known by its path below ``path``, whatever its name, so replicas of any origin can be compared.
    With ``one_write`` all files come from one write of Spark, whose id in their names does not count.
    A file is read whole by one task; its size is set by the partitions that were written. All gzip
    members are read; damaged gzip data give one record for each damaged stretch, hashed as stored.
    """
    ship(spark)

    def run(batches):
        for batch in batches:
            files = batch.column(0).to_pylist()
            for k, content in enumerate(batch.column(1)):
                stored = content.as_py() or b""
                data, found = stored_records(stored)
                view = memoryview(data)
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([files[k]] * len(found), pa.string()),
                    "offset": pa.array([f[0] for f in found], pa.int64()),
                    "length": pa.array([f[1] for f in found], pa.int64()),
                    "record_id": pa.array([f[2] for f in found], pa.string()),
                    "sha256": pa.array([hashlib.sha256(view[o:o + n]).hexdigest() for o, n, _ in found], pa.string())})

    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(folder).toString().rstrip("/")
    below = F.expr(f"substring(path, {len(root) + 2})")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        (F.regexp_replace(below, WRITE_ID, "$1") if one_write else below).alias("file"), "content")
    return files.mapInArrow(run, "file string, offset long, length long, record_id string, sha256 string")


def _combined(rows: DataFrame, keys: list[str], order: list[str], hash_col: str) -> DataFrame:
    """One node per group: SHA-256 over its children in order. Groups are bounded by range and fan-out."""
    child = F.concat_ws(":", *[F.col(c).cast("string") for c in (*order, hash_col)])
    listed = F.array_sort(F.collect_list(F.struct(*order, child.alias("child"))))
    return rows.groupBy(*keys).agg(
        F.sha2(F.concat_ws("\n", F.transform(listed, lambda x: x["child"])), 256).alias("hash"))


def merkle_levels(records: DataFrame, depth: int, leaf_bytes: int = LEAF_BYTES, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Node tables (file, node, hash) of every file's tree, leaves first; the last level is one root a file.

    A leaf is the range of ``leaf_bytes`` offsets; it hashes offset, length and digest of the records that
    begin there. An inner node hashes ``fan_out`` neighbouring ranges.
    """
    leaves = records.withColumn("node", F.floor(F.col("offset") / leaf_bytes))
    levels = [_combined(leaves, ["file", "node"], ["offset", "length"], "sha256")]
    for _ in range(depth):
        below = levels[-1].withColumnsRenamed({"node": "child_node"}).withColumn("node", F.floor(F.col("child_node") / fan_out))
        levels.append(_combined(below, ["file", "node"], ["child_node"], "hash"))
    return levels


def audit(left: DataFrame, right: DataFrame, leaf_bytes: int = LEAF_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """One row per record of either replica: record_id, file, offset, length, status, left_sha256, right_sha256.

    Roots are compared file by file; below a root that differs, only children of differing nodes are
    compared, level by level, down to the leaf ranges whose records are compared one by one. Status is
    intact, changed, missing (only in the left replica) or added (only in the right one). A record that
    moved within its file is missing at the old offset and added at the new one.

    Equal records repeat at different offsets and are told apart by them. Empty replicas give no rows.
    """
    left, right = written(left, "fixity-left"), written(right, "fixity-right")
    top = max(left.agg(F.max("offset")).first()[0] or 0, right.agg(F.max("offset")).first()[0] or 0)
    depth, reach = 0, leaf_bytes
    while reach <= top:
        depth, reach = depth + 1, reach * fan_out
    a = [written(x, "fixity-tree") for x in merkle_levels(left, depth, leaf_bytes, fan_out)]
    b = [written(x, "fixity-tree") for x in merkle_levels(right, depth, leaf_bytes, fan_out)]
    open_ = None
    for level in range(depth, -1, -1):
        one, two = a[level], b[level].withColumnRenamed("hash", "other")
        if open_ is not None:
            parents = open_.withColumnRenamed("node", "parent")
            one, two = [
                x.withColumn("parent", F.floor(F.col("node") / fan_out)).join(parents, ["file", "parent"], "left_semi").drop("parent")
                for x in (one, two)]
        open_ = written(
            one.join(two, ["file", "node"], "full_outer").filter(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node"),
            "fixity-open")
    ranged = [x.withColumn("node", F.floor(F.col("offset") / leaf_bytes)) for x in (left, right)]
    same = ranged[0].join(open_, ["file", "node"], "left_anti").select(
        "record_id", "file", "offset", "length", F.lit("intact").alias("status"),
        F.col("sha256").alias("left_sha256"), F.col("sha256").alias("right_sha256"))
    inside = [x.join(open_, ["file", "node"], "left_semi") for x in ranged]
    r = inside[1].select("file", "offset", F.col("length").alias("r_length"), F.col("record_id").alias("r_id"),
                         F.col("sha256").alias("r_sha"))
    status = (
        F.when(F.col("r_sha").isNull(), "missing").when(F.col("sha256").isNull(), "added")
        .when((F.col("sha256") == F.col("r_sha")) & (F.col("length") == F.col("r_length")), "intact").otherwise("changed"))
    compared = inside[0].join(r, ["file", "offset"], "full_outer").select(
        F.coalesce("record_id", "r_id").alias("record_id"), "file", "offset", F.coalesce("length", "r_length").alias("length"),
        status.alias("status"), F.col("sha256").alias("left_sha256"), F.col("r_sha").alias("right_sha256"))
    return same.unionByName(compared)


def damaged(id_col: str) -> Column:
    """Pages whose copy gets a wrong byte in the audit query: 1 in 97 by the checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 97 == 5, F.lit(False))


def audited_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Writes two replicas of the pages as WARC, the second with wrong bytes in some bodies, and audits them.

    One row per page: page_id, file, offset, length, status. Null urls and bodies are empty; a null id is an
    empty record id and comes back as null, as does an id that is no number. Repeated rows are records at
    offsets of their own. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    spark = pages.sparkSession
    picked = pages.select(id_col, url_col, body_col)
    first, second = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    write_warc(picked, first, id_col, url_col, body_col)
    spoiled = F.when(damaged(id_col), F.concat(F.lit("~"), F.expr(f"substring({body_col}, 2)"))).otherwise(F.col(body_col))
    write_warc(picked.withColumn(body_col, spoiled), second, id_col, url_col, body_col)
    found = audit(read_records(spark, first, one_write=True), read_records(spark, second, one_write=True))
    return found.select(
        F.expr("try_cast(record_id AS long)").alias("page_id"), "file", "offset", "length", "status")
