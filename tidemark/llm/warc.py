"""WARC records, and a Merkle audit of two replicas of an archive.

Every record is hashed, and the hashes are hashed again over ordered ranges of the file:
first ranges of `range_bytes`, then `fanout` neighbouring ranges at a time, up to one root
per file. Ranges are places in the file, so damage to one record changes the hashes on its
own path only. An audit compares roots and descends into the children of nodes that
differ; branches that agree are never looked at below.

A node has at most `fanout` children, or the records that start in one range, so no task
gathers more. `audit` takes tables of records. `audit_files` takes stored files, each of which
is hashed by the task that reads it; nothing but hashes leaves that task.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import Scratch

RANGE_BYTES = 64 << 10
FANOUT = 16
GZIP = b"\x1f\x8b"
CHUNK_BYTES = 64 << 10


def record_bytes(record_id: Column, uri: Column, payload: Column) -> Column:
    """A WARC/1.0 resource record; a null address is left empty, a null payload too."""
    body = F.coalesce(payload, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(uri, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    ).cast("binary")
    return F.concat(head, body, F.lit("\r\n\r\n").cast("binary"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, plain, with one gzip member per record, or compressed as a whole (offsets are then those of the content).

    `file`, `offset` and `length` (of the stored bytes), `record_id`, `uri`, `type`, `record`
    (the stored record, uncompressed). A file is read by one task, so files should keep to
    the usual size of about 1 GB. What follows a broken header is one record of type null.
    """
    files = stored_files(spark, path)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["file"], batch["content"]):
                for offset, length, record in split_records(opened(bytes(data))):
                    head = headers(record)
                    yield pd.DataFrame(
                        {
                            "file": [name],
                            "offset": [offset],
                            "length": [length],
                            "record_id": [head.get("warc-record-id")],
                            "uri": [head.get("warc-target-uri")],
                            "type": [head.get("warc-type")],
                            "record": [record],
                        }
                    )

    return files.mapInPandas(parse, "file string, offset long, length long, record_id string, uri string, type string, record binary")


def headers(record: bytes) -> dict[str, str]:
    lines = record.partition(b"\r\n\r\n")[0].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        return {}
    pairs = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _member(data: bytes, at: int) -> tuple[int, bytes] | None:
    """Stored length and bytes of the gzip member at a place; None where it is damaged or cut off."""
    member, view, place, parts = zlib.decompressobj(wbits=31), memoryview(data), at, []
    try:
        while place < len(data) and not member.eof:
            parts.append(member.decompress(view[place : place + CHUNK_BYTES]))
            place = min(place + CHUNK_BYTES, len(data))
    except zlib.error:
        return None
    return (place - len(member.unused_data) - at, b"".join(parts)) if member.eof else None


def _starts(data: bytes, at: int) -> bool:
    return data.startswith((GZIP, b"WARC/"), at)


def _resumed(data: bytes, at: int) -> int:
    """The next place after `at` where a record can start: a header behind an empty line, or a gzip member that is whole."""
    header = data.find(b"\r\n\r\nWARC/", at)
    header = header + 4 if header >= 0 else len(data)
    magic = data.find(GZIP, at + 1, header)
    while magic >= 0 and _member(data, magic) is None:
        magic = data.find(GZIP, magic + 1, header)
    return magic if magic >= 0 else header


def opened(data: bytes) -> bytes:
    """A stored file; the content of one that is compressed as a whole, not record by record."""
    if data.startswith(GZIP) and (member := _member(data, 0)) and member[0] == len(data):
        _, length, _ = next(split_records(member[1]), (0, 0, b""))
        return member[1] if length < len(member[1]) else data
    return data


def split_records(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, stored length and bytes of each record of a file.

    A damaged record is given as it is stored, up to the place where the next one starts.
    """
    at = 0
    while at < len(data):
        if data.startswith(GZIP, at) and (member := _member(data, at)):
            length, record = member
        else:
            end = data.find(b"\r\n\r\n", at)
            size = headers(data[at : end + 4]).get("content-length", "") if end >= 0 else ""
            stop = end + 4 + int(size) + 4 if size.isdecimal() else len(data) + 1
            whole = stop <= len(data) and data[stop - 4 : stop] == b"\r\n\r\n"
            if not (whole and (stop == len(data) or _starts(data, stop))):
                # The length is damaged, or what follows is.
                resumed = _resumed(data, at)
                stop = stop if whole and resumed >= stop else resumed
            length = stop - at
            record = data[at : at + length]
        yield at, length, record
        at += length


def in_order(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Places of equal values in two lists, both rising: the longest such run over the first, second, ... copies of each value."""
    waiting: dict[str, deque[int]] = {}
    for j, value in enumerate(right):
        waiting.setdefault(value, deque()).append(j)
    pairs = [(i, waiting[value].popleft()) for i, value in enumerate(left) if waiting.get(value)]
    ends: list[int] = []  # the least right place in which a run of each length ends
    last: list[int] = []  # its pair
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        ends[k : k + 1], last[k : k + 1] = [j], [n]
        before.append(last[k - 1] if k else -1)
    run, n = [], last[-1] if last else -1
    while n >= 0:
        run.append(pairs[n])
        n = before[n]
    return run[::-1]


def aligned(ours: pd.DataFrame, theirs: pd.DataFrame) -> Iterator[tuple]:
    """Faults among the differing records of one file, told from offsets, lengths, ids and hashes.

    Records of equal hash belong together, wherever they have moved. A stretch between two
    of them that has kept its length has not moved: its records are changed, and where the
    other replica can't be cut as ours its bytes have to be read (`unread`, with the place
    in the other file). Else records are matched by id, then length, then order; what is left
    is missing or extra.
    """
    lost, pieces = (list(side.sort_values("offset").itertuples(index=False)) for side in (ours, theirs))
    i = j = 0
    for k, m in [*in_order([r.hash for r in lost], [r.hash for r in pieces]), (len(lost), len(pieces))]:
        yield from _gap(lost[i:k], pieces[j:m])
        i, j = k + 1, m + 1


def _gap(lost: list, pieces: list) -> Iterator[tuple]:
    """The same for records between two that agree, cut where records in between agree at their own offsets."""
    cuts = sorted({b.offset for side in (lost, pieces) for a, b in pairwise(side) if a.offset + a.length != b.offset})
    stretches: list[tuple[list, list]] = [([], []) for _ in range(len(cuts) + 1)]
    for n, side in enumerate((lost, pieces)):
        for record in side:
            stretches[bisect_right(cuts, record.offset)][n].append(record)
    for stretch in stretches:
        yield from _stretch(*stretch)


def _stretch(lost: list, pieces: list) -> Iterator[tuple]:
    if [r.length for r in lost] == [r.length for r in pieces]:
        yield from ((r.offset, r.record_id, "changed", None, r.length, r.hash) for r in lost)
        return
    if sum(r.length for r in lost) == sum(r.length for r in pieces):
        shift = pieces[0].offset - lost[0].offset
        yield from ((r.offset, r.record_id, "unread", r.offset + shift, r.length, r.hash) for r in lost)
        return
    for key in (lambda r: r.record_id, lambda r: r.length, lambda r: "any"):
        waiting: dict = {}
        for record in lost:
            waiting.setdefault(key(record), deque()).append(record)
        matched, left = set(), []
        for piece in pieces:
            if (k := key(piece)) is not None and waiting.get(k):
                record = waiting[k].popleft()
                matched.add(record.offset)
                yield record.offset, record.record_id, "changed", None, record.length, record.hash
            else:
                left.append(piece)
        lost, pieces = [r for r in lost if r.offset not in matched], left
    yield from ((r.offset, r.record_id, "missing", None, r.length, r.hash) for r in lost)
    yield from ((r.offset, r.record_id, "extra", None, r.length, r.hash) for r in pieces)


def stored_files(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """`file`, `content` of the files in and below a folder, or of the named ones; names are relative to it, so that replicas agree on them."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    wanted = path if names is None else [f"{path}/" + re.sub(r"([\\\[\]{}*?])", r"\\\1", name) for name in names]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(wanted)
    inside = F.expr(f"substring(path, {len(root) + 2})")
    name = F.when(F.startswith("path", F.lit(root + "/")), inside).otherwise(F.substring_index("path", "/", -1))
    return files.select(name.alias("file"), "content")


def numbered_files(spark: SparkSession, path: str, side: str, names: list | None = None) -> DataFrame:
    """`file` (number), `content` of one replica of `write_replicas`, none if it has no records; only the folders of the named files are read."""
    files = spark.read.format("binaryFile").load(path)
    if "side" not in files.columns:
        return spark.createDataFrame([], "file long, content binary")
    files = files.where(F.col("side") == side)
    return (files if names is None else files.where(F.col("file").isin(names))).select("file", "content")


def hashed(files: DataFrame) -> DataFrame:
    """The records of files (`file`, `content`), hashed where they lie: `file`, `offset`, `length`, `record_id`, `hash` of the stored bytes."""

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["file"], batch["content"]):
                data, rows = opened(bytes(data)), []
                for offset, length, record in split_records(data):
                    digest = hashlib.sha256(data[offset : offset + length]).hexdigest()
                    rows.append((name, offset, length, headers(record).get("warc-record-id"), digest))
                yield pd.DataFrame(rows, columns=["file", "offset", "length", "record_id", "hash"])

    kind = files.schema["file"].dataType.simpleString()
    return files.mapInPandas(leaves, f"file {kind}, offset long, length long, record_id string, hash string")


def audit_files(ours: Callable[..., DataFrame], theirs: Callable[..., DataFrame], fanout: int = FANOUT, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records in which two replicas of archives differ: `file`, `offset`, `record_id`, `fault`; `ours` is the sound one.

    A replica is a function: its files (`file`, `content`), or those of a list of names. Each is
    hashed where it lies, in one pass; its tree is over ranges of its own offsets. Roots
    are compared and differing branches descended. Only hashes move, and only those of records
    below differing branches are aligned, file by file, since records behind a lost one have other
    offsets there. Bytes are read again where that leaves doubt, from the files concerned alone.

    `fault` is `changed`, `missing`, or `extra`, which has the offset and id of theirs. Empty
    replicas and files that one of them lacks are compared like others. A file is the work of
    one task.
    """
    spark = (files := ours()).sparkSession
    scratch = Scratch(spark, "fixity")
    sides = [scratch.keep(hashed(f))[0] for f in (files, theirs())]
    differ = differing(*sides, fanout, range_bytes, scratch)
    below = [
        side.join(differ.where(F.col(own).isNotNull()).select("file", F.col("no").alias("offset")), ["file", "offset"], "left_semi")
        for side, own in zip(sides, ("a", "b"))
    ]
    kind = files.schema["file"].dataType.simpleString()
    columns = ["offset", "record_id", "fault", "start", "length", "hash"]

    def faults(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame(list(aligned(a, b)), columns=columns)
        found["start"] = found["start"].astype("Int64")
        found.insert(0, "file", (a if len(a) else b)["file"].iloc[0])
        return found

    schema = f"file {kind}, offset long, record_id string, fault string, start long, length long, hash string"
    found, _ = scratch.keep(below[0].groupBy("file").cogroup(below[1].groupBy("file")).applyInPandas(faults, schema))
    unread = found.where("fault = 'unread'")
    told = found.where("fault <> 'unread'").select("file", "offset", "record_id", "fault")
    # Names of files only, which Spark lists on the driver anyhow.
    names = [row["file"] for row in unread.select("file").distinct().collect()]
    if not names:
        return told

    def read(places: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        data = opened(bytes(stored["content"].iloc[0]))
        own = [hashlib.sha256(data[at : at + size]).hexdigest() for at, size in zip(places["start"], places["length"])]
        return places.loc[places["hash"] != own, ["file", "offset", "record_id"]].assign(fault="changed")

    files = theirs(names).groupBy("file")
    return told.unionByName(unread.groupBy("file").cogroup(files).applyInPandas(read, told.schema))


def write_replicas(records: DataFrame, sides: dict[str, Column], path: str) -> None:
    """Write replicas of archives, a folder for each, from one shuffle of their records.

    `records` has `file` and `offset`; `sides` gives each replica's record, ended by an empty
    line, or null where it has none. A file is compressed as a whole by Spark's text writer.
    """
    # The text writer ends every row with the last two bytes of its record.
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("side"), record.alias("record")) for name, record in sides.items())))
    rows = records.repartition("file").select("file", "offset", each.alias("r")).where("r.record IS NOT NULL")
    text = F.expr("substring(r.record, 1, octet_length(r.record) - 2)").cast("string").alias("value")
    rows = rows.select("r.side", "file", "offset", text).sortWithinPartitions("side", "file", "offset").drop("offset")
    rows.write.partitionBy("side", "file").option("lineSep", "\r\n").option("compression", "gzip").text(path)


def last_offset(records: DataFrame) -> int:
    return records.where("file IS NOT NULL").agg(F.max("offset")).first()[0] or 0


def tree(records: DataFrame, fanout: int = FANOUT, range_bytes: int = RANGE_BYTES, last: int | None = None) -> DataFrame:
    """Nodes of every file's tree: `file`, `level`, `no`, `hash`; level 0 has the records, `no` their offset.

    `records` has `file`, `offset` and `record`, or its `hash`. The highest level has one node per file, if no offset is above
    `last` (by default the largest). A
    null record counts as empty; rows without file or offset have no place and are left
    out. Rows that repeat file and offset count together: their hashes are hashed in order.
    """
    placed = records.where("file IS NOT NULL AND offset IS NOT NULL")
    own = F.sha2(F.coalesce("record", F.lit(b"")), 256) if "record" in records.columns else F.col("hash")
    leaves = placed.select("file", F.col("offset").alias("no"), own.alias("hash"))
    repeated = leaves.groupBy("file", "no").agg(F.array_join(F.sort_array(F.collect_list("hash")), "").alias("hash"))
    leaves = repeated.select("file", F.lit(0).alias("level"), "no", "hash")
    last = last_offset(placed) if last is None else last
    levels, nodes = [leaves], leaves
    for level in range(1, 2 + max(0, math.ceil(math.log(last // range_bytes + 1, fanout) - 1e-9))):
        width = range_bytes if level == 1 else fanout
        children = F.sort_array(F.collect_list(F.struct("no", "hash")))
        text = F.array_join(F.transform(children, lambda c: F.concat(c["no"].cast("string"), F.lit(":"), c["hash"])), ",")
        nodes = nodes.groupBy("file", F.floor(F.col("no") / width).alias("no")).agg(F.sha2(text.cast("binary"), 256).alias("hash"))
        nodes = nodes.select("file", F.lit(level).alias("level"), "no", "hash")
        levels.append(nodes)
    return reduce(DataFrame.unionByName, levels)


def differing(ours: DataFrame, theirs: DataFrame, fanout: int, range_bytes: int, scratch: Scratch) -> DataFrame:
    """Leaves in which the trees of two tables differ: `file`, `no`, hashes `a` and `b`, null where there is none."""
    # Both trees are as high as the longer replica needs, so that roots meet roots.
    last = max(map(last_offset, (ours, theirs)))
    trees = [scratch.keep(tree(r, fanout, range_bytes, last))[0] for r in (ours, theirs)]
    top, suspects = max(t.agg(F.max("level")).first()[0] or 0 for t in trees), None
    for level in range(top, -1, -1):
        sides = []
        for name, nodes in zip(("a", "b"), trees):
            side = nodes.where(F.col("level") == level)
            if suspects is not None:
                width = range_bytes if level == 0 else fanout
                side = side.withColumn("parent", F.floor(F.col("no") / width)).join(suspects, ["file", "parent"], "left_semi")
            sides.append(side.select("file", "no", F.col("hash").alias(name)))
        differ = sides[0].join(sides[1], ["file", "no"], "full").where(~F.col("a").eqNullSafe(F.col("b")))
        found, _ = scratch.keep(differ)
        suspects = found.select("file", F.col("no").alias("parent"))
    return found


def audit(ours: DataFrame, theirs: DataFrame, fanout: int = FANOUT, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records in which two replicas differ: `file`, `offset`, `fault`.

    `fault` is `changed`, `missing` (not in theirs) or `extra` (only in theirs). Replicas
    are tables as for `tree`; agreeing ones, two empty ones too, give no rows.
    """
    found = differing(ours, theirs, fanout, range_bytes, Scratch(ours.sparkSession, "merkle"))
    fault = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    return found.select("file", F.col("no").alias("offset"), fault.alias("fault"))


def archived(rows: DataFrame, per_file: int, id_col: str, uri_col: str, payload_col: str) -> DataFrame:
    """Rows as the records of archives of `per_file` ids each, in the order of their ids.

    `file` (number), `offset`, `id`, `record`. A file's offsets are running sums within it.
    Rows without an id are left out: they have no place.
    """
    from pyspark.sql import Window

    records = rows.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.floor(F.col(f"`{id_col}`") / per_file).alias("file"),
        F.col(f"`{id_col}`").alias("id"),
        record_bytes(F.col(f"`{id_col}`"), F.col(f"`{uri_col}`"), F.col(f"`{payload_col}`")).alias("record"),
    )
    before = Window.partitionBy("file").orderBy("id", F.sha2("record", 256)).rowsBetween(Window.unboundedPreceding, -1)
    sizes = records.withColumn("size", F.octet_length("record").cast("long"))
    return sizes.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0))).select("file", "offset", "id", "record")
