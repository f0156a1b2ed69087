"""WARC records and a Merkle fixity audit of archive replicas.

Pages become WARC records that lie one behind the other in archive files. An
audit hashes every record of both replicas and gives each replica a tree of its
own: a leaf covers a fixed range of page_ids and digests the records that the
replica holds there, each with the file and offset at which that replica has
it; every FANOUT neighbouring nodes make a node with the digest of theirs, up
to one root. Replicas with equal roots are equal, and the audit ends there.
Otherwise only the children of differing nodes are compared, level by level.
Records are matched in the leaves that differ, and nowhere else: there they are
intact, moved, corrupt, missing or in excess.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import checkpoint, levels
from clickweave.llm.scan import running_sums
from clickweave.operators.lookup import lookup

FANOUT = 16
# Ids of a file of the default layout, and of a leaf.
RECORDS_PER_FILE = 256
LEAF_IDS = 16
# The file of records without a page_id.
NO_ID_FILE = -2**62
DATE = "1970-01-01T00:00:00Z"


def record_text(url: Column, page_id: Column, body: Column, date: str = DATE) -> Column:
    """A WARC record; null values are empty ones. The length is the body's in bytes."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """(page_id, record)"""
    p = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return p.select("page_id", record_text(F.col("url"), F.col("page_id"), F.col("html"), date).alias("record"))


def digests(recs: DataFrame, places: bool = False) -> DataFrame:
    """(page_id, id, length, sha256[, file, offset]): what the rest of an audit
    needs of a record; id is page_id as text, empty for null. A null record is
    an empty one."""
    whole = F.coalesce(F.col("record").cast("binary"), F.lit(b""))
    own = [F.coalesce(F.col("file").cast("string"), F.lit("")).alias("file"), F.coalesce(F.col("offset").cast("long"), F.lit(-1)).alias("offset")]
    r = recs.select(F.col("page_id").cast("long").alias("page_id"), whole.alias("record"), *(own if places else []))
    return r.select("page_id", F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("id"),
                    F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("sha256"),
                    *(["file", "offset"] if places else []))


def layout(digested: DataFrame, per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """Adds file and offset: a file holds ``per_file`` neighbouring page_ids, its
    records in order of page_id and digest. Records without an id have a file
    of their own."""
    group = F.coalesce(F.floor(F.col("page_id") / F.lit(per_file).cast("decimal(20,0)")).cast("long"), F.lit(NO_ID_FILE))
    filed = checkpoint(digested.withColumn("file", group))  # hashed once; the sort reads its input twice
    out = running_sums(filed, ["file"], [F.col("page_id"), F.col("sha256")], {"end": "length"})
    return out.withColumn("offset", F.col("end") - F.col("length")).withColumn("file", F.col("file").cast("string")).drop("end")


def placed(recs: DataFrame, places: bool, per_file: int) -> DataFrame:
    """(page_id, id, length, sha256, file, offset) of a replica's records."""
    found = digests(recs, places)
    return checkpoint(found.select("page_id", "id", "length", "sha256", "file", "offset") if places else
                      layout(found, per_file).select("page_id", "id", "length", "sha256", "file", "offset"))


def leaves(laid: DataFrame, replica: str) -> DataFrame:
    """(replica, node, digest) from records (node, ...). The digests of a leaf's
    records, which hold their places, are added up, so a leaf of any number of
    records is an aggregate with a map-side combine."""
    own = F.sha2(F.concat_ws(" ", "id", "file", "offset", "length", "sha256"), 256)
    lane = lambda i: F.conv(F.substring("h", 16 * i + 1, 16), 16, 10).cast("decimal(20,0)")
    sums = laid.select("node", own.alias("h")).select("node", *[lane(i).alias(f"l{i}") for i in range(4)]).groupBy("node").agg(
        F.count("*").alias("n"), *[F.sum(f"l{i}").alias(f"l{i}") for i in range(4)])
    return sums.select(F.lit(replica).alias("replica"), "node", F.sha2(F.concat_ws(":", "n", *[F.col(f"l{i}") for i in range(4)]), 256).alias("digest"))


def tree(leaf_rows: DataFrame, n: int, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of the replicas' trees over leaves 0..n-1, leaves first, each
    (replica, node, digest). A group to be hashed holds ``fanout`` rows at most."""
    out = [checkpoint(leaf_rows)]
    for _ in range(levels(n, fanout)):
        below = F.array_sort(F.collect_list(F.struct("node", "digest")))
        text = F.array_join(F.transform(below, lambda c: F.concat_ws(":", c["node"], c["digest"])), ",")
        up = out[-1].withColumn("up", F.expr(f"node div {fanout}")).groupBy("replica", "up").agg(F.sha2(text, 256).alias("digest"))
        out.append(checkpoint(up.select("replica", F.col("up").alias("node"), "digest")))
    return out


def differing(level: DataFrame, a: str, b: str, parents: DataFrame | None = None, fanout: int = FANOUT) -> DataFrame:
    """(node): nodes of one level whose digests differ or that one replica lacks;
    only children of ``parents`` are looked at."""
    if parents is not None:
        level = (level.withColumn("up", F.expr(f"node div {fanout}"))
                 .join(parents.select(F.col("node").alias("up")), "up", "left_semi").drop("up"))
    side = lambda r: F.max(F.when(F.col("replica") == r, F.col("digest")))
    both = level.groupBy("node").agg(side(a).alias("x"), side(b).alias("y"))
    return both.where(~F.col("x").eqNullSafe(F.col("y"))).select("node")


def compare(leaf_rows: DataFrame, n: int, a: str, b: str, fanout: int = FANOUT) -> tuple[DataFrame, list[int]]:
    """(node) of the leaves in which replicas a and b differ, and how many nodes
    differ at each level from the root down; equal replicas end at the root."""
    trees = tree(leaf_rows, n, fanout)
    found, seen = None, []
    for level in reversed(trees):
        found = checkpoint(differing(level, a, b, found, fanout))
        seen.append(found.count())
        if not seen[-1]:
            break
    return found, seen


def numbered(rows: DataFrame, keys: list[str], order: list, name: str) -> DataFrame:
    """Adds ``name``: the row's place, from 1, among those equal in ``keys``."""
    h = {f"{name}_{i}": F.xxhash64(F.lit(i), *keys) for i in range(2)}
    out = running_sums(rows.withColumns(h).withColumn("one_", F.lit(1).cast("long")), list(h), order, {name: "one_"})
    return out.drop("one_", *h)


def matched(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of differing leaves, a's (with their ``ordinal``) and b's ->
    (ordinal, status, replica_file, replica_offset) for each of a's, and b's
    records in excess.

    Equal records of one id are paired in order of their places; what is left
    of an id on both sides is paired in order of place and is corrupt."""
    whole, place = ["id", "sha256"], [F.col("file"), F.col("offset")]
    x = numbered(a, whole, place, "nth").select("ordinal", "nth", *whole, "file", "offset")
    y = numbered(b, whole, place, "nth").select("nth", *whole, F.col("page_id").alias("p"), F.col("length").alias("l"),
                                                F.col("file").alias("replica_file"), F.col("offset").alias("replica_offset"))
    both = checkpoint(x.join(y, [*whole, "nth"], "full"))
    met = both.where("file is not null and replica_file is not null").select("ordinal", F.lit("ok").alias("status"), "replica_file", "replica_offset")
    left = numbered(both.where("replica_file is null").select("ordinal", "id", "file", "offset"), ["id"], place, "k").select("ordinal", "id", "k")
    over = both.where("file is null").select("id", "p", "l", "sha256", "replica_file", "replica_offset")
    over = numbered(over, ["id"], [F.col("replica_file"), F.col("replica_offset")], "k")
    rest = checkpoint(left.join(over, ["id", "k"], "full"))
    kind = F.when(F.col("replica_file").isNull(), "missing").otherwise("corrupt")
    found = met.union(rest.where("ordinal is not null").select("ordinal", kind.alias("status"), "replica_file", "replica_offset"))
    extra = rest.where("ordinal is null").select(F.col("p").alias("page_id"), F.col("l").alias("length"), "sha256", "replica_file", "replica_offset")
    return found, extra


def audit(primary: DataFrame, replica: DataFrame, fanout: int = FANOUT, per_file: int = RECORDS_PER_FILE,
          places: bool = False) -> DataFrame:
    """Audits the records of a replica, (page_id, record) like the primary's:
    (page_id, warc_file, ordinal, offset, length, sha256, status, moved,
    replica_file, replica_offset), one row per record of the primary with its
    own place and digest. status is ok, corrupt or missing; ``moved`` is true
    where the replica has the record, intact or not, at another file or offset
    (a lost record moves those behind it in its file). A record that only the
    replica has makes a row of status extra, without a place in the primary.

    With ``places`` both sides give the file (text) and offset of their records,
    as ``parse`` does; otherwise each side is laid out by itself in files of
    ``per_file`` neighbouring ids. Every record of both sides is hashed. Records
    are text or binary, null ones are empty. Records of one page_id, also null,
    are told apart by digest; equal ones are as many records. Other columns are
    ignored. If one side is empty all records of the other are missing, or
    extra; two empty sides give an empty result.
    """
    a, b = placed(primary, places, per_file), placed(replica, places, per_file)
    leaf = F.floor(F.col("page_id") / F.lit(LEAF_IDS).cast("decimal(20,0)")).cast("long")
    low, high = a.select(leaf.alias("n")).union(b.select(leaf.alias("n"))).agg(F.min("n"), F.max("n")).first()
    low, high = (0, 0) if low is None else (low, high)
    node = F.coalesce(leaf - F.lit(low) + 1, F.lit(0))  # ids that are null: leaf 0
    a, b = a.withColumn("node", node), b.withColumn("node", node)
    bad, _ = compare(leaves(a, "primary").union(leaves(b, "replica")), high - low + 2, "primary", "replica", fanout)
    order = [F.col("page_id").asc_nulls_first(), F.col("sha256"), F.col("file"), F.col("offset")]
    a = running_sums(a.withColumn("one_", F.lit(1).cast("long")), [], order, {"at": "one_"}).withColumn("ordinal", F.col("at") - 1)
    found, extra = matched(lookup(a, bad, "node"), lookup(b, bad, "node"))
    out = a.join(found.select("ordinal", "status", F.col("replica_file").alias("rf"), F.col("replica_offset").alias("ro")), "ordinal", "left")
    same = F.col("status").isNull()
    out = out.select("page_id", F.col("file").alias("warc_file"), "ordinal", "offset", "length", "sha256",
                     F.coalesce("status", F.lit("ok")).alias("status"),
                     F.when(same, False).otherwise(F.coalesce((F.col("rf") != F.col("file")) | (F.col("ro") != F.col("offset")), F.lit(False))).alias("moved"),
                     F.when(same, F.col("file")).otherwise(F.col("rf")).alias("replica_file"),
                     F.when(same, F.col("offset")).otherwise(F.col("ro")).alias("replica_offset"))
    none = lambda kind: F.lit(None).cast(kind)
    return out.union(extra.select("page_id", none("string"), none("long"), none("long"), "length", "sha256", F.lit("extra"), F.lit(False),
                                  "replica_file", "replica_offset"))


def damaged(body: Column) -> Column:
    """A body with its first character changed (an empty one gets a character)."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(F.when(F.startswith(body, F.lit("~")), "^").otherwise("~"), F.substring(body, 2, 2**31 - 1))


def audit_damaged_copy(pages: DataFrame, corrupt: Column, lost: Column, fanout: int = FANOUT,
                       per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """Archives the pages, makes a replica in which the ``corrupt`` records are
    changed and the ``lost`` ones missing, and audits it: the columns of
    ``audit``, one row per input row; status is ok, corrupt or missing. lost wins
    over corrupt; null conditions are false.

    Null url, html and page_id are empty in the record; null ids come first.
    Repeated rows are records of their own, with neighbouring places. Other
    columns are ignored. An empty table gives an empty result.
    """
    bad, gone = F.coalesce(corrupt, F.lit(False)), F.coalesce(lost, F.lit(False))
    html = F.col("html").cast("string")
    copy = pages.where(~gone).select("page_id", "url", F.when(bad, damaged(html)).otherwise(html).alias("html"))
    return audit(records(pages), records(copy), fanout, per_file)


def members(raw: bytes):
    """(offset, length, content, whole) of the gzip members of a file, or of the
    file itself if it is not compressed. A damaged member ends where the next
    one begins, and gives the bytes that can be read."""
    import zlib
    if raw[:2] != b"\x1f\x8b":
        yield 0, len(raw), raw, True
        return
    at = 0
    while at < len(raw):
        d, out, ok = zlib.decompressobj(31), b"", True
        try:
            out = d.decompress(raw[at:])
            ok = d.eof
        except zlib.error:
            ok = False
        end = len(raw) - len(d.unused_data) if ok else raw.find(b"\x1f\x8b\x08", at + 3)
        end = len(raw) if end < 0 else end
        yield at, end - at, out, ok
        at = end


def cut_records(raw: bytes):
    """(offset, length, page_id or None, record, damage or None) of one file's or
    member's records. A record without a readable header or Content-Length, or
    whose length does not lead to the next record or the end, reaches to the
    next line that begins a record, and is reported."""
    import re
    at = 0
    while at < len(raw):
        head = raw.find(b"\r\n\r\n", at)
        header = raw[at:head] if head >= 0 else b""
        size = re.search(rb"(?mi)^Content-Length:[ \t]*(\d+)[ \t]*\r?$", header)
        name = re.search(rb"(?mi)^WARC-Record-ID:[ \t]*<urn:page:(-?\d*)>", header)
        damage = None
        if not header.startswith(b"WARC/"):
            damage = "no header"
        elif b"\nWARC/" in header:
            damage = "no end of header"
        elif size is None:
            damage = "no length"
        end = head + 4 + int(size[1]) + 4 if damage is None else -1
        if damage is None and (end > len(raw) or raw[end - 4:end] != b"\r\n\r\n" or raw[end:end + 5] not in (b"", b"WARC/")):
            damage = "wrong length"
        if damage is not None:
            end = raw.find(b"\nWARC/", at + 1) + 1 or len(raw)
        yield at, end - at, name[1].decode() if name and damage != "no end of header" else None, raw[at:end], damage
        at = end


def parse(files: DataFrame) -> DataFrame:
    """(file, content binary) -> (file, offset, length, page_id, record, damage):
    the records of WARC files, plain or with gzip members; ``audit`` takes them,
    with ``places`` too. offset is that of the record, or of its member.

    damage is null for a sound record, else ``no header``, ``no end of header``,
    ``no length``, ``wrong length`` or ``damaged member``; such a record ends
    where the next one begins, so none is swallowed. A null or empty file has no
    records. A file is read by one task; its size is bounded by what the reader
    of binary files allows.
    """
    def cut(batches):
        import pandas as pd
        for b in batches:
            for name, raw in zip(b["file"], b["content"]):
                rows = []
                for at, length, content, whole in members(bytes(raw or b"")):
                    plain = length == len(content) and at == 0
                    for start, size, page_id, record, damage in cut_records(content):
                        rows.append((name, at + start if plain else at, size if plain else length, page_id, record, damage or (None if whole else "damaged member")))
                    if not whole and not content:
                        rows.append((name, at, length, None, b"", "damaged member"))
                yield pd.DataFrame(rows, columns=["file", "offset", "length", "page_id", "record", "damage"])
    out = files.select("file", "content").mapInPandas(cut, "file string, offset long, length long, page_id string, record binary, damage string")
    return out.withColumn("page_id", F.expr("try_cast(page_id as long)"))
