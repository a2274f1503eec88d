"""WARC archives: deterministic sharded writer and its reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestfold.llm.common import file_uri, id_shards, lookup, make_folders, publish, store, table
from nestfold.llm.files import Files, batch_of
from nestfold.llm.registry import register
from nestfold.session import scratch_path

#: Payload bytes per shard (one writing task) and compressed bytes at which a file is closed.
SHARD_BYTES, ROLL_BYTES = 64 << 20, 32 << 20
#: Fixed value: every record carries this date, so that equal input gives equal files.
WARC_DATE = "2020-01-01T00:00:00Z"

MANIFEST = "shard int, seq int, temp string, name string, records long, bytes long, sha1 string"
READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _record(kind: str, page_id, url, digest: str, payload: bytes | None, size: int, refers_to) -> bytes:
    """One record, headers made anew from the content."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + (payload or b"")
    own = "null" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{own}:{kind}>", f"WARC-Date: {WARC_DATE}"]
    if url is not None:  # a line end in a header would end the header
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    head.append("WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode())
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}:response>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", 6, mtime=0)


class _Roll:
    """Archive files of one task, each closed at ``limit`` compressed bytes."""

    def __init__(self, root: str, limit: int):
        self.files, self.limit, self.out, self.done, self.shard = Files(root), limit, None, [], None

    def write(self, shard: int, data: bytes):
        if shard != self.shard:
            self.close()
            self.shard, self.seq = shard, 0
        elif self.out is not None and self.size + len(data) > self.limit:
            self.close()
        if self.out is None:
            self.temp, self.out = self.files.temp(f"{shard:06d}-{self.seq:04d}")
            self.size, self.records, self.sha = 0, 0, hashlib.sha1()
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)
        self.records += 1

    def close(self):
        if self.out is not None:
            self.out.close()
            name = f"part-{self.shard:06d}-{self.seq:04d}.warc.gz"
            self.done.append((self.shard, self.seq, self.temp, name, self.records, self.size, self.sha.hexdigest()))
            self.out, self.seq = None, self.seq + 1


def write_warc(pages: DataFrame, root: str, min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC files below ``root``, a uri
    that all executors reach; return the manifest.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest page_id is a response, the others are revisits without payload.
    Shards are id ranges of about ``shard_bytes`` payload bytes, cut from a
    histogram of fixed size, so the same rows give the same files. Each task
    sorts its shard (on disk if need be) and streams it to files under
    temporary names. Only files in the manifest, which Spark commits for one
    attempt of each task, are renamed; those of lost attempts stay under
    ``temp`` and are removed.

    Null html is an empty payload; a null page_id sorts first and is the last
    choice for a response. Line ends in a url are percent-encoded. Rows repeated in all columns: the first is the
    response. An empty table gives no files.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long"), F.col("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    small = rows.select("page_id", "sha1", "size", (F.col("size") + 512).alias("weight"))
    by_digest = F.conv(F.substring("sha1", 1, 8), 16, 10).cast("double") / (1 << 32)
    shard, n = id_shards(small, "page_id", "weight", shard_bytes, by_digest)

    rank = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"))
    groups = small.where(F.col("size") >= min_bytes).groupBy("sha1").agg(F.count("*").alias("held"), F.min(rank).alias("first")).where("held > 1")
    groups = store(groups.select("sha1", "held", F.struct(F.col("first.id").alias("id")).alias("first")), "warc-groups")
    marked = lookup(rows, groups, "sha1", "held", rows.count())
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.id"))
    marked = marked.select(
        "page_id", "url", "sha1", "size", F.col("first").isNotNull().alias("shared"), F.col("first.id").alias("first"), revisit.alias("revisit"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        shard.alias("shard"),
    )
    dealt = marked.repartitionByRange(n, "shard").sortWithinPartitions("shard", "page_id", "sha1", "url")

    def save(batches):
        out, last = _Roll(root, roll_bytes), None
        for batch in batches:
            for r in batch.to_pylist():
                digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                again = r["shared"] and last == (r["page_id"], r["sha1"])  # a repeated row
                last = (r["page_id"], r["sha1"])
                kind = "revisit" if r["revisit"] or again else "response"
                first = "null" if r["first"] is None else r["first"]
                out.write(r["shard"], _record(kind, r["page_id"], r["url"], digest, None if kind == "revisit" else r["payload"], r["size"], first))
        out.close()
        yield batch_of(out.done, MANIFEST)

    make_folders(spark, root)
    return publish(store(dealt.mapInArrow(save, MANIFEST), "warc-manifest"), root)


def read_warc(spark: SparkSession, root: str, payload: bool = True) -> DataFrame:
    """The records of the archives that the manifest below ``root`` names, see
    ``READ``; a file is streamed record by record. Digest and size of a
    response come from its content, those of a revisit from its headers. A
    damaged record raises ValueError. ``payload=False`` leaves the content null."""
    files = spark.read.schema(MANIFEST).parquet(f"{root}/manifest").select("name")

    def load(batches):
        folder = Files(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with folder.open(name) as raw:
                    for r in _records(raw):
                        rows.append(r if payload else (*r[:2], None, *r[3:]))
                        size += len(r[2] or b"") if payload else 0
                        if len(rows) >= 4096 or size >= 8 << 20:
                            yield batch_of(rows, READ)
                            rows, size = [], 0
                yield batch_of(rows, READ)

    return files.repartition(max(1, files.count())).mapInArrow(load, READ)


def _records(raw):
    """Parse the records of an archive stream."""
    text = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20)
    while line := text.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"not a record: {line[:40]!r}")
        head = {}
        while (line := text.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            head[k] = v
        block = text.read(int(head["Content-Length"]))
        if text.read(4) != b"\r\n\r\n" or base64.b32encode(hashlib.sha1(block).digest()).decode() != head["WARC-Block-Digest"][5:]:
            raise ValueError(f"damaged record {head.get('WARC-Record-ID')}")
        http, _, body = block.partition(b"\r\n\r\n")
        size = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"][5:]
        if kind == "response" and (len(body) != size or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
            raise ValueError(f"wrong payload in {head['WARC-Record-ID']}")
        refers = _page(head["WARC-Refers-To"]) if kind == "revisit" else None
        yield _page(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), body if kind == "response" else None, size, digest, kind, refers


def _page(urn: str):
    part = urn.split(":")[2]
    return None if part == "null" else int(part)


@register(
    "op6_warc",
    r"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x FROM p),
    b AS (
      SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(x, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT, 1)), '') AS digest,
        min(page_id) OVER (PARTITION BY x) AS first FROM d)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
      CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
    FROM b
    """,
)
def op6_warc(spark, sf_dir):
    root = file_uri(scratch_path(spark, "warc"))
    write_warc(table(spark, sf_dir, "pages"), root)
    return read_warc(spark, root, payload=False).drop("url", "payload")
