"""Web archives: a deterministic sharded writer and a reader of what it wrote.

1. Payloads are measured and hashed in one scan; equal payloads of at least
   ``REVISIT_BYTES`` have one response, that of the smallest id, and the others
   revisit it.
2. Records are range-sorted by id and digest. A distributed prefix sum of payload
   sizes puts every ``range_bytes`` into one range, so ranges depend on the rows alone and
   not on how Spark dealt them; an id that many different pages share has many ranges.
3. One task writes one range: records one by one, each a gzip member of its
   own, with headers and digests made anew; a file is closed when it has
   ``roll_bytes``, compressed. A file gets its name only when it is whole: it is
   written under a temporary name and then renamed, and a task that runs again
   writes the same bytes to the same name.
4. The manifest, one row per file with size and digest, is written by Spark's
   own commit. Readers take the files that the manifest lists, check them, and fail if
   one is missing. Records are read one after the other, in time linear in the file.

Page contents are shuffled once, each range to a task of its own. To the tasks goes one
key for each range. Files are written with ``pyarrow.fs``, which serves local and shared
folders and object stores by their address.

Defined results: a null page is an empty payload; a null url gives a record
without target; white space and control characters in a url are percent-encoded.
A null id sorts last. Rows that repeat the smallest id with an equal payload
are all responses; rows equal in id and payload are in one range. An empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeframe.llm.rows import map_batches, running_sums, saved, small, text_of

REVISIT_BYTES = 100
RANGE_BYTES, ROLL_BYTES = 32 << 20, 16 << 20
LEVEL = 4
PIECE = 16 << 10  # compressed bytes looked at together
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = (
    "file string, range bigint, n_records bigint, n_bytes bigint, sha256 string, "
    "first_id bigint, last_id bigint"
)
RECORD = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, payload binary"
)


def _name(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{digest}>"


def _page_of(name: str) -> int | None:
    part = name.split(":")[2]
    return None if part == "none" else int(part)


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _encoded(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
    revisit: bool, date: str = DATE,
) -> bytes:
    """One record, not compressed. The block of a revisit has the HTTP header alone."""
    block = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _name(page_id, digest)),
        ("WARC-Date", date),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _encoded(url)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to, digest))]
    else:
        block += payload
    fields += [
        ("WARC-Block-Digest", f"sha256:{_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class _Shard:
    """One file in the making."""

    def __init__(self, folder: str, range_: int, number: int):
        self.store, base = fs.FileSystem.from_uri(folder)
        self.file, self.range = f"{range_:08d}-{number:05d}.warc.gz", range_
        self.at, self.temporary = f"{base}/data/{self.file}", f"{base}/tmp/{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.temporary)
        self.sum, self.size, self.ids = hashlib.sha256(), 0, []
        self.records = 0

    def add(self, page_id: int | None, data: bytes) -> None:
        press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        data = press.compress(data) + press.flush()
        self.out.write(data)
        self.sum.update(data)
        self.size += len(data)
        self.records += 1
        self.ids = [self.ids[0] if self.ids else page_id, page_id]

    def commit(self) -> tuple:
        self.out.close()
        self.store.move(self.temporary, self.at)
        return (self.file, self.range, self.records, self.size, self.sum.hexdigest(), *self.ids)


def _written(folder: str, roll_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, mark = None, 0, None
        done: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                range_, page_id, digest, _, url, page, refers_to = (c[i].as_py() for c in batch.columns)
                if page is None:  # says that the rows of this id and payload are revisits
                    mark = (page_id, digest, refers_to)
                    continue
                if shard and (shard.range != range_ or shard.size >= roll_bytes):
                    number = number + 1 if shard.range == range_ else 0
                    done.append(shard.commit())
                    shard = None
                elif not shard:
                    number = 0
                shard = shard or _Shard(folder, range_, number)
                revisit = mark is not None and mark[:2] == (page_id, digest)
                shard.add(page_id, record(
                    page_id, url, page.encode(), digest, mark[2] if revisit else None, revisit, date
                ))
        if shard:
            done.append(shard.commit())
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = [part.split()[0] for part in MANIFEST.split(", ")]
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), kinds)], names
            )

    return run


def _place(id: str, digest: str) -> Column:
    """Text that sorts as (id, start of the digest), null ids last."""
    sortable = F.lpad(F.hex(F.col(id).bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.concat(F.coalesce(F.concat(F.lit("0"), sortable), F.lit("1")), F.substring(digest, 1, 16))


def write_archives(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", page: str = "html",
    range_bytes: int = RANGE_BYTES, roll_bytes: int = ROLL_BYTES, date: str = DATE,
) -> DataFrame:
    """Write a record per row under ``folder``; returns the manifest, read from there."""
    spark = pages.sparkSession
    body = text_of(page)
    records = pages.select(
        F.col(id).cast("bigint").alias("page_id"), F.sha2(body, 256).alias("digest"),
        F.col(url).cast("string").alias("url"), body.alias("html"),
    )
    measured = saved(
        records.select("page_id", "digest", F.octet_length("html").cast("bigint").alias("n_bytes")),
        "warc-measured",
    )
    firsts = (
        measured.filter(F.col("n_bytes") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").drop("n")
    )
    revisits = (
        measured.select("page_id", "digest").distinct().join(firsts, "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    )
    place = _place("page_id", "digest")
    placed = running_sums(
        measured.withColumn("place", place), [F.col("place")], {"before": "n_bytes"}, "warc-order"
    )
    # One key per range: a row for each ``range_bytes`` of pages.
    starts = (
        placed.groupBy(F.floor(F.col("before") / range_bytes).alias("range"))
        .agg(F.min("place").alias("first")).toArrow()
    )
    starts = spark.sparkContext.broadcast(np.unique(starts["first"].to_numpy().astype("S")))

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = starts.value
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype("S")
            number = np.maximum(np.searchsorted(limits, keys, "right") - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), *batch.columns], ["range", *batch.schema.names]
            )

    rows = records.select(
        "page_id", "digest", F.lit(1).alias("kind"), "url", "html",
        F.lit(None).cast("bigint").alias("refers_to"),
    ).unionByName(revisits.select(
        "page_id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("html"), "refers_to",
    ))
    kinds = (
        "range bigint, place string, page_id bigint, digest string, kind int, url string, "
        "html string, refers_to bigint"
    )
    store, base = fs.FileSystem.from_uri(folder)
    for part in ("data", "tmp"):
        store.create_dir(f"{base}/{part}", recursive=True)
    ranges = max(1, len(starts.value))
    sorted_rows = (
        map_batches(rows.select(place.alias("place"), "*"), ranged, kinds)
        .repartitionById(ranges, F.col("range").cast("int"))
        .sortWithinPartitions("range", "place", "digest", "kind", "url").drop("place")
    )
    written = map_batches(sorted_rows, _written(folder, roll_bytes, date), MANIFEST)
    written.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _members(data: bytes) -> Iterator[bytes]:
    """Contents of gzip members that follow one another."""
    view, at = memoryview(data), 0
    while at < len(view):
        press, parts = zlib.decompressobj(31), []
        while not press.eof:
            piece = view[at : at + PIECE]
            if not piece:
                raise ValueError("a record is cut off")
            parts.append(press.decompress(piece))
            at += len(piece)
        at -= len(press.unused_data)
        yield b"".join(parts)


def parse_records(data: bytes) -> Iterator[tuple]:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of a file.

    The digest of a response is taken from its payload; one that its header
    does not confirm is an error.
    """
    for text in _members(data):
        head, _, rest = text.partition(b"\r\n\r\n")
        fields = dict(
            line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line
        )
        block = rest[: int(fields["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"(?im)^Content-Length: (\d+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = fields["WARC-Type"]
        if kind == "response" and (len(payload) != size or _digest(payload) != digest):
            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
        if f"sha256:{_digest(block)}" != fields["WARC-Block-Digest"]:
            raise ValueError(f"damaged block of {fields['WARC-Record-ID']}")
        yield (
            _page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, digest, kind,
            _page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None,
            payload if kind == "response" else None,
        )


def _read(keep_payload: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [part.split()[0] for part in RECORD.split(", ")]
    for batch in batches:
        for content, expected in zip(batch.column(0), batch.column(1)):
            content = content.as_py()
            if _digest(content) != expected.as_py():
                raise ValueError("a file is not what the manifest says")
            rows = [r if keep_payload else (*r[:-1], None) for r in parse_records(content)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names
            )


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row per record of the files that the manifest under ``folder`` lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _read(payloads, batches)

    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    if listed.isEmpty():
        return spark.createDataFrame([], RECORD)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(f"{folder}/data")
    names = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    # Names first, without contents: a file that is not there is an error.
    missing = small(listed.select("file")).join(names.select("file"), "file", "left_anti").first()
    if missing:
        raise FileNotFoundError(f"{folder}/data/{missing.file} is missing")
    checked = names.join(small(listed.select("file", "sha256")), "file").select("content", "sha256")
    return map_batches(checked, run, RECORD)
