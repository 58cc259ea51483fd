"""WARC archives written by Spark's text sink and read back in splits of any size.

Writing: a record is a header, an HTTP head and the payload; the sink's separator is the
blank line pair that ends a WARC record, so archives go to any file system Spark writes.
Equal payloads are stored once, later ones become ``revisit`` records.

Reading (boundary-chain verification): a task sees one split and cannot know whether a line
that starts with ``WARC/1.`` begins a record or stands inside a payload. It emits every such
line with a readable header as a candidate and where the record after it would begin
(offset + header + Content-Length + 4). Chains inside a split are followed there; what
leaves the split points to a candidate of a later one. Pointer jumping from offset 0 of each
file, doubling the distance each round, keeps the candidates that are reached, and only the
records on their chains are real. Payloads inside a split are hashed as they are scanned;
those that cross splits, or that lay inside a false record, are cut out of the splits and
put together.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from basketlens.shipping import map_batches, ship
from basketlens.staging import new_path, stage

END = "\r\n\r\n"
MAGIC = b"WARC/1."
#: What goes on for more lines or bytes than this is not a record header.
HEADER_LINES = 1000
HEADER_BYTES = 1 << 20
#: Bytes of a split that travel in one row when records are put together.
CHUNK = 1 << 20
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ROWS = (
    "kind string, file long, block long, rel long, bytes long, head binary, done boolean, body long, length long, next long, "
    "out long, type string, record_id string, target_uri string, refers_to_id string, stated_digest string, "
    "payload_bytes long, payload_digest string, payload binary"
)
_SCHEMA = pa.schema(
    [
        ("kind", pa.string()), ("file", pa.int64()), ("block", pa.int64()), ("rel", pa.int64()), ("bytes", pa.int64()),
        ("head", pa.binary()), ("done", pa.bool_()), ("body", pa.int64()), ("length", pa.int64()), ("next", pa.int64()),
        ("out", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
        ("refers_to_id", pa.string()), ("stated_digest", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("payload", pa.binary()),
    ]
)
FIELDS = ("type", "record_id", "target_uri", "refers_to_id", "stated_digest")


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of ``data`` in upper-case base32, from built-in functions."""
    digits = F.sha1(data)
    groups = [F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int") for i in range(8)]
    letters = [
        F.substr(F.lit(BASE32), F.shiftright(g, shift).bitwiseAND(31) + 1, F.lit(1)) for g in groups for shift in (15, 10, 5, 0)
    ]
    return F.concat(*letters)


def record_uri(identifier: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(identifier.cast("string"), F.lit("")), F.lit(">"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    records_per_file: int = 50_000,
) -> None:
    """Write one record per row of ``pages`` under ``path``; null html is an empty payload.

    Of rows with equal payloads of at least ``least_bytes`` the smallest id is a response
    (as are rows that repeat it), the others revisit it. Rows without an id revisit one that
    has it; if none has, all are responses. Line ends in urls are percent-encoded. The payload
    is shuffled only if repeated payloads are too many to be broadcast by Spark.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("same", F.sha2("html", 256)).withColumn("size", F.octet_length("html").cast("long"))
    firsts = stage(
        rows.where(F.col("size") >= least_bytes)
        .groupBy("same")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("same", "first"),
        "warc-firsts",
    )
    rows = rows.join(firsts, "same", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    line = "\r\n"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "), F.col("size"), F.lit(END)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{line}WARC-Record-ID: "),
        record_uri(F.col("id")),
        F.lit(f"{line}WARC-Date: {date}{line}WARC-Target-URI: "),
        uri,
        F.lit(f"{line}WARC-Payload-Digest: sha1:"),
        base32_sha1(F.col("html")),
        F.when(
            revisit,
            F.concat(
                F.lit(f"{line}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{line}WARC-Refers-To: "),
                record_uri(F.col("first")),
            ),
        ).otherwise(F.lit("")),
        F.lit(f"{line}Content-Type: application/http; msgtype=response{line}Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
    )
    (
        rows.select(F.concat(header, block).alias("value"))
        .write.option("lineSep", END)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def _fields(lines: list[bytes]) -> dict | None:
    """The fields of a header, or None where no length can be read."""
    found: dict[str, bytes] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if colon:
            found.setdefault(name.strip().lower().decode("latin-1"), value.strip())
    length = found.get("content-length", b"")
    if not length.isdigit() or len(length) > 18:
        return None
    text = lambda key: found[key].decode("utf-8", "replace") if key in found else None
    digest = text("warc-payload-digest")
    return {
        "length": int(length),
        "type": text("warc-type"),
        "record_id": text("warc-record-id"),
        "target_uri": text("warc-target-uri"),
        "refers_to_id": text("warc-refers-to"),
        "stated_digest": digest.rpartition(":")[2] if digest else None,
    }


class Body:
    """The payload of a record block, hashed as its bytes arrive."""

    def __init__(self, keep: bool) -> None:
        self.keep, self.head, self.sha1, self.size, self.kept, self.http = keep, b"", hashlib.sha1(), 0, [], None

    def feed(self, data: bytes) -> None:
        if self.http is None:
            self.head += data
            at = self.head.find(b"\r\n\r\n")
            if at < 0:
                return
            self.http, data, self.head = self.head[:at], self.head[at + 4 :], b""
        self.sha1.update(data)
        self.size += len(data)
        if self.keep:
            self.kept.append(data)

    def result(self, kind: str | None) -> dict:
        """Size and digest of the payload; of a revisit what its HTTP head says."""
        if self.http is None:  # no HTTP head: the block is the payload
            self.http, head, self.head = b"", self.head, b""
            self.sha1.update(head)
            self.size += len(head)
            self.kept.append(head)
        if kind == "revisit":
            said = _fields(self.http.replace(b"\r\n", b"\n").split(b"\n"))
            return {"payload_bytes": said["length"] if said else None}
        return {
            "payload_bytes": self.size,
            "payload_digest": base64.b32encode(self.sha1.digest()).decode(),
            "payload": b"".join(self.kept) if self.keep else None,
        }


class Split:
    """Candidates of one split; offsets count from its first line."""

    def __init__(self, file: int, block: int, keep: bool) -> None:
        self.file, self.block, self.keep = file, block, keep
        self.base, self.lines, self.total = 0, [], 0
        self.found: list[dict] = []
        self.body: Body | None = None
        self.owner: dict | None = None
        self.fed = 0
        self.head: list[bytes] = []
        self.head_size, self.head_done, self.head_over = 0, False, False

    def feed(self, lines: list[bytes]) -> None:
        for line in lines:
            if self.head_over:
                break
            self.head.append(line + b"\n")
            self.head_size += len(line) + 1
            self.head_done = line == b"\r"
            self.head_over = self.head_done or len(self.head) > HEADER_LINES or self.head_size > HEADER_BYTES
        lines = self.lines + lines
        ends = self.base + np.cumsum([len(x) + 1 for x in lines])
        starts = np.concatenate([[self.base], ends[:-1]])
        self.total = int(ends[-1])
        stop, at = len(lines), 0
        while at < len(lines):
            if not lines[at].startswith(MAGIC):
                at += 1
                continue
            blank = next((k for k in range(at + 1, min(len(lines), at + 1 + HEADER_LINES)) if lines[k] == b"\r"), None)
            if blank is None:
                if at + 1 + HEADER_LINES > len(lines) and ends[-1] - starts[at] <= HEADER_BYTES:
                    stop = at  # the header may go on in the next lines
                    break
                at += 1
                continue
            fields = _fields(lines[at + 1 : blank])
            if fields is not None:
                start, body = int(starts[at]), int(ends[blank])
                record = fields | {"rel": start, "body": body, "next": body + fields["length"] + 4}
                self.found.append(record)
                if self.owner is None or start >= self.owner["next"]:
                    self._close()
                    self.owner, self.body, self.fed = record, Body(self.keep), body
                    self._take(lines, starts, ends)
            at += 1
        self._take(lines, starts, ends)
        self.base = int(starts[stop]) if stop < len(lines) else self.total
        self.lines = lines[stop:]

    def _take(self, lines: list[bytes], starts: np.ndarray, ends: np.ndarray) -> None:
        """Give the open record its bytes among these lines."""
        if self.owner is None:
            return
        until = self.owner["body"] + self.owner["length"]
        if self.fed >= until or self.fed >= ends[-1]:
            return
        a, b = int(np.searchsorted(ends, self.fed, side="right")), int(np.searchsorted(starts, until, side="left"))
        data = b"\n".join(lines[a:b]) + b"\n"
        piece = data[self.fed - int(starts[a]) : until - int(starts[a])]
        self.body.feed(piece)
        self.fed += len(piece)

    def _close(self) -> None:
        if self.owner is not None and self.fed >= self.owner["body"] + self.owner["length"]:
            self.owner |= self.body.result(self.owner["type"])
        self.owner = self.body = None

    def rows(self) -> list[dict]:
        self._close()
        same = {"file": self.file, "block": self.block}
        begun = []
        if self.lines:
            begun = [{"kind": "open", "rel": self.base, "head": b"".join(x + b"\n" for x in self.lines)}]
        inside = {r["rel"]: r for r in self.found}
        for record in reversed(self.found):
            onward = record["next"]
            if onward in inside:
                record["out"] = inside[onward]["out"]
            elif begun and onward == self.base or onward >= self.total:
                record["out"] = onward
            else:
                record["out"] = None
        split = {"kind": "split", "bytes": self.total, "head": b"".join(self.head) if self.head_done else None, "done": self.head_done}
        return [same | r for r in [split, *begun, *({"kind": "record"} | r for r in self.found)]]


def _segments(batches):
    """(file, block, lines) in order, cut where the split changes and at CHUNK bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        files, blocks = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        sizes = np.cumsum(np.diff(np.frombuffer(batch.column(0).buffers()[1], np.int32, batch.num_rows + 1, batch.column(0).offset * 4)))
        change = (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1]) | (sizes[1:] // CHUNK != sizes[:-1] // CHUNK)
        edges = np.concatenate([[0], np.flatnonzero(change) + 1, [batch.num_rows]])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield int(files[a]), int(blocks[a]), batch.column(0).slice(a, b - a).to_pylist()


def _scan(keep: bool):
    def emit(split: Split):
        rows = split.rows()
        for a in range(0, len(rows), 2000):
            yield pa.RecordBatch.from_pylist(rows[a : a + 2000], schema=_SCHEMA)

    def run(batches):
        split = None
        for file, block, lines in _segments(batches):
            if split is None or (split.file, split.block) != (file, block):
                if split is not None:
                    yield from emit(split)
                split = Split(file, block, keep)
            split.feed(lines)
        if split is not None:
            yield from emit(split)

    return run


def _chunks(batches):
    """(file, block, rel, bytes): a split's bytes in rows of about CHUNK bytes."""
    at, key = 0, None
    for file, block, lines in _segments(batches):
        if key != (file, block):
            at, key = 0, (file, block)
        data = b"".join(x + b"\n" for x in lines)
        yield pa.RecordBatch.from_arrays(
            [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([at], pa.int64()), pa.array([data], pa.binary())],
            names=["file", "block", "rel", "data"],
        )
        at += len(data)


def _headers(batches):
    """Read headers that go on from one split into the next."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            fields = _fields(row["head"].split(b"\n")[1:])
            size = len(row["head"])
            if fields is not None:
                body = row["start"] + size
                out.append(fields | {k: row[k] for k in ("file", "block", "start")} | {"body": body, "out": body + fields["length"] + 4})
        yield pa.RecordBatch.from_pylist(out, schema=_OPENED)


OPENED = (
    "file long, block long, start long, body long, length long, out long, type string, record_id string, target_uri string, "
    "refers_to_id string, stated_digest string"
)
_OPENED = pa.schema(
    [(n, pa.int64()) for n in ("file", "block", "start", "body", "length", "out")] + [(n, pa.string()) for n in FIELDS]
)


def _follow(candidates: pa.Table, entries: pa.Table) -> pa.Table:
    """The candidates of a split that lie on the chain of an entry."""
    begins = candidates.column("start").to_pylist()
    onward = dict(zip(begins, candidates.column("following").to_pylist(), strict=True))
    real = set()
    for at in entries.column("start").to_pylist():
        while at in onward and at not in real:
            real.add(at)
            at = onward[at]
    return candidates.filter(pa.array([b in real for b in begins], pa.bool_()))


def _assembled(keep: bool):
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                body = Body(keep)
                for part in row["parts"]:
                    body.feed(part["data"])
                out.append({"file": row["file"], "start": row["start"]} | {"payload_digest": None, "payload": None} | body.result(row["type"]))
            yield pa.RecordBatch.from_pylist(
                out,
                schema=pa.schema(
                    [("file", pa.int64()), ("start", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
                ),
            )

    return run


def reachable(nodes: DataFrame) -> DataFrame:
    """(file, start) reached from start 0 of each file over ``out``, by pointer jumping.

    ``nodes`` has file, start, out. Every round doubles the distance, so rounds grow with the
    logarithm of the number of nodes in a file.
    """
    jumps = stage(nodes.select("file", "start", "out"), "warc-jumps")
    places = jumps.select("file", "start")
    known = stage(jumps.where("start = 0").select("file", "start").distinct(), "warc-known")
    n = known.count()
    while True:
        step = known.join(jumps, ["file", "start"]).select("file", F.col("out").alias("start"))
        step = step.join(places, ["file", "start"], "left_semi")
        known = stage(known.union(step).distinct(), "warc-known")
        total = known.count()
        if total == n:
            return known
        n = total
        further = jumps.select("file", F.col("start").alias("out"), F.col("out").alias("beyond"))
        jumps = stage(jumps.join(further, ["file", "out"]).select("file", "start", F.col("beyond").alias("out")), "warc-jumps")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(file, start, type, record_id, target_uri, refers_to_id, stated_digest, payload_bytes,
    payload_digest, payload) of every record reached from the start of its file.

    ``file`` is a hash of the file's path, ``start`` the record's offset. Digest and payload
    (the latter only with ``payloads``) are those of the bytes read; a revisit has the size
    its HTTP head states and no digest of its own. A file that does not begin with a record
    gives none, what follows a broken length is not reached. No archives: an empty result.
    """
    ship(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    scanned = stage(map_batches(lines, _scan(payloads), ROWS), "warc-scan")

    by_file = Window.partitionBy("file").orderBy("block")
    splits = stage(
        scanned.where("kind = 'split'").select(
            "file",
            "block",
            "bytes",
            F.coalesce(F.sum("bytes").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("base"),
            F.lead("head").over(by_file).alias("following_head"),
            F.lead("done").over(by_file).alias("following_done"),
        ),
        "warc-splits",
    )
    bases = splits.select("file", "block", "base", "bytes")
    opened = scanned.where("kind = 'open'").select("file", "block", "rel", "head").join(splits, ["file", "block"])
    opened = opened.where("following_done").select(
        "file", "block", (F.col("rel") + F.col("base")).alias("start"), F.concat("head", "following_head").alias("head")
    )
    opened = stage(map_batches(opened, _headers, OPENED), "warc-opened")
    records = scanned.where("kind = 'record'").join(bases, ["file", "block"])
    records = records.select(
        "file",
        "block",
        (F.col("rel") + F.col("base")).alias("start"),
        (F.col("body") + F.col("base")).alias("body"),
        "length",
        (F.col("next") + F.col("base")).alias("following"),
        (F.col("out") + F.col("base")).alias("out"),
        *FIELDS,
        "payload_bytes",
        "payload_digest",
        "payload",
    )
    missing = [F.lit(None).cast(t).alias(n) for n, t in (("payload_bytes", "long"), ("payload_digest", "string"), ("payload", "binary"))]
    records = records.unionByName(
        opened.select("file", "block", "start", "body", "length", F.col("out").alias("following"), "out", *FIELDS, *missing)
    )
    # Only candidates that some chain leaves a split for can be entered from outside.
    chains = records.select("file", "block", "start", "following", "out")
    targets = chains.select("file", F.col("out").alias("start")).union(
        splits.select("file", F.lit(0).cast("long").alias("start"))
    )
    entries = reachable(chains.join(targets.distinct(), ["file", "start"], "left_semi"))
    entries = stage(chains.select("file", "block", "start").join(entries, ["file", "start"]), "warc-entries")
    real = (
        chains.select("file", "block", "start", "following")
        .groupBy("file", "block")
        .cogroup(entries.select("file", "block", "start").groupBy("file", "block"))
        .applyInArrow(_follow, "file long, block long, start long, following long")
    )
    found = stage(records.join(real.select("file", "start"), ["file", "start"], "left_semi"), "warc-records")

    cut = found.where("payload_bytes is null").select("file", "start", "body", "length", "type")
    parts = cut.join(bases.withColumnsRenamed({"block": "of", "bytes": "split_bytes"}), "file").where(
        "body < base + split_bytes and body + length > base"
    )
    # Written first, so that Spark knows its size before it decides how to join the archives' bytes.
    parts = stage(parts, "warc-parts")
    chunks = map_batches(lines, _chunks, "file long, block long, rel long, data binary")
    pieces = chunks.withColumnRenamed("block", "of").join(parts, ["file", "of"])
    pieces = pieces.withColumn("at", F.col("base") + F.col("rel")).withColumn("size", F.octet_length("data"))
    pieces = pieces.where("at < body + length and at + size > body")
    begin = F.greatest(F.col("body") - F.col("at"), F.lit(0).cast("long"))
    end = F.least(F.col("body") + F.col("length") - F.col("at"), F.col("size").cast("long"))
    sliced = pieces.select(
        "file",
        "start",
        "type",
        F.struct("at", F.substr("data", (begin + 1).cast("int"), (end - begin).cast("int")).alias("data")).alias("part"),
    )
    whole = (
        cut.select("file", "start", "type")
        .join(sliced.groupBy("file", "start").agg(F.array_sort(F.collect_list("part")).alias("parts")), ["file", "start"], "left")
        .withColumn("parts", F.coalesce("parts", F.expr("cast(array() as array<struct<at: bigint, data: binary>>)")))
    )
    whole = map_batches(whole, _assembled(payloads), "file long, start long, payload_bytes long, payload_digest string, payload binary")
    shown = ["file", "start", *FIELDS]
    late = found.select(*shown).join(whole, ["file", "start"])
    return (
        found.where("payload_bytes is not null")
        .select(*shown, "payload_bytes", "payload_digest", "payload")
        .unionByName(late.select(*shown, "payload_bytes", "payload_digest", "payload"))
    )


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to, intact) from archives of ``pages`` read back."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, html_col)
    found = read_archives(spark, path)
    number = lambda uri: F.regexp_extract(uri, "^<urn:page:(-?[0-9]+)>$", 1)
    as_id = lambda uri: F.when(number(uri) != "", number(uri).cast("long"))
    return found.select(
        as_id("record_id").alias("id"),
        "payload_bytes",
        F.coalesce("payload_digest", "stated_digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        as_id("refers_to_id").alias("refers_to"),
        (F.coalesce("payload_digest", "stated_digest") == F.col("stated_digest")).alias("intact"),
    )
