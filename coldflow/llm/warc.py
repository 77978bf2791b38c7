"""WARC archives, index first (4).

Writing: every task writes its rows as one ``.warc.gz`` file (a gzip member
per record, WARC/1.1) into the shared folder and returns one index row per
record: file, offset, length, url, digest and more.  File names hold a random
part, and only files that the committed index table names count, so a retried
or speculative task leaves at most an unused file behind.

Deduplication: of records with equal payloads of at least ``MIN_REVISIT``
bytes the smallest record id keeps the payload (``response``); the others are
``revisit`` records (identical-payload-digest profile) without payload.

Reading: selected index rows are sorted by file and offset and coalesced into
byte ranges (gaps of up to ``MAX_GAP`` bytes are read through, a range ends
at ``MAX_RANGE``); each range is one read, each record one gzip member in it.
Digests of payloads are checked against the header on reading.  Ranges are
dealt to tasks by their bytes, whatever files they lie in.

Files are reached through ``pyarrow.fs`` (file, hdfs, s3, gs URIs).  Defined
cases: a null payload is empty; a null url is written as an empty one; a null
id is written as an empty one and read back as null, such a record is always a response; rows
that repeat an id with another payload are records of their own; payload
bytes are kept as they are; an empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coldflow.llm.text import column_bytes
from coldflow.session import scratch_path, stage_table

MIN_REVISIT = 100
MAX_GAP = 64 << 10
MAX_RANGE = 8 << 20
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, record_id long, url string, payload_digest string, record_type string, refers_to long"


def record(record_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One uncompressed record; a revisit (``refers_to`` given) holds no payload."""
    body = payload if refers_to is None else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:record:{'' if record_id is None else record_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/octet-stream",
        f"Content-Length: {len(body)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:record:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, body) of an uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def _compress(raw: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)  # 31: a gzip member
    return c.compress(raw) + c.flush()


def _clean(url: str | None) -> str:
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def deduplicated(records: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(record_id, url, payload) with ``digest`` and ``refers_to``: the keeper's id for revisits, else null."""
    rows = records.select("record_id", "url", F.coalesce(F.col("payload"), F.lit(b"")).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    # only payloads that occur more than once are joined; partial aggregation takes hot ones apart before the shuffle
    copies = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.min("record_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("copy_digest"), "keeper")
    joined = rows.join(copies, rows["digest"] == copies["copy_digest"], "left")
    return joined.select("record_id", "url", "payload", "digest", F.when(F.col("keeper") != F.col("record_id"), F.col("keeper")).alias("refers_to"))


def write(records: DataFrame, path: str) -> DataFrame:
    """Write ``records`` (record_id long, url string, payload binary) under ``path``; returns the staged index."""

    def run(batches):
        files, root = fs.FileSystem.from_uri(path)
        files.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for b in batches:
            if out is None and b.num_rows:
                out = files.open_output_stream(f"{root}/{name}", compression=None)  # members are compressed one by one
            data, offsets = column_bytes(b.column("payload"))
            index = []
            for k, (rid, url, digest, refers) in enumerate(zip(*(b.column(c).to_pylist() for c in ("record_id", "url", "digest", "refers_to")), strict=True)):
                raw = _compress(record(rid, _clean(url), data[offsets[k] : offsets[k + 1]].tobytes(), digest, refers))
                out.write(raw)
                index.append((name, at, len(raw), rid, url, digest, "response" if refers is None else "revisit", refers))
                at += len(raw)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in index], schema=schema)
        if out is not None:
            out.close()

    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    path = as_uri(path)
    return stage_table(deduplicated(records).mapInArrow(run, INDEX), "warc-index")


def as_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def ranges(index: DataFrame, max_gap: int = MAX_GAP, max_range: int = MAX_RANGE) -> DataFrame:
    """(file, begin, end, members): selected records coalesced into byte ranges, members in file order.

    A range ends at a gap of more than ``max_gap`` bytes and where the running
    offset enters the next ``max_range`` bytes of the file.
    """
    w = Window.partitionBy("file").orderBy("offset")
    gap = F.coalesce(F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(w) > max_gap, F.lit(True))
    cell = F.floor(F.col("offset") / max_range)
    new = gap | F.coalesce(cell != F.lag(cell).over(w), F.lit(True))
    runs = index.withColumn("first", new).withColumn("run", F.sum(F.col("first").cast("long")).over(w))
    return runs.groupBy("file", "run").agg(F.min("offset").alias("begin"), F.max(F.col("offset") + F.col("length")).alias("end"), F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("members")).select("file", "begin", "end", "members")


def read(spark: SparkSession, path: str, index: DataFrame, keep_payload: bool = False) -> DataFrame:
    """The records behind selected ``index`` rows: headers, digest of the stored payload checked, payload if wanted."""
    path = as_uri(path)

    def run(batches):
        files, root = fs.FileSystem.from_uri(path)
        for b in batches:
            for r in b.to_pylist():
                with files.open_input_file(f"{root}/{r['file']}") as f:
                    raw = f.read_at(r["end"] - r["begin"], r["begin"])
                out = []
                for m in r["members"]:
                    a = m["offset"] - r["begin"]
                    head, body = parse_record(zlib.decompress(raw[a : a + m["length"]], 31))
                    digest = head["warc-payload-digest"].removeprefix("sha256:")
                    if head["warc-type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"{r['file']} at {m['offset']}: payload does not match its digest")
                    refers = head.get("warc-refers-to")
                    out.append({"record_id": _record_id(head["warc-record-id"]), "url": head["warc-target-uri"], "payload_bytes": int(head["x-payload-length"]), "payload_digest": digest, "record_type": head["warc-type"], "refers_to": _record_id(refers) if refers else None, "payload": body if keep_payload else None})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("record_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    found = stage_table(ranges(index), "warc-ranges")
    total = found.agg(F.sum(F.col("end") - F.col("begin"))).collect()[0][0] or 0
    # dealt round robin: a task reads about MAX_RANGE bytes of archives, whatever files they are in
    return found.repartition(max(1, -(-total // MAX_RANGE))).mapInArrow(run, "record_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def _record_id(urn: str) -> int | None:
    own = urn.removeprefix("<urn:record:").removesuffix(">")
    return int(own) if own else None


def new_archive(spark: SparkSession) -> str:
    """A fresh archive folder in the cluster's shared folder."""
    return scratch_path(spark, "warc")
