"""Web archives: writing WARC records, and finding them again by verified chains of boundaries.

The bytes that begin a record may also stand inside a payload, so each place they are found at is only a
candidate. A candidate's own headers say where its successor must begin. Every task takes a block of a file,
lists its candidates and follows their chains to the first successor beyond the block; pointer
jumping over these exits, which doubles the distance each round, gives the entries that the start of
the file leads to. What their chains reach are records; everything else is payload.

Spark's text files carry the bytes: a record ends with the separator the writer puts after each row, and
the reader splits at the candidates. So commits, retries, splits and remote stores are Spark's.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellrecon.session import written

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: So many repeated payloads (some 100 bytes each) are sent to every task at most.
BROADCAST_FIRSTS = 200_000

FIELDS = (
    "page_id bigint, record_type string, refers_to bigint, target_uri string, "
    "payload_bytes bigint, payload_digest string"
)
_CANDIDATES = (
    "file string, block bigint, piece bigint, local bigint, size bigint, successor bigint, exit bigint, "
    "whole boolean, declared string, " + FIELDS
)


def sha1_base32(text: Column) -> Column:
    """Twenty bits of the digest are five hexadecimal digits and four of base 32."""
    hexed = F.sha1(text)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(
    pages: DataFrame, path: str, min_revisit_bytes: int = 0, files: int | None = None, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """A record for each row of ``pages`` (``page_id``, ``url``, ``html``), the html as payload.

    Of rows with equal payloads of at least ``min_revisit_bytes``, the one with the smallest ``page_id`` is a
    response and the others revisit it; where that id is repeated, each of its rows is a response. A null html is an
    empty payload. A row without an id is never referred to; where no row of a payload has one, all are
    responses. White space and control characters in a url become ``%20``, a null url leaves the header out.
    """
    spark = pages.sparkSession
    rows = pages.select(
        pages["page_id"].cast("bigint").alias("page_id"),
        pages["url"].alias("url"),
        F.coalesce(pages["html"], F.lit("")).alias("payload"),
    ).withColumn("digest", sha1_base32(F.col("payload").cast("binary")))
    long_enough = F.octet_length("payload") >= min_revisit_bytes
    # Payloads that come once need no partner, so only repeated ones are joined; a hot one is split there.
    firsts = (
        rows.filter(long_enough)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first is not null")
        .select("digest", "first")
    )
    firsts = written(firsts, "warc-firsts")
    # Few enough to send to every task, the pages stay where they are; else both sides are shuffled.
    if firsts.count() <= BROADCAST_FIRSTS:
        firsts = F.broadcast(firsts)
    judged = rows.join(firsts, "digest", "left").withColumn(
        "first", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    )
    judged = judged.repartition(files) if files else judged
    judged.select(_record(date).alias("value")).write.option("lineSep", END).text(path)


def _record(date: str) -> Column:
    def header(name: str, value: Column | str) -> Column:
        value = value if isinstance(value, Column) else F.lit(value)
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("first").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return F.concat(
        F.lit(MAGIC),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", urn(F.col("page_id"))),
        header("WARC-Date", date),
        header("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        header("WARC-Refers-To", F.when(revisit, urn(F.col("first")))),
        header("Content-Type", "application/http;msgtype=response"),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def _headers(text: str) -> dict[str, str]:
    lines = (line.partition(":") for line in text.split("\r\n"))
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def _number(value: str | None) -> int | None:
    return int(value) if value is not None and re.fullmatch(r"[0-9]{1,18}", value) else None


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", urn or "")
    return int(found[1]) if found else None


def _described(head: str, block: bytes) -> dict:
    """The fields of a record with these headers and this block."""
    headers = _headers(head)
    payload = block.partition(END.encode())[2]
    return {
        "page_id": _page(headers.get("warc-record-id")),
        "record_type": headers.get("warc-type"),
        "refers_to": _page(headers.get("warc-refers-to")),
        "target_uri": headers.get("warc-target-uri"),
        "payload_bytes": len(payload),
        "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
    }


def _candidate(text: str, size: int) -> dict:
    """What the text after a magic says: its successor's distance, and the record if the text holds all of it."""
    head, found, body = text.partition(END)
    length = _number(_headers(head).get("content-length")) if found else None
    if length is None:
        return {"successor": None, "whole": False, "declared": None} | dict.fromkeys(_FIELD_NAMES)
    successor = len(MAGIC) + len(head.encode()) + len(END) + length + len(END)
    declared = _headers(head).get("warc-payload-digest")
    whole = successor == size
    block = body.encode()[:length] if whole else b""
    return {"successor": successor, "whole": whole, "declared": declared} | _described(head, block)


_FIELD_NAMES = [f.split()[0] for f in FIELDS.split(", ")]
_CANDIDATE_NAMES = [f.split()[0] for f in _CANDIDATES.split(", ")]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Files cut at every magic; the first piece of a file, before its first magic, is empty."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, str]]:
    """(file, block, number within the block, text), in the order of the files."""
    at, n = None, 0
    for batch in batches:
        for key_file, block, text in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")), strict=True):
            n = n + 1 if at == (key_file, block) else 0
            at = (key_file, block)
            yield key_file, block, n, text


def _find_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of each block with places relative to the block's first piece, and their chains' exits.

    A piece begins where its magic does, so the pieces of all blocks of a file add up to the file.
    """
    at, rows, local = None, [], 0

    def ended() -> Iterator[pa.RecordBatch]:
        exits: dict[int, int | None] = {}
        for r in reversed(rows):
            to = None if r["successor"] is None else r["local"] + r["successor"]
            # A successor inside the block must itself be a candidate, or the chain is broken.
            r["exit"] = exits[r["local"]] = to if to is None or to >= local else exits.get(to)
        for start in range(0, len(rows), 4096):
            part = rows[start : start + 4096]
            columns = [pa.array([r[c] for r in part], t) for c, t in zip(_CANDIDATE_NAMES, _ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, _CANDIDATE_NAMES)

    for file, block, n, text in _numbered(batches):
        if at != (file, block):
            yield from ended()
            at, rows, local = (file, block), [], 0
        first = block == 0 and n == 0  # before the first magic of the file
        size = len(text.encode()) + (0 if first else len(MAGIC))
        row = {"successor": None, "whole": False, "declared": None} | dict.fromkeys(_FIELD_NAMES)
        if not first:
            row = _candidate(text, size)
        if not first or size:
            rows.append(row | {"file": file, "block": block, "piece": n, "local": local, "size": size})
        local += size
    yield from ended()


_TYPES = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
_ARROW = [_TYPES[f.split()[1]] for f in _CANDIDATES.split(", ")]


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """All candidates with absolute places ``start``, ``next`` and ``exit``."""
    local = written(_pieces(spark, path).mapInArrow(_find_candidates, _CANDIDATES), "warc-candidates")
    sizes = local.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))
    placed = local.join(bases, ["file", "block"])
    start = F.col("base") + F.col("local")
    return placed.select(
        "*",
        start.alias("start"),
        (start + F.col("successor")).alias("next"),
    ).withColumn("exit", F.col("base") + F.col("exit"))


def entries(found: DataFrame) -> DataFrame:
    """``file, start`` of the candidates at which chains from the start of a file enter its blocks."""
    spark = found.sparkSession
    reached = found.select("file").distinct().select("file", F.lit(0).cast("bigint").alias("start"))
    most = found.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] or 0
    if most < 2:
        return reached
    doors = found.select("file", F.col("exit").alias("start")).union(reached).distinct()
    jumps = written(found.join(doors, ["file", "start"], "left_semi").select("file", "start", "exit"), "warc-jumps")
    for _ in range(math.ceil(math.log2(most)) + 1):
        ahead = reached.join(jumps, ["file", "start"]).select("file", F.col("exit").alias("start"))
        reached = written(reached.union(ahead).filter("start is not null").distinct(), "warc-reached")
        onward = jumps.select("file", F.col("start").alias("exit"), F.col("exit").alias("beyond"))
        jumps = written(
            jumps.join(onward, ["file", "exit"]).select("file", "start", F.col("beyond").alias("exit")), "warc-jumps"
        )
    return reached


def verified(found: DataFrame) -> DataFrame:
    """``found`` with ``owner``: the start of the record a piece belongs to, its own for a record."""
    marked = found.join(entries(found).withColumn("entered", F.lit(True)), ["file", "start"], "left")

    def follow(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("start")
        chain, owners = set(block.loc[block["entered"].notna(), "start"]), []
        owner = None
        for start, following in zip(block["start"], block["next"], strict=True):
            if start in chain:
                owner = start
                if following == following and following is not None:
                    chain.add(int(following))
            owners.append(owner)
        return pd.DataFrame(
            {
                "file": block["file"],
                "start": block["start"],
                "block": block["block"],
                "piece": block["piece"],
                "owner": pd.array(owners, "Int64"),
            }
        )

    owners = marked.select("file", "start", "block", "piece", "next", "entered").groupBy("file", "block").applyInPandas(
        follow, "file string, start bigint, block bigint, piece bigint, owner bigint"
    )
    owners = written(owners, "warc-owners")
    # A record that began in an earlier block also owns the first pieces of a later one.
    last = owners.groupBy("file", "block").agg(F.max("owner").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = last.select("file", "block", F.max("last").over(earlier).alias("before"))
    return owners.join(before, ["file", "block"]).select(
        "file", "start", "block", "piece", F.coalesce("owner", "before").alias("owner")
    )


def _assembled(spark: SparkSession, path: str, wanted: DataFrame, schema: str, make) -> DataFrame:
    """Records put together from ``wanted`` pieces (``file, block, piece, owner``), a row of ``schema`` for each."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in _numbered(batches):
            rows.append(row)
            if len(rows) == 512:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def _batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["file", "block", "piece", "text"])

    def join(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["block", "piece"])
        return pd.DataFrame([make(MAGIC.join(pieces["text"]))])

    texts = _pieces(spark, path).mapInArrow(number, "file string, block bigint, piece bigint, text string")
    return texts.join(wanted, ["file", "block", "piece"]).groupBy("file", "owner").applyInPandas(join, schema)


def _split_record(text: str) -> tuple[str, bytes]:
    head, _, body = text.partition(END)
    length = _number(_headers(head).get("content-length")) or 0
    return head, body.encode()[:length]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record: ``page_id, record_type, refers_to, target_uri, payload_bytes, payload_digest``.

    Size and digest are those of the payload itself, for revisits those of the response they refer to. A folder
    without records gives no rows. Bytes that no chain from the start of a file reaches are no records.
    """
    found = candidates(spark, path)
    owned = verified(found)
    records = found.join(owned.filter("owner = start").select("file", "start"), ["file", "start"])
    records = written(records, "warc-records")
    split = records.filter(~F.col("whole")).select("file", F.col("start").alias("owner"))
    pieces = owned.join(split, ["file", "owner"], "left_semi").select("file", "block", "piece", "owner")
    rest = _assembled(spark, path, written(pieces, "warc-pieces"), FIELDS, lambda text: _described(*_split_record(text)))
    described = records.filter("whole").select("declared", *_FIELD_NAMES)
    described = described.unionByName(rest.withColumn("declared", F.lit(None).cast("string")))
    described = written(described, "warc-described")
    responses = (
        described.filter("record_type = 'response'")
        .select(
            F.col("page_id").alias("refers_to"),
            F.concat(F.lit("sha1:"), F.col("payload_digest")).alias("declared"),
            F.col("payload_bytes").alias("full_bytes"),
        )
        .distinct()
    )
    revisits = described.filter("record_type = 'revisit'").join(responses, ["refers_to", "declared"], "left").select(
        "page_id",
        "record_type",
        "refers_to",
        "target_uri",
        F.col("full_bytes").alias("payload_bytes"),
        F.substring("declared", 6, 32).alias("payload_digest"),
    )
    return described.filter("record_type <> 'revisit'").select(*_FIELD_NAMES).unionByName(revisits)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record_type, payload``: the records with their own payloads, empty for revisits."""

    def make(text: str) -> dict:
        head, block = _split_record(text)
        known = _described(head, block)
        payload = block.partition(END.encode())[2].decode()
        return {"page_id": known["page_id"], "record_type": known["record_type"], "payload": payload}

    owned = verified(candidates(spark, path)).filter("owner is not null")
    wanted = written(owned.select("file", "block", "piece", "owner"), "warc-pieces")
    return _assembled(spark, path, wanted, "page_id bigint, record_type string, payload string", make)
