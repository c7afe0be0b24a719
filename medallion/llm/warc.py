"""Web archives: pages written as WARC records, and read back by boundary-chain verification.

Spark's text writer ends every value with the record terminator, so archives are plain files on any file
system Spark can write. Reading splits files at every occurrence of the record magic, also inside payloads.
Each occurrence is a candidate that names its successor: its own offset plus the length it claims.
Candidates that follow each other without a gap are one run, told apart while a split is read. Pointer jumping over
runs, from the start of each file, keeps the candidates that the chain reaches; the rest is payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.tables import stored
from medallion.session import fresh_dir

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
# The base32 alphabet.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(digest: Column) -> Column:
    """Bare base32 of a SHA-1 in hex."""
    symbols = []
    for i in range(8):  # five hex digits are four symbols
        bits = F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            symbols.append(F.lit(ALPHABET).substr(F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*symbols)


def _identity(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:pages:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """One record per page. Of pages with equal payloads of at least ``min_bytes`` bytes, that with the largest
    page_id is written whole and the others as revisits of it.

    A null html is an empty payload, a null url leaves the target out, line breaks in urls are percent-encoded. A
    page without id counts as smaller than any other. Rows that repeat the largest page_id are all written whole.
    An empty table writes no record; other columns are ignored. Pages meet others with the same digest only
    as (id, digest) pairs, reduced to one row per digest before the shuffle.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload")
    ).select("*", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("digest"))
    ids = rows.select("page_id", "digest", "size").filter(F.col("size") >= min_bytes)
    whole = ids.groupBy("digest", "size").agg(F.max("page_id").alias("whole"), F.count("*").alias("n")).filter("n > 1")
    repeats = ids.join(whole, ["digest", "size"]).filter("not (page_id <=> whole)")
    # Mostly short: then the planner broadcasts it and payloads stay where they are.
    repeats = stored(repeats.select("page_id", "digest", "whole").distinct(), "revisits")
    key = (F.col("p.page_id").eqNullSafe(F.col("r.page_id"))) & (F.col("p.digest") == F.col("r.digest"))
    joined = rows.alias("p").join(repeats.alias("r"), key, "left").select("p.*", "r.whole")

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "size", F.lit(END))
    body = F.when(F.col("whole").isNull(), F.concat(http, "payload")).otherwise(http)
    clean_url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    kind = F.when(F.col("whole").isNull(), F.lit("WARC-Type: response\r\n")).otherwise(
        F.concat(F.lit(f"WARC-Type: revisit\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _identity(F.col("whole")), F.lit("\r\n"))
    )
    record = F.concat(
        F.lit(MAGIC),
        kind,
        F.lit("WARC-Record-ID: "),
        _identity(F.col("page_id")),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), clean_url), F.lit("")),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:"),
        base32(F.col("digest")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("body").cast("string"),
        F.lit(END),
        "body",
    )
    joined.withColumn("body", body).select(record.alias("value")).write.option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Everything between two occurrences of the magic, with the split it was read in."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"),
    )


def parse_record(record: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields and the whole length claimed by a record without its magic; None for what is no header."""
    stop = record.find(END.encode())
    if stop < 0:
        return None
    fields = dict(re.findall(r"([A-Za-z-]+): ?([^\r\n]*)", record[:stop].decode("utf-8", "replace")))
    length = fields.get("Content-Length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        return None
    return fields, len(MAGIC) + stop + len(END) + int(length) + len(END)


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:pages:(-?[0-9]+)>", name or "")
    return int(found[1]) if found else None


def describe(record: bytes) -> tuple:
    """(page_id, type, refers_to, url, payload bytes, payload digest) of a record without its magic.

    A revisit has no payload; its size is the one its HTTP head names, its digest the one its header names.
    """
    fields, length = parse_record(record)
    head = record.find(END.encode()) + len(END)
    body = record[head : length - len(MAGIC) - len(END)]
    split = body.find(END.encode()) + len(END)
    kind = fields.get("WARC-Type", "")
    if kind == "revisit":
        size = re.search(rb"Content-Length: ([0-9]+)", body[:split])
        digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
        return _page(fields.get("WARC-Record-ID")), kind, _page(fields.get("WARC-Refers-To")), fields.get("WARC-Target-URI"), int(size[1]), digest
    payload = body[split:]
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return _page(fields.get("WARC-Record-ID")), kind, None, fields.get("WARC-Target-URI"), len(payload), digest


_FIELDS = "page_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string"
_CANDIDATE = f"file string, block long, number long, before long, size long, claimed long, run long, {_FIELDS}"


def _candidates(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Per piece: bytes of its block before it, own length, length it claims; the fields if it is a whole record.

    ``run``: number of the piece that begins its run, in which each claims to end where the next one starts.
    """
    at, number, before, run = None, 0, 0, 0
    for batch in batches:
        out = []
        for file, block, piece in zip(*(batch.column(n).to_pylist() for n in ("file", "block", "piece"))):
            if (file, block) != at:
                at, number, before, run = (file, block), 0, 0, 0
            claimed = (parse_record(piece) or (None, None))[1]
            whole = claimed == len(MAGIC) + len(piece)
            out.append((file, block, number, before, len(piece), claimed, run, *(describe(piece) if whole else [None] * 6)))
            number, before = number + 1, before + len(piece) + len(MAGIC)
            run = run if whole else number
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


def reachable(edges: DataFrame) -> DataFrame:
    """(file, start) of all nodes on the chain from offset 0, by pointer jumping: the distance doubles per round.

    ``edges``: file, start and the start ``to`` of the next node, or null where a chain ends.
    """
    reached, jump = stored(edges.filter("start = 0").select("file", "start"), "reached"), edges.filter("to is not null")
    count = reached.count()
    while True:
        step = reached.join(jump, ["file", "start"]).select("file", F.col("to").alias("start"))
        reached = stored(reached.unionByName(step).distinct(), "reached")
        known, count = count, reached.count()
        if count == known:
            return reached
        further = jump.select("file", "start", F.col("to").alias("mid")).join(
            jump.select("file", F.col("start").alias("mid"), "to"), ["file", "mid"]
        )
        jump = stored(further.select("file", "start", "to"), "jump")


def on_chain(placed: DataFrame) -> DataFrame:
    """The candidates of ``placed`` that are records.

    A chain enters a run at one of its pieces, perhaps not the first, and has all that follow in the run. So jumps lead
    from run to run: their number follows that of payloads that hold the magic, not that of records.
    """
    end = F.max(F.struct("start", (F.col("start") + F.col("claimed")).alias("to")))["to"]
    runs = stored(placed.groupBy("file", "block", "run").agg(F.min("start").alias("first"), end.alias("to")), "runs")
    members = placed.select("file", F.col("start").alias("to"), F.col("block").alias("_block"), F.col("run").alias("_run"))
    firsts = runs.select("file", F.col("block").alias("_block"), F.col("run").alias("_run"), F.col("first").alias("next"))
    links = members.join(runs.select("file", "first", "to"), ["file", "to"]).join(firsts, ["file", "_block", "_run"])
    links = stored(links.select("file", F.col("first").alias("start"), "next", F.col("to").alias("entry")), "links")
    chain = reachable(
        runs.select("file", F.col("first").alias("start")).join(links, ["file", "start"], "left").select("file", "start", F.col("next").alias("to"))
    )
    entered = chain.join(links, ["file", "start"]).select("file", F.col("next").alias("first"), "entry")
    begun = chain.filter("start = 0").select("file", F.col("start").alias("first"), F.col("start").alias("entry"))
    entries = entered.unionByName(begun).join(runs, ["file", "first"]).select("file", "block", "run", "entry")
    return placed.join(stored(entries, "entries"), ["file", "block", "run"]).filter("start >= entry and claimed is not null").drop("run", "entry")


def index_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, start offset, split, piece number, and the fields of ``describe``.

    Candidates that the chain from the file's start does not reach are dropped; a record whose payload holds the
    magic is put together from its pieces. An archive without records gives no row.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T._parse_datatype_string(_CANDIDATE))
    found = stored(_pieces(spark, path).mapInArrow(lambda batches: _candidates(batches, arrow), _CANDIDATE), "candidates")
    totals = found.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))
    # A piece begins after its magic; the first piece of a file stands before any magic.
    placed = found.join(base, ["file", "block"]).withColumn("start", F.col("base") + F.col("before") - len(MAGIC))
    placed = stored(placed.filter("start >= 0").drop("base", "before"), "placed")
    records = on_chain(placed)
    columns = ["file", "start", "claimed", "block", "number", *[f.split()[0] for f in _FIELDS.split(", ")]]
    whole = records.filter("record_type is not null").select(*columns)
    parts = stored(_spread(placed, records.filter("record_type is null")), "spread")
    return whole.unionByName(_glued(spark, path, parts).select(*columns))


def _spread(placed: DataFrame, records: DataFrame) -> DataFrame:
    """Pieces of records that hold the magic: those between the record's start and the end it claims."""
    cells = F.sequence(F.floor(F.col("start") / 65536), F.floor((F.col("start") + F.col("claimed") - 1) / 65536))
    ranges = records.select(
        "file", F.col("start").alias("record"), F.col("claimed").alias("length"), F.col("block").alias("home"), F.explode(cells).alias("cell")
    )
    pieces = placed.select("file", "start", "block", "number", F.floor(F.col("start") / 65536).alias("cell"))
    return pieces.join(ranges, ["file", "cell"]).filter("start >= record and start < record + length").drop("cell")


def _glued(spark: SparkSession, path: str, parts: DataFrame) -> DataFrame:
    schema = f"file string, start long, claimed long, block long, number long, {_FIELDS}"

    def put_together(key, rows):
        import pandas as pd

        rows = rows.sort_values("start")
        record = MAGIC.encode().join(rows["piece"])
        first = rows.iloc[0]
        return pd.DataFrame([(*key, first["length"], first["home"], first["number"], *describe(record))])

    numbered = _numbered(spark, path)
    return numbered.join(parts, ["file", "block", "number"]).groupBy("file", "record").applyInPandas(put_together, schema)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, number = None, 0
    for batch in batches:
        numbers = []
        for key in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
            number = number + 1 if key == at else 0
            at = key
            numbers.append(number)
        yield batch.append_column("number", pa.array(numbers, pa.int64()))


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    return _pieces(spark, path).mapInArrow(_number, "file string, block long, piece binary, number long")


def round_trip(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write pages as archives and read their records back (see ``write_warc`` and ``index_warc``)."""
    spark = pages.sparkSession
    path = path or fresh_dir(spark, "warc")
    write_warc(pages, path, min_bytes)
    return index_warc(spark, path)
