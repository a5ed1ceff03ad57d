"""WARC archives with a two-level capture index.

Writing: one record per page, payloads equal to an earlier one (by page id) become
revisit records.  Archives are plain WARC/1.1 files written by Spark's text writer,
whose line separator is the blank line that ends a record.

Indexing: archives are read as streams, one task per file, and every record gives a
line (reversed-host URL key, page id, file, offset, length).  Lines sorted by key are
cut into compressed blocks; the sparse directory holds the first key of each block
and never more than MAX_BLOCKS entries, so it fits into every executor.

Looking up: a key's block is found by binary search in the directory, its lines by
binary search in the block, and the records are read as byte ranges.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import map_rows, materialise
from mercato.session import scratch_path

MIN_DEDUP = 100  # bytes; smaller payloads are never revisits (from the contract)
BLOCK_LINES = 512
MAX_BLOCKS = 65_536  # blocks grow beyond BLOCK_LINES instead
SALTS = 16
CRLF = "\r\n"
NAMELESS = "none"  # in the record name of a page without an id
NO_ID = -(1 << 63)  # its id in the index
DATE = "2026-01-01T00:00:00Z"  # capture time; pages carry none


# ------------------------------------------------------------------ writing
def record_types(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the revisits: pages whose payload, of MIN_DEDUP
    bytes at least, equals that of a page with a smaller id (a page without an id comes
    after all that have one).

    Narrow columns only; digests are counted before the shuffle, and the rows of
    one digest are spread over SALTS keys for the join back.
    """
    narrow = pages.where(F.col("bytes") >= MIN_DEDUP).select("page_id", "digest")
    first = (narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 AND refers_to IS NOT NULL")
             .select("digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    return (narrow.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
            .join(first, ["digest", "salt"]).where("page_id > refers_to OR page_id IS NULL")
            .select("page_id", "digest", "refers_to").distinct())


def _digested(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    url = F.col(f"`{url_col}`") if url_col in pages.columns else F.lit(None).cast("string")
    return pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                        plain_url(url).alias("url"), html.alias("html"),
                        F.octet_length(html).cast("long").alias("bytes"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))


def plain_url(url: Column) -> Column:
    """A URL as a header can hold it (null: empty)."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", "")


def _head(kind: str, fields: list[tuple[str, Column]]) -> Column:
    """Header lines of a record; a field that is null is left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}")]
    lines += [F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in fields]
    return F.concat_ws(CRLF, *lines)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> None:
    """Write ``pages`` below ``path``, a file per input partition; the payload is
    the html in UTF-8.

    Null html counts as empty and null URLs as the empty URL.  A page without an id
    gives a record too, named after its payload and a row number; it is a revisit
    where a page with an id has its payload, and a response otherwise, for there is no
    name to refer to.  Of rows that share an id each gives a record (the smallest id of equal
    payloads is the response).  Very long payloads are written whole.  Other columns play
    no part.  An empty table gives a folder without records.
    """
    df = _digested(pages, id_col, url_col, html_col)
    # a stored table of known size: the planner broadcasts it if it is small
    revisits = materialise(record_types(df), "warc-revisits").select(
        F.col("page_id").alias("of"), F.col("digest").alias("same"), "refers_to")
    df = df.join(revisits, F.col("page_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")), "left")
    unnamed = F.concat(F.lit(f"{NAMELESS}-"), F.substring("digest", 1, 16), F.lit("-"), F.monotonically_increasing_id())
    uri = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), unnamed))
    same = [("WARC-Record-ID", F.concat(F.lit("<"), uri, F.lit(">"))), ("WARC-Target-URI", F.col("url")),
            ("WARC-Date", F.lit(DATE)), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            ("X-Payload-Length", F.col("bytes"))]
    response = F.concat(_head("response", [*same, ("Content-Type", F.lit("text/html; charset=utf-8")),
                                           ("Content-Length", F.col("bytes"))]), F.lit(CRLF * 2), F.col("html"))
    revisit = F.concat(_head("revisit", [
        *same, ("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("Content-Length", F.lit(0))]), F.lit(CRLF * 2))
    df.select(F.when(F.col("refers_to").isNull(), response).otherwise(revisit).alias("value")) \
        .write.option("lineSep", CRLF * 2).text(path)


# ------------------------------------------------------------------ files
def _open(uri: str):
    """A random-access file of any store that pyarrow reaches (local, HDFS, S3, GCS)."""
    from pyarrow import fs
    uri = uri.replace("file:///", "/").removeprefix("file:")
    if "://" not in uri:
        return fs.LocalFileSystem().open_input_file(unquote(uri))
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def page_of(name: str) -> int | None:
    """The page_id in a record's name; None for a page without one."""
    page = name.strip("<>").rsplit(":", 1)[1]
    return None if page.startswith(NAMELESS) else int(page)


def parse_head(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split(CRLF)
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    return dict(x.split(": ", 1) for x in lines[1:] if ": " in x)


def records(uri: str, step: int = 1 << 20) -> Iterator[tuple[int, int, dict[str, str]]]:
    """(offset, length, header) of each record of a file, read front to back in
    steps; payloads are skipped, so memory holds a step and a header."""
    with _open(uri) as f:
        size, at = f.size(), 0
        buffer, base = b"", 0
        while at < size:
            if not base <= at < base + len(buffer):
                f.seek(at)
                buffer, base = f.read(step), at
            end = buffer.find(b"\r\n\r\n", at - base)
            while end < 0 and base + len(buffer) < size:
                more = f.read(step)
                buffer, base = buffer[at - base:] + more, at
                end = buffer.find(b"\r\n\r\n")
            if end < 0:
                raise ValueError(f"{uri}: the record at {at} is cut off")
            head = parse_head(buffer[at - base:end])
            length = base + end + 4 - at + int(head["Content-Length"]) + 4
            yield at, length, head
            at += length


def surt(url: str) -> str:
    """Reversed-host key: scheme, ``www.`` and fragment go, the host's labels are
    turned round, path and query keep their order."""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    host, slash, path = rest.partition("/")
    host, mark, query = host.partition("?")
    host, _, port = host.rpartition("@")[2].lower().partition(":")
    host = host.removeprefix("www.")
    port = f":{port}" if port and port not in ("80", "443") else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (slash + path if slash else "/") + mark + query


# ------------------------------------------------------------------ index
def build_index(spark, archive: str, path: str) -> None:
    """Index the archives below ``archive``: ``path``/blocks (block, first key,
    lines compressed) and ``path``/directory (block, first)."""
    files = spark.read.format("binaryFile").load(archive).select("path", "length").where("length > 0")
    tasks = max(1, files.count())
    files = files.repartition(tasks, "path")

    def lines(batches):
        for b in batches:
            for uri in b["path"]:
                held: dict[str, list] = {k: [] for k in ("key", "page_id", "file", "offset", "length")}
                for at, length, head in records(uri):
                    page = page_of(head["WARC-Record-ID"])
                    page = NO_ID if page is None else page
                    for k, v in zip(held, (surt(head.get("WARC-Target-URI", "")), page, uri, at, length)):
                        held[k].append(v)
                    if len(held["key"]) >= 4096:
                        yield held
                        held = {k: [] for k in held}
                yield held

    captures = materialise(map_rows(files.select("path"), lines,
                                    "key string, page_id long, file string, offset long, length long"), "warc-lines")
    total = captures.count()
    size = max(BLOCK_LINES, -(-2 * total // MAX_BLOCKS))
    shards = max(1, min(MAX_BLOCKS // 2, -(-total // (size * 64)) * 4))

    def cut(batches):
        held: list = []
        number, shard = 0, 0

        def block():
            first = held[0]
            return {"shard": [shard], "block": [number], "first": [first[0]], "first_id": [first[1]],
                    "n": [len(held)], "data": [zlib.compress(json.dumps(held).encode(), 6)]}

        for b in batches:
            shard = b["shard"][0]
            for row in zip(b["key"], b["page_id"], b["file"], b["offset"], b["length"]):
                held.append(row)
                if len(held) == size:
                    yield block()
                    held, number = [], number + 1
        if held:
            yield block()

    order = ["key", "page_id", "file", "offset"]
    placed = (captures.repartitionByRange(shards, *order).sortWithinPartitions(*order)
              .select("*", F.spark_partition_id().alias("shard")))
    map_rows(placed, cut, "shard int, block int, first string, first_id long, n int, data binary") \
        .write.parquet(f"{path}/blocks")
    (spark.read.parquet(f"{path}/blocks").select("shard", "block", "first", "first_id")
     .orderBy("shard", "block").coalesce(1).write.parquet(f"{path}/directory"))


def lookup(spark, index: str, wanted: DataFrame) -> DataFrame:
    """Captures (key, page_id, file, offset, length) of the ``wanted`` (url,
    page_id) pairs; a null page_id asks for all captures of the URL, NO_ID for
    those of pages without an id.

    The directory (MAX_BLOCKS entries at most, by construction) goes to the
    executors; keys meet their block in groups as large as a block.
    """
    directory = spark.read.parquet(f"{index}/directory").collect()
    directory.sort(key=lambda r: (r.shard, r.block))
    firsts = [(r.first, r.first_id) for r in directory]

    def find(batches):
        for b in batches:
            out: dict[str, list] = {"place": [], "key": [], "page_id": []}
            for url, page in zip(b["url"], b["page_id"]):
                key = surt(url or "")
                if page is None:  # every block that can hold the key
                    low, high = bisect_left(firsts, (key, -(1 << 63))) - 1, bisect_right(firsts, (key, 1 << 63))
                else:
                    low = bisect_left(firsts, (key, page)) - 1
                    high = bisect_right(firsts, (key, page))
                for place in range(max(0, low), high):
                    out["place"].append(place)
                    out["key"].append(key)
                    out["page_id"].append(page)
            yield out

    keys = map_rows(wanted.select("url", F.col("page_id").cast("long").alias("page_id")).distinct(), find,
                    "place int, key string, page_id long")
    place = {(r.shard, r.block): k for k, r in enumerate(directory)}

    def number(batches):
        for b in batches:
            yield {"place": [place[x] for x in zip(b["shard"], b["block"])], "data": b["data"]}

    blocks = map_rows(spark.read.parquet(f"{index}/blocks").select("shard", "block", "data"), number,
                      "place int, data binary")

    def search(asked, stored):
        import pandas as pd
        columns = ["key", "page_id", "file", "offset", "length"]
        found = set()
        if len(asked) and len(stored):
            lines = [tuple(x) for x in json.loads(zlib.decompress(stored["data"].iloc[0]))]
            for key, page in zip(asked["key"], asked["page_id"]):
                if page is None or page != page:
                    low, high = bisect_left(lines, (key,)), bisect_left(lines, (key + "\0",))
                else:
                    low, high = bisect_left(lines, (key, int(page))), bisect_left(lines, (key, int(page) + 1))
                found.update(lines[low:high])
        return pd.DataFrame(sorted(found), columns=columns)

    return keys.groupBy("place").cogroup(blocks.groupBy("place")).applyInPandas(
        search, "key string, page_id long, file string, offset long, length long")


def fetch(captures: DataFrame, with_payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to,
    payload string) of ``captures``, by reading their byte ranges; responses are
    held against length and digest.  A revisit's payload is null; without
    ``with_payload`` all are."""
    def run(batches):
        uri, f = None, None
        for b in batches:
            out: dict[str, list] = {k: [] for k in (
                "page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")}
            for where, at, length in zip(b["file"], b["offset"], b["length"]):
                if where != uri:
                    uri, f = where, _open(where)
                f.seek(at)
                head, _, rest = f.read(length).partition(b"\r\n\r\n")
                h = parse_head(head)
                payload = rest[:int(h["Content-Length"])]
                digest, kind = h["WARC-Payload-Digest"].removeprefix("sha256:"), h["WARC-Type"]
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"{where}: the record at {at} doesn't match its digest")
                refers = h.get("WARC-Refers-To")
                for k, v in zip(out, (page_of(h["WARC-Record-ID"]), h.get("WARC-Target-URI", ""),
                                      kind, int(h["X-Payload-Length"]), digest,
                                      refers and page_of(refers),
                                      payload.decode("utf-8", "replace") if with_payload and kind == "response" else None)):
                    out[k].append(v)
            yield out

    spark = captures.sparkSession
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    near = captures.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return map_rows(near.select("file", "offset", "length"), run,
                    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
                    "refers_to long, payload string")


def round_trip(pages: DataFrame, with_payload: bool = True) -> DataFrame:
    """Archive ``pages``, index the archives, and fetch every page through the index."""
    spark = pages.sparkSession
    root = scratch_path(spark, "warc")
    write(pages, f"{root}/archive")
    build_index(spark, f"{root}/archive", f"{root}/index")
    wanted = pages.select(plain_url(F.col("url")).alias("url"), F.coalesce("page_id", F.lit(NO_ID)).alias("page_id"))
    captures = materialise(lookup(spark, f"{root}/index", wanted), "warc-captures")
    return fetch(captures, with_payload)
