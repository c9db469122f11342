"""Derived archive records: metadata and plain text of each response, linked to it.

Every response gives one ``metadata`` and one ``conversion`` record. Both refer to the response by its
identifier and keep its target, headers and payload digest. ``write_warc`` and ``read_warc`` are the
archive files themselves: written by Spark's text source with the end of a record as line end, read in the pieces between
version lines, which are put together by the records' lengths. A table of pages has no dates; an archive's date is the writer's argument.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.llm.common import bounded_batches

VERSION = "WARC/1.1"

# How HTML becomes plain text, in this order. Comments, scripts and styles without an end reach to the end of
# the page. A tag begins with a letter; any other "<" is text.
BLANK = r"[\x20\x09-\x0D]"
RAW = "|".join(rf"{tag}(?:{BLANK}[^>]*)?>.*?(?:</{tag}{BLANK}*>|\z)" for tag in ("script", "style"))
UNSEEN = "|".join(rf"{tag}(?:{BLANK}[^>]*)?>.*?</{tag}{BLANK}*>" for tag in ("noscript", "template"))
HIDDEN = rf"(?is)<(?:!--.*?(?:-->|\z)|{RAW}|{UNSEEN})"
BREAK = (
    r"(?i)</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|title|head|body|html|blockquote|pre)"
    rf"(?:{BLANK}[^>]*)?/?>"
)
TAG = r"<(?:/?[A-Za-z]|[!?])[^>]*>"
REFERENCE = r"^(#[0-9]{1,9}|#[xX][0-9A-Fa-f]{1,8}|[A-Za-z][A-Za-z0-9]*);"
COMMON = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": " ", "copy": "©", "middot": "·"}
# All names of the standard, and the numbers that the standard reads as Windows characters.
NAMED = {k[:-1]: v for k, v in html5.items() if k.endswith(";")} | COMMON
WINDOWS = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)]
UNKNOWN = "�"

HEADER_LINE = "\r\n"


def urn(*parts: Column) -> Column:
    """A record identifier that depends on its parts only, so that reruns agree."""
    h = F.md5(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]))
    pieces = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def responses(pages: DataFrame) -> DataFrame:
    """Response records of a table of pages: page_id, record_id, target_uri, http_headers, payload.

    A null page has an empty payload, a null address no target. Rows that repeat all columns give records that
    repeat their identifier.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    size = F.octet_length(payload).cast("string")
    headers = F.concat_ws(
        HEADER_LINE, F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), size)
    )
    return pages.select(
        "page_id",
        urn(F.lit("response"), F.col("page_id"), F.col("url"), digest(payload)).alias("record_id"),
        F.col("url").alias("target_uri"),
        headers.alias("http_headers"),
        payload.alias("payload"),
    )


def code_point(n: Column) -> Column:
    """The character of a numeric reference; no character has the number: U+FFFD."""
    # a byte order mark in front, as the first one is not part of the text
    text = F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(n), 8, "0"))), "UTF-32")
    return (
        F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), UNKNOWN)
        .when(n.between(128, 159), F.element_at(F.array(*map(F.lit, WINDOWS)), (n - 127).cast("int")))
        .when(n == 160, " ")
        .otherwise(text)
    )


def unescaped(text: Column) -> Column:
    """Character references as characters, each once; what is none stays as it is.

    The text is named once, and so is each reference: a list's function is not compiled, hence repeats what it names twice.
    """
    named = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def cut(x: Column, place: Column) -> Column:
        return F.struct(x.alias("x"), F.when(place > 0, F.regexp_extract(x, REFERENCE, 1)).alias("name"))

    def piece(s: Column) -> Column:
        name = s["name"]
        char = F.when(name == "", F.lit(None).cast("string"))
        for common, value in COMMON.items():
            char = char.when(name == common, value)
        hexadecimal = F.lower(F.substring(name, 2, 1)) == "x"
        number = F.when(hexadecimal, F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 9)).cast("long")
        char = char.when(F.startswith(name, F.lit("#")), code_point(number)).otherwise(F.try_element_at(named, name))
        rest = F.substring(s["x"], F.length(name) + 2, F.length(s["x"]))
        return F.when(name.isNull(), s["x"]).otherwise(F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), s["x"])))

    return F.array_join(F.transform(F.transform(F.split(text, "&"), cut), piece), "")


def plain_text(html: Column) -> Column:
    """Text of a page: what is hidden and all tags go, blocks are lines, references are characters, blanks are one."""
    out = F.regexp_replace(html, HIDDEN, "")
    out = F.regexp_replace(out, BREAK, "\n")
    out = F.regexp_replace(out, TAG, "")
    out = unescaped(out)
    out = F.regexp_replace(out, r"[\x20\x09\x0B\x0C\x0D]+", " ")
    out = F.regexp_replace(out, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(out, r"^[ \n]+|[ \n]+$", "")


def derive(response: DataFrame) -> DataFrame:
    """Two records for each response, no response left out.

    Reads page_id, record_id, target_uri, http_headers, payload (nulls count as empty). Returns page_id,
    record_type, record_id, refers_to, target_uri, content_type, source_headers, source_payload_digest,
    content_length (bytes of the block), block_digest, block. An empty page has an empty text; long ones are taken whole. Responses
    that repeat give records that repeat; an empty table gives none.
    """
    payload = F.coalesce(F.col("payload"), F.lit(""))
    rows = response.select(
        "page_id", "record_id", "target_uri",
        F.coalesce(F.col("http_headers"), F.lit("")).alias("source_headers"),
        digest(payload).alias("source_payload_digest"),
        payload.alias("payload"),
    )
    title = F.trim(F.regexp_replace(F.regexp_extract("payload", r"(?is)<title[^>]*>([^<]*)</title>", 1), r"[\x20\x09-\x0D]+", " "))
    language = F.regexp_extract("payload", r"""(?i)<html[^>]*[\x20\x09-\x0D]lang=["']([^"']*)["']""", 1)
    links = F.regexp_extract_all("payload", F.lit(r"""(?i)<a[\x20\x09-\x0D][^>]*href=["']([^"']*)["']"""), F.lit(1))
    fields = F.concat(
        F.array(
            F.concat(F.lit("title: "), title),
            F.concat(F.lit("language: "), language),
            F.concat(F.lit("payload-length: "), F.octet_length("payload").cast("string")),
        ),
        F.transform(links, lambda x: F.concat(F.lit("outlink: "), x, F.lit(" L a/@href"))),
    )
    blocks = F.array(
        F.struct(
            F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"),
            F.array_join(fields, HEADER_LINE).alias("block"),
        ),
        F.struct(
            F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
            plain_text(F.col("payload")).alias("block"),
        ),
    )
    made = rows.select("*", F.inline(blocks))
    return made.select(
        "page_id", "record_type",
        urn(F.col("record_type"), F.col("record_id")).alias("record_id"),
        F.col("record_id").alias("refers_to"),
        "target_uri", "content_type", "source_headers", "source_payload_digest",
        F.octet_length("block").cast("long").alias("content_length"),
        digest(F.col("block")).alias("block_digest"),
        "block",
    )


def derivatives(pages: DataFrame) -> DataFrame:
    return derive(responses(pages))


def derivatives_sql() -> str:
    """The same in DuckDB's SQL; character references are joined to a table of names."""
    def q(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def uuid(expr: str) -> str:
        return f"(SELECT '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>' FROM (SELECT md5({expr}) AS h))"

    stripped = f"regexp_replace(payload, {q(HIDDEN)}, '', 'g')"
    stripped = f"regexp_replace({stripped}, {q(BREAK)}, chr(10), 'g')"
    stripped = f"regexp_replace({stripped}, {q(TAG)}, '', 'g')"
    names = ", ".join(f"({q(k)}, {q(v)})" for k, v in sorted(NAMED.items()))
    windows = ", ".join(map(q, WINDOWS))
    text = "decoded"
    text = rf"regexp_replace({text}, '[\x20\x09\x0B\x0C\x0D]+', ' ', 'g')"
    text = rf"regexp_replace({text}, ' ?\n[ \n]*', chr(10), 'g')"
    text = rf"regexp_replace({text}, '^[ \n]+|[ \n]+$', '', 'g')"
    crlf = "chr(13) || chr(10)"
    title = r"trim(regexp_replace(regexp_extract(payload, '(?is)<title[^>]*>([^<]*)</title>', 1), '[\x20\x09-\x0D]+', ' ', 'g'))"
    language = r"""regexp_extract(payload, '(?i)<html[^>]*[\x20\x09-\x0D]lang=["'']([^"'']*)["'']', 1)"""
    links = r"""regexp_extract_all(payload, '(?i)<a[\x20\x09-\x0D][^>]*href=["'']([^"'']*)["'']', 1)"""
    return f"""
    WITH raw AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
    digests AS (SELECT *, 'sha256:' || sha256(payload) AS source_payload_digest FROM raw),
    response AS (
        SELECT page_id, url AS target_uri, payload, source_payload_digest,
               {uuid("'response' || chr(31) || coalesce(CAST(page_id AS VARCHAR), chr(0)) || chr(31) || coalesce(url, chr(0)) || chr(31) || source_payload_digest")} AS refers_to,
               'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: text/html; charset=utf-8' || {crlf} || 'Content-Length: ' || strlen(payload) AS source_headers
        FROM digests),
    numbered AS (SELECT *, row_number() OVER () AS row FROM response),
    names(name, char) AS (VALUES {names}),
    parts AS (
        SELECT row, unnest(string_split(stripped, '&')) AS part, generate_subscripts(string_split(stripped, '&'), 1) AS place
        FROM (SELECT row, {stripped} AS stripped FROM numbered)),
    referred AS (SELECT *, CASE WHEN place > 1 THEN regexp_extract(part, {q(REFERENCE)}, 1) ELSE '' END AS name FROM parts),
    points AS (
        SELECT *, CASE WHEN name[1:2] IN ('#x', '#X') THEN CAST('0x' || name[3:] AS BIGINT) WHEN name[1:1] = '#' THEN CAST(name[2:] AS BIGINT) END AS n
        FROM referred),
    characters AS (
        SELECT row, place, part, p.name,
               CASE WHEN n IS NULL THEN char WHEN n = 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111 THEN chr(65533)
                    WHEN n BETWEEN 128 AND 159 THEN [{windows}][n - 127] WHEN n = 160 THEN ' ' ELSE chr(CAST(n AS INTEGER)) END AS char
        FROM points p LEFT JOIN names ON names.name = p.name),
    texts AS (
        SELECT row, string_agg(CASE WHEN place = 1 THEN part WHEN char IS NULL THEN '&' || part ELSE char || part[length(name) + 2:] END, '' ORDER BY place) AS decoded
        FROM characters GROUP BY row),
    made AS (
        SELECT * EXCLUDE (row), 'metadata' AS record_type, 'application/warc-fields' AS content_type,
               array_to_string(list_concat(['title: ' || {title}, 'language: ' || {language}, 'payload-length: ' || strlen(payload)],
                   ['outlink: ' || x || ' L a/@href' FOR x IN {links}]), {crlf}) AS block
        FROM numbered
        UNION ALL
        SELECT n.* EXCLUDE (row), 'conversion', 'text/plain; charset=utf-8', {text} FROM numbered n JOIN texts USING (row))
    SELECT page_id, record_type, {uuid("record_type || chr(31) || refers_to")} AS record_id, refers_to, target_uri, content_type,
           source_headers, source_payload_digest, CAST(strlen(block) AS BIGINT) AS content_length,
           'sha256:' || sha256(block) AS block_digest, block
    FROM made"""


def record_text(date: Column) -> Column:
    """A whole record: version, header, blank line, block. The source's header lines follow as one-line fields."""
    one_line = F.replace(F.col("source_headers"), F.lit(HEADER_LINE), F.lit(" | "))
    head = F.concat_ws(
        HEADER_LINE,
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), F.col("record_id")),
        F.concat(F.lit("WARC-Refers-To: "), F.col("refers_to")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("target_uri")),  # null: no such line
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("Content-Type: "), F.col("content_type")),
        F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string")),
        F.concat(F.lit("WARC-Block-Digest: "), F.col("block_digest")),
        F.concat(F.lit("Source-Payload-Digest: "), F.col("source_payload_digest")),
        F.concat(F.lit("Source-Headers: "), one_line),
    )
    return F.concat(head, F.lit(HEADER_LINE * 2), F.col("block"))


def write_warc(records: DataFrame, path: str, date: str, compression: str = "gzip") -> None:
    """Archive files below ``path``, one per task: records end with two line breaks."""
    (
        records.select(record_text(F.lit(date)).alias("value"))
        .write.option("lineSep", HEADER_LINE * 2).option("compression", compression).text(path)
    )


# What every version line begins with, of any version; blocks may hold it too.
MARK = b"WARC/"
_START = re.compile(rb"[0-9]+\.[0-9]+[ \t]*\r?\n")
_HEAD_END = re.compile(rb"\r?\n\r?\n")
FIELDS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "refers_to": "warc-refers-to", "target_uri": "warc-target-uri",
    "date": "warc-date", "content_type": "content-type", "block_digest": "warc-block-digest",
    "source_payload_digest": "source-payload-digest", "source_headers": "source-headers",
}
_READ = pa.schema([
    ("version", pa.string()), *[(name, pa.string()) for name in FIELDS], ("content_length", pa.int64()), ("block", pa.binary()),
    ("complete", pa.bool_()),
])


class _Record:
    """A record that is put together from pieces: its head up to the first blank line, then a block of the length that the head tells."""

    def __init__(self, piece: bytes):
        self.parts, self.size = [piece], len(piece)
        self.body = self.length = None  # where the block begins, and how long it is
        self.fields: dict[str, str] = {}
        self._look(piece)

    def _look(self, data: bytes) -> None:
        end = _HEAD_END.search(data)
        if not end:
            return
        self.body = end.end()
        self.version, *lines = re.split(r"\r?\n", data[: end.start()].decode("utf-8", "replace"))
        name = None
        for line in lines:
            if line[:1] in (" ", "\t") and name:  # a folded line goes on with the field before
                self.fields[name] += " " + line.strip()
            else:
                name, _, value = line.partition(":")
                name = name.strip().lower()
                self.fields.setdefault(name, value.strip())
        told = self.fields.get("content-length", "")
        self.length = int(told) if told.isascii() and told.isdigit() else None

    def wants_more(self) -> bool:
        return self.body is None or (self.length is not None and self.size - self.body < self.length)

    def add(self, piece: bytes) -> None:
        self.parts += [MARK, piece]
        self.size += len(MARK) + len(piece)
        if self.body is None:
            self.parts = [b"".join(self.parts)]
            self._look(self.parts[0])

    def row(self) -> dict:
        data = b"".join(self.parts)
        if self.body is None:  # no blank line: nothing is known of it but its bytes
            return {"version": None, "content_length": None, "block": data, "complete": False} | dict.fromkeys(FIELDS)
        end = len(data) if self.length is None else self.body + self.length
        block, rest = data[self.body : end], data[end:]
        found = {name: self.fields.get(field) or None for name, field in FIELDS.items()}
        if found["source_headers"]:
            found["source_headers"] = found["source_headers"].replace(" | ", HEADER_LINE)
        whole = self.length == len(block) and not rest.strip(b"\r\n") and _agrees(block, found["block_digest"])
        return {"version": self.version.strip(), "content_length": self.length, "block": block, "complete": whole} | found


def _agrees(block: bytes, told: str | None) -> bool:
    """Whether a block has the digest that its head tells, in base 16 or 32; one of an unknown kind is not looked at."""
    kind, _, value = (told or "").partition(":")
    if kind.lower().replace("-", "") not in ("md5", "sha1", "sha256", "sha512"):
        return True
    found = hashlib.new(kind.lower().replace("-", ""), block)
    return value.lower() in (found.hexdigest(), base64.b32encode(found.digest()).decode().lower().rstrip("="), base64.b32encode(found.digest()).decode().lower())


def _records(pieces: Iterator[tuple[str, bytes]]) -> Iterator[dict]:
    """Records of the pieces between marks, in the order of each file; every byte other than line ends between records is in some record."""
    file, record = None, None
    for name, piece in pieces:
        if name != file:
            if record:
                yield record.row()
            file, record = name, None
            # what precedes the first mark
            if piece.strip(b"\r\n"):
                yield _Record(piece).row() | {"complete": False}
            continue
        if record and (record.wants_more() or not _START.match(piece)):
            record.add(piece)
            continue
        if record:
            yield record.row()
        record = _Record(piece)
    if record:
        yield record.row()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces() -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

    held, size = [], 0
    for row in _records(pieces()):
        held.append(row)
        size += len(row["block"])
        if size > READ_BYTES or len(held) == READ_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=_READ)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_READ)


READ_ROWS, READ_BYTES = 2000, 16 * 1024 * 1024


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of whole plain files."""
    def pieces() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = 0
                while at <= len(data):
                    end = data.find(MARK, at)
                    end = len(data) if end < 0 else end
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data[at:end]], pa.binary())], ["file", "piece"])
                    at = end + len(MARK)

    return _read(pieces())


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of archive files below ``path``, of any version: version, header fields, content_length, block, complete.

    A file is read in pieces that end where a version line may begin. A record takes as many pieces as its Content-Length asks for, so a
    block may hold version lines and whole records. ``complete`` is false for a record that is cut, has no length or no blank line
    after its head, has bytes beyond its length, or has not the digest that it tells; what there is of it is returned. Bytes before the
    first record of a file are such a row too. Header names ignore case, folded lines are joined, lines may end with or without a carriage
    return. No file and an empty file give no row; a file that is there twice gives its records twice.

    Compressed files (``.gz``) are streamed, one task each, and a task holds one record at a time beside a batch; these may be of any
    size. A plain file is one value of at most two gigabytes (Spark fails beyond that): compress larger ones.
    """
    bounded_batches(spark)
    schema = ", ".join(f"`{f.name}` {_SPARK_TYPES[f.type]}" for f in _READ)
    packed = spark.read.option("lineSep", MARK.decode()).option("pathGlobFilter", "*.gz").text(path)
    packed = packed.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    plain = spark.read.format("binaryFile").option("pathGlobFilter", "*[^z]").load(path).select("path", "content")
    found = packed.mapInArrow(_read, schema).unionAll(plain.mapInArrow(_split, schema))
    return found.withColumn("block", F.col("block").cast("string"))


_SPARK_TYPES = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean"}
