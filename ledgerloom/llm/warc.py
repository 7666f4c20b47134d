"""WARC derivatives: metadata and plain-text conversion records made from response records.

A response record becomes two records that refer to it by its identifier and keep its target,
date and digests: a metadata record, JSON with the source's WARC and HTTP headers, the title and
the links of the page, and a conversion record with the page's text. Identifiers of derived
records follow from the source's, so that a task that runs again makes the same records. Files
hold one gzip member a record; a written manifest names the files that count, so that attempts
that were lost leave at most files that nobody reads.

Nothing is shuffled: every record is made in the task that reads its source.

Chunked, gzip and deflate codings of a page are undone. Of a header that repeats the metadata
hold a list of all values. A record that cannot be parsed, has another coding, or is no response,
gives no derived records but one row with its error. Null urls and null pages are empty. Rows that repeat give records of their own with
equal identifiers. Empty tables give no records. Text of pages is decoded by the charset of the
HTTP header, UTF-8 by default, with replacement.
"""

import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import give_back, materialize, new_path, place

VERSION = "WARC/1.0"
#: Names under which identifiers are made.
SPACE = uuid.UUID("0f1c2a52-6d0a-5b6e-8f43-2f8f7a1f6d10")
FILE_BYTES = 256 << 20


# Two letters of base 32 for each ten bits; a digest has sixteen such pairs.
PAIRS = [a + b for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567" for b in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"]
SHIFTS = range(150, -1, -10)


def digest(raw: bytes) -> str:
    number = int.from_bytes(hashlib.sha1(raw).digest())
    return "sha1:" + "".join([PAIRS[number >> shift & 1023] for shift in SHIFTS])


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(text: str) -> str:
    return re.sub(r"[\r\n]+", " ", text)


class Headers(dict):
    """Values by names in lower case, the last one where a name repeats; ``all`` keeps every value in order."""

    def __init__(self):
        super().__init__()
        self.values_of: dict[str, list[str]] = {}

    def all(self) -> dict[str, str | list[str]]:
        """A name's value, or the list of its values where it repeats."""
        return {name: values[0] if len(values) == 1 else values for name, values in self.values_of.items()}


def _headers(raw: bytes) -> Headers:
    """The headers of a block of lines; a line that begins with a blank continues the one before."""
    out = Headers()
    last = ""
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            out.values_of[last][-1] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            out.values_of.setdefault(last, []).append(value.strip())
    out.update({name: values[-1] for name, values in out.values_of.items()})
    return out


def _unchunked(body: bytes) -> bytes:
    """A body without its chunk sizes; ValueError if they do not fit."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip()
        if end < 0 or not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise ValueError("damaged chunk")
        length, at = int(size, 16), end + 2
        if not length:
            return b"".join(out)
        if body[at + length : at + length + 2] != b"\r\n":
            raise ValueError("damaged chunk")
        out.append(body[at : at + length])
        at += length + 2


def _inflated(body: bytes, kind: str) -> bytes:
    """A body without a gzip or deflate coding; deflate also without its zlib frame, as some servers send it."""
    if not body:
        return body
    if kind == "gzip":
        out = []
        while body:
            part = zlib.decompressobj(31)
            out.append(part.decompress(body) + part.flush())
            if not part.eof:
                raise ValueError("content ends within its coding")
            body = part.unused_data.lstrip(b"\0")
        return b"".join(out)
    try:
        return zlib.decompress(body)
    except zlib.error:
        return zlib.decompress(body, -15)


def decoded(body: bytes, http: Headers) -> bytes:
    """A body without its transfer and content codings, the last one applied first; ValueError if one is unknown or damaged."""
    for name in ("transfer-encoding", "content-encoding"):
        codings = [c.strip().lower() for value in http.values_of.get(name, []) for c in value.split(",")]
        for coding in reversed(codings):
            if coding in ("", "identity"):
                continue
            if coding == "chunked" and name == "transfer-encoding":
                body = _unchunked(body)
            elif coding in ("gzip", "x-gzip", "deflate"):
                try:
                    body = _inflated(body, coding.removeprefix("x-"))
                except zlib.error as wrong:
                    raise ValueError(f"damaged {coding} content") from wrong
            else:
                raise ValueError(f"unknown coding {coding}")
    return body


def parse(raw: bytes) -> tuple[Headers, bytes]:
    """Headers and block of a record; ValueError if it is damaged."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    first, _, fields = head.partition(b"\r\n")
    if not gap or not first.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    headers = _headers(fields)
    length = headers.get("content-length", "")
    if not length.isdigit() or len(rest) < int(length):
        raise ValueError("content is shorter than its length")
    block = rest[: int(length)]
    wanted = headers.get("warc-block-digest", "")
    if wanted.startswith("sha1:") and wanted != digest(block):
        raise ValueError("block digest differs")
    return headers, block


def response(page_id, url: str, page: str, date: str) -> bytes:
    """A response record of a page."""
    payload = page.encode("utf-8", "replace")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    own = digest(payload)
    name = uuid.uuid5(SPACE, json.dumps([page_id, url, own]))
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", own),
        ("WARC-Block-Digest", digest(http + payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record(headers, http + payload)


# Elements that begin a line of their own, and elements without text for readers.
BLOCKS = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul title".split()
)
SILENT = frozenset("script style noscript template iframe".split())
#: What a tag does by its name; other names do nothing.
KINDS = {**dict.fromkeys(BLOCKS, "block"), **dict.fromkeys(SILENT, "silent"), "a": "link", "title": "title"}
# A tag with all up to its end, which a quoted value does not close; the last group is empty where no end is found so.
TAG = re.compile(r"<!--|<(?:(/?)([A-Za-z][^\s/>]*)|[!?])((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>)?")
HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)


def page_text(page: str) -> tuple[str, str, list[str]]:
    """(title, text by lines, link targets) of a page, in one pass."""
    out: list[str] = []
    links: list[str] = []
    title = ""
    at, in_title = 0, -1
    search, put = TAG.search, out.append
    while m := search(page, at):
        put(page[at : m.start()])
        slash, name, closed = m.groups()
        if closed:
            at = m.end()
        elif m[0] == "<!--":
            at = page.find("-->", m.end()) + 3
            if at < 3:
                at = len(page)
            continue
        else:
            at = page.find(">", m.end()) + 1
            if not at:
                break
        if not name:
            continue
        what = KINDS.get(name) or KINDS.get(name.lower())
        if not what:
            continue
        if what == "silent":
            if not slash:
                close = re.compile(rf"</{name}\b", re.I).search(page, at)
                at = close.start() if close else len(page)
            continue
        if what == "link":
            if not slash and (h := HREF.search(page, m.end(2), at)):
                links.append(html.unescape(h[1] or h[2] or h[3] or ""))
            continue
        if what == "title":
            if not slash:
                in_title = len(out)
            elif in_title >= 0:
                title = " ".join(html.unescape("".join(out[in_title:])).split())
                del out[in_title:]
                in_title = -1
        put("\n")
    else:
        put(page[at:])
    lines = (" ".join(line.split()) for line in html.unescape("".join(out)).split("\n"))
    return title, "\n".join(line for line in lines if line), links


def derive_record(raw: bytes) -> tuple[bytes, bytes]:
    """The metadata and the conversion record of a response record."""
    source, block = parse(raw)
    if source.get("warc-type") != "response" or "warc-record-id" not in source:
        raise ValueError("no response record")
    head, gap, payload = block.partition(b"\r\n\r\n")
    status, _, fields = head.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("no HTTP response")
    http = _headers(fields)
    body = decoded(payload, http)
    charset = re.search(r"charset=\"?([\w.-]+)", http.get("content-type", ""), re.I)
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    title, text, links = page_text(page)
    about = {
        "status": status.decode("latin-1"),
        "source_headers": source.all(),
        "http_headers": http.all(),
        "title": title,
        "links": links,
    }
    shared = [(n, source[n.lower()]) for n in ("WARC-Date", "WARC-Target-URI") if n.lower() in source]
    out = []
    for kind, content_type, content in (
        ("metadata", "application/json", json.dumps(about, ensure_ascii=False, sort_keys=True).encode("utf-8", "replace")),
        ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")),
    ):
        headers = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(SPACE, kind + source['warc-record-id'])}>"),
            ("WARC-Refers-To", source["warc-record-id"]),
            *shared,
            ("WARC-Source-Payload-Digest", source.get("warc-payload-digest") or digest(payload)),
            ("WARC-Block-Digest", digest(content)),
            ("Content-Type", content_type),
        ]
        out.append(record(headers, content))
    return out[0], out[1]


#: Pages or records that a task works on at once.
ROWS = 500


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)
    give_back()


def response_batches(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    """(id, record) from batches of (id, url, html)."""
    for batch in _slices(batches):
        ids, urls, pages = (c.to_pylist() for c in batch.columns)
        made = [response(str(i), u or "", p or "", date) for i, u, p in zip(ids, urls, pages, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=[batch.schema.names[0], "record"])


def derived_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, kind, record, error) from batches of (id, record)."""
    for batch in _slices(batches):
        source, rows = [], []
        for i, raw in enumerate(batch.column(1).to_pylist()):
            try:
                made = derive_record(raw or b"")
                rows += [("metadata", made[0], None), ("conversion", made[1], None)]
                source += [i, i]
            except ValueError as wrong:
                rows.append((None, None, str(wrong)))
                source.append(i)
        kinds, made, errors = zip(*rows, strict=True) if rows else ((), (), ())
        columns = [batch.column(0).take(pa.array(source, pa.int64())), pa.array(kinds, pa.string()), pa.array(made, pa.binary()), pa.array(errors, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[batch.schema.names[0], "kind", "record", "error"])


DATE = "2024-01-01T00:00:00Z"
DERIVED = "kind string, record binary, error string"


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> tuple[DataFrame, str]:
    rows = pages.select(id_col, F.col(url_col).cast("string").alias("__url"), F.col(html_col).cast("string").alias("__html"))
    return rows, f"`{id_col}` {rows.schema[0].dataType.simpleString()}"


def responses(pages: DataFrame, date: str = DATE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, record) with a response record of every page."""
    rows, kind = _pages(pages, id_col, url_col, html_col)
    return rows.mapInArrow(lambda batches: response_batches(batches, date), f"{kind}, record binary")


def derive(records: DataFrame, id_col: str = "page_id", record_col: str = "record") -> DataFrame:
    """(id, kind, record, error): two rows of each response record, or one with an error."""
    rows = records.select(id_col, record_col)
    return rows.mapInArrow(derived_batches, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, {DERIVED}")


def derive_pages(pages: DataFrame, date: str = DATE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """derive(responses(pages)) in one stage, so that one worker a task holds records."""
    rows, kind = _pages(pages, id_col, url_col, html_col)
    return rows.mapInArrow(lambda batches: derived_batches(response_batches(batches, date)), f"{kind}, {DERIVED}")


def write(records: DataFrame, record_col: str = "record", folder: str | None = None) -> DataFrame:
    """Write records to files of gzip members; the manifest (path, n_records)."""
    folder = folder or new_path(records.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, name = place(folder)
        system.create_dir(name)
        stream, files = None, []
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                if raw is None:
                    continue
                if stream is None:
                    files.append([f"{uuid.uuid4().hex}.warc.gz", 0])
                    stream = system.open_output_stream(f"{name}/{files[-1][0]}", compression=None)
                squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                stream.write(squeeze.compress(raw) + squeeze.flush())
                files[-1][1] += 1
                if stream.tell() >= FILE_BYTES:
                    stream.close()
                    stream = None
        if stream is not None:
            stream.close()
        paths, counts = [f"{folder}/{f}" for f, _ in files], [n for _, n in files]
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "n_records"])

    return materialize(records.select(record_col).mapInArrow(run, "path string, n_records bigint"), "warc-manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    held = stream.read(1 << 20)
    while held:
        inflate = zlib.decompressobj(31)
        parts = []
        while not inflate.eof:
            if not held:
                raise ValueError("the last member is cut off")
            parts.append(inflate.decompress(held))
            held = inflate.unused_data if inflate.eof else stream.read(1 << 20)
        yield b"".join(parts)
        held = held or stream.read(1 << 20)


FIELDS = {
    "record_id": "warc-record-id",
    "kind": "warc-type",
    "refers_to": "warc-refers-to",
    "target_uri": "warc-target-uri",
    "source_digest": "warc-source-payload-digest",
    "block_digest": "warc-block-digest",
}


def read(manifest: DataFrame) -> DataFrame:
    """(record_id, kind, refers_to, target_uri, source_digest, block_digest, content) of all records; digests are checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*FIELDS, "content"]
        types = [*[pa.string()] * len(FIELDS), pa.binary()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = place(path)
                rows, size = [], 0
                with system.open_input_stream(name, compression=None) as stream:
                    for raw in members(stream):
                        headers, block = parse(raw)
                        rows.append((*(headers.get(f) for f in FIELDS.values()), block))
                        size += len(block)
                        if size > 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    n = manifest.count()
    return manifest.select("path").repartition(max(1, n)).mapInArrow(run, ", ".join(f"{f} string" for f in FIELDS) + ", content binary")
