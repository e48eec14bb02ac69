"""Metadata and plain-text conversion records made from WARC response records.

Each response gives two records, linked to it by ``WARC-Refers-To``: *metadata*
(``application/warc-fields``: title, language, character set, source headers, source
digest, links) and *conversion* (``text/plain``: the text that a reader sees). Record ids
are name-based: the same response gives the same ids in every run, also after a lost
executor. Digests are SHA-256, as ``sha256:<hex>``.

Text: comments and the contents of script, style, noscript and template go, tags of blocks
become line ends, other tags go, character references are resolved, blanks are joined,
empty lines go. A response of null payload counts as an empty one, a null URI or date
leaves its header out. Repeated responses give repeated records. A comment, element or tag that
is never closed is text. Work grows in proportion to the payload, also for very long ones with
many unclosed tags. No responses give no records; columns named like a record's are replaced.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmine.llm.text import slices, widened

RESPONSE = "record_id string, target_uri string, warc_date string, http_headers string, payload string"
RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length long, block_digest string, source_digest string, source_headers string, block string"
)

# Each pattern is applied so that no stretch of a page is read more than a few times, whatever
# is left open in it: tags end at the next ">", so none is looked for behind the last one.
_OPENING = re.compile(r"(?i)<!--|<(script|style|noscript|template)\b")
_CLOSING = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "noscript", "template")}
_CLOSING[None] = re.compile("-->")
_BLOCK = re.compile(
    r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|"
    r"section|table|td|th|title|tr|ul)\b[^>]*>")
_TAG = re.compile(r"<[A-Za-z/!?][^>]*>")
_TITLE = re.compile(r"(?i)<title\b[^>]*>")
_TITLE_END = re.compile(r"(?i)</title\s*>")
_HTML = re.compile(r"(?i)<html\b[^>]*")
_LANGUAGE = re.compile(r"(?i)\blang\s*=\s*[\"']?([A-Za-z-]+)")
_CHARSET = re.compile(r"(?i)\bcharset\s*=\s*[\"']?([A-Za-z0-9_-]+)")
_ANCHOR = re.compile(r"(?i)<a\b")
_HREF = re.compile(r"(?i)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")


def digest(block: str) -> str:
    return "sha256:" + hashlib.sha256(block.encode()).hexdigest()


def named_id(*parts: str) -> str:
    """A record id that follows from the parts alone."""
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(chr(0).join(parts).encode()).hexdigest())}>"


def without_hidden(markup: str) -> str:
    """A blank in place of each comment and each element that is not shown; unclosed ones stay."""
    out, kept, at, unclosed = [], 0, 0, set()
    while opening := _OPENING.search(markup, at):
        name = opening[1] and opening[1].lower().replace("ſ", "s")
        closing = None if name in unclosed else _CLOSING[name].search(markup, opening.end())
        if closing:
            out.append(markup[kept : opening.start()])
            kept = at = closing.end()
        else:
            unclosed.add(name)  # nor is any later one closed
            at = opening.start() + 1
    return " ".join([*out, markup[kept:]])


def _sub_tags(tag: re.Pattern[str], by: str, markup: str) -> str:
    end = markup.rfind(">") + 1
    return tag.sub(by, markup[:end]) + markup[end:]


def visible_text(shown: str) -> str:
    """What a reader sees of markup without hidden elements, one line a block."""
    text = html.unescape(_sub_tags(_TAG, "", _sub_tags(_BLOCK, "\n", shown)))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def links_of(shown: str) -> Iterator[str]:
    """The ``href`` of each anchor that has one, as written."""
    at, end, href = 0, 0, _HREF.search(shown)
    while href and (anchor := _ANCHOR.search(shown, at)):
        if href.start() < anchor.end():
            href = _HREF.search(shown, anchor.end())
        if 0 <= end < anchor.end():
            end = shown.find(">", anchor.end())
        if href and (end < 0 or href.start() < end):
            yield href[1] or href[2] or href[3] or ""
            at = href.end()
        elif end < 0:
            return
        else:
            at = end


def _title(payload: str) -> str:
    opening = _TITLE.search(payload, 0, payload.rfind(">") + 1)
    closing = opening and _TITLE_END.search(payload, opening.end())
    return payload[opening.end() : closing.start()] if closing else ""


def _language(payload: str) -> str:
    found = (_LANGUAGE.search(payload, m.start() + len("<html"), m.end()) for m in _HTML.finditer(payload))
    return next((m[1] for m in found if m), "")


def metadata_fields(payload: str, shown: str, uri: str | None, headers: str | None, source_digest: str) -> str:
    """The block of a metadata record; ``shown`` is the payload without hidden elements."""
    charset = _CHARSET.search(payload)
    fields = [("title", " ".join(html.unescape(_title(payload)).split())), ("language", _language(payload)),
              ("charset", charset[1] if charset else ""), ("source-payload-digest", source_digest)]
    fields += [("source-header", line) for line in (headers or "").splitlines() if line]
    seen = dict.fromkeys(html.unescape(link).strip() for link in links_of(shown))
    fields += [("outlink", _resolved(uri, link)) for link in seen if link and not link.startswith("#")]
    return "".join(f"{name}: {' '.join(value.split())}\r\n" for name, value in fields if value)


def _resolved(uri: str | None, link: str) -> str:
    try:
        return urljoin(uri or "", link)
    except ValueError:  # not an address; kept as it stands
        return link


def _derive(kept: list[str]):
    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in RECORD.split(", ")]
        for batch in slices(batches, "payload"):
            rows, out = [], {n: [] for n in names}
            columns = [batch.column(c).to_pylist() for c in ("record_id", "target_uri", "warc_date", "http_headers", "payload")]
            for row, (source, uri, date, headers, payload) in enumerate(zip(*columns)):
                payload = payload or ""
                source_digest = digest(payload)
                shown = without_hidden(payload)
                blocks = (("metadata", "application/warc-fields", metadata_fields(payload, shown, uri, headers, source_digest)),
                          ("conversion", "text/plain; charset=utf-8", visible_text(shown)))
                for kind, content_type, block in blocks:
                    rows.append(row)
                    values = (kind, named_id(kind, source or "", source_digest), source, uri, date, content_type,
                              len(block.encode()), digest(block), source_digest, headers, block)
                    for name, value in zip(names, values):
                        out[name].append(value)
            take = pa.array(rows, pa.int64())
            arrays = [batch.column(c).take(take) for c in kept]
            arrays += [pa.array(out[n], pa.int64() if n == "content_length" else pa.string()) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *names])

    return derive


def derive_records(responses: DataFrame) -> DataFrame:
    """Metadata and conversion records of ``responses``, with the columns of ``RECORD``.

    Needs the columns of ``RESPONSE``. Further columns are carried along unless their name
    is one of a record's.
    """
    names = [field.split()[0] for field in RECORD.split(", ")]
    kept = [c for c in responses.columns if c not in (*names, "http_headers", "payload")]
    return responses.mapInArrow(_derive(kept), widened(responses.select(*kept), RECORD))


def responses_of_pages(pages: DataFrame, warc_date: str) -> DataFrame:
    """``page_id``, ``url``, ``html`` as the response records of a crawl on a date."""
    length = F.coalesce(F.octet_length("html"), F.lit(0))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length, F.lit("\r\n"))
    name = F.md5(F.concat_ws("\x00", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                             F.coalesce("url", F.lit("")), F.sha2(F.coalesce("html", F.lit("")), 256)))
    dashed = F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return pages.select(
        "page_id", F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("record_id"), F.col("url").alias("target_uri"),
        F.lit(warc_date).alias("warc_date"), headers.alias("http_headers"), F.col("html").alias("payload"))


def record_text(records: DataFrame) -> DataFrame:
    """``value``: each record in WARC 1.1 form, without the very last line feed."""
    header = lambda name, column: F.when(F.col(column).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(column), F.lit("\r\n")))
    parts = [F.lit("WARC/1.1\r\n")]
    parts += [header(n, c) for n, c in (
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length"))]
    return records.select(F.concat(F.concat_ws("", *parts), F.lit("\r\n"), "block", F.lit("\r\n\r")).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as WARC files below ``path``, one a partition."""
    record_text(records).write.option("lineSep", "\n").text(path)
