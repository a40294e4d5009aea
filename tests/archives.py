"""Small archives written byte by byte."""

from __future__ import annotations

import gzip


def record(kind: str, rid: str, body: bytes, content_type: str | None = None, uri: str = "http://a.example/",
           refers: str | None = None, length: int | None = None, version: str = "1.0",
           http: tuple[str, ...] = ()) -> bytes:
    if kind == "response":
        lines = ["HTTP/1.1 200 OK", f"Content-Type: {content_type or 'text/html'}", *http]
        body = "\r\n".join(lines).encode() + b"\r\n\r\n" + body
    head = [f"WARC/{version}", f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", f"WARC-Target-URI: {uri}"]
    if refers:
        head.append(f"WARC-Concurrent-To: <{refers}>")
    head.append(f"Content-Length: {len(body) if length is None else length}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def languages(*pairs: tuple[str, float]) -> bytes:
    listed = ",".join(f'{{"code":"{c}","text-covered":{t}}}' for c, t in pairs)
    return b'fetchTimeMs: 3\r\nlanguages-cld2: {"reliable":true,"languages":[' + listed.encode() + b"]}\r\n"


def write_gz(path, *records: bytes) -> str:
    """One gzip member per record, as crawls store them."""
    with open(path, "wb") as out:
        for r in records:
            out.write(gzip.compress(r))
    return str(path)


def write_plain(path, *records: bytes) -> str:
    with open(path, "wb") as out:
        out.write(b"".join(records))
    return str(path)


def page(text: str, title: str = "A title that is long") -> bytes:
    return f"<html><head><title>{title}</title></head><body><p>{text}</p></body></html>".encode()
