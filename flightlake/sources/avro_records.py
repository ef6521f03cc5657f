"""Records of an Avro object container file, decoded inside a task.

Used by the ``tarstates`` source for ``.avro`` archive members when
``fastavro`` is not installed. Follows the public Avro 1.x specification:
header (magic, metadata map with the writer schema and codec, sync marker),
then blocks of ``count`` records. Codecs: ``null`` and ``deflate``. Types:
all primitives, records, enums, arrays, maps, unions and fixed; logical types
are returned as their underlying values.
"""

from __future__ import annotations

import io
import json
import struct
import zlib
from collections.abc import Iterator
from typing import Any

MAGIC = b"Obj\x01"


class _Reader:
    def __init__(self, data: bytes):
        self.buf = io.BytesIO(data)

    def read(self, n: int) -> bytes:
        b = self.buf.read(n)
        if len(b) != n:
            raise EOFError("truncated avro data")
        return b

    def long(self) -> int:
        shift, acc = 0, 0
        while True:
            b = self.read(1)[0]
            acc |= (b & 0x7F) << shift
            if not b & 0x80:
                break
            shift += 7
        return (acc >> 1) ^ -(acc & 1)

    def bytes_(self) -> bytes:
        return self.read(self.long())


def _decode(schema: Any, r: _Reader, named: dict[str, Any]) -> Any:
    if isinstance(schema, list):                       # union
        return _decode(schema[r.long()], r, named)
    if isinstance(schema, dict):
        t = schema["type"]
        if t == "record":
            named[schema["name"]] = schema
            return {f["name"]: _decode(f["type"], r, named) for f in schema["fields"]}
        if t == "enum":
            named[schema["name"]] = schema
            return schema["symbols"][r.long()]
        if t == "fixed":
            named[schema["name"]] = schema
            return r.read(schema["size"])
        if t in ("array", "map"):
            out: Any = [] if t == "array" else {}
            while True:
                n = r.long()
                if n == 0:
                    break
                if n < 0:
                    n = -n
                    r.long()                            # block size in bytes
                for _ in range(n):
                    if t == "array":
                        out.append(_decode(schema["items"], r, named))
                    else:
                        k = r.bytes_().decode("utf-8")
                        out[k] = _decode(schema["values"], r, named)
            return out
        return _decode(t, r, named)                     # primitive with attributes
    if schema == "null":
        return None
    if schema == "boolean":
        return r.read(1) != b"\x00"
    if schema in ("int", "long"):
        return r.long()
    if schema == "float":
        return struct.unpack("<f", r.read(4))[0]
    if schema == "double":
        return struct.unpack("<d", r.read(8))[0]
    if schema == "bytes":
        return r.bytes_()
    if schema == "string":
        return r.bytes_().decode("utf-8", errors="ignore")
    if schema in named:
        return _decode(named[schema], r, named)
    raise ValueError(f"unsupported avro type {schema!r}")


def read_records(f) -> Iterator[dict]:
    """Yield the records of an Avro container read from the binary stream ``f``."""
    data = f.read()
    r = _Reader(data)
    if r.read(4) != MAGIC:
        raise ValueError("not an avro container")
    meta: dict[str, bytes] = {}
    while True:
        n = r.long()
        if n == 0:
            break
        if n < 0:
            n = -n
            r.long()
        for _ in range(n):
            k = r.bytes_().decode("utf-8")
            meta[k] = r.bytes_()
    sync = r.read(16)
    schema = json.loads(meta["avro.schema"])
    codec = meta.get("avro.codec", b"null").decode()
    if codec not in ("null", "deflate"):
        raise ValueError(f"unsupported avro codec {codec}")
    while r.buf.tell() < len(data):
        count = r.long()
        block = r.bytes_()
        if r.read(16) != sync:
            raise ValueError("avro sync marker mismatch")
        if codec == "deflate":
            block = zlib.decompress(block, -15)
        br = _Reader(block)
        named: dict[str, Any] = {}
        for _ in range(count):
            yield _decode(schema, br, named)
