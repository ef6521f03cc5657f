"""Avro members of state archives: decoder and alias mapping."""

import io
import json
import struct
import zlib

from flightlake.operators.ingest import accept_members
from flightlake.sources.avro_records import read_records
from flightlake.sources.tarstates import register

from .test_sources import make_tar

SCHEMA = {"type": "record", "name": "State", "fields": [
    {"name": "time", "type": "long"}, {"name": "icao24", "type": "string"},
    {"name": "latitude", "type": ["null", "double"]}, {"name": "longitude", "type": ["null", "double"]},
    {"name": "speed", "type": ["null", "float"]}, {"name": "onground", "type": "boolean"},
    {"name": "geo_altitude", "type": ["null", "double"]}, {"name": "altitude", "type": ["null", "double"]},
    {"name": "tags", "type": {"type": "array", "items": "string"}}]}


def zz(n):
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        if n:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def s(x):
    b = x.encode() if isinstance(x, str) else x
    return zz(len(b)) + b


def union(v, enc):
    return zz(0) if v is None else zz(1) + enc(v)


def encode(rec):
    return (zz(rec["time"]) + s(rec["icao24"]) + union(rec["latitude"], lambda v: struct.pack("<d", v))
            + union(rec["longitude"], lambda v: struct.pack("<d", v)) + union(rec["speed"], lambda v: struct.pack("<f", v))
            + (b"\x01" if rec["onground"] else b"\x00") + union(rec["geo_altitude"], lambda v: struct.pack("<d", v))
            + union(rec["altitude"], lambda v: struct.pack("<d", v))
            + (zz(len(rec["tags"])) + b"".join(s(t) for t in rec["tags"]) + zz(0) if rec["tags"] else zz(0)))


def container(records, codec="null"):
    sync = bytes(range(16))
    meta = {"avro.schema": json.dumps(SCHEMA).encode(), "avro.codec": codec.encode()}
    head = b"Obj\x01" + zz(len(meta)) + b"".join(s(k) + s(v) for k, v in meta.items()) + zz(0) + sync
    block = b"".join(encode(r) for r in records)
    if codec == "deflate":
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        block = c.compress(block) + c.flush()
    return head + zz(len(records)) + s(block) + sync


RECS = [
    {"time": 1700000000, "icao24": "abc", "latitude": 50.5, "longitude": 8.25, "speed": 100.5, "onground": False,
     "geo_altitude": None, "altitude": 1200.0, "tags": ["x", "y"]},
    {"time": 1700000010, "icao24": "def", "latitude": None, "longitude": -1.0, "speed": None, "onground": True,
     "geo_altitude": 300.0, "altitude": 9.0, "tags": []},
]


def test_decoder_codecs():
    for codec in ("null", "deflate"):
        got = list(read_records(io.BytesIO(container(RECS, codec))))
        assert got[0]["tags"] == ["x", "y"] and got[1]["latitude"] is None and got[1]["onground"] is True
        assert abs(got[0]["speed"] - 100.5) < 1e-6


def test_avro_member_through_ingest(spark, tmp_path):
    register(spark)
    tar = make_tar(tmp_path / "avro.tar", [("part.avro", container(RECS, "deflate"))])
    rows = accept_members(spark.read.format("tarstates").load(tar), "strict").orderBy("time").collect()
    assert [r.time for r in rows] == ["1700000000", "1700000010"]
    a, b = rows
    assert (a.lat, a.lon, a.velocity, a.onground, a.geoaltitude) == ("50.5", "8.25", "100.5", "False", "1200.0")
    assert (b.lat, b.velocity, b.onground, b.geoaltitude, b.heading) == ("", "", "True", "300.0", "")


def test_values_with_commas_stay_whole(spark, tmp_path):
    register(spark)
    rec = dict(RECS[0], icao24="AB,C")
    tar = make_tar(tmp_path / "comma.tar", [("part.avro", container([rec]))])
    for mode in ("strict", "lenient"):
        row = accept_members(spark.read.format("tarstates").load(tar), mode).first()
        assert (row.icao24, row.onground, row.alert) == ("AB,C", "False", "")
