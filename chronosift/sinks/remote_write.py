"""Remote write: series as protobuf write requests, in bounded requests, Snappy-compressed."""

from __future__ import annotations

import struct
import urllib.request

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: samples of one request at most.
MAX_SAMPLES = 5000
#: Samples that a worker holds as Python objects, beside a single longer series.
HELD = 100_000


def varint(n: int) -> bytes:
    """Base-128 varint; negative numbers as 64-bit two's complement."""
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, body: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(body)) + body


def encode_series(labels: dict[str, str], samples: list[tuple[int, float]]) -> bytes:
    """One TimeSeries message: labels by name, then samples."""
    if not labels.get("__name__"):
        raise ValueError("a series needs a __name__ label")
    parts = [_field(1, _field(1, k.encode()) + _field(2, v.encode())) for k, v in sorted(labels.items())]
    parts += [_field(2, b"\x09" + struct.pack("<d", float(v)) + (b"\x10" + varint(int(t)))) for t, v in samples]
    return b"".join(parts)


def encode_request(series: list[tuple[dict[str, str], list[tuple[int, float]]]]) -> bytes:
    """A WriteRequest; series without samples are left out."""
    return b"".join(_field(1, encode_series(labels, samples)) for labels, samples in series if samples)


def chunks(series: list[tuple[dict[str, str], list]], most: int = MAX_SAMPLES) -> list[list[tuple[dict[str, str], list]]]:
    """Requests of at most ``most`` samples, filled in order; a longer series is split."""
    out, room = [], 0
    for labels, samples in series:
        at = 0
        while at < len(samples):
            if not room:
                out.append([])
                room = most
            part = samples[at : at + room]
            if len(part) < len(samples) - at and out[-1] and len(samples) <= most:
                out.append([])  # a series that fits one request isn't split
                room = most
                part = samples[at : at + room]
            out[-1].append((labels, part))
            at += len(part)
            room -= len(part)
    return out


def compress(raw: bytes) -> bytes:
    """Snappy block format, or the same format with literals only where there is no codec."""
    try:
        return pa.Codec("snappy").compress(raw, asbytes=True)
    except (ImportError, NotImplementedError, pa.ArrowInvalid):
        out = [varint(len(raw))]
        for at in range(0, len(raw), 1 << 16):
            part = raw[at : at + (1 << 16)]
            out.append(bytes([61 << 2]) + struct.pack("<H", len(part) - 1) + part)
        return b"".join(out)


def pieces(series: DataFrame, most: int = MAX_SAMPLES) -> DataFrame:
    """Series (labels, samples) cut to pieces of at most ``most`` samples: (series_id, piece, labels, samples)."""
    keyed = series.withColumn("series_id", F.xxhash64(F.to_json("labels"))).withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("samples") / most).cast("int") - 1))))
    return keyed.where(F.size("samples") > 0).select("series_id", "piece", "labels", F.slice("samples", F.col("piece") * most + 1, most).alias("samples"))


def requests(series: DataFrame, most: int = MAX_SAMPLES, partitions: int | None = 8, in_order: bool = False) -> DataFrame:
    """(n_samples, body) of compressed requests; each partition of series fills its own. Without ``partitions`` series stay where they are; ``in_order`` keeps all pieces
    of a series in one, by time."""

    def run(batches):
        for batch in batches:
            labels, samples = batch.column(0), batch.column(1)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(samples), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:  # so many samples are held as objects at once, or a series
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HELD, "right")))
                whole = [(dict(x), [(p["ts_ms"], p["value"]) for p in ps or []]) for x, ps in zip(labels.slice(at, upto - at).to_pylist(), samples.slice(at, upto - at).to_pylist(), strict=True)]
                rows = [(sum(len(ps) for _, ps in c), compress(encode_request(c))) for c in chunks(whole, most)]
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["n_samples", "body"])
                at = upto

    if in_order:
        keyed = series.withColumn("_series", F.xxhash64(F.to_json("labels"))).withColumn("_first", F.get("samples", F.lit(0))["ts_ms"])
        dealt = (keyed.repartition(partitions, "_series") if partitions else keyed.repartition("_series")).sortWithinPartitions("_series", "_first")
    else:
        dealt = series.repartition(partitions) if partitions else series
    return dealt.select("labels", "samples").mapInArrow(run, "n_samples long, body binary")


def _unvarint(raw: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = raw[at]
        n |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return n, at


def _fields(raw: bytes):
    """(number, value) of a message: bytes, doubles, or whole numbers as signed 64 bits."""
    at = 0
    while at < len(raw):
        tag, at = _unvarint(raw, at)
        if tag & 7 == 2:
            size, at = _unvarint(raw, at)
            yield tag >> 3, raw[at : at + size]
            at += size
        elif tag & 7 == 1:
            yield tag >> 3, struct.unpack_from("<d", raw, at)[0]
            at += 8
        elif tag & 7 == 0:
            n, at = _unvarint(raw, at)
            yield tag >> 3, n - (1 << 64) if n >> 63 else n
        else:
            raise ValueError(f"unexpected wire type {tag & 7}")


def decode_request(raw: bytes) -> list[tuple[dict[str, str], list[tuple[int, float]]]]:
    """The series of an uncompressed WriteRequest."""
    out = []
    for _, series in _fields(raw):
        labels, samples = {}, []
        for number, body in _fields(series):
            parts = dict(_fields(body))
            if number == 1:
                labels[parts[1].decode()] = parts[2].decode()
            elif number == 2:
                samples.append((parts.get(2, 0), parts.get(1, 0.0)))
        out.append((labels, samples))
    return out


def received(bodies: DataFrame, col: str = "body") -> DataFrame:
    """(labels, ts_ms, value) of all samples in compressed requests, as a receiver reads them."""

    def run(batches):
        codec = pa.Codec("snappy")
        for batch in batches:
            for body in batch.column(0):
                body = body.as_py()
                size, _ = _unvarint(body, 0)
                for labels, samples in decode_request(codec.decompress(body, size, asbytes=True)):
                    n, width = len(samples), len(labels)
                    maps = pa.MapArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array([*labels] * n, pa.string()), pa.array([*labels.values()] * n, pa.string()))
                    yield pa.RecordBatch.from_arrays([maps, pa.array([t for t, _ in samples], pa.int64()), pa.array([v for _, v in samples], pa.float64())], names=["labels", "ts_ms", "value"])

    return bodies.select(col).mapInArrow(run, "labels map<string,string>, ts_ms long, value double")


def push(series: DataFrame, endpoint: str, tenant: str | None = None, timeout: float = 30.0, path: str = "/api/v1/push", most: int = MAX_SAMPLES, dry_run: bool = False) -> int:
    """Send all series from the executors; the number of samples. A dry run only counts."""
    if dry_run:
        return series.agg(F.coalesce(F.sum(F.size("samples")), F.lit(0))).first()[0]
    headers = {"Content-Type": "application/x-protobuf", "Content-Encoding": "snappy", "X-Prometheus-Remote-Write-Version": "0.1.0"} | ({"X-Scope-OrgID": tenant} if tenant else {})
    url = endpoint.rstrip("/") + path

    def send(batches):
        for pdf in batches:
            for body in pdf["body"]:
                urllib.request.urlopen(urllib.request.Request(url, data=body, headers=headers, method="POST"), timeout=timeout).close()
            yield pd.DataFrame({"n_samples": [int(pdf["n_samples"].sum())]})

    return requests(series, most, in_order=True).mapInPandas(send, "n_samples long").agg(F.coalesce(F.sum("n_samples"), F.lit(0))).first()[0]


def to_series(points: DataFrame) -> DataFrame:
    """Long points with labels as series rows."""
    return points.groupBy("group_id", "channel").agg(F.first("labels").alias("labels"), F.array_sort(F.collect_list(F.struct("ts_ms", "value"))).alias("samples")).select("labels", "samples")


def to_pieces(points: DataFrame, most: int = MAX_SAMPLES) -> DataFrame:
    """The same in pieces of at most ``most`` samples, however long a series is: no task holds it. Points are dealt by ranges of series, time and value; a range is cut every
    ``most`` rows, and where another series begins. Pieces of a series follow each other in time."""
    order = ["group_id", "channel", "ts_ms", "value"]
    row = F.monotonically_increasing_id()  # the partition, and the row in it, which starts from 0
    cut = points.select(*order, "labels").repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", row)
    piece = F.struct(F.shiftright("_row", 33).alias("part"), F.floor(F.col("_row").bitwiseAND((1 << 33) - 1) / most).alias("nth"))
    return cut.groupBy("group_id", "channel", piece.alias("_piece")).agg(F.first("labels").alias("labels"), F.array_sort(F.collect_list(F.struct("ts_ms", "value"))).alias("samples")).select("labels", "samples")


def rank_pieces(series: DataFrame, most: int) -> DataFrame:
    """Numbers of pieces and samples of each series, for planning."""
    return pieces(series, most).withColumn("n", F.size("samples")).withColumn("rn", F.row_number().over(Window.partitionBy("series_id").orderBy("piece")))
