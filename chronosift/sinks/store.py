"""The signal history: an append-only Parquet folder, and queries by entity, metric and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronosift.schema import SIGNAL, labels_json

#: At rest labels are JSON text with sorted keys.
STORED = "entity_uid string, metric_name string, ts long, severity string, score double, method string, horizon string, n_points long, labels string, text string"


class SignalStore:
    """Signals under ``root`` (any path that Spark can write)."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def write(self, signals: DataFrame, files: int | None = None, batch: str | None = None) -> bool:
        """Append; sorted within files so that queries skip row groups. Nothing is written for no rows.

        With ``batch``, a name, the rows replace what an earlier try of that batch has written.
        """
        rows = signals.withColumn("labels", labels_json(F.col("labels"))).select(*[c.split()[0] for c in STORED.split(", ")])
        rows = rows.coalesce(files) if files else rows
        held = rows.persist()  # computed once for the two looks at it
        try:
            if held.isEmpty():
                return False
            out = held.sortWithinPartitions("entity_uid", "metric_name", "ts").write
            out.mode("overwrite" if batch else "append").parquet(f"{self.root}/batch-{batch}" if batch else self.root)
            return True
        finally:
            held.unpersist()

    def read(self) -> DataFrame:
        """All signals; missing text fields read as empty. A root that doesn't exist is an empty history."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], SIGNAL)
        return decode(self._stored())

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(STORED).option("recursiveFileLookup", "true").parquet(self.root)

    def query(self, entity: str, metric: str | None = None, since: int | None = None, until: int | None = None, limit: int | None = None) -> DataFrame:
        """An entity's signals in order of time; bounds are inclusive."""
        return history(self.read(), entity, metric, since, until, limit)

    def latest(self, entity: str | None = None, metric: str | None = None) -> DataFrame:
        """The newest signal of each (entity, metric)."""
        rows = self.read()
        if entity is not None:
            rows = rows.where(F.col("entity_uid") == entity)
        if metric is not None:
            rows = rows.where(F.col("metric_name") == metric)
        return newest(rows)

    def compact(self, target: str, files: int) -> None:
        """The history in fewer files, in another folder."""
        self._stored().repartitionByRange(files, "entity_uid", "metric_name", "ts").sortWithinPartitions("entity_uid", "metric_name", "ts").write.parquet(target)


def decode(rows: DataFrame) -> DataFrame:
    empty = F.create_map().cast("map<string,string>")
    return rows.withColumns({"labels": F.coalesce(F.from_json("labels", "map<string,string>"), empty), "horizon": F.coalesce("horizon", F.lit("")), "text": F.coalesce("text", F.lit(""))})


def history(signals: DataFrame, entity: str, metric: str | None = None, since: int | None = None, until: int | None = None, limit: int | None = None) -> DataFrame:
    rows = signals.where(F.col("entity_uid") == entity)
    if metric is not None:
        rows = rows.where(F.col("metric_name") == metric)
    if since is not None:
        rows = rows.where(F.col("ts") >= since)
    if until is not None:
        rows = rows.where(F.col("ts") <= until)
    rows = rows.orderBy("ts", "metric_name")
    return rows if limit is None else rows.limit(limit)


def newest(signals: DataFrame) -> DataFrame:
    order = Window.partitionBy("entity_uid", "metric_name").orderBy(F.desc("ts"), F.desc("score"), "severity")
    return signals.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def signal_history(spark: SparkSession, root: str, entity: str, metric: str | None = None, since: int | None = None, until: int | None = None, limit: int | None = None) -> dict:
    """The answer of the history endpoint."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be 1 or more")
    rows = [r.asDict(recursive=True) for r in SignalStore(spark, root).query(entity, metric, since, until, limit).collect()]
    return {"entity": entity, "metric": metric, "count": len(rows), "signals": rows}


def serve(spark: SparkSession, root: str, host: str = "127.0.0.1", port: int = 8080):
    """An HTTP server with GET /health and GET /api/v1/signals/history; call serve_forever() on it."""
    import json
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from urllib.parse import parse_qs, urlparse

    class Handler(BaseHTTPRequestHandler):
        def _send(self, code: int, body: dict) -> None:
            raw = json.dumps(body).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def do_GET(self) -> None:  # noqa: N802
            url = urlparse(self.path)
            q = {k: v[0] for k, v in parse_qs(url.query).items()}
            if url.path == "/health":
                self._send(200, {"status": "ok"})
            elif url.path != "/api/v1/signals/history":
                self._send(404, {"error": "not found"})
            else:
                try:
                    number = {k: int(q[k]) if k in q else None for k in ("since", "until", "limit")}
                    self._send(200, signal_history(spark, root, q["entity"], q.get("metric"), **number))
                except (KeyError, ValueError) as bad:
                    self._send(422, {"error": str(bad)})

        def log_message(self, *args) -> None:
            return

    return ThreadingHTTPServer((host, port), Handler)
