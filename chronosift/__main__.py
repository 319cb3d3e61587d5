"""``python -m chronosift run CONFIG | ingest --csv FILE ... | experiment --csv FILE ... | serve --root DIR``"""

from __future__ import annotations

import argparse
import os

from chronosift.plans import experiment, pipeline


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="chronosift")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run a pipeline configuration")
    run.add_argument("config")
    ingest = sub.add_parser("ingest", help="send a wide CSV by remote write")
    for flag in ("--csv", "--endpoint", "--instance", "--tenant", "--timestamp-column"):
        ingest.add_argument(flag, required=flag in ("--csv", "--endpoint", "--instance"))
    ingest.add_argument("--metric-prefix", default="")
    ingest.add_argument("--time-format", default="%Y-%m-%d %H:%M:%S", help="with % signs or in Spark's letters")
    ingest.add_argument("--label", action="append", default=[], metavar="K=V")
    ingest.add_argument("--end-at-now", action="store_true")
    ingest.add_argument("--dry-run", action="store_true")
    serve = sub.add_parser("serve", help="answer history queries over HTTP")
    serve.add_argument("--root", default=os.environ.get("SIGNAL_ROOT", "signals"))
    serve.add_argument("--host", default=os.environ.get("SIGNAL_HOST", "127.0.0.1"))
    serve.add_argument("--port", type=int, default=int(os.environ.get("SIGNAL_PORT", "8080")))
    trial = sub.add_parser("experiment", help="fit a forecaster to a wide CSV and print its errors", parents=[experiment.parser()])
    trial.add_argument("--csv", required=True)
    trial.add_argument("--out", help="a folder that gets the line of metrics")
    args = parser.parse_args(argv)
    if args.command == "run":
        print(pipeline.run_pipeline(pipeline.load_config(args.config)))
    elif args.command == "experiment":
        from chronosift.sinks import rows
        from chronosift.sources import files

        what = experiment.from_args(args)
        spark = pipeline.session()
        points = files.csv_points(spark, args.csv, "csv").select("channel", "ts_ms", "value")
        if what.data.features == "S":
            points = points.where(points["channel"] == what.data.target)
        found = experiment.run(points, ["channel"], ["ts_ms"], what)
        if args.out:
            rows.write_metrics(found, args.out, what.setting)
        for row in found.orderBy("part").collect():
            print(row.asDict())
    elif args.command == "ingest":
        import time

        from chronosift.sinks import remote_write
        from chronosift.sources import files

        labels = {k: v for k, _, v in (x.partition("=") for x in args.label)}
        points = files.csv_points(pipeline.session(), args.csv, args.instance, args.timestamp_column, args.metric_prefix, args.time_format, int(time.time() * 1000) if args.end_at_now else None, labels)
        print(remote_write.push(remote_write.to_pieces(points), args.endpoint, args.tenant, dry_run=args.dry_run))
    else:
        from chronosift.sinks import store

        store.serve(pipeline.session(), args.root, args.host, args.port).serve_forever()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
