"""Command line: ``python -m carelake <command> ...``.

  load     <landing> <root>            batch-load every landing CSV, then refresh the MART
  stream   <landing> <root> [--every]  ingest pending files (availableNow), or keep running
                                       with a processing-time trigger (e.g. --every "5 minutes")
  refresh  <root>                      rebuild the MART snapshots from stored CORE
  retain   <root>                      compact CORE and delete versions, states and snapshots of the past
  query    <root> <name> [--role R]    show a registered query over the stored warehouse
  list                                 names of the registered queries

A landing file is taken once, by whichever of load and stream sees it first.  ``stream --every`` keeps the
additive aggregates current per micro-batch.  Checkpoints are kept below the root.
"""

import argparse
import sys

from carelake.session import get_spark


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="carelake")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("load")
    a.add_argument("landing")
    a.add_argument("root")
    a.add_argument("--key", default=None, help="names the load, so that the same rows again replay it")
    s = sub.add_parser("stream")
    s.add_argument("landing")
    s.add_argument("root")
    s.add_argument("--every", default=None)
    s.add_argument("--max-files", type=int, default=None, help="files of a micro-batch, so that a backlog comes in parts")
    r = sub.add_parser("refresh")
    r.add_argument("root")
    t = sub.add_parser("retain")
    t.add_argument("root")
    q = sub.add_parser("query")
    q.add_argument("root")
    q.add_argument("name")
    q.add_argument("--role", default=None)
    q.add_argument("--rows", type=int, default=50)
    sub.add_parser("list")
    args = p.parse_args(argv)

    from carelake.plans.catalog import catalog

    if args.cmd == "list":
        print("\n".join(sorted(catalog())))
        return 0
    spark = get_spark()
    from carelake import Warehouse

    if args.cmd == "load":
        from carelake.pipeline import run_batch

        wh = Warehouse.from_landing(spark, args.landing)
        raws = {d: wh.resolve(f"raw_{d}") for d in ("patients", "appointments", "billing")}
        run_batch(spark, args.root, raws, load_key=args.key, load_once=True)
    elif args.cmd == "stream":
        from carelake.streaming import run_available, start_ingest

        if args.every:
            queries = [start_ingest(spark, args.landing, args.root, d, trigger={"processingTime": args.every},
                                    incremental=True, max_files_per_trigger=args.max_files)
                       for d in ("patients", "appointments", "billing")]
            spark.streams.awaitAnyTermination()
            for x in queries:
                x.stop()
        else:
            print(run_available(spark, args.landing, args.root, max_files_per_trigger=args.max_files))
    elif args.cmd == "refresh":
        from carelake.pipeline import refresh_mart

        refresh_mart(spark, args.root)
    elif args.cmd == "retain":
        from carelake.retention import retain

        print(retain(spark, args.root))
    elif args.cmd == "query":
        wh = Warehouse.from_storage(spark, args.root, role=args.role)
        catalog()[args.name](wh).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
