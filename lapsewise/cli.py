"""Command-line entry points for the pipeline steps.

    python -m lapsewise.cli clean   SRC OUT
    python -m lapsewise.cli load    ROOT --clients C --products P --lapses L
    python -m lapsewise.cli marts   ROOT OUT
    python -m lapsewise.cli test    ROOT [--provinces A,B,C]
    python -m lapsewise.cli ingest  SRC OUT ERROR AUDIT CHECKPOINT [--max-files N]

``--master`` selects the Spark master (default: as configured by
spark-submit / the environment).
"""

from __future__ import annotations

import argparse
import json
import sys


#: Files whose profile is also printed; all are written.
PRINTED_FILES = 50


def _session(args):
    from lapsewise.session import build_session, use_private_checkpoints

    spark = build_session(args.master, app_name=f"lapsewise-{args.cmd}")
    use_private_checkpoints(spark)
    return spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="lapsewise")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean", help="clean header-less delimited text files to CSV")
    c.add_argument("src")
    c.add_argument("out")
    ld = sub.add_parser("load", help="load the star schema (dims insert-if-absent, fact reload)")
    ld.add_argument("root")
    ld.add_argument("--clients", required=True)
    ld.add_argument("--products", required=True)
    ld.add_argument("--lapses", required=True)
    ld.add_argument("--calendar", default="2024-01-01,2024-04-30")
    ld.add_argument("--policies", default="1001,1100")
    ld.add_argument("--num-clients", type=int, default=8)
    ld.add_argument("--num-products", type=int, default=5)
    m = sub.add_parser("marts", help="build dim_patients and the claims summary")
    m.add_argument("root")
    m.add_argument("out")
    for p in (ld, m):
        p.add_argument("--plain", action="store_true", help="write plain Parquet folders, not tables in versions")
    t = sub.add_parser("test", help="run the model tests; non-zero exit on failure")
    t.add_argument("root")
    t.add_argument("--provinces", default=None)
    i = sub.add_parser("ingest", help="convert newly arrived Parquet files to CSV")
    i.add_argument("src")
    i.add_argument("out")
    i.add_argument("error")
    i.add_argument("audit")
    i.add_argument("checkpoint")
    i.add_argument("--max-files", type=int, default=1000)
    i.add_argument("--continuous", metavar="SECONDS", type=int, default=None,
                   help="keep running: new and changed files every SECONDS")
    args = ap.parse_args(argv)
    spark = _session(args)
    from lapsewise.session import release_scratch

    try:
        return _run(spark, args)
    finally:
        release_scratch(spark)
        spark.stop()


def _in_versions(spark, plain: bool, root: str) -> bool:
    """Tables in versions, unless plain ones are asked for or are there already."""
    from lapsewise.operators.loading import hadoop_fs
    from lapsewise.operators.versioned import is_versioned

    fs, folder = hadoop_fs(spark, root)
    held = [s.getPath().toString() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return not plain and all(is_versioned(spark, p) for p in held)


def _run(spark, args) -> int:
    """One command; the exit status."""
    status = 0
    from lapsewise import schemas
    from lapsewise.plans import models, warehouse

    if args.cmd == "clean":
        from lapsewise.operators import textclean

        res = textclean.clean_files(spark, args.src, args.out)
        report = f"{args.out.rstrip('/')}/profiles"
        res["profiles"].drop("_first").write.mode("overwrite").option("partitionOverwriteMode", "static").json(report)
        profiles, empty = spark.read.json(report), res["empty_files"].count()
        files = profiles.count()
        summary = {"files": files, "files_without_data": empty, "rejected_rows": res["rejects"].count(), "profiles": report}
        print(json.dumps(summary))
        for r in profiles.limit(PRINTED_FILES).collect() if files else []:
            print(json.dumps(r.asDict()))
        if not files:
            print("no file holds data", file=sys.stderr)
            status = 1
    elif args.cmd == "load":
        cal = tuple(args.calendar.split(","))
        pol = tuple(int(x) for x in args.policies.split(","))
        paths = warehouse.load_warehouse(
            spark, args.root, args.clients, args.products, args.lapses,
            calendar=cal, policies=pol, num_clients=args.num_clients, num_products=args.num_products,
            versioned=_in_versions(spark, args.plain, args.root),
        )
        print(json.dumps(paths))
    elif args.cmd == "marts":
        paths = {n: f"{args.root.rstrip('/')}/{n}" for n in schemas.TABLES}
        print(json.dumps(warehouse.build_marts(spark, warehouse.read_warehouse(spark, paths), args.out,
                                               versioned=_in_versions(spark, args.plain, args.out))))
    elif args.cmd == "test":
        from lapsewise.operators import quality as Q

        paths = {n: f"{args.root.rstrip('/')}/{n}" for n in schemas.TABLES}
        t = warehouse.read_warehouse(spark, paths)
        stg = models.stg_clients(t["dim_clients"], ["client_id"])
        patients = models.dim_patients(stg)
        frames = {
            "stg_clients": stg,
            "stg_products": models.stg_products(t["dim_products"]),
            "stg_health_lapses": models.stg_health_lapses(t["fct_health_lapses"], t["dim_policy"]),
            "dim_patients": patients,
            "fct_patient_claims_summary": models.patient_claims_summary(
                t["fct_health_lapses"], t["dim_policy"], patients
            ),
        }
        provinces = args.provinces.split(",") if args.provinces else warehouse.DEFAULT_PROVINCES
        rows = Q.run_checks(warehouse.model_tests(provinces), frames).collect()
        for r in rows:
            print(f"{'PASS' if r.failures == 0 else 'FAIL'} {r.test_name} ({r.failures})")
        return 0 if all(r.failures == 0 for r in rows) else 1
    elif args.cmd == "ingest":
        from lapsewise.streaming.ingest import ParquetToCsvIngest

        job = ParquetToCsvIngest(
            spark, args.src, args.out, args.error, args.audit, args.checkpoint,
            max_files_per_trigger=args.max_files,
        )
        if args.continuous is None:
            job.run_once()
        else:
            job.start_continuous(f"{args.continuous} seconds")
            spark.streams.awaitAnyTermination()
    return status


if __name__ == "__main__":
    sys.exit(main())
