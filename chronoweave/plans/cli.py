"""Command-line entry for ``spark-submit``: build a dataset from the two JSON documents (the
sources with their tags, and the import rule), or read a stored dataset back.

    spark-submit chronoweave/plans/cli.py import '<sources json>' '<rule json>' --store <folder>
    spark-submit chronoweave/plans/cli.py read <dataset id> --store <folder> [--out <folder>]
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None, spark=None) -> int:
    parser = argparse.ArgumentParser(prog="chronoweave")
    sub = parser.add_subparsers(dest="cmd", required=True)
    imp = sub.add_parser("import", help="build and store a dataset")
    imp.add_argument("sources")
    imp.add_argument("rule")
    imp.add_argument("--store", required=True)
    imp.add_argument("--format", default="parquet")
    rd = sub.add_parser("read", help="read a stored dataset back")
    rd.add_argument("dataset")
    rd.add_argument("--store", required=True)
    rd.add_argument("--format", default="parquet")
    rd.add_argument("--out", help="write the unpacked dataset here (Parquet) instead of printing a summary")
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    from chronoweave.plans.dataset_import import import_dataset
    from chronoweave.sources.store import DatasetStore
    from chronoweave.specs import ImportRule, sources_from_json_fields

    spark = spark or SparkSession.builder.appName("chronoweave").getOrCreate()
    store = DatasetStore(spark, args.store, args.format)
    if args.cmd == "import":
        rule = ImportRule.from_json_fields(json.loads(args.rule))
        import_dataset(spark, sources_from_json_fields(args.sources), rule, store)
        print(json.dumps({"dataset": rule.dataset_id, "version": store.latest(rule.dataset_id)[0]}))
    else:
        df = store.load(args.dataset)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        print(json.dumps({"dataset": args.dataset, "columns": df.columns}))
    return 0


if __name__ == "__main__":
    # run as a file (spark-submit .../cli.py): make the package importable from its checkout
    sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(
        __import__("os").path.dirname(__import__("os").path.abspath(__file__)))))
    sys.exit(main())
