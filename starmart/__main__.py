"""``python -m starmart JOB --input PREFIX --output PREFIX``; ``all`` also merges.

``python -m starmart merge [GROUP ...] --warehouse ROOT`` merges what is staged already,
``python -m starmart vacuum --warehouse ROOT --hours N`` deletes what nothing refers to.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starmart.plans.load import JOBS, MERGES, merge_all, run_all, run_job
from starmart.schemas import RATING_TYPE, T, warehouse_specs
from starmart.scratch import remove_old
from starmart.warehouse import Warehouse


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starmart")
    parser.add_argument("job", choices=[*JOBS, "all", "merge", "vacuum"])
    parser.add_argument("groups", nargs="*", help="what to merge (default: all that is staged)")
    parser.add_argument("--input", default="/source", help="prefix of the CSV files")
    parser.add_argument("--output", default="/output", help="prefix of the clean datasets")
    parser.add_argument("--warehouse", default="/warehouse", help="warehouse root, for 'all'")
    parser.add_argument("--required", choices=["output", "all"], default="output")
    parser.add_argument("--on-violation", choices=["fail", "drop"], default="fail")
    parser.add_argument(
        "--dedupe", action="store_true",
        help="keep one row per source key: the smallest in the updated columns",
    )
    parser.add_argument(
        "--dedupe-by", action="append", default=[], metavar="TABLE=COLUMN,...",
        help="as --dedupe, but the smallest in these columns of the table",
    )
    parser.add_argument(
        "--rating-type", default=f"{RATING_TYPE.precision},{RATING_TYPE.scale}",
        metavar="PRECISION,SCALE", help="decimal type of a stored rating",
    )
    parser.add_argument("--database", help="also show the warehouse tables as views in this database")
    parser.add_argument("--rejects", action="store_true", help="with 'all': also write the cells that did not parse")
    parser.add_argument("--hours", type=float, default=168.0, help="for 'vacuum': the age from which on")
    parser.add_argument("--packages", help="connector packages for a new session")
    parser.add_argument("--jdbc-url", help="also append the clean data to staging tables here")
    parser.add_argument("--jdbc-schema", default="movies", help="schema of those tables")
    parser.add_argument(
        "--jdbc-property",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="connection property such as driver, user or password",
    )
    args = parser.parse_args(argv)
    unknown = [g for g in args.groups if args.job != "merge" or g not in MERGES]
    if unknown:
        parser.error(f"not to be merged: {unknown}; choose from {list(MERGES)}")
    by = {t: c.split(",") for t, c in (d.split("=", 1) for d in args.dedupe_by)}
    dedupe = by or args.dedupe
    rating_type = T.DecimalType(*map(int, args.rating_type.split(",")))

    jdbc = None
    if args.jdbc_url:
        properties = dict(p.split("=", 1) for p in args.jdbc_property)
        jdbc = {"url": args.jdbc_url, "schema": args.jdbc_schema, "properties": properties}
    builder = SparkSession.builder.appName(f"starmart {args.job}")
    if args.packages:
        builder = builder.config("spark.jars.packages", args.packages)
    spark = builder.getOrCreate()
    options = {"required": args.required, "jdbc": jdbc}
    if args.job == "all":
        run_all(
            spark,
            args.input,
            args.output,
            args.warehouse,
            on_violation=args.on_violation,
            dedupe=dedupe,
            rating_type=rating_type,
            database=args.database,
            rejects=args.rejects,
            **options,
        )
    elif args.job == "merge":
        warehouse = Warehouse(spark, args.warehouse, warehouse_specs(rating_type), args.database)
        merge_all(warehouse, args.groups or None, args.on_violation, dedupe)
    elif args.job == "vacuum":
        gone = Warehouse(spark, args.warehouse, warehouse_specs(rating_type)).vacuum(args.hours)
        print("\n".join([*gone, *remove_old(spark, args.hours)]))
    else:
        run_job(spark, args.job, args.input, args.output, **options)


if __name__ == "__main__":
    main()
