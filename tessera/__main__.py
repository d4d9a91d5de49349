"""Run the report as a batch job.

    spark-submit --py-files tessera.zip -m tessera \\
        --sources /data/sources --history /data/report_history \\
        --cutoff 2026-08-11 --out /data/report \\
        [--append-history --roll-to 2026-09-01]

Sources are read by name from ``--sources`` (a Parquet folder per table)
or from catalog tables with ``--table-prefix``. ``--rep-aliases`` names a
two-column Parquet table (source_name, alias); without that table the run
needs ``--no-rep-aliases``. The history must be readable, except on a run
that is marked ``--first-run``. With ``--append-history`` the live rows
dated before ``--roll-to`` are written into the history folder as the roll
from the cutoff to that date (running the job again replaces this roll), so
the next run with cutoff ``--roll-to`` reads them instead of recomputing
them. A roll that would overlap the history or leave a gap is refused, as is
a history that ends before the cutoff. ``--source name=place`` names the
place of a single source, a path or a catalog table.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from tessera.config import ReportConfig
from tessera.plans.report import DATE_COL, Report, with_labels
from tessera.session import get_session
from tessera.sources import SourceCatalog, read_history, write_history, write_report


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__.split("\n\n")[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--sources", help="folder holding one Parquet folder per source table")
    src.add_argument("--table-prefix", help="read sources as catalog tables <prefix><name>")
    p.add_argument("--source", action="append", default=[], metavar="NAME=PLACE",
                   help="path or catalog table of one source, instead of --sources or --table-prefix; repeatable")
    p.add_argument("--history", help="history folder (Part A)")
    p.add_argument("--cutoff", type=dt.date.fromisoformat, default=ReportConfig().cutoff)
    p.add_argument("--out", required=True, help="output folder for the report")
    p.add_argument("--labels", action="store_true", help="write display labels as column names")
    p.add_argument("--rep-aliases", help="Parquet table (source_name, alias) of sales-rep spellings")
    p.add_argument("--no-rep-aliases", action="store_true", help="no sales-rep name needs an alias")
    p.add_argument("--key-mode", choices=("binary_rtrim", "binary", "ci_rtrim"), default=ReportConfig().key_mode,
                   help="do trailing blanks of keys count (binary) or not (binary_rtrim, the default), or case, either (ci_rtrim)")
    p.add_argument("--unique-lookups", action="store_true",
                   help="fail at a lookup key that has several rows, instead of multiplying report rows")
    p.add_argument("--duplicates-out", help="output folder for the keys that multiply report rows")
    p.add_argument("--first-run", action="store_true", help="there is no history yet: do not read --history")
    p.add_argument("--append-history", action="store_true",
                   help="also write live rows dated before --roll-to into --history")
    p.add_argument("--roll-to", type=dt.date.fromisoformat, help="upper date bound for --append-history")
    return p.parse_args(argv)


def check_args(args: argparse.Namespace) -> None:
    """Refuse contradictory arguments before anything is read or written."""
    if args.append_history and not (args.history and args.roll_to):
        raise SystemExit("--append-history needs --history and --roll-to")
    if args.append_history and args.roll_to <= args.cutoff:
        raise SystemExit("--roll-to must be after --cutoff")
    if args.first_run and not args.history:
        raise SystemExit("--first-run is about --history, which is not given")
    if any(not all(s.partition("=")) for s in args.source):
        raise SystemExit("--source takes NAME=PLACE")


def main(argv: list[str] | None = None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    check_args(args)
    spark = get_session(app_name="tessera-report")
    frames = {}
    if args.rep_aliases:
        frames["rep_aliases"] = spark.read.parquet(args.rep_aliases)
    # a history that cannot be read is an error: the report would lack Part A
    history = (read_history(spark, args.history, before=args.cutoff, date_col=DATE_COL)
               if args.history and not args.first_run else None)
    src = SourceCatalog(spark, frames=frames, parquet_root=args.sources, table_prefix=args.table_prefix,
                        history=history, locations=dict(s.split("=", 1) for s in args.source))
    cfg = ReportConfig(cutoff=args.cutoff, key_mode=args.key_mode, rep_aliases=() if args.no_rep_aliases else None,
                       unique_lookups=args.unique_lookups)
    report = Report(src, cfg)
    out = report.build()
    write_report(with_labels(out) if args.labels else out, args.out)
    for name, rows in report.multiplied().items():
        print(f"lookup {name}: repeated keys added {rows} rows", file=sys.stderr)
    if args.duplicates_out:
        report.duplicates().write.mode("overwrite").parquet(args.duplicates_out)
    if args.append_history:
        # live rows are dated on/after the cutoff, where the roll begins
        live = report.live().where(F.col(DATE_COL) < F.lit(args.roll_to))
        write_history(live, args.history, DATE_COL, roll=args.roll_to, start=args.cutoff)
    report.release()
    return 0


if __name__ == "__main__":
    sys.exit(main())
