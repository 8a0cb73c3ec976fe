"""Command line: build a star, the query tables, the arrivals star, or run one refresh.

    python -m starloom.jobs star --log LOG --songs SONGS --out OUT [--preset lake] [--staged]
    python -m starloom.jobs query-tables --events CSV_FOLDER --out OUT
    python -m starloom.jobs refresh --log LOG --songs SONGS --out OUT [--preset hourly]
        [--plain] [--max-error N] [--files-per-batch N]
    python -m starloom.jobs arrivals --arrivals PARQUET --temperatures CSV --demographics CSV
        --ports TXT --countries TXT --out OUT [--distinct]

The master and the resources come from spark-submit; `--master` is for a local run.
"""

from __future__ import annotations

import argparse

from starloom.contracts import CITY_DEMOGRAPHICS_CSV, CITY_TEMPERATURE_CSV, SONG_CATALOG
from starloom.plans.arrivals import run_arrivals_star
from starloom.plans.plays import HOURLY, PRESETS, run_play_star
from starloom.plans.query_tables import run_query_tables
from starloom.plans.refresh import run_hourly
from starloom.session import build_session, clear_scratch
from starloom.sources.files import (
    scan_arrivals, scan_country_codes, scan_csv, scan_json, scan_port_codes,
)


# Presets with a key that an incremental fact can rely on.
REFRESH_PRESETS = {"hourly": HOURLY, **{k: p for k, p in PRESETS.items() if p.key == "row"}}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starloom.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    needed = {
        "star": ["log", "songs", "out"],
        "query-tables": ["events", "out"],
        "refresh": ["log", "songs", "out"],
        "arrivals": ["arrivals", "temperatures", "demographics", "ports", "countries", "out"],
    }
    for job, names in needed.items():
        sub = jobs.add_parser(job)
        sub.add_argument("--master")
        for name in names:
            sub.add_argument(f"--{name}", required=True)
        if job == "star":
            sub.add_argument("--preset", choices=list(PRESETS), default="default")
            sub.add_argument("--staged", action="store_true")
        if job == "refresh":
            sub.add_argument("--preset", choices=list(REFRESH_PRESETS), default="hourly")
            sub.add_argument("--plain", dest="staged", action="store_false")
            sub.add_argument("--max-error", type=int, default=0)
            sub.add_argument("--files-per-batch", type=int)
        if job == "arrivals":
            sub.add_argument("--distinct", action="store_true")
            sub.add_argument("--format", default="parquet")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> dict[str, str]:
    args = _arguments(argv)
    spark = build_session(f"starloom-{args.job}", args.master)
    if args.job == "star":
        paths = run_play_star(
            spark, args.log, args.songs, args.out, PRESETS[args.preset], args.staged
        )
    elif args.job == "query-tables":
        paths = run_query_tables(spark, args.events, args.out)
    elif args.job == "refresh":
        paths = run_hourly(
            spark, args.log, scan_json(spark, args.songs, SONG_CATALOG, arrival=True), args.out,
            REFRESH_PRESETS[args.preset], args.staged, args.max_error, args.files_per_batch,
        )
    else:
        paths = run_arrivals_star(
            scan_arrivals(spark, args.arrivals, args.format),
            scan_csv(spark, args.temperatures, CITY_TEMPERATURE_CSV),
            scan_csv(spark, args.demographics, CITY_DEMOGRAPHICS_CSV, sep=";"),
            scan_port_codes(spark, args.ports),
            scan_country_codes(spark, args.countries),
            args.out,
            args.distinct,
        )
    clear_scratch(spark)
    return paths


if __name__ == "__main__":
    for table, path in main().items():
        print(f"{table}: {path}")
