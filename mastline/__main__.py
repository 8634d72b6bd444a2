"""Run the pipeline for one date or a range: ``python -m mastline --source ... --base ...``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from mastline import Engine, build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="mastline", description=__doc__)
    parser.add_argument("--source", required=True, help="folder the daily files arrive in")
    parser.add_argument("--base", required=True, help="folder of the bronze, silver and gold tables")
    parser.add_argument("--date", help="logical date of a daily run (default: today, UTC)")
    parser.add_argument("--start", help="first date of a backfill; needs --end")
    parser.add_argument("--end", help="last date of a backfill; needs --start")
    parser.add_argument("--run-id", help="name of this run in the ledger")
    parser.add_argument("--tz", default="UTC", help="time zone of the freshness check")
    parser.add_argument("--strict", action="store_true", help="type checks as a whole-file reader infers them")
    args = parser.parse_args(argv)

    date = args.date or datetime.now(timezone.utc).strftime("%Y-%m-%d")
    run_id = args.run_id or f"manual__{datetime.now(timezone.utc):%Y%m%dT%H%M%S}"
    engine = Engine(build_session(), args.source, args.base, tz=args.tz, strict=args.strict)
    rows = engine.run(run_id, date, args.start, args.end).orderBy("execution_date", "table_name")
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


if __name__ == "__main__":
    main()
