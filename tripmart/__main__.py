"""Command line: refresh the warehouse, answer a question, run the checks.

    python -m tripmart refresh --landing DIR --zones-csv FILE --root DIR
    python -m tripmart question q03_top_pickup_zones --root DIR [--year 2024] [--n 10] [--out DIR]
    python -m tripmart checks --root DIR

``--root`` is where bronze and gold tables live (a shared folder on a cluster),
and the settings that ``refresh`` was given. The session is the submitted one;
without a submitted master Spark runs on this machine. ``question`` writes its
whole answer as Parquet to ``--out``, or prints all of it. ``refresh`` ends with
status 1 when a month file could not be read, unless ``--allow-failed``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import inspect
import json

from pyspark.sql import DataFrame, SparkSession

from tripmart.config import REFERENCE, Settings
from tripmart.session import session


def _settings(args):
    kw = {}
    for name in ("calendar_start", "calendar_end", "plan_start", "plan_end"):
        v = getattr(args, name, None)
        if v:
            kw[name] = dt.date.fromisoformat(v)
    return REFERENCE.with_(**kw)


DATES = ("calendar_start", "calendar_end", "plan_start", "plan_end")


def _save_settings(spark: SparkSession, root: str, settings: Settings) -> None:
    from tripmart.sources.tables import write_text

    write_text(spark, f"{root}/settings.json", json.dumps({k: getattr(settings, k).isoformat() for k in DATES}))


def _saved_settings(spark: SparkSession, root: str) -> Settings:
    from tripmart.sources.tables import read_text

    text = read_text(spark, f"{root}/settings.json")
    return REFERENCE.with_(**{k: dt.date.fromisoformat(v) for k, v in json.loads(text or "{}").items()})


def _print_all(df: DataFrame) -> None:
    """Every row, tab-separated, one partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tripmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("--landing", required=True)
    r.add_argument("--zones-csv", required=True)
    r.add_argument("--root", required=True)
    for name in ("calendar-start", "calendar-end", "plan-start", "plan-end"):
        r.add_argument(f"--{name}")
    r.add_argument("--allow-failed", action="store_true")
    q = sub.add_parser("question")
    q.add_argument("name")
    q.add_argument("--root", required=True)
    q.add_argument("--year", type=int)
    q.add_argument("--n", type=int)
    q.add_argument("--min-trips", type=int)
    q.add_argument("--out")
    c = sub.add_parser("checks")
    c.add_argument("--root", required=True)
    args = ap.parse_args(argv)
    spark = session()

    if args.cmd == "refresh":
        from tripmart.sources.landing import read_zone_lookup
        from tripmart.warehouse import refresh

        settings = _settings(args)
        out = refresh(spark, args.landing, read_zone_lookup(spark, args.zones_csv),
                      args.root, settings)
        _save_settings(spark, args.root, settings)
        print(json.dumps({"loads": out.loads, "checks": out.checks}, default=str))
        if any(x.get("failed_months") for x in out.loads.values()) and not args.allow_failed:
            raise SystemExit(1)
    elif args.cmd == "question":
        from tripmart.operators.gold import read_star
        from tripmart.plans.questions import QUESTIONS

        star = read_star(spark, f"{args.root}/gold", _saved_settings(spark, args.root))
        fn = QUESTIONS[args.name]
        accepted = inspect.signature(fn).parameters
        kw = {k: v for k, v in (("year", args.year), ("n", args.n),
                                ("min_trips", args.min_trips)) if v is not None and k in accepted}
        answer = fn(star, **kw)
        if args.out:
            answer.write.mode("overwrite").parquet(args.out)
        else:
            _print_all(answer)
    else:
        from tripmart.operators import checks as K
        from tripmart.operators.gold import read_star
        from tripmart.operators.silver import silver_trips
        from tripmart.warehouse import bronze_tables

        star = read_star(spark, f"{args.root}/gold", _saved_settings(spark, args.root))
        yellow, green, zones = bronze_tables(spark, args.root)
        models = {"silver_trips": silver_trips(yellow, green, zones), "zone_lookup": zones,
                  "dim_service_type": star.dim_service_type,
                  "dim_payment_type": star.dim_payment_type, "dim_zone": star.dim_zone,
                  "dim_date": star.dim_date, "fct_trips": star.fct}
        _print_all(K.run_checks(spark, K.REFERENCE_SUITE, models))


if __name__ == "__main__":
    main()
