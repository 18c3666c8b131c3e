"""The jobs on the command line, for ``spark-submit`` or ``python -m chanpulse``::

    python -m chanpulse transform RAW_DIR OUT_DIR
    python -m chanpulse load PROCESSED_DIR WAREHOUSE_DIR [--loader narrow] [--mode quarantine]
    python -m chanpulse check WAREHOUSE_DIR
    python -m chanpulse report WAREHOUSE_DIR
    python -m chanpulse run LANDED_DIR WORK_DIR [--max-videos N]

``--as-of`` sets the run's time (ISO, UTC; by default now).  What a job found (paths, counts,
the report) is printed as JSON, but for the report, which is text.  A failed check or a broken
rule ends with an error.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from .plans import load as loading
from .plans.quality import quality_check
from .plans.report import render, summary_report
from .plans.run import run
from .plans.transform import transform
from .session import build_session


def _time(text: str) -> dt.datetime:
    t = dt.datetime.fromisoformat(text)
    return t.astimezone(dt.timezone.utc).replace(tzinfo=None) if t.tzinfo else t


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="chanpulse", description=__doc__.split("::")[0])
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--as-of", type=_time, default=None)
    tables = argparse.ArgumentParser(add_help=False)
    tables.add_argument("--database", default=None)
    tables.add_argument("--video-buckets", type=int, default=16)
    rules = argparse.ArgumentParser(add_help=False)
    rules.add_argument("--loader", choices=["full", "narrow"], default="full")
    rules.add_argument("--on-duplicate", choices=["error", "last"], default="error")
    jobs = top.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("transform", parents=[common])
    job.add_argument("raw_dir")
    job.add_argument("out_dir")
    job.add_argument("--multiline", action="store_true")
    job = jobs.add_parser("load", parents=[common, tables, rules])
    job.add_argument("processed_dir")
    job.add_argument("warehouse_dir")
    job.add_argument("--mode", choices=["fail", "quarantine"], default="fail")
    for name in ("check", "report"):
        jobs.add_parser(name, parents=[common, tables]).add_argument("warehouse_dir")
    job = jobs.add_parser("run", parents=[common, tables, rules])
    job.add_argument("landed_dir")
    job.add_argument("work_dir")
    job.add_argument("--max-videos", type=int, default=None)
    return top


def main(argv: list[str] | None = None) -> None:
    a = arguments().parse_args(argv)
    spark = build_session()
    now = a.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if a.job == "transform":
        res = transform(spark, a.raw_dir, a.out_dir, now, multiline=a.multiline)
        found = {"paths": res.paths, "summary": res.summary, "rejects": res.rejects}
    elif a.job == "load":
        res = loading.load(spark, a.processed_dir, a.warehouse_dir, now, a.loader, mode=a.mode,
                           video_buckets=a.video_buckets, on_duplicate=a.on_duplicate,
                           database=a.database)
        found = {"merged": res.merged, "summary": res.summary,
                 "quarantined": {k: df.count() for k, df in res.quarantined.items()}}
    elif a.job == "run":
        res = run(spark, a.landed_dir, a.work_dir, now, a.loader, a.max_videos, a.video_buckets,
                  a.on_duplicate, a.database)
        found = {"raw": res.raw, "rejects": res.reply_rejects, "merged": res.load.merged,
                 "fresh": res.fresh}
        print(render(res.report))
    else:
        wh = loading.warehouse(spark, a.warehouse_dir, a.video_buckets, database=a.database)
        if a.job == "report":
            print(render(summary_report(wh.channels.read(), wh.videos.read())))
            return
        found = quality_check(wh, now)
    print(json.dumps(found, default=str, sort_keys=True))


if __name__ == "__main__":
    main()
