"""Command line: ``python -m cohortspark <job> --config job.json``.

Jobs: ``integrate`` (cohort files -> long cells + labels), ``expert`` (one
modality -> OOF predictions, fold scores, models), ``stack`` (OOF tables ->
stacker OOF and report).  The config holds the job function's arguments;
``sources`` for ``integrate`` is a list of cohort-source objects.
"""

from __future__ import annotations

import argparse
import json

from .plans import jobs
from .session import build_session
from .sources.ingest import CohortSource


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="cohortspark")
    ap.add_argument("job", choices=["integrate", "expert", "stack"])
    ap.add_argument("--config", required=True)
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    with open(args.config) as f:
        cfg = json.load(f)
    spark = build_session(args.master)
    if args.job == "integrate":
        cfg["sources"] = [CohortSource(**s) for s in cfg["sources"]]
        out = jobs.integration_job(spark, **cfg)
    elif args.job == "expert":
        out = jobs.expert_job(spark, **cfg)
    else:
        out = jobs.stacking_job(spark, **cfg)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
