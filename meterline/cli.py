"""Command line for the batch jobs.

  python -m meterline.cli ingest  --landing L --warehouse W --batch B
  python -m meterline.cli run     --warehouse W [--customer C] [--batch B]
  python -m meterline.cli STAGE   --warehouse W [--customer C] [--batch B]
      STAGE: raw-model | sessionize | segregate | curate

Prints the stage metrics as one JSON line. On a cluster the session comes
from spark-submit; the shared checkpoint folder is read from
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from meterline.params import SessionParams
from meterline.plans import pipeline as P
from meterline.session import configure, ensure_checkpoint_dir


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="meterline")
    ap.add_argument("stage", choices=["ingest", "run", "raw-model", "sessionize", "segregate", "curate"])
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--landing")
    ap.add_argument("--customer")
    ap.add_argument("--batch")
    ap.add_argument("--gap-seconds", type=int, default=SessionParams().gap_seconds)
    ap.add_argument("--credit-floor", type=float, default=SessionParams().credit_floor)
    a = ap.parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"meterline-{a.stage}").getOrCreate())
    ensure_checkpoint_dir(spark)
    wh = P.Warehouse(a.warehouse)
    params = SessionParams(gap_seconds=a.gap_seconds, credit_floor=a.credit_floor)
    if a.stage == "ingest":
        if not (a.landing and a.batch):
            ap.error("ingest needs --landing and --batch")
        out = P.ingest(spark, a.landing, wh, a.batch)._asdict()
    elif a.stage == "run":
        out = P.run_batch(spark, wh, a.customer, a.batch, params)
    elif a.stage == "raw-model":
        out = P.raw_model(spark, wh, a.customer, a.batch)
    elif a.stage == "sessionize":
        out = P.sessionize(spark, wh, a.customer, a.batch, params)[1]
    elif a.stage == "segregate":
        out = P.segregate(spark, wh, a.customer, a.batch)
    else:
        out = P.curate(spark, wh, a.customer, a.batch)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
