"""``python -m harrow.publish payload.json``: puts a briefing into the published document.

The document's url, branch and the token come from HARROW_PUBLISH_URL, HARROW_PUBLISH_BRANCH and HARROW_PUBLISH_TOKEN.
"""

from __future__ import annotations

import datetime as dt
import os
import sys

from harrow.sources.readers import read_briefings
from harrow.sources.versioned import Versioned, publish_briefings


def main(arguments: list[str]) -> int:
    if len(arguments) != 1:
        print("usage: python -m harrow.publish payload.json", file=sys.stderr)
        return 2
    token = os.environ.get("HARROW_PUBLISH_TOKEN", "").strip()
    if not token:
        raise RuntimeError("HARROW_PUBLISH_TOKEN is not set")
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.getOrCreate()
    target = Versioned(os.environ["HARROW_PUBLISH_URL"], token, os.environ.get("HARROW_PUBLISH_BRANCH", "main"))
    n = publish_briefings(spark, read_briefings(spark, arguments[0]), target, dt.datetime.now(dt.UTC).isoformat(timespec="seconds"))
    print(f"{n} briefings are published")
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
