"""python -m statuta.cli FOLDER LAW FROM TO [-s SECTION] [--no-color]: the difference of two versions of a law."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .api import LawStore, render
from .plans.laws import section_rows


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="statuta", description=__doc__)
    for name in ("folder", "law", "old", "new"):
        p.add_argument(name)
    p.add_argument("-s", "--section")
    p.add_argument("--no-color", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("statuta").getOrCreate()
    store = LawStore(section_rows(spark, a.folder))
    try:
        print(render(store.diff(a.law, a.old, a.new, section_id=a.section), f"{a.law}: {a.old} → {a.new}", not a.no_color))
    except LookupError as e:
        known = [r.abbrev for r in store.laws().limit(20).collect()]
        print(f"{e}. Known laws: {', '.join(known)}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
