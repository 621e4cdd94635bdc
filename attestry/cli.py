"""Entry points: python -m attestry.cli csv|pages. Exit code 0 and counts alone, or 1 and what is wrong."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from attestry.errors import AttestryError
from attestry.sources import browser, csv_import, pages


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="attestry")
    kinds = out.add_subparsers(dest="kind", required=True)
    table = kinds.add_parser("csv", help="import a strict CSV with its sidecar")
    table.add_argument("--input", required=True)
    table.add_argument("--root", required=True, help="the private folder that input and output must lie in")
    shown = kinds.add_parser("pages", help="import a rendered table, page by page")
    shown.add_argument("--url", required=True)
    for x in (table, shown):
        x.add_argument("--season", required=True)
        x.add_argument("--output", required=True)
    return out


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None, source: Callable[[str], pages.PageSource] = browser.BrowserSource, now: Callable[[], str] = csv_import.utc_now) -> int:
    asked = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("attestry").getOrCreate()
    try:
        if asked.kind == "csv":
            counts = csv_import.run_import(spark, asked.input, asked.season, asked.output, asked.root, now)
        else:
            made = pages.import_pages(spark, source(asked.url), asked.season, asked.output, asked.url, now)
            counts = {"pages": made["collection"]["observed_page_count"], "rows": made["collection"]["total_physical_row_count"]}
    except AttestryError as e:
        print(e, file=sys.stderr)
        return 1
    print(" ".join(f"{k}={v}" for k, v in counts.items()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
