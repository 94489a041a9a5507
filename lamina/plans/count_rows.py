"""Print the number of rows of a parquet directory."""

from __future__ import annotations

import argparse

from lamina.operators.conform import MONTH, YEAR
from lamina.session import job
from lamina.sources.files import row_count


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--path", required=True)
    parser.add_argument("--year", type=int, help="only this ingest year")
    parser.add_argument("--month", type=int, help="only this ingest month")
    args = parser.parse_args(argv)
    with job("count_rows") as spark:
        rows = row_count(spark, args.path, {YEAR: args.year, MONTH: args.month})
    print(rows)


if __name__ == "__main__":
    main()
