"""python -m biblioforge --out FOLDER --wos FILE... --scopus FILE --scimago FILE --country FILE [--works FILE]"""

import argparse


def main() -> None:
    from pyspark.sql import SparkSession

    from .plans.pipeline import preprocess

    p = argparse.ArgumentParser(prog="biblioforge")
    p.add_argument("--out", required=True)
    p.add_argument("--wos", nargs="*")
    for name in ("scopus", "scimago", "country", "works"):
        p.add_argument(f"--{name}")
    p.add_argument("--kind", default="parquet", choices=("parquet", "csv"))
    a = p.parse_args()
    preprocess(SparkSession.builder.getOrCreate(), a.out, a.wos, a.scopus, a.scimago, a.country, a.works, a.kind)


if __name__ == "__main__":
    main()
