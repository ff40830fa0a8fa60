"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import tempfile
import time

import numpy as np
from pyspark.sql import SparkSession

from splatframe.plans.assets import to_ply, to_spz
from splatframe.plans.queries import QUERIES
from splatframe.sources import formats, ply

NAMES = ("a01_extent", "p29_sh_transpose", "p08_sh_flip", "p16_smallest_three", "o01_top_n", "o03_reindex", "j03_palette", "j04_compare", "v01_option_pipeline")
#: Splats of degree 3 in the files that are read.
SPLATS = (139_410, 500_000)


def write_files(folder: str, n: int) -> None:
    r = np.random.default_rng(n)
    columns, rest = {name: r.normal(size=n) for name in ply.REQUIRED}, r.normal(size=(n, 45)) / 4
    for kind, encode in (("ply", to_ply), ("spz", to_spz)):
        with open(f"{folder}/{n}.{kind}", "wb") as f:
            f.write(encode(columns, rest))


def main() -> None:
    path, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}

    def timed(name: str, make) -> None:
        runs = []
        for _ in range(3):  # the first one compiles
            began = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name] = round(min(runs), 4)

    for name in NAMES:
        timed(name, lambda name=name: QUERIES[name](spark, path))
    formats.register(spark)
    with tempfile.TemporaryDirectory() as folder:  # of this machine: the benchmark is local
        for n in SPLATS:
            write_files(folder, n)
            for kind in ("ply", "spz"):
                timed(f"open_{kind}_{n}", lambda kind=kind, n=n: spark.read.format(f"splat_{kind}").option("decoded", "true").load(f"{folder}/{n}.{kind}"))
                timed(f"meta_{kind}_{n}", lambda kind=kind, n=n: spark.read.format(f"splat_{kind}").option("metadataOnly", "true").load(f"{folder}/{n}.{kind}"))
    per_million = {k: round(v / int(k.rsplit("_", 1)[1]) * 1e6, 3) for k, v in took.items() if k.startswith("open_")}
    print(json.dumps({"metric": "seconds for all headline queries, best of three", "value": round(sum(took.values()), 4), "unit": "sec", "queries": took, "seconds_per_million": per_million, "sf": os.path.basename(path.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
