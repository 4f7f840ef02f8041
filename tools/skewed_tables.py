"""Make larger, skewed tables from the given ones, for timings: python tools/skewed_tables.py FROM TO [TIMES]

events, orders and lineitem are repeated TIMES (20) times under new keys, and a third of their rows is moved to a
single key; the other tables are copied. Everything is derived from the given rows, so it is the same on each run.
"""

import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marketlake.session import build_session  # noqa: E402

# Key that makes a row new (null: none), and the foreign key of which a third becomes one value.
GROWN = {"events": ("event_id", "user_id"), "orders": ("o_orderkey", "o_custkey"), "lineitem": ("l_orderkey", "l_orderkey")}
COPIED = ("region", "nation", "customer", "supplier", "part")


def main(source: str, target: str, times: int = 20) -> None:
    spark = build_session("skewed-tables", "local[*]", spark__driver__memory="8g")
    for name in COPIED:
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{target}/{name}.parquet")
    for name, (key, hot) in GROWN.items():
        rows = spark.read.parquet(f"{source}/{name}.parquet")
        last, first = rows.agg(F.max(key), F.min(hot)).first()
        copy = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
        more = rows.withColumn("_copy", copy).withColumn(key, (F.col(key) + F.col("_copy") * (last + 1)).cast(rows.schema[key].dataType))
        third = F.pmod(F.xxhash64(*more.columns), F.lit(3)) == 0
        more.withColumn(hot, F.when(third, F.lit(first)).otherwise(F.col(hot)).cast(rows.schema[hot].dataType)).drop("_copy").write.parquet(
            f"{target}/{name}.parquet"
        )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], *map(int, sys.argv[3:4]))
